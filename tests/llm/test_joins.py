"""Near-duplicate operators against all pairs by brute force."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trendlake.llm import textscan
from trendlake.llm.embedding_join import near_vectors
from trendlake.llm.minhash import _draw, near_duplicates, super_minhash, without_near_duplicates
from trendlake.llm.shared import Workspace, components as connected, numbered

from .helpers import awkward, components, documents, words


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(found) >= k:
        return {tuple(found[i:i + k]) for i in range(len(found) - k + 1)}
    return {tuple(found)} if found else set()


def brute(rows, k, percent):
    """Expected ``(doc_id, n_shingles, component_id, kept)`` with rows as nodes."""
    sets = [shingles(text, k) for _, text, *_ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    group = components(range(len(rows)), links)
    out = []
    for i, row in enumerate(rows):
        least = None if row[0] is None else min(rows[j][0] for j in range(len(rows)) if group[j] == group[i])
        out.append((row[0], len(sets[i]), least, row[0] == least if row[0] is not None else True))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_awkward_rows(spark, k, percent):
    rows = awkward()
    assert found(near_duplicates(documents(spark, rows), k, percent)) == brute(rows, k, percent)


def test_near_duplicates_chain_and_crowd(spark):
    """A chain whose ends are unlike, and a crowd of near copies: no link is lost, whoever leads."""
    rng = random.Random(5)
    rows, text = [], words(rng, 150).split()
    for i in range(25):
        rows.append((1000 - i, " ".join(text), "en", "a"))
        text[(i * 4) % 150] = f"n{i}"
    crowd = words(rng, 200).split()
    for i in range(60):
        copy = list(crowd)
        copy[rng.randrange(200)] = f"c{i}"
        rows.append((2000 + i, " ".join(copy), "en", "a"))
    passage = words(rng, 40)
    rows += [(3000 + i, passage + " " + words(rng, 60), "en", "a") for i in range(40)]
    expected = brute(rows, 3, 85)
    assert found(near_duplicates(documents(spark, rows))) == expected
    assert found(near_duplicates(documents(spark, rows), rounds=0, crowd=5)) == expected


def test_near_duplicates_small_sets_at_the_threshold(spark):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        text = words(rng, rng.randint(3, 25)).split()
        rows.append((2 * i, " ".join(text), "en", "a"))
        rows.append((2 * i + 1, " ".join(text + ["more"]), "en", "a"))
    assert found(near_duplicates(documents(spark, rows))) == brute(rows, 3, 85)


def test_near_duplicates_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0


def test_without_near_duplicates_keeps_one_of_each(spark):
    rows = awkward()
    docs = documents(spark, rows)
    kept = without_near_duplicates(docs, words=3, percent=85)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.where("doc_id is not null").collect()))
    stay = {d for d, _, _, k in brute(rows, 3, 85) if k and d is not None}
    assert ids == sorted(d for d, _ in {(d, text) for d, text, *_ in rows if d in stay})
    assert kept.where("doc_id is null").count() == 2


def test_signature_is_that_of_the_sequential_method():
    """Level by level over all elements gives what element by element gives."""
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2 ** 63, size=n).astype(np.uint64) for n in (1, 2, 9, 60)]
    for own, row in zip(sets, super_minhash(sets, 40)):
        expected = np.full(40, np.inf)
        for e in own:
            order = list(range(40))
            for j in range(40):
                r, k = _draw(np.array([e], dtype=np.uint64), j, 40)
                order[j], order[k[0]] = order[k[0]], order[j]
                expected[order[j]] = min(expected[order[j]], r[0] + j)
        assert (row == expected).all()


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    estimates = []
    for _ in range(200):
        a = rng.integers(0, 2 ** 63, size=100).astype(np.uint64)
        b = np.concatenate([a[:80], rng.integers(0, 2 ** 63, size=20).astype(np.uint64)])
        x, y = super_minhash([a, b], 160)
        estimates.append((x == y).mean())
    assert abs(np.mean(estimates) - 80 / 120) < 0.01


def test_text_scan_parts_agree(monkeypatch):
    texts = [t for _, t, *_ in awkward()] + ["x" * 9000, "a " * 5000]
    whole = list(textscan.shingle_sets(texts, 3))
    monkeypatch.setattr(textscan, "PART_BYTES", 700)
    for text, a, b in zip(texts, whole, textscan.shingle_sets(texts, 3)):
        assert len(a) == len(shingles(text, 3)) and (a == b).all()


def test_text_scan_holds_little():
    """A task's memory for its scan is that of a lot of texts, not that of a batch."""
    texts = [words(random.Random(i), 2_500) for i in range(20)] * 30
    column = pa.array([None, *texts, ""])
    tracemalloc.start()
    try:
        counts = []
        for part, some in textscan.lots(column):
            sets = list(textscan.shingle_sets(some, 3))
            super_minhash(sets, 160)
            counts += map(len, sets)
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.reset_peak()
        textscan.word_hashes([" ".join(texts[:200])])
        _, of_one = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert counts == [len(shingles(t, 3)) for t in [None, *texts[:20]]] + counts[21:-1] + [0] and len(counts) == len(column)
    assert peak < 40 << 20 and of_one < 40 << 20


def test_whole_texts_go_to_python_in_small_batches(spark, monkeypatch):
    name, seen, table = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, Workspace.table
    before = spark.conf.get(name, None)

    def rows_at_once(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    counted = spark.range(5_000, numPartitions=1).mapInArrow(rows_at_once, "n long")
    sizes = [r["n"] for r in Workspace(spark, "t").table("few", counted, 700).collect()]
    assert sum(sizes) == 5_000 and max(sizes) == 700
    assert spark.conf.get(name, None) == before

    monkeypatch.setattr(Workspace, "table", lambda self, n, df, batch_rows=None: seen.update({n: batch_rows}) or table(self, n, df, batch_rows))
    near_duplicates(documents(spark, awkward()), rounds=0, crowd=1).count()
    scans = [n for n in seen if n == "signed" or n.endswith("-sets")]
    assert {"signed", "verify-across-sets", "crowds-sets"} <= set(scans)
    assert all(seen[n] and seen[n] <= 1_000 for n in scans)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cell string, weight long")


def brute_vectors(rows, similarity):
    unit = []
    for vec_id, e, *_ in rows:
        sound = vec_id is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
        v = np.array(e, dtype=np.float32).astype(float) if sound else None
        unit.append(None if v is None else v / np.linalg.norm(v))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= similarity]
    group, degree = components(range(len(rows)), links), [0] * len(rows)
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    out = []
    for i, row in enumerate(rows):
        least = None if row[0] is None else min(rows[j][0] for j in range(len(rows)) if group[j] == group[i])
        out.append((row[0], degree[i], least, row[0] is None or row[0] == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [dict(), dict(cell_rows=20, block_rows=16, max_pivots=12)])
def test_embedding_join(spark, sizes):
    """Groups of every tightness, copies, scaled copies and rows that take no part; in one cell and in many."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(16)], 0, "c", 1) for i in range(120)]
    for g in range(6):
        centre = rng.standard_normal(16)
        centre /= np.linalg.norm(centre)
        noise = 0.02 * 2 ** g
        rows += [(1000 * (g + 1) + i, [float(x) for x in centre + noise * rng.standard_normal(16)], 0, "c", 1) for i in range(40)]
    rows += [(-1, [2 * x for x in rows[5][1]], 0, "c", 1), (-2, rows[5][1], 0, "c", 1), (-2, rows[5][1], 0, "c", 1)]
    rows += [(9001, None, 0, None, None), (9002, [], 0, "c", 1), (9003, [0.0] * 16, 0, "c", 1), (9004, [1.0] * 8, 0, "c", 1),
             (9005, [1.0] * 8, 0, "c", 1), (9006, [float("nan")] * 16, 0, "c", 1), (9007, [None] + [1.0] * 15, 0, "c", 1),
             (9008, [float("inf")] + [1.0] * 15, 0, "c", 1), (None, rows[5][1], 0, "c", 1)]
    got = near_vectors(vectors(spark, rows), **sizes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_vectors(rows, 0.9)


def test_embedding_join_writes_no_vector_for_those_it_meets(spark, monkeypatch):
    """Vectors without structure meet all others, in several lots; tables hold each of them once, and no shuffle outlives its table."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.standard_normal(16)], 0, "c", 1) for i in range(400)]
    rows += [(1000 + i, [x + 0.01 * float(rng.standard_normal()) for x in rows[i][1]], 0, "c", 1) for i in range(20)]
    seen, table = {}, Workspace.table

    def counted(self, name, df, batch_rows=None):
        out = table(self, name, df, batch_rows)
        seen[name] = (out.count(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        return out

    monkeypatch.setattr(Workspace, "table", counted)
    got = near_vectors(vectors(spark, rows), cell_rows=20, block_rows=16, lot_bytes=16 * 8 * 100)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_vectors(rows, 0.9)
    assert len([name for name in seen if "-lot" in name]) == 5
    assert max(n for n, _ in seen.values()) == len(rows) and sum(n for n, _ in seen.values()) < 5 * len(rows)
    assert {freed for _, freed in seen.values()} == {"false"}


def test_embedding_join_empty_table(spark):
    assert near_vectors(vectors(spark, [])).count() == 0


def test_components_and_numbering(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in connected(df, Workspace(spark, "t")).collect()}
    nodes = {x for pair in links if pair[0] != pair[1] for x in pair}
    assert got == {n: r for n, r in components(range(500), links).items() if n in nodes}

    # Few links held at once, a hub, a chain over all partitions, equal links, and names as bytes.
    many = [(7, i) for i in range(1000, 1400)] + [(i, i + 1) for i in range(2000, 2300)] + links * 2
    rng.shuffle(many)
    expected = {n: r for n, r in components(range(2400), many).items() if n in {x for pair in many if pair[0] != pair[1] for x in pair}}
    spread = spark.createDataFrame(many, "a long, b long").repartition(7)
    assert {r["node"]: r["root"] for r in connected(spread, Workspace(spark, "t"), held_links=20).collect()} == expected
    named = spread.select(*[F.lpad(F.col(c).cast("string"), 4, "0").cast("binary").alias(c) for c in "ab"])
    assert {int(r["node"]): int(r["root"]) for r in connected(named, Workspace(spark, "t")).collect()} == expected
    assert connected(df.limit(0), Workspace(spark, "t")).count() == 0

    rows = [(rng.choice(["a", "b", None]), i % 37, i) for i in range(500)]
    table = spark.createDataFrame(rows, "k string, o long, amount long")
    out = numbered(table, ["k"], ["o", "amount"], "n", block_rows=20, amount="amount", before="sum").collect()
    for key in ("a", "b", None):
        own = sorted((r["n"], r["amount"], r["sum"]) for r in out if r["k"] == key)
        assert [n for n, *_ in own] == list(range(sum(k == key for k, *_ in rows)))
        total = 0
        for _, amount, before in own:
            assert before == total
            total += amount
