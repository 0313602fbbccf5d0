"""Operators that place rows: mixing, sharding, packing, archives, neighbours."""

import hashlib
import random
import zlib
from base64 import b32encode
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry.compare import difference, duck
from trendlake.llm.mixing import SCHEDULES, mix, mixed, row_hash, targets, training_time, units_of
from trendlake.llm.neighbours import nearest
from trendlake.llm.packing import Tokens, bin_patterns, cut, default_vocabulary, fullest, pack, sequences
from trendlake.llm.queries import ORACLES, QUERIES
from trendlake.llm.sharding import Range, deal, shard_documents, shard_keys
from trendlake.llm.warc import archive_round_trip, decode_message, plan_records, read_archives, write_archives

from .helpers import awkward, documents, words


# Mixing

def brute_targets(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_ = {}, set(order)
    left = budget * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return {**out, **share}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def test_targets_stop_and_share(spark):
    rng = random.Random(1)
    for _ in range(4):
        rows = [(i, words(rng, rng.randint(0, 50)), "en", rng.choice(["b", "a", None, "Z", "é", "small"][:rng.randint(1, 6)])) for i in range(60)]
        rows += [(1000, words(rng, 900), "en", "a")]
        sizes = Counter()
        for _, t, _, s in rows:
            sizes[s] += len(t.split())
        got = {r["source"]: r["target"] for r in targets(units_of(documents(spark, rows))).collect()}
        expected = brute_targets(dict(sizes))
        assert got.keys() == expected.keys()
        for s in expected:
            assert got[s] == pytest.approx(expected[s])


def test_mix_meets_targets(spark):
    rng = random.Random(2)
    rows = awkward() + [(500 + i, words(rng, rng.randint(1, 80)), "en", rng.choice("abcd")) for i in range(300)]
    docs = documents(spark, rows)
    out = mix(docs, block_rows=13).collect()
    assert len(out) == len(rows)
    taken, target = Counter(), {}
    for r in out:
        assert r["taken"] == r["passes"] * r["size"] and 0 <= r["passes"] <= 2 and len(r["positions"]) == r["passes"]
        assert all(0 <= p <= 1 for p in r["positions"])
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for s in target:
        # No document left out would bring the source nearer to its target.
        gap, own = round(target[s]) - taken[s], [r for r in out if r["source"] == s]
        left_out = [r["size"] for r in own if r["passes"] == min(x["passes"] for x in own) and r["size"]]
        assert all(abs(gap - n) >= abs(gap) for n in left_out), (s, taken[s], target[s])
    again = mix(docs.repartition(7), block_rows=13).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)

    drawn = mixed(docs, block_rows=13)
    assert drawn.columns == docs.columns
    passes = Counter()
    for r in out:
        passes[r["row_hash"]] += r["passes"]
    counts = Counter(r["h"] for r in drawn.withColumn("h", row_hash(docs)).collect())
    assert counts == {k: n for k, n in passes.items() if n}
    assert mix(documents(spark, [])).count() == 0 and mixed(documents(spark, [])).count() == 0


@pytest.mark.parametrize("share", [0.1, 0.33, 0.87])
def test_equal_rows_are_taken_one_by_one(spark, share):
    rng, n = random.Random(8), 1500
    hot = [(None, words(rng, 20), "en", "a")] * int(n * share)
    rows = hot + [(i, words(rng, rng.randint(10, 30)), "en", rng.choice("ab")) for i in range(n - len(hot))]
    out = mix(documents(spark, rows), block_rows=50)
    sums = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert all(abs(r["taken"] - r["target"]) <= r["most"] / 2 + 1 for r in sums) and out.count() == n
    assert out.where("taken > 2 * size").count() == 0
    assert mixed(documents(spark, rows), block_rows=50).count() == out.agg(F.sum("passes")).first()[0]


def test_mix_places_every_pass_in_training_order(spark):
    rng = random.Random(9)
    rows = awkward() + [(None, "x y z", "en", "a")] * 40 + [(500 + i, words(rng, rng.randint(0, 60)), "en", rng.choice("abc")) for i in range(300)]
    out = mix(documents(spark, rows), block_rows=13).collect()
    assert len(out) == len(rows) and all(len(r["places"]) == len(r["positions"]) == r["passes"] for r in out)
    stream = sorted((place, position) for r in out for place, position in zip(r["places"], r["positions"]))
    assert [place for place, _ in stream] == list(range(sum(r["passes"] for r in out)))
    assert [position for _, position in stream] == sorted(position for _, position in stream)


def test_training_time_inverts_the_schedule(spark):
    df = spark.range(0, 101).select((F.col("id") / 100).alias("share"))
    for i, knots in enumerate(SCHEDULES):
        x, y = np.array(knots).T
        grid = np.linspace(0, 1, 20_001)
        area = np.concatenate(([0], np.cumsum((np.interp(grid, x, y)[1:] + np.interp(grid, x, y)[:-1]) / 2 * np.diff(grid))))
        for r in df.select("share", training_time(F.col("share"), F.lit(i), SCHEDULES).alias("t")).collect():
            assert np.interp(r["t"], grid, area / area[-1]) == pytest.approx(r["share"], abs=1e-4)


# Sharding

def test_sharding_law_and_slots(spark, tmp_path):
    rng = random.Random(3)
    hot = words(rng, 30)
    rows = awkward() + [(500 + i, hot if i % 4 == 0 else words(rng, rng.randint(1, 40)), "en", "a") for i in range(1200)]
    docs = documents(spark, rows)
    out = shard_keys(docs, shards=4, sample_rows=2000).collect()
    assert len(out) == len(rows)
    sizes, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    for r in out:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(sizes) == {0, 1, 2, 3}
    by_id = Counter((repr(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert by_id == Counter((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in out)
    # The awkward rows hold one text that alone is larger than a shard; beside it the shards are even.
    small = shard_keys(documents(spark, [r for r in rows if r[0] != 12]), shards=4, sample_rows=2000).collect()
    sizes, homes = Counter(), defaultdict(set)
    for r in small:
        sizes[r["shard"]] += r["size"]
        homes[r["text_crc32"]].add(r["shard"])
    assert max(sizes.values()) < 1.15 * min(sizes.values())
    assert len(homes[zlib.crc32(hot.encode())]) <= 2 and all(len(s) == 1 for k, s in homes.items() if k != zlib.crc32(hot.encode()))
    shard_documents(docs, str(tmp_path / "s"), shards=4, sample_rows=2000)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(rows)
    assert shard_keys(documents(spark, [])).count() == 0


@pytest.mark.parametrize("share", [0.075, 1 / 3])
@pytest.mark.parametrize("place", [0, 100, 311, 517, 1000, 1024])
def test_a_hot_key_leaves_shards_even(share, place):
    sizes, ranges = [1000] * 1024, [Range(10 * i, 10 * i + 10) for i in range(1024)]
    hot = round(share / (1 - share) * sum(sizes))
    ranges.insert(place, Range(10 * place, 10 * place + 1))
    sizes.insert(place, hot)
    held, total = Counter(), sum(sizes)
    for size, (first, ends) in zip(sizes, deal(ranges, sizes, 16)):
        for i, (a, b) in enumerate(zip([0, *ends], [*ends, 1])):
            held[first + i] += size * (b - a)
    assert all(abs(held[i] * 16 / total - 1) < 0.05 for i in range(16))


def test_equal_rows_of_a_hot_text_are_dealt(spark, tmp_path):
    rng = random.Random(6)
    hot = words(rng, 20)
    docs = documents(spark, [(None, hot, "en", "a")] * 1500 + [(i, words(rng, 20), "en", "a") for i in range(3000)])
    out = shard_keys(docs, shards=8, sample_rows=2000)
    sizes = [r["n"] for r in out.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.3 * min(sizes)
    shard_documents(docs, str(tmp_path / "s"), shards=8, sample_rows=2000)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4500


# Packing

@pytest.mark.parametrize("share", [0.1, 0.33, 0.87])
def test_equal_rows_keep_the_law(spark, share):
    """Rows equal in id and text, drawn with a chance far below 1 a row: shards stay even."""
    rng, n = random.Random(9), 20_000
    text = words(rng, 30)
    rows = [(None, text, "en", "a")] * int(n * share) + [(i, words(rng, rng.randint(5, 60)), "en", "a") for i in range(int(n * (1 - share)))]
    out = shard_keys(documents(spark, rows).select("doc_id", "text"), shards=8, sample_rows=500)
    sums = [r[0] for r in out.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sums) == 8 and max(sums) < 1.1 * min(sums)
    slots = out.groupBy("shard").agg(F.count_distinct("slot").alias("n"), F.max("slot").alias("last")).collect()
    assert sum(r["n"] for r in slots) == len(rows) and all(r["last"] == r["n"] - 1 for r in slots)


def test_fullest_is_the_best_sum():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        room = rng.randint(0, 60)
        got = fullest(sorted(counts, reverse=True), counts, room)
        assert all(n <= counts[length] for length, n in Counter(got).items())
        reach = {0}
        for length, n in counts.items():
            reach = {s + i * length for s in reach for i in range(n + 1)}
        assert sum(got) == max(s for s in reach if s <= room)


def test_patterns_use_all_pieces_and_few_bins():
    rng = random.Random(5)
    counts = Counter(rng.randint(1, 1024) for _ in range(5000))
    patterns = bin_patterns(dict(counts), 1024)
    used = Counter()
    for lengths, bins in patterns:
        assert sum(lengths) <= 1024 and bins > 0
        for length in lengths:
            used[length] += bins
    assert used == counts
    total = sum(k * n for k, n in counts.items())
    assert sum(b for _, b in patterns) <= 1.01 * total / 1024 + 1


def test_cut_lets_only_the_first_piece_be_shorter():
    for n in (1, 5, 1023, 1024, 1025, 2048, 3000):
        parts = cut(n, 1024)
        assert [s for s, _ in parts] == list(np.cumsum([0] + [m for _, m in parts[:-1]])) and sum(m for _, m in parts) == n
        assert all(m == 1024 for _, m in parts[1:]) and 0 < parts[0][1] <= 1024


def test_packing_round_trip(spark):
    rows = awkward()
    docs = documents(spark, rows)
    out = pack(docs).collect()
    tokens = Tokens(default_vocabulary())
    expected = Counter()
    for i, text, *_ in rows:
        ids = np.array(tokens.slow.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        for k, (start, length) in enumerate(cut(len(ids), 1024)):
            expected[(i, k, start, length, zlib.crc32(ids[start:start + length].tobytes()))] += 1
    assert expected == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out)
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts[:-1]])) and sum(n for _, n in parts) <= 1024
    assert len(bins) <= -(-sum(r["length"] for r in out) // 1024) + 1
    assert pack(documents(spark, [])).count() == 0
    whole = sequences(docs).collect()
    assert sorted(len(r["ids"]) for r in whole) == sorted(sum(n for _, n in parts) for parts in bins.values())


def test_tokens_equal_the_reference_library():
    tokens, rng = Tokens(default_vocabulary()), random.Random(6)
    texts = ["", " a  b", "\n\n x", "<|endoftext|> hi", "don't we'll", "漢字 😀", "''s !'s", "\r\n\t x \n y", " " * 5000, "a" * 50_000, "\x00\x1c x"]
    texts += ["".join(rng.choice(" \n\t'sdab1!é漢\u0085<|>") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    for text in texts:
        assert tokens.ids(text).tolist() == tokens.slow.encode(text, add_special_tokens=False).ids


# Archives

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, name string, copy long")


def test_archives(spark):
    rng = random.Random(7)
    long = words(rng, 8_000) + " é漢字"
    rows = [(1, "http://a/1", long), (2, "http://a/2\r\nX: y", long), (3, None, ""), (4, "http://a/4", None), (5, "u", "é"), (6, "u", "WARC/1.1\r\n\r\n\r\n"),
            (7, "u", "é"), (7, "u", "é"), (8, "u", "once"), (None, "u", "é"), (None, "v", "lone"), (-3, "u", "x" * 4096), (9, "u", "x" * 4097)]
    table = pages(spark, [(*r, "n", 1) for r in rows])
    out = archive_round_trip(table, segment_bytes=1000, chunk_bytes=300, file_records=7).collect()
    lead = {}
    for i, _, html in rows:
        lead[html or ""] = max([x for x in (lead.get(html or ""), i) if x is not None], default=None)
    expected, seen = [], set()
    for i, _, html in rows:
        data, answer = (html or "").encode(), i == lead[html or ""] and (i, html or "") not in seen
        seen.add((i, html or ""))
        expected.append((i, len(data), b32encode(hashlib.sha1(data).digest()).decode(), "response" if answer else "revisit", None if answer else lead[html or ""]))
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)
    short = archive_round_trip(table, min_bytes=3).where("payload_bytes < 3").collect()
    assert short and all(r["record_type"] == "response" and r["refers_to"] is None for r in short)
    assert archive_round_trip(pages(spark, [])).count() == 0


def test_every_record_has_the_url_of_its_row(spark):
    rows = [(None, f"http://a/{i % 5}", "", "n", 1) for i in range(10)] + [(7, "u", "é", "n", 1), (7, "v", "é", "n", 1), (7, None, "é", "n", 1)]
    plan = plan_records(pages(spark, rows)).collect()
    assert sorted((r["url"] or "" for r in plan)) == sorted((r[1] or "" for r in rows))
    assert len({(r["name"], r["copy"]) for r in plan}) == len(rows)
    assert [r["record_type"] for r in plan].count("response") == 2
    out = archive_round_trip(pages(spark, rows)).collect()
    assert sorted((r["page_id"] or 0, r["refers_to"] or 0) for r in out) == [(0, 0)] * 10 + [(7, 0), (7, 7), (7, 7)]


def test_archives_tell_what_is_wrong(spark, tmp_path):
    table = pages(spark, [(1, "u", "abcdefgh" * 100, "n", 1)])
    write_archives(plan_records(table).coalesce(1), str(tmp_path / "w"), segment_bytes=300, chunk_bytes=50)
    files = [p for p in (tmp_path / "w").iterdir() if p.name.endswith(".gz")]
    import gzip

    whole = b"".join(gzip.decompress(p.read_bytes()) for p in files)
    records = whole.split(b"\r\n\r\nWARC/1.1\r\n")
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "a.warc").write_bytes(b"\r\n\r\nWARC/1.1\r\n".join(records[:1] + records[2:]))
    assert read_archives(spark, str(broken)).first()["problem"] == "a segment is missing or repeated"
    assert read_archives(spark, str(tmp_path / "w"), with_payload=True).first()["payload"] == b"abcdefgh" * 100
    assert decode_message(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nabc")[2] == "a chunk is cut off"


# Neighbours

def test_neighbours_recall_and_awkward_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.standard_normal(12) * rng.uniform(0.5, 2)], 0) for i in range(1500)]
    rows += [(2000 + i, rows[40][1], 0) for i in range(30)] + [(2000, rows[41][1], 0), (60, rows[60][1], 0)]
    rows += [(3000, None, 0), (3020, [], 0), (3040, [0.0] * 12, 0), (3060, [float("nan")] * 12, 0), (None, rows[0][1], 0), (3080, [1.0, 2.0], 0), (3081, [2.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = nearest(df, F.col("vec_id") % 20 == 0, block_rows=400, query_rows=50).collect()
    sound = [(i, np.array(e, dtype=np.float32).astype(float)) for i, e, _ in rows if i is not None and e and np.isfinite(e).all() and any(e)]
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for q, v in {(i, tuple(x)) for i, x in sound if i % 20 == 0 and i < 2000}:
        v = np.array(v)
        best = sorted(((-(x * v).sum(), i) for i, x in sound if i != q and len(x) == len(v)))[:20]
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True) and len(got[q]) == 20
        hits += len({round(-s, 12) for s, _ in best} & {round(s, 12) for _, s in got[q]})
        total += len({round(-s, 12) for s, _ in best})
    assert hits / total > 0.95
    assert got[3080] == [(3081, 6.0)]
    assert not {3000, 3020, 3040, 3060} & set(got)
    assert got[40] == sorted(got[40], key=lambda x: (-x[1], x[0]))  # equal scores: smaller ids first
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, sf_dir)
    relation = duck(sf_dir).sql(ORACLES[name])
    assert difference([tuple(r) for r in df.collect()], df.columns, relation.fetchall(), relation.columns) is None


def test_packing_and_mixing_queries_return_every_document(spark):
    sf_dir = "/root/testdata/sf0.001"
    ids = sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect())
    for name in ("op2_minhash", "op4_sharding", "op6_mixing"):
        assert sorted(r["doc_id"] for r in QUERIES[name](spark, sf_dir).collect()) == ids
    assert sorted({r["doc_id"] for r in QUERIES["op8_packing"](spark, sf_dir).collect()}) == ids
