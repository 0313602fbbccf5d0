"""Ranked search against the formula computed row by row."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from trendlake.llm import lexical
from trendlake.llm.lexical import OP11_SQL, ItemBlock, op11_lexical, search, term_counts

from .helpers import awkward, documents, words

ITEMS = "item_id long, text string, rank string, doc_id string"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, results=10):
    """``(item_id, rank, doc_id, score)`` of every item row, from the definition."""
    bags = [Counter(terms(d[1])) for d in docs]
    sizes = [b.total() for b in bags]
    n_docs, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for b in bags for t in b)
    out = []
    for item_id, text in items:
        asked, scores = Counter(terms(text)), defaultdict(int)
        for i, bag in enumerate(bags):
            if sizes[i]:
                m = 100 - 75 + (75 * sizes[i] * n_docs) // length
                scores[i] = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 8 * m))
                                for t, n in asked.items() if t in bag)
        order = sorted((-s, docs[i][0] is None, docs[i][0] or 0) for i, s in scores.items() if s > 0)
        out += [(item_id, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(order[:results], 1)]
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ITEMS)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def test_awkward_rows(spark):
    rows = awkward()
    asked = [(1, rows[0][1]), (2, "Two WORDS two words"), (3, None), (4, ""), (5, "漢字 é É ß"), (6, "12 34 nowhere"), (7, rows[17][1]), (7, "one")]
    assert found(search(documents(spark, rows), items_of(spark, asked))) == brute(rows, asked)


def test_classes_ties_and_blocks(spark):
    """Many equal bags in another order of words, ties beyond the limit, items in several blocks."""
    rng = random.Random(1)
    base = [words(rng, 12) for _ in range(6)]
    rows = []
    for i in range(600):
        some = base[i % 6 if i % 3 else 0].split()
        rng.shuffle(some)
        rows.append((rng.randrange(1000) if i % 50 else None, " ".join(some), "en", "a"))
    asked = [(i, " ".join(rng.sample(" ".join(base).split(), 5))) for i in range(30)]
    expected = brute(rows, asked)
    assert found(search(documents(spark, rows).repartition(5), items_of(spark, asked))) == expected
    assert found(search(documents(spark, rows), items_of(spark, asked), block_terms=10)) == expected


def test_small_lots_and_parts_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = words(rng, 80).split()
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 90))), "en", "a") for i in range(300)]
    asked = [(i, " ".join(rng.choices(vocabulary, k=20))) for i in range(12)]
    monkeypatch.setattr(lexical, "LOT", 50)
    block = ItemBlock([(i, t.encode(), n) for i, text in asked for t, n in Counter(text.split()).items()])
    best = lexical._Best(len(block.items), 10)
    bags = [block.bag(term_counts(r[1])) for r in rows]
    row, term, times = lexical._entries(pa.array(bags))
    for start, end, low, high in block.lots(row, term, len(rows)):
        best.add(block.scores(row[low:high] - start, term[low:high], times[low:high], end - start), np.arange(start, end), np.arange(start, end))
    for i, (_, text) in enumerate(asked):
        asked_terms = Counter(text.split())
        scores = sorted(((-sum(Counter(r[1].split())[t] * n for t, n in asked_terms.items()), r[0]) for r in rows))
        assert [(-s, d) for s, d in scores if s][:10] == [(int(x[1]), int(x[2])) for x in best.held if x[0] == i]
    monkeypatch.setattr(lexical, "PART_BYTES", 7)
    for text in [r[1] for r in rows[:40]] + ["x" * 50, "é" * 30 + " " + "A" * 3, "", None, " , "]:
        assert term_counts(text) == Counter(t.encode() for t in terms(text))


def test_empty_tables(spark):
    rows = awkward()
    assert search(documents(spark, []), items_of(spark, [(1, "one")])).collect() == []
    assert search(documents(spark, rows), items_of(spark, [])).collect() == []
    none = search(documents(spark, rows), items_of(spark, [(1, None), (2, "--")]))
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_long_sums_stay_exact():
    block = ItemBlock([(0, b"a", 3_000_000), (0, b"b", 1), (1, b"b", 7)])
    value = np.array([25_000 * 999_999, 12_345_678_901], dtype=np.int64)
    sums = block.scores(np.array([0, 0]), np.array([0, 1]), value, 1)
    assert sums.tolist() == [[int(value[0]) * 3_000_000 + int(value[1]), int(value[1]) * 7]]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_agrees_with_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    df = op11_lexical(spark, folder)
    assert df.dtypes[:4] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    expected = connection.sql(OP11_SQL).fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(expected) and len(expected) > 100
