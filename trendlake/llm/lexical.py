"""Ranked lexical search over all documents, with equal bags of words scored once.

Items are the queries. A document is restricted to the items' vocabulary: its bag
is the sorted list of (term, frequency) it shares with them. Documents with the
same bag and the same length term ``m`` get the same score for every item, so
they form a class: classes are found by a 64-bit hash of both and verified on the
bags themselves, scored once, and expanded to their members in the order of
``doc_id``. Of a class no more members than results are wanted can rank, so it
carries just these; a class of a third of all documents reaches its reducer as a
few rows per map task.

All items are searched, in blocks of about ``block_terms`` distinct terms (items
are never cut); a block's terms and counts pass the driver and go to the tasks.
Documents are read once a block. Corpus counts are taken over all documents.
Scores are integers; sums run in two halves of the values, so that they stay
exact in doubles for items of up to billions of terms.

Terms are the maximal runs of ASCII letters, digits and all code points from
U+0080, with A-Z lowered.

Defined cases: a NULL or empty text has no terms, an item without terms and a
block without matches give no rows; documents equal in score come by ascending
``doc_id``, NULL last; rows with a repeated id are documents of their own, and so
are items: each item row has its own ranks; very long texts are counted in parts
cut between terms; an empty table on either side gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .shared import Workspace, numbered

#: A term in lowered UTF-8; fixed by the search's rule.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
NO_TERM = re.compile(rb"[^0-9a-z\x80-\xff]")
PART_BYTES = 4 << 20
#: Share of the length in the length term, in percent; fixed by the score's formula.
LENGTH_PERCENT = 75
#: Places of a value that its lower half holds.
HALF = 20
#: Sums that are built at once in a task.
LOT = 1 << 21


def term_counts(text: str | None) -> Counter:
    """How often each term stands in the whole text; memory grows with its distinct terms."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    if len(data) <= PART_BYTES:
        return Counter(TERM.findall(data))
    out, at = Counter(), 0
    while at < len(data):
        gap = NO_TERM.search(data, min(at + PART_BYTES, len(data)))
        end = gap.start() if gap else len(data)
        out.update(TERM.findall(data, at, end))
        at = end
    return out


class ItemBlock:
    """Terms of some items: places of the vocabulary, and for each term the items that hold it."""

    def __init__(self, rows: list[tuple[int, bytes, int]]):
        self.items = sorted({r[0] for r in rows})
        self.terms = sorted({r[1] for r in rows})
        self.place = {t: i for i, t in enumerate(self.terms)}
        number = {item: i for i, item in enumerate(self.items)}
        postings = np.array(sorted((self.place[t], number[i], n) for i, t, n in rows), dtype=np.int64).reshape(-1, 3)
        self.starts = np.searchsorted(postings[:, 0], np.arange(len(self.terms) + 1))
        self.item_of, self.times = postings[:, 1].copy(), postings[:, 2].copy()

    def bag(self, counts: Counter) -> bytes:
        """The document's terms of this vocabulary and their frequencies, as sorted places and counts."""
        found = sorted((self.place[t], counts[t]) for t in counts.keys() & self.place.keys())
        return np.array(found, dtype="<u4").reshape(-1, 2).tobytes()

    def weights(self, with_term: dict[int, int], documents: int) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * with_term.get(t, 0) + 1))) for t in range(len(self.terms))], dtype=np.int64)

    def lots(self, rows: np.ndarray, terms: np.ndarray, n_rows: int) -> Iterator[tuple[int, int, int, int]]:
        """Rows, and their entries, that take about ``LOT`` sums."""
        entries = np.searchsorted(rows, np.arange(n_rows + 1))
        work = np.concatenate(([0], np.cumsum((self.starts[terms + 1] - self.starts[terms]))))[entries] + np.arange(n_rows + 1) * len(self.items)
        at = 0
        while at < n_rows:
            end = max(at + 1, int(np.searchsorted(work, work[at] + LOT, side="right")) - 1)
            yield at, end, int(entries[at]), int(entries[end])
            at = end

    def scores(self, rows: np.ndarray, terms: np.ndarray, values: np.ndarray, n_rows: int) -> np.ndarray:
        """Rows x items: sums of the rows' values over the terms of each item, repeats included."""
        degree = self.starts[terms + 1] - self.starts[terms]
        entry = np.repeat(np.arange(len(terms)), degree)
        posting = np.arange(len(entry)) - np.repeat(np.cumsum(degree) - degree, degree) + self.starts[terms][entry]
        cell = rows[entry] * len(self.items) + self.item_of[posting]
        times, value = self.times[posting], values[entry]
        high, low = (np.bincount(cell, weights=(part * times).astype(np.float64), minlength=n_rows * len(self.items)).astype(np.int64)
                     for part in (value >> HALF, value & ((1 << HALF) - 1)))
        return ((high << HALF) + low).reshape(n_rows, len(self.items))


class _Best:
    """The highest classes of each item so far: by score, then by the smallest id of a member."""

    def __init__(self, items: int, limit: int):
        self.limit, self.least = limit, np.ones(items, dtype=np.int64)
        self.held = np.zeros((0, 4), dtype=np.int64)  # item, score, first id, class

    def add(self, scores: np.ndarray, first: np.ndarray, classes: np.ndarray) -> None:
        least = self.least
        if len(scores) > self.limit:
            least = np.maximum(least, np.partition(scores, -self.limit, axis=0)[-self.limit])
        row, item = np.nonzero(scores >= least)
        rows = np.concatenate((self.held, np.stack((item, scores[row, item], first[row], classes[row]), axis=1)))
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        start = np.searchsorted(rows[:, 0], rows[:, 0])
        self.held = rows[np.arange(len(rows)) - start < self.limit]
        full = np.searchsorted(self.held[:, 0], np.arange(len(self.least)), side="right")
        count = full - np.searchsorted(self.held[:, 0], np.arange(len(self.least)))
        ready = count == self.limit
        self.least[ready] = self.held[full[ready] - 1, 1]


def _item_terms(items: DataFrame, work: Workspace, block_terms: int) -> tuple[DataFrame, DataFrame, int]:
    """Stored ``item_no, item_id`` and ``block, item_no, term, times``, and the number of blocks."""
    rows = work.table("items", items.select("item_id", "text", F.monotonically_increasing_id().alias("item_no")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_no").to_pylist(), batch.column("text").to_pylist()):
                found = sorted(term_counts(text).items())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array([t for t, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())],
                    ["item_no", "term", "times"])

    terms = work.table("terms", rows.select("item_no", "text").mapInArrow(count, "item_no long, term binary, times long"))
    sizes = terms.groupBy(F.col("item_no").alias("_item")).agg(F.count("*").alias("_terms")).withColumn("_all", F.lit(0))
    blocks = numbered(sizes, ["_all"], ["_item"], "_n", amount="_terms", before="_before").select(
        "_item", F.floor(F.col("_before") / block_terms).cast("long").alias("block"))
    placed = work.table("blocks", terms.join(blocks, F.col("item_no") == F.col("_item")).drop("_item"))
    last = placed.agg(F.max("block")).first()[0]
    return rows.select(F.col("item_no").alias("_item"), "item_id"), placed, 0 if last is None else last + 1


def search(docs: DataFrame, items: DataFrame, results: int = 10, block_terms: int = 200_000) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``results`` highest-scoring documents of every item."""
    spark = docs.sparkSession
    work = Workspace(spark, "lexical")
    names, terms, blocks = _item_terms(items, work, block_terms)
    found = [_search_block(docs, ItemBlock([tuple(r) for r in rows]), results, work, i)
             for i in range(blocks) if (rows := terms.where(F.col("block") == i).select("item_no", "term", "times").collect())]
    if not found:
        return names.where("false").select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.join(names, F.col("item_no") == F.col("_item")).select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, block: ItemBlock, results: int, work: Workspace, number: int) -> DataFrame:
    bags = work.table(f"bags-{number}", bags_of(docs, block))
    documents, length = bags.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    weights = block.weights(_with_term(bags), documents)
    members = work.table(f"members-{number}", classes_of(bags.where("n > 0"), documents, length or 1, results))
    top = work.table(f"top-{number}", _best_classes(members.where("place = 1"), block, weights, results))
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc("first"), "class")
    top = work.table(f"classes-{number}", top.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= results).drop("_n", "first"))
    # At most ``results`` rows an item are left, and the items of a block are bounded by its terms.
    expanded = members.select(F.col("class").alias("_class"), "doc_id").join(broadcast_if_small(top), F.col("class") == F.col("_class"))
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = expanded.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= results)
    out = work.table(f"found-{number}", ranked.select("item_no", "rank", "doc_id", "score"))
    work.drop(*(f"{name}-{number}" for name in ("bags", "members", "top", "classes")))
    return out


def bags_of(docs: DataFrame, block: ItemBlock) -> DataFrame:
    """``doc_id, n, bag``: all terms of each whole document counted, those of the vocabulary listed."""
    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bags = [], []
            for text in batch.column("text").to_pylist():
                counts = term_counts(text)
                n.append(counts.total())
                bags.append(block.bag(counts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(bags, pa.binary())], ["doc_id", "n", "bag"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(restrict, "doc_id long, n long, bag binary")


def _entries(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and frequency of all entries of some bags, by row."""
    lists = bags.to_pylist()
    pairs = np.frombuffer(b"".join(lists), dtype="<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(lists)), [len(x) // 8 for x in lists]), pairs[:, 0], pairs[:, 1]


def _with_term(bags: DataFrame) -> dict[int, int]:
    """Number of documents that hold each term; one row per term of the block."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            some = np.bincount(_entries(batch.column("bag"))[1], minlength=len(total))
            some[:len(total)] += total
            total = some
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(total[term], pa.int64())], ["term", "docs"])

    counted = bags.select("bag").mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs"))
    return {r[0]: r[1] for r in counted.collect()}


def classes_of(bags: DataFrame, documents: int, length: int, results: int) -> DataFrame:
    """``class, m, bag, doc_id, place``: of each class of equal bags and ``m`` the first ``results`` members.

    The hash comes first among the keys: bags are compared where hashes are equal. The class is named by its
    first member's row, of whom place 1 carries the class.
    """
    shift = 100 - LENGTH_PERCENT
    m = F.expr(f"{shift} + ({LENGTH_PERCENT}L * n * {documents}L) div {length}L")
    keyed = bags.select("doc_id", "bag", m.alias("m"), F.monotonically_increasing_id().alias("_row")).withColumn("_hash", F.xxhash64("bag", "m"))
    same = Window.partitionBy("_hash", "m", "bag")
    placed = keyed.withColumn("place", F.row_number().over(same.orderBy(F.asc_nulls_last("doc_id"), "_row"))).where(F.col("place") <= results)
    return placed.withColumn("class", F.min("_row").over(same)).select("class", "m", "bag", "doc_id", "place")


def _best_classes(classes: DataFrame, block: ItemBlock, weights: np.ndarray, results: int) -> DataFrame:
    """``item_no, class, score, first``: for each task the classes that lead each item."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(block.items), results)
        for batch in batches:
            row, term, times = _entries(batch.column("bag"))
            m, names = (batch.column(c).to_numpy() for c in ("m", "class"))
            first = batch.column("first").to_numpy()
            value = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[row]))
            for start, end, low, high in block.lots(row, term, len(m)):
                sums = block.scores(row[low:high] - start, term[low:high], value[low:high], end - start)
                best.add(sums, first[start:end], names[start:end])
        item, total, first, name = best.held.T
        items = np.array(block.items, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (items[item], name, total, first)], ["item_no", "class", "score", "first"])

    rows = classes.select("class", "m", "bag", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("first"))
    return rows.mapInArrow(score, "item_no long, class long, score long, first long")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
asked AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(terms) AS term FROM items) GROUP BY ALL),
held AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, corpus GROUP BY term, n_docs),
sized AS (SELECT d, doc_id, 25 + (75 * len(terms) * n_docs) // n_terms AS m FROM docs, corpus WHERE len(terms) > 0),
scored AS (SELECT i, d, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM asked JOIN held USING (term) JOIN weighed USING (term) JOIN sized USING (d) GROUP BY i, d)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored JOIN items USING (i) JOIN sized USING (d) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) <= 10
"""
