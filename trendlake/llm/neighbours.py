"""Approximate nearest neighbours by collision counting.

The nearest rows are those with the largest inner product. Rows are lifted to a
sphere (``x`` becomes ``[x, sqrt(M^2 - |x|^2)] / M`` with the largest norm ``M``,
a query ``[q / |q|, 0]``), where the largest inner product is the least
distance. Rows are dealt to blocks by hash; a block is indexed by ``projections``
sorted arrays, one for each random line. Around a query's place on every line a
window is opened; a row in enough of the windows collides with the query and is
verified exactly. Virtual rehashing widens all windows by ``growth`` until the
``k``-th row found lies within the radius the windows stand for, or a window
round has seen the whole block. The best rows of all blocks are merged.

All rows are indexed. The threshold follows from the window: a row at the
radius lands in one window with the probability ``hit``, so it collides in all
but ``miss`` standard deviations of the expected windows.

Queries are a stated set and meet all rows in blocks: a task holds one block of
rows (``block_rows``) and one of queries (``query_rows``).

Defined cases: vectors that are NULL, empty, zero or hold a NULL or non-finite
component take no part, nor do rows without id; vectors of different lengths
are no neighbours; rows with the query's id are its own; a repeated query is one
query, repeated rows are candidates of their own; with fewer candidates than
``k`` all are returned; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Workspace
from .vectors import as_doubles, packed, rows_by_length, unpacked

K = 20
#: Half a window in standard deviations of a projected distance, and the chance to lie within it.
HALF_WINDOW = 1.2
HIT = math.erf(HALF_WINDOW / math.sqrt(2))


def _sound(vectors: DataFrame) -> DataFrame:
    """``vec_id, dim, vector`` (packed) of the rows that take part."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in rows_by_length(batch.column("vector")):
                if len(at):
                    norm = np.sqrt((matrix * matrix).sum(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("vec_id").take(pa.array(at)), pa.array(np.full(len(at), matrix.shape[1], dtype="int32")),
                         pa.array(packed(matrix), pa.binary()), pa.array(norm)], names=["vec_id", "dim", "vector", "norm"])

    rows = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), as_doubles("embedding"))
    return rows.mapInArrow(scan, "vec_id long, dim int, vector binary, norm double")


class BlockIndex:
    """Sorted projections of one block of lifted rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, largest: float, projections: int, seed: int = 7):
        self.ids, self.rows, self.largest = ids, rows, largest
        scaled = rows / largest
        lift = np.sqrt(np.maximum(1.0 - (scaled * scaled).sum(axis=1), 0.0))
        self.lines = np.random.default_rng(seed).standard_normal((rows.shape[1] + 1, projections))
        places = scaled @ self.lines[:-1] + lift[:, None] * self.lines[-1]
        order = places.argsort(axis=0, kind="stable").T
        self.places = np.ascontiguousarray(np.sort(places, axis=0).T)
        # Where each row stands in each sorted array: a row lies in a window when its place does.
        self.ranks = np.empty(order.shape, dtype=np.int32 if len(ids) >= 1 << 15 else np.int16)
        np.put_along_axis(self.ranks, order, np.arange(len(ids), dtype=self.ranks.dtype)[None, :], axis=1)

    def collisions(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many windows each row lies in: queries x rows. The windows are queries x projections."""
        out = np.zeros((len(starts), len(self.ids)), dtype=np.int16)
        kind = self.ranks.dtype
        unsigned = np.uint32 if kind == np.int32 else np.uint16
        for rank, start, width in zip(self.ranks, starts.T.astype(kind), (ends - starts).T.astype(kind)):
            out += (rank[None, :] - start[:, None]).view(unsigned) < width[:, None].view(unsigned)
        return out

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, miss: float, first: float, growth: float, lot: int = 128):
        """For each query the positions and scores of its ``k`` best rows found."""
        m, n = len(self.ranks), len(self.ids)
        needed = math.floor(m * HIT - miss * math.sqrt(m * HIT * (1 - HIT)))
        norms = np.sqrt((queries * queries).sum(axis=1))
        centre = (queries / norms[:, None]) @ self.lines[:-1]
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(queries)
        waiting, radius = np.arange(len(queries)), first
        while len(waiting):
            half = HALF_WINDOW * radius
            starts = np.stack([np.searchsorted(p, centre[waiting, i] - half, "left") for i, p in enumerate(self.places)], axis=1)
            ends = np.stack([np.searchsorted(p, centre[waiting, i] + half, "right") for i, p in enumerate(self.places)], axis=1)
            everything = (ends - starts).min(axis=1) == n
            left = []
            for j, q in enumerate(waiting):
                if j % lot == 0:
                    hits = self.collisions(starts[j:j + lot], ends[j:j + lot])
                found = np.flatnonzero(hits[j % lot] >= needed) if not everything[j] else np.arange(n)
                found = found[self.ids[found] != own[q]]
                if len(found) >= k or everything[j]:
                    scores = self.rows[found] @ queries[q]
                    if len(found) > k:
                        kth = np.partition(scores, len(found) - k)[len(found) - k]
                        # Within rounding of the k-th: the exact scores below decide.
                        near = scores >= kth - 1e-9 * self.largest * norms[q]
                        found = found[near]
                    exact = (self.rows[found] * queries[q]).sum(axis=1)
                    best = np.lexsort((self.ids[found], -exact))[:k]
                    reach = math.sqrt(max(0.0, 2.0 - 2.0 * exact[best[-1]] / (self.largest * norms[q]))) if len(best) else 0.0
                    if everything[j] or reach <= radius:
                        out[q] = (found[best], exact[best])
                        continue
                left.append(q)
            waiting, radius = np.array(left, dtype=np.int64), radius * growth
        return out


def _search_block(largest: float, k: int, projections: int, miss: float, first: float, growth: float):
    def search(table: pa.Table) -> pa.Table:
        asks = table.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
        ids, vectors = table.column("vec_id").to_numpy(), unpacked(table.column("vector"))
        query_ids, ranks, found_ids, scores = [], [], [], []
        if asks.any() and not asks.all():
            index = BlockIndex(ids[~asks], vectors[~asks], largest, projections)
            answers = index.search(vectors[asks], ids[asks], k, miss, first, growth)
            for query, (at, score) in zip(ids[asks], answers):
                query_ids.append(np.full(len(at), query))
                found_ids.append(index.ids[at])
                scores.append(score)
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
        return pa.table({"query_id": join(query_ids, pa.int64()), "vec_id": join(found_ids, pa.int64()), "score": join(scores, pa.float64())})

    return search


def nearest(vectors: DataFrame, is_query: Column, k: int = K, projections: int = 40, miss: float = 0.8, first: float = 0.6,
            growth: float = 1.22, block_rows: int = 4096, query_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each row of ``vectors`` for which ``is_query`` over ``vec_id`` holds."""
    work = Workspace(vectors.sparkSession, "neighbours")
    sound = work.table("sound", _sound(vectors))
    parts = []
    for dim, n, largest in sorted(tuple(r) for r in sound.groupBy("dim").agg(F.count("*"), F.max("norm")).collect()):
        own = sound.where(F.col("dim") == dim).select("vec_id", "vector")
        asked = work.table(f"queries-{dim}", own.where(is_query).distinct())
        blocks, lots = -(-n // block_rows), max(1, -(-asked.count() // query_rows))
        # A row's block must not depend on its id alone: rows that repeat an id are spread as well.
        rows = own.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
        rows = rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
        questions = asked.withColumn("lot", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(lots)).cast("int"))
        questions = questions.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        both = rows.select("block", "lot", "vec_id", "vector", F.lit(False).alias("is_query")).union(
            questions.select("block", "lot", "vec_id", "vector", F.lit(True)))
        parts.append(both.groupBy("block", "lot").applyInArrow(
            _search_block(largest, k, projections, miss, first, growth), "query_id long, vec_id long, score double"))
    if not parts:
        return sound.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = work.table("found", found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
