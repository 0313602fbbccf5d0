"""Sharding into contiguous key ranges of near equal bytes, by sampled splitters.

The key of a record is a hash of its text, so copies of a text are neighbours
and go to one shard. Bytes are first summed by key, so that equal rows, however many,
are one weight. A size-weighted sample of keys gives quantile boundaries; bytes
are counted exactly in the resulting ranges; ranges that turn out overfull are
subdivided by splitters drawn from a denser sample of that range, or in their
middle where the sample holds too little of them, until only ranges of a single
key are overfull. The exact bytes of the ranges then decide which of them form a
shard.

The law is ``bytes``. Shards differ by about one range, a ``1 / ranges_per_shard``
of a shard. A text whose copies alone exceed a range and cross the end of a
shard is the only group that is dealt to several shards: to each it touches in
proportion to the place that is free there, row by row, whatever the rows' ids.

The driver gets about ``sample_rows`` distinct keys a round at most and one row
per range: a key is drawn once, with as many votes as its bytes call for.

Defined cases: a NULL text has no bytes, counts one byte and stands beside the
empty text; NULL or repeated ids are rows like others, and rows equal in all
columns are placed one by one; a text of any length is one row and is never cut;
an empty table gives no rows; further columns are kept by ``shard_documents``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Workspace, numbered, unit_hash


@dataclass(frozen=True)
class Range:
    """Keys over ``low`` up to ``high``; of a single key, the part ``part`` of ``parts``."""

    low: int
    high: int
    parts: int = 1


SMALLEST, LARGEST = -(1 << 63), (1 << 63) - 1


def _sample(weights: DataFrame, rate: float) -> list[int]:
    """Keys with ``rate`` votes a byte; what is left of a whole vote is drawn by the key's hash."""
    votes = F.col("size") * F.lit(rate)
    drawn = F.floor(votes) + F.when(unit_hash(F.col("key"), F.lit("sample")) < votes - F.floor(votes), 1).otherwise(0)
    rows = weights.select("key", drawn.cast("long").alias("votes")).where("votes > 0").collect()
    return sorted(key for key, n in rows for _ in range(n))


def _quantiles(sample: list[int], low: int, high: int, pieces: int) -> list[Range]:
    """Ranges that split the sample evenly; a key that fills a piece alone gets a range of its own."""
    cuts = {high}
    for i in range(1, pieces):
        if sample:
            key = sample[i * len(sample) // pieces]
            cuts.add(key)
            if _width(sample, key) * pieces > len(sample):
                cuts.add(max(low, key - 1))
    edges = sorted(c for c in cuts if low < c <= high)
    return [Range(a, b) for a, b in zip([low, *edges], edges)]


def _width(sample: list[int], key: int) -> int:
    return bisect_left(sample, key + 1) - bisect_left(sample, key)


def _measured(keys: DataFrame, ranges: list[Range]) -> list[int]:
    """Exact bytes of every range."""
    sums = {r[0]: r[1] for r in _with_range(keys, ranges).groupBy("range").agg(F.sum("size")).collect()}
    return [sums.get(i, 0) for i in range(len(ranges))]


def _with_range(keys: DataFrame, ranges: list[Range]) -> DataFrame:
    highs = np.array([r.high for r in ranges], dtype=np.int64)

    @F.pandas_udf("int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for key in batches:
            yield pd.Series(np.searchsorted(highs, key.to_numpy(), side="left").astype("int32"))

    return keys.withColumn("range", place("key"))


def find_ranges(weights: DataFrame, shards: int, ranges_per_shard: int, sample_rows: int) -> tuple[list[Range], list[int]]:
    """Ranges in the order of their keys, and the bytes in each; ``weights`` has one row per key."""
    total = weights.agg(F.sum("size")).first()[0] or 0
    wanted = shards * ranges_per_shard
    ranges = _quantiles(_sample(weights, sample_rows / max(total, 1)), SMALLEST - 1, LARGEST, wanted)
    sizes = _measured(weights, ranges)
    most = 2 * max(1, total // wanted)
    while full := [i for i, (r, n) in enumerate(zip(ranges, sizes)) if n > most and r.high - r.low > 1]:
        bytes_there = sum(sizes[i] for i in full)
        # The whole sample goes to the overfull ranges, so it is denser there than the one before.
        sample = _sample(_with_range(weights, ranges).where(F.col("range").isin(full)), sample_rows / bytes_there)
        split = []
        for i, r in enumerate(ranges):
            own = sample[bisect_left(sample, r.low + 1):bisect_left(sample, r.high + 1)]
            parts = _quantiles(own, r.low, r.high, -(-2 * sizes[i] // most)) if i in full else [r]
            if i in full and len(parts) == 1:
                middle = (r.low + r.high) // 2
                parts = [Range(r.low, middle), Range(middle, r.high)]
            split += parts
        ranges, sizes = split, _measured(weights, split)
    return ranges, sizes


def deal(ranges: list[Range], sizes: list[int], shards: int) -> list[tuple[int, list[float]]]:
    """First shard of each range, and the shares of the range at which its next shards begin (for a key larger than a range)."""
    total, before, out = sum(sizes), 0, []
    most = 2 * max(1, total // max(1, len(ranges)))
    for r, size in zip(ranges, sizes):
        first = min(shards - 1, (2 * before + size) * shards // max(1, 2 * total))
        ends = []
        if r.high - r.low == 1 and size > most:
            first = min(shards - 1, before * shards // total)
            last = min(shards - 1, (before + size - 1) * shards // total)
            # A shard takes what lies between its own two ends, so what it holds of other keys counts.
            ends = [(total * (i + 1) / shards - before) / size for i in range(first, last)]
        out.append((first, ends))
        before += size
    return out


def shard_keys(docs: DataFrame, shards: int = 16, ranges_per_shard: int = 64, sample_rows: int = 50_000) -> DataFrame:
    """``doc_id, size, text_crc32, key, shard, slot``: one narrow row per document."""
    work = Workspace(docs.sparkSession, "sharding")
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = work.table("keys", docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"), F.monotonically_increasing_id().alias("row"),
    ))
    weights = work.table("weights", keys.groupBy("key").agg(F.sum("size").alias("size")))
    ranges, sizes = find_ranges(weights, shards, ranges_per_shard, sample_rows)
    places = deal(ranges, sizes, shards)
    table = docs.sparkSession.createDataFrame(
        [(i, a, ends) for i, (a, ends) in enumerate(places)] or [(0, 0, [])], "range int, first int, ends array<double>")
    placed = _with_range(keys, ranges).join(F.broadcast(table), "range")
    # The row number is written with the keys, so equal rows are dealt one by one and a repeated task deals them alike.
    part = unit_hash(F.col("doc_id"), F.col("row"), F.lit("part"))
    beyond = F.size(F.filter("ends", lambda e: part >= e))
    placed = placed.withColumn("shard", (F.col("first") + beyond).cast("int"))
    return numbered(placed.drop("range", "first", "ends"), ["shard"], ["key", "doc_id", "row"], "slot").drop("row")


def shard_documents(docs: DataFrame, folder: str, **options) -> None:
    """Write whole documents as Parquet, one folder per shard."""
    placed = shard_keys(docs, **options).groupBy(F.col("key").alias("__key"), F.col("doc_id").alias("__id"), "shard").agg(F.count("*").alias("__n"))
    # Rows equal in text and id may lie in several shards: each shard takes as many of them as it was dealt.
    upto = Window.partitionBy("__key", "__id").orderBy("shard")
    placed = placed.withColumn("__to", F.sum("__n").over(upto)).withColumn("__from", F.col("__to") - F.col("__n"))
    placed = placed.withColumn("__parts", F.count("*").over(Window.partitionBy("__key", "__id")))
    keyed = docs.drop("shard").withColumn("__text", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    keyed = Workspace(docs.sparkSession, "sharding").table("rows", keyed.withColumn("__row", F.monotonically_increasing_id()))
    names = ["__text", "doc_id"]
    split = placed.where("__parts > 1").select(F.col("__key").alias("__k"), F.col("__id").alias("__i")).distinct()
    rows = keyed.select(*names, "__row").join(split, (F.col("__text") == F.col("__k")) & F.col("doc_id").eqNullSafe(F.col("__i")))
    turns = numbered(rows.drop("__k", "__i"), names, ["__row"], "__turn").select(F.col("__row").alias("__r"), "__turn")
    keyed = keyed.join(turns, F.col("__row") == F.col("__r"), "left")
    turn = F.coalesce(F.col("__turn"), F.lit(0))
    same = (F.col("__text") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    own = (F.col("__parts") == 1) | ((turn >= F.col("__from")) & (turn < F.col("__to")))
    joined = keyed.join(placed, same & own)
    joined.select(*[f"`{c}`" for c in docs.columns if c != "shard"], "shard").write.partitionBy("shard").parquet(folder)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_keys(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
