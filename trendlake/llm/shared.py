"""What the operators of this subpackage share: work tables, numbering, components.

Work tables are Parquet files below the folder that ``spark.checkpoint.dir``
names, so they outlive executors and every executor can read them. A
``Workspace`` removes the tables it no longer needs while it runs; the rest is
removed when the session ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder, shuffles_freed

#: White space of the word rule: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Workspace:
    """A folder of work tables for one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._fs().deleteOnExit(self._hadoop(self.path))

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def table(self, name: str, df: DataFrame, batch_rows: int | None = None) -> DataFrame:
        """Write ``df`` and read it back: its lineage ends here, and so do its shuffles. Functions over Arrow batches get at most ``batch_rows`` rows at once."""
        conf, before = self.spark.conf, self.spark.conf.get(_ARROW_ROWS, None)
        if batch_rows and not 0 < int(conf.get(_ARROW_ROWS)) <= batch_rows:
            conf.set(_ARROW_ROWS, str(batch_rows))
        try:
            with shuffles_freed(self.spark):
                df.write.parquet(self.folder(name))
        finally:
            if batch_rows and before is None:
                conf.unset(_ARROW_ROWS)
            elif batch_rows:
                conf.set(_ARROW_ROWS, before)
        return self.spark.read.schema(df.schema).parquet(self.folder(name))

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            self._fs().delete(self._hadoop(self.folder(name)), True)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each with as many ``_`` before it as no column of ``df`` has, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def unit_hash(*columns: Column | str) -> Column:
    """A number in [0, 1) that only depends on the columns' values."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def crc_bucket(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def numbered(df: DataFrame, keys: list[str], order: list[str], number: str, block_rows: int = 1_000,
             amount: str | None = None, before: str | None = None) -> DataFrame:
    """Number the rows of each group from 0 in a fixed, hashed order.

    A group is cut into blocks by a hash of ``order``; rows are numbered within
    a block and shifted by what the blocks before it hold, so a group with a
    third of all rows is spread like the rest. Rows equal in ``order`` share a
    block: where they may be many, a number written with the rows belongs to it.
    With ``amount`` the column ``before`` gets the sum of the amounts of the
    rows that come earlier in the group. Rows equal in ``order`` follow each
    other in any order.
    """
    width = 1 << 40
    place = df.withColumn("_h", F.pmod(F.xxhash64(*order), F.lit(width)))
    counts = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count("*").alias("_rows"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    blocked = place.join(counts, _all(same)).withColumn(
        "_block", F.floor(F.col("_h").cast("double") / width * F.ceil(F.col("_rows") / block_rows)).cast("bigint")
    ).drop("_h", "_rows", *[f"_k_{k}" for k in keys])
    total = F.sum(amount).cast("bigint") if amount else F.lit(0).cast("bigint")
    blocks = blocked.groupBy(*keys, "_block").agg(F.count("*").alias("_n"), total.alias("_a"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_block").alias("_b"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"),
        F.coalesce(F.sum("_a").over(earlier), F.lit(0)).alias("_shift_a"),
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(F.xxhash64(*order), *order)
    out = blocked.withColumn("_r", F.row_number().over(inside) - 1)
    if amount:
        out = out.withColumn("_s", F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    out = out.join(shifts, _all([*same, F.col("_block") == F.col("_b")]))
    out = out.withColumn(number, (F.col("_r") + F.col("_shift")).cast("bigint"))
    if amount:
        out = out.withColumn(before, (F.coalesce(F.col("_s"), F.lit(0)) + F.col("_shift_a")).cast("bigint"))
    return out.drop("_r", "_s", "_b", "_block", "_shift", "_shift_a", *[f"_k_{k}" for k in keys])


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b``, and no ``b`` is an ``a``: each component is then the star of its root."""
    seen = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    sums = seen.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def _union_find(held_links: int):
    """Links of a partition as trees: each node with the least node it is joined to; at most ``held_links`` links are held."""

    def trees(links: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(links)
        ends = pa.chunked_array(table["a"].chunks + table["b"].chunks).combine_chunks().dictionary_encode()
        names = ends.dictionary.to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        place = np.empty(len(names), dtype=np.int64)
        place[order] = np.arange(len(names))
        codes = place[ends.indices.to_numpy()]
        parent = list(range(len(names)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for a, b in zip(codes[:len(table)].tolist(), codes[len(table):].tolist()):
            a, b = root(a), root(b)
            if a != b:  # the smaller one becomes the root, so a root is the least of its tree
                parent[max(a, b)] = min(a, b)
        below = [(names[order[x]], names[order[root(x)]]) for x in range(len(names)) if parent[x] != x]
        return pa.table({"a": pa.array([a for a, _ in below], table.schema.field("a").type),
                         "b": pa.array([b for _, b in below], table.schema.field("b").type)})

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, held_links):
                held.append(batch.slice(at, held_links))
                rows += held[-1].num_rows
                if rows >= held_links:
                    held, kept = trees(held).to_batches(), rows
                    rows = sum(b.num_rows for b in held)
                    if rows * 2 > kept:  # little was joined: these trees are done
                        yield from held
                        held, rows = [], 0
        if rows:
            yield from trees(held).to_batches()

    return contract


def components(links: DataFrame, work: Workspace, name: str = "components", max_rounds: int = 60, held_links: int = 100_000) -> DataFrame:
    """Connected components: columns ``node`` and ``root``, the smallest node reachable.

    ``links`` has the columns ``a`` and ``b`` of any ordered type. A union-find
    in every partition of the links leaves trees, each node with the least one of
    its tree; a node takes the least root of its trees as label. What joins trees
    of different partitions are links between roots alone, a graph as large as the
    trees are many, whose components come from star steps. So the links of a hub
    stay where they are, in trees of their partitions. Only nodes with a link are returned.
    """
    sound = links.select("a", "b").where("a <> b")
    trees = work.table(f"{name}-trees", sound.mapInArrow(_union_find(held_links), sound.schema).distinct())
    labels = work.table(f"{name}-labels", trees.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")))
    roots = trees.select(F.col("b").alias("r")).distinct()
    apart = trees.join(labels, F.col("a") == F.col("node")).where("b <> label").select("b", "label")
    below = labels.join(roots, F.col("node") == F.col("r"), "left_semi")
    across = work.table(f"{name}-0", apart.union(below).select(
        F.greatest("b", "label").alias("a"), F.least("b", "label").alias("b")).distinct())
    own = roots.join(labels, F.col("r") == F.col("node"), "left_anti").select(F.col("r").alias("node"), F.col("r").alias("label"))
    labelled = labels.union(own)
    if across.isEmpty():
        return labelled.select("node", F.col("label").alias("root"))
    tops = _stars(across, work, name, max_rounds).select(F.col("a").alias("n"), F.col("b").alias("top"))
    return labelled.join(tops, F.col("label") == F.col("n"), "left").select("node", F.coalesce("top", "label").alias("root"))


def _stars(edges: DataFrame, work: Workspace, name: str, max_rounds: int) -> DataFrame:
    """``a, b``: every node but the roots with the root of its component, by alternating the large-star and the small-star step.

    Every node hands its smallest neighbour to the others; both steps are one
    grouping and one join on the hub. It ends when all links are stars around a
    root. ``edges`` are distinct, with ``a > b``, and stored as ``name-0``.
    """
    kept = f"{name}-0"
    for turn in range(1, max_rounds + 1):
        if _are_stars(edges):
            return edges
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        least = least.select("n", F.least("n", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("n"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        small = small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges = work.table(f"{name}-{turn}", small)
        work.drop(kept)
        kept = f"{name}-{turn}"
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
