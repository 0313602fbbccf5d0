"""Mixing sources to target weights along a time-varying curriculum.

``targets`` shares a budget of words among the sources by weight; no source
gets more than ``max_passes`` times its size. ``mix`` decides which documents
fill each target and where in training they come: a source's weight changes
over training time by a piecewise linear schedule; the integral of the schedule
is the source's cumulative demand, and a document's training position is the
time at which the demand reaches the middle of the document. The positions of all
sources are sorted by ranges and numbered, which gives every pass its place in
the training order.

Documents of a source follow each other by hash. Whole passes take all of
them; the last, partial pass takes documents from the start while they fit, of
those no larger than what is missing, until none fits any more, and then the one
whose size comes nearest to the rest. So a source is off by less than the best
single document can mend, and no text is cut; where one document makes up most
of a source, the target may be out of reach for whole documents.

Sources are numbered and their levels found by windows over one narrow row per
source, in one task: meant for up to some hundred thousand sources.

Defined cases: a NULL text has size 0; a NULL source is a source of its own and
the last one; a NULL doc_id is a value like others; rows equal in all columns
are copies, numbered and taken one by one; documents equal in size follow each
other by hash, sources equal in size per weight by code point; a text of any
length counts whole; sources of size 0 get the target 0; an empty table gives no
rows; further columns are kept by ``mixed``, and else only tell rows apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .shared import WORD, Workspace, free_names, numbered

WEIGHTS = (3, 1, 2)
#: Relative weight of a source over training time, as knots (time, weight), repeating by source like the weights.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row (but maps, which have none)."""
    return F.xxhash64(*(f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"))


def units_of(docs: DataFrame) -> DataFrame:
    """Narrow rows, one per document; of rows equal in all columns the ``copy`` counts from 0, and ``copies`` tells how many there are."""
    equal = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), row_hash(docs).alias("row_hash")
    ).groupBy("doc_id", "source", "size", "row_hash").agg(F.count("*").alias("copies"))
    return equal.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))


def targets(units: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = 1.5, max_passes: int = 2) -> DataFrame:
    """``source, source_size, class, target``: one narrow row per source.

    Sources that would get more than ``max_passes`` times their size stop there.
    Ordered by size per weight these are the first ones, so one running sum
    over the sources finds where stopping ends, and the rest share what is left.
    """
    by_source = units.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ordinal = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("class") + 1)
    sized = by_source.withColumn("class", (ordinal % len(weights)).cast("int")).withColumn("weight", weight)
    rank = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    ahead, rest = rank.rowsBetween(Window.unboundedPreceding, -1), rank.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.col("source_size") * F.lit(max_passes)
    left = F.sum("source_size").over(everything) * F.lit(budget) - F.coalesce(F.sum(cap).over(ahead), F.lit(0))
    level = sized.withColumn("left", left).withColumn("share", F.sum("weight").over(rest))
    level = level.withColumn("stops", F.col("left") * F.col("weight") / F.col("share") >= cap)
    opens = F.min(F.when(~F.col("stops"), F.struct((F.col("source_size") / F.col("weight")).alias("s"), F.coalesce("source", F.lit("")), "left", "share")))
    level = level.withColumn("open", opens.over(everything))
    free = F.col("open.left") * F.col("weight") / F.col("open.share")
    return level.select("source", "source_size", "class", F.when(F.col("stops"), cap.cast("double")).otherwise(free).alias("target"))


def training_time(share: Column, place: Column, schedules: Sequence[Sequence[tuple[float, float]]]) -> Column:
    """The time in [0, 1] at which schedule ``place`` has handed out ``share`` of its whole demand."""
    out = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        area = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
        done = 0.0
        chain = None
        for (a, b), part in zip(zip(knots, knots[1:]), area):
            if part <= 0:
                continue
            need = share * F.lit(sum(area)) - F.lit(done)
            slope = (b[1] - a[1]) / (b[0] - a[0])
            if slope:
                root = F.sqrt(F.greatest(F.lit(a[1] ** 2) + need * F.lit(2 * slope), F.lit(0.0)))
                step = (root - F.lit(a[1])) / F.lit(slope)
            else:
                step = need / F.lit(a[1])
            done += part
            time = F.lit(a[0]) + F.greatest(F.lit(0.0), F.least(step, F.lit(b[0] - a[0])))
            reached = share * F.lit(sum(area)) <= F.lit(done)
            chain = F.when(reached, time) if chain is None else chain.when(reached, time)
        out = F.when(place == i, chain.otherwise(F.lit(knots[-1][0]))).otherwise(out)
    return out


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES, budget: float = 1.5, max_passes: int = 2,
        block_rows: int = 1_000) -> DataFrame:
    """One row per document: ``passes`` through it, ``taken`` words, and ``positions`` and ``places``, one per pass.

    Places number the passes from 0 in training order: by position, then by id,
    hash and copy. A range of positions is sorted by one task and shifted by what
    the ranges before it hold.
    """
    work = Workspace(docs.sparkSession, "places")
    chosen = choose(docs, weights, schedules, budget, max_passes, block_rows)
    own = [c for c in chosen.columns if c != "positions"]
    each = chosen.select(*own, F.posexplode_outer("positions").alias("_pass", "_position"))
    order = [F.asc_nulls_last("_position"), F.asc("doc_id"), F.asc("row_hash"), F.asc("copy"), F.asc("_pass")]
    ranged = work.table("ranged", each.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    # One row for each task of the shuffle.
    sizes = ranged.groupBy(F.col("_range").alias("_r")).agg(F.count("_position").alias("_n"))
    earlier = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_r", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    placed = ranged.withColumn("_number", number).join(F.broadcast(sizes), F.col("_range") == F.col("_r"))
    here = F.struct("_pass", "_position", (F.col("_number") + F.col("_shift")).cast("long").alias("_place"))
    passes = placed.groupBy(*own).agg(F.array_sort(F.collect_list(F.when(F.col("_position").isNotNull(), here))).alias("_passes"))
    return passes.select(*own, F.col("_passes._position").alias("positions"), F.col("_passes._place").alias("places"))


def choose(docs: DataFrame, weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES, budget: float = 1.5, max_passes: int = 2,
           block_rows: int = 1_000) -> DataFrame:
    """``mix`` up to the ``positions``, without the places."""
    work = Workspace(docs.sparkSession, "mixing")
    order = ["doc_id", "row_hash", "size", "copy"]
    units = work.table("units", units_of(docs))
    whole = F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))), F.lit(max_passes)).cast("long")
    share = targets(units, weights, budget, max_passes).withColumn("whole", whole).withColumn(
        "need", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
    share = broadcast_if_small(work.table("targets", share.withColumnRenamed("source", "_source")))
    same = F.col("source").eqNullSafe(F.col("_source"))
    placed = units.withColumn("amount", F.col("size"))
    placed = numbered(placed, ["source"], order, "place", block_rows, "amount", "before").join(share, same).drop("_source")
    placed = work.table("placed", placed.withColumns({"got": F.lit(0).cast("long"), "at": F.lit(None).cast("long")}))
    gap = F.col("need") - F.col("got")
    fits = F.coalesce(F.col("at").isNull() & (F.col("amount") > 0) & (F.col("amount") <= gap), F.lit(False))
    turn = 0
    # Each turn takes at least one document of every source that has one that fits.
    while not placed.where(fits).isEmpty():
        tried = numbered(placed.where(fits), ["source"], order, "_n", block_rows, "amount", "_ahead").drop("_n")
        tried = tried.withColumn("at", F.when(F.col("_ahead") + F.col("amount") <= gap, F.col("got") + F.col("_ahead"))).drop("_ahead")
        filled = work.table(f"filled-{turn}", tried.unionByName(placed.where(~fits)).drop("got"))
        placed = work.table(f"placed-{turn}", _with_got(filled, same, work, f"got-{turn}"))
        work.drop(f"filled-{turn}", "placed" if turn == 0 else f"placed-{turn - 1}")
        turn += 1
    gap = F.col("need") - F.col("got")
    nearest = F.struct(F.abs(F.col("amount") - gap).alias("off"), F.col("place").alias("place"))
    last = placed.where("at is null").where(F.abs(F.col("amount") - gap) < gap).groupBy(F.col("source").alias("_source")).agg(
        F.min(nearest).alias("_filler"))
    chosen = placed.join(broadcast_if_small(work.table("last", last)), same, "left").drop("_source")
    at = F.coalesce("at", F.when(F.col("place") == F.col("_filler.place"), F.col("got")))

    def time(start: Column) -> Column:
        middle = start + F.col("amount") / 2
        return training_time(F.when(F.col("target") > 0, middle / F.col("target")).otherwise(F.lit(0.0)), F.col("class"), schedules)

    positions = F.array(*[
        F.when(F.col("whole") > i, time(F.col("before") + F.col("source_size") * i))
        .when(at.isNotNull() & (F.col("whole") == i), time(at + F.col("source_size") * F.col("whole"))) for i in range(max_passes)
    ])
    positions = F.filter(positions, lambda p: p.isNotNull())
    passes = F.size(positions).cast("long")
    return chosen.select(
        "doc_id", "source", "size", "row_hash", "copy", "copies", "source_size", "target", passes.alias("passes"),
        (F.col("size") * passes).alias("taken"), positions.alias("positions"),
    )


def _with_got(filled: DataFrame, same: Column, work: Workspace, name: str) -> DataFrame:
    """Adds what each source's partial pass holds so far."""
    got = filled.groupBy(F.col("source").alias("_source")).agg(F.coalesce(F.sum(F.when(F.col("at").isNotNull(), F.col("amount"))), F.lit(0)).alias("got"))
    return filled.join(broadcast_if_small(work.table(name, got)), same).drop("_source")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents in training order: a document stands once for each pass, with its columns as they were.

    Of copies it is all one which stands where, so one row of them is joined with all their positions.
    The documents themselves are sorted by ranges of the positions.
    """
    hash_, copies, position, own = free_names(docs, "_mix_hash", "_mix_copies", "_mix_position", "_mix_row")
    chosen = Workspace(docs.sparkSession, "mixing").table("chosen", choose(docs, **options).where("passes > 0").select(
        F.col("row_hash").alias(hash_), F.col("copies").alias(copies), F.explode("positions").alias(position)))
    keyed = docs.withColumn(own, row_hash(docs))
    same = F.col(own) == F.col(hash_)
    single = keyed.join(chosen.where(F.col(copies) == 1), same)
    copied = chosen.where(F.col(copies) > 1)
    rows = keyed.join(broadcast_if_small(copied.select(hash_).distinct()), same, "left_semi").dropDuplicates([own])
    drawn = single.unionByName(rows.join(copied, same))
    return drawn.orderBy(position, "doc_id").select(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "size", "source_size", "target", "taken", "positions", "places")
