"""Landing raw API payloads in bronze, and checking what has landed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import normal_region, region_list


def with_pipeline_metadata(payloads: DataFrame, moment: Column, source: str, count_items: bool = True) -> DataFrame:
    """Payload rows with their ``_pipeline_metadata`` struct.

    ``moment`` is the time of ingestion; payloads without an ``items`` array
    count 0 videos.
    """
    fields = [
        F.date_format(moment, K.INGESTION_ID_FORMAT).alias("ingestion_id"),
        normal_region("region").alias("region"),
        F.date_format(moment, K.ISO_TIMESTAMP_FORMAT).alias("ingestion_timestamp"),
    ]
    if count_items:
        items = F.size("items") if "items" in payloads.columns else F.lit(0)
        fields.append(F.greatest(F.coalesce(items, F.lit(0)), F.lit(0)).cast("bigint").alias("video_count"))
    return payloads.withColumns({
        "_pipeline_metadata": F.struct(*fields, F.lit(source).alias("source")),
        "region": normal_region("region"),
        "date": F.date_format(moment, K.DATE_PARTITION_FORMAT),
        "hour": F.date_format(moment, K.HOUR_PARTITION_FORMAT),
    })


def land_payloads(
    payloads: DataFrame, path: str, kind: str = "statistics", *,
    moment: Column | None = None, source: str = "api", mode: str = "append",
) -> None:
    """Write payload rows as JSON, one document per line.

    Trending documents go to ``region/date/hour``, category documents to
    ``region/date``. ``payloads`` has a ``region`` column and the fields of one
    API answer.
    """
    if kind not in ("statistics", "reference"):
        raise ValueError(f"unknown kind {kind!r}")
    statistics = kind == "statistics"
    moment = F.current_timestamp() if moment is None else moment
    landed = with_pipeline_metadata(payloads, moment, source, count_items=statistics)
    folders = ["region", "date", "hour"] if statistics else ["region", "date"]
    if not statistics:
        landed = landed.drop("hour")
    landed.hint("rebalance", *folders).write.mode(mode).partitionBy(*folders).json(path)


def ingestion_coverage(
    landed: DataFrame, expected: str | Iterable[str] | DataFrame = K.LANDED_REGIONS,
    runs: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """Expected regions against landed documents, per ingestion run.

    One row per run and expected region: documents and videos that arrived,
    and whether any did; regions that landed without being expected follow with
    ``expected`` false. ``expected`` is a list of codes or a DataFrame with a
    ``region`` column. ``runs`` (ids, or a DataFrame with ``ingestion_id``) are
    reported even when nothing of them landed; without it only runs that landed
    something are known.
    """
    meta = F.col("_pipeline_metadata")
    spark = landed.sparkSession
    if not isinstance(expected, DataFrame):
        expected = spark.createDataFrame([(code,) for code in sorted(set(region_list(expected)))], "region string")
    codes = expected.select(normal_region("region").alias("region")).distinct()
    arrived = landed.groupBy(
        meta["ingestion_id"].alias("ingestion_id"), normal_region(meta["region"]).alias("region")
    ).agg(F.count(F.lit(1)).alias("documents"), F.sum(meta["video_count"]).alias("videos"))
    known = arrived.select("ingestion_id")
    if runs is not None:
        if not isinstance(runs, DataFrame):
            runs = spark.createDataFrame([(run,) for run in runs], "ingestion_id string")
        known = known.union(runs.select("ingestion_id"))
    # The report has a row for each run and expected region, so this product is its size.
    wanted = known.distinct().crossJoin(codes).withColumn("expected", F.lit(True))
    found = arrived.withColumnsRenamed({"ingestion_id": "_run", "region": "_region"})
    same = F.col("ingestion_id").eqNullSafe(F.col("_run")) & F.col("region").eqNullSafe(F.col("_region"))
    met = wanted.join(found, same, "full")
    is_expected = F.coalesce("expected", F.lit(False))
    return met.select(
        F.when(is_expected, F.col("ingestion_id")).otherwise(F.col("_run")).alias("ingestion_id"),
        F.when(is_expected, F.col("region")).otherwise(F.col("_region")).alias("region"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("videos", F.lit(0)).alias("videos"),
        F.col("documents").isNotNull().alias("landed"),
        is_expected.alias("expected"),
    )


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """Per run: regions expected and landed, the codes that failed and those that were not expected."""
    return coverage.groupBy("ingestion_id").agg(
        F.count_if("expected").alias("regions_total"),
        F.count_if(F.col("expected") & F.col("landed")).alias("regions_landed"),
        F.array_sort(F.collect_list(F.when(~F.col("landed"), F.col("region")))).alias("failed_regions"),
        F.array_sort(F.collect_list(F.when(~F.col("expected"), F.col("region")))).alias("unexpected_regions"),
    )
