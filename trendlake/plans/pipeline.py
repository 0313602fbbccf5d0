"""Silver, quality gate, gold: the data order of one pipeline run."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import region_filter
from ..schemas import COUNTERS, SILVER_PARTITIONS
from ..operators import quality
from ..operators.aggregates import categories_of_parts, channel_totals, daily_parts, days_of_parts, rank_channels, stamped
from ..operators.reference import EmptyReferenceError, clean_reference, reference_items
from ..operators.sinks import reference_metrics, statistics_metrics, write_partitioned
from ..operators.versions import publish
from ..operators.statistics import finish_statistics, latest_statistics, prepare_statistics
from ..session import delete_path, shuffles_freed, work_path
from ..sources.tables import read_table, read_table_if_present


@dataclass(frozen=True)
class PipelineConfig:
    """Where the layers live and what they are called.

    Paths are folders; table names are optional and register the folders in
    the catalog. With ``gold_versions`` each full or regional build of gold is
    written beside the one before, and readers of its names change over at once
    (``operators.versions``); ``plans.refresh`` writes in place and refuses such gold.
    """

    silver_path: str
    gold_path: str
    silver_database: str | None = None
    gold_database: str | None = None
    statistics_table: str = "clean_statistics"
    reference_table: str = "clean_reference_data"
    statistics_partitions: tuple[str, ...] = SILVER_PARTITIONS
    statistics_job: str = "bronze-to-silver"
    reference_job: str = "bronze-to-silver"
    reference_mode: str = "merge"
    keep_recency: bool = True  # store the ingestion time, for later merges
    rules: dict[str, quality.QualityRules] = field(default_factory=lambda: {
        "clean_statistics": quality.STATISTICS_RULES,
        "clean_reference_data": quality.REFERENCE_RULES,
    })

    gold_versions: bool = False

    def __post_init__(self) -> None:
        if self.gold_versions and not self.gold_database:
            raise ValueError("versions of gold need a gold_database, whose names are switched")

    def silver(self, name: str) -> str:
        return f"{self.silver_path.rstrip('/')}/{name}"

    @property
    def changes(self) -> str:
        """Regions and days that merges have touched."""
        return self.silver(f"{self.statistics_table}_changes")

    def gold(self, name: str) -> str:
        return f"{self.gold_path.rstrip('/')}/{name}"

    def table(self, database: str | None, name: str) -> str | None:
        return f"{database}.{name}" if database else None


def run_pipeline(
    spark: SparkSession,
    statistics: DataFrame,
    reference: DataFrame | None,
    config: PipelineConfig,
    *,
    regions: Iterable[str] | None = None,
    recency: Column | str | None = None,
    now: Column | None = None,
) -> dict[str, dict[str, int]]:
    """Bronze frames to gold tables; returns the row counts of every write.

    ``regions`` restricts both silver and gold. Raises ``QualityGateError`` before gold is touched
    when a rule fails.
    Empty bronze input writes nothing and leaves what silver already holds.
    """
    written = {}
    statistics = region_filter(statistics, regions)
    if not statistics.isEmpty():
        written[config.statistics_table] = write_statistics(statistics, config, recency=recency)
    if reference is not None and not reference.isEmpty():
        written[config.reference_table] = write_reference(reference, config)
    check_silver(spark, config, now=now)
    written.update(build_gold(spark, config, regions=regions))
    return written


def write_statistics(
    bronze: DataFrame, config: PipelineConfig, *, recency: Column | str | None = None
) -> dict[str, int]:
    """Clean and write; counts rows before and after de-duplication in the same jobs.

    De-duplication and the sizing of files each shuffle every row. The latest rows
    are stored between both, which takes far less room than a shuffle does, so disk
    never holds the two shuffles at once.
    """
    spark = bronze.sparkSession
    before = Observation()
    rows = prepare_statistics(bronze, recency=recency).observe(before, F.count(F.lit(1)).alias("rows_in"))
    # One row per video, region and day; its texts are as good as unique there.
    unlike = ("video_id", "title", "thumbnail_link", "description")
    latest, path = latest_statistics(rows), work_path(spark, "latest")
    try:
        with shuffles_freed(spark):
            latest.write.options(**{f"parquet.enable.dictionary#{name}": "false" for name in unlike}).parquet(path)
        # Files don't tell what is never NULL; where columns may be, the rates take several times as long.
        stored = spark.read.schema(latest.schema).parquet(path).where("video_id is not null")
        stored = stored.withColumns({name: F.coalesce(name, F.lit(0)) for name in COUNTERS})
        counts = write_partitioned(
            finished_in_files(stored, config),
            config.silver(config.statistics_table),
            config.statistics_partitions,
            table=config.table(config.silver_database, config.statistics_table),
            rebalance=False,
            metrics=statistics_metrics(),
            unlike=unlike,
        )
    finally:
        delete_path(spark, path)
    return {**before.get, **counts}


def finished_in_files(rows: DataFrame, config: PipelineConfig) -> DataFrame:
    """Silver from its cleaned rows, with the shuffle that sizes the files ahead of the derived columns, so it doesn't carry them."""
    def finish(df: DataFrame) -> DataFrame:
        return finish_statistics(df, job_name=config.statistics_job, keep_recency=config.keep_recency)

    if set(config.statistics_partitions) <= set(rows.columns):
        return finish(rows.hint("rebalance", *config.statistics_partitions))
    return finish(rows).hint("rebalance", *config.statistics_partitions)


def write_reference(bronze: DataFrame, config: PipelineConfig) -> dict[str, int]:
    """Clean and write; raises ``EmptyReferenceError`` when the documents hold no category."""
    categories = clean_reference(bronze, job_name=config.reference_job, mode=config.reference_mode)
    # Copies don't matter here, so the first item found answers without a shuffle.
    if reference_items(bronze, config.reference_mode).isEmpty():
        raise EmptyReferenceError("no category items found")
    return write_partitioned(
        categories,
        config.silver(config.reference_table),
        table=config.table(config.silver_database, config.reference_table),
        metrics=reference_metrics(),
    )


def check_silver(spark: SparkSession, config: PipelineConfig, *, now: Column | None = None) -> None:
    """Quality gate over the silver tables that have rules."""
    tables = {name: config.silver(name) for name in config.rules}
    quality.require_quality(quality.quality_report(spark, tables, config.rules, now=now, read_now=True))


def build_gold(
    spark: SparkSession, config: PipelineConfig, *, regions: Iterable[str] | None = None
) -> dict[str, dict[str, int]]:
    """All three gold tables from all of silver, for the given regions.

    ``plans.refresh`` brings gold up to date from changed days alone. Without
    ``regions`` the tables are replaced, so a region that silver lost is gone
    from gold too. Silver is not cached: each table reads only the few narrow
    columns it needs. The channel totals, which ranking reads more than once, and
    the partial figures by category and day, which two tables are built from, are
    stored meanwhile in the shared folder.
    """
    stats = region_filter(read_table(spark, config.silver(config.statistics_table)), regions)
    reference = read_table_if_present(spark, config.silver(config.reference_table))
    mode = "overwrite" if regions is None else "overwrite_partitions"

    def write(name: str, df: DataFrame) -> dict[str, int]:
        table = config.table(config.gold_database, name)
        if config.gold_versions:
            return publish(df, config.gold(name), table, mode=mode)
        return write_partitioned(df, config.gold(name), mode=mode, table=table)

    paths = [work_path(spark, name) for name in ("parts", "channels")]
    try:
        for df, path in zip((daily_parts(stats, reference), channel_totals(stats, reference)), paths):
            with shuffles_freed(spark):
                df.write.parquet(path)
        parts, totals = (spark.read.parquet(path) for path in paths)
        written = {"trending_analytics": write("trending_analytics", days_of_parts(parts))}
        written["channel_analytics"] = write("channel_analytics", stamped(rank_channels(totals)))
        written["category_analytics"] = write("category_analytics", categories_of_parts(parts, reference))
    finally:
        for path in paths:
            delete_path(spark, path)
    return written
