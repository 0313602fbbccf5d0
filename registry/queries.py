"""Registered queries: whole test tables through the library's operators."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from datetime import datetime, timezone
from functools import lru_cache

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake import functions as fn
from trendlake import (
    category_analytics, category_lookup, category_momentum, channel_analytics, channel_partners,
    classify_files, clean_reference, clean_statistics, ingestion_coverage, land_payloads, publish_timing,
    quality_failures, quality_report, quality_verdict, region_targeting, run_pipeline,
    trending_analytics, with_category_names, write_partitioned, PipelineConfig,
)
from trendlake.operators import quality
from trendlake.operators.aggregates import channel_totals
from trendlake.operators.landing import coverage_summary, with_pipeline_metadata
from trendlake.operators.quality import QualityRules
from trendlake.operators.reference import EmptyReferenceError, normalise_reference
from trendlake.operators.sinks import read_evolving, statistics_metrics, write_evolving
from trendlake.operators.versions import publish
from trendlake.plans.pipeline import build_gold, write_reference, write_statistics
from trendlake.plans.refresh import build_channel_state, update_gold
from trendlake.operators.statistics import GOLD_COLUMNS, conform_statistics, finish_statistics, prepare_statistics
from trendlake.session import shuffles_freed, work_path
from trendlake.sources.bronze import (
    preview_csv, read_csv, read_csv_tolerant, read_reference_documents, read_reference_files, read_reference_records,
    read_statistics_csv, read_trending_documents, record_status,
)
from trendlake.sources.files import list_files, route_files
from trendlake.sources.tables import read_table_if_present
from trendlake.streaming import (
    merge_statistics, stream_reference_documents, stream_statistics_csv, update_reference, update_statistics,
)

from .adapter import bronze_reference, bronze_statistics, read, trending_payloads

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Two of the test regions, in spellings the filter has to normalise.
TWO_REGIONS = (" Asia", "AFRICA")
TARGET_REGION = "ASIA"
CHECKED_AT = datetime(2024, 1, 31)

CLEAN_COLUMNS = [
    "video_id", "trending_date", "title", "channel_title", "category_id", "publish_time", "tags", "views",
    "likes", "dislikes", "comment_count", "thumbnail_link", "comments_disabled", "ratings_disabled",
    "video_error_or_removed", "description", "region", "trending_date_parsed", "like_ratio", "engagement_rate",
]


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under ``name``."""
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_statistics(bronze_statistics(spark, sf_dir), job_name="check", recency="ingested")


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as gold reads it: the other columns are left out ahead of the shuffle."""
    return clean_statistics(bronze_statistics(spark, sf_dir), job_name="check", recency="ingested", columns=GOLD_COLUMNS)


def by_value():
    """No recency: copies of one snapshot are told apart by their values only."""
    return F.lit(None).cast("timestamp")


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_reference(bronze_reference(spark, sf_dir), job_name="check")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Averages to 4 places: sums of doubles depend on their order in the last bits."""
    return df.withColumns({name: F.round(name, 4) for name in columns})


# Bronze scans and schema resolution

@query("scan_region_pruned")
def scan_region_pruned(spark, sf_dir):
    bronze = fn.region_filter(bronze_statistics(spark, sf_dir), TWO_REGIONS)
    return bronze.select("video_id", "region", "trending_date", "views")


@query("csv_bronze_scan")
def csv_bronze_scan(spark, sf_dir):
    """Bronze written as CSV by region, two regions read back and cleaned."""
    path = work_path(spark, "csv")
    bronze = bronze_statistics(spark, sf_dir).drop("ingested").withColumn("region", fn.normal_region("region"))
    bronze.write.partitionBy("region").options(**CSV_WRITE).csv(path)
    return clean_statistics(
        read_statistics_csv(spark, path, TWO_REGIONS), job_name="check", recency=by_value()
    ).select(*CLEAN_COLUMNS)


@query("csv_text_roundtrip")
def csv_text_roundtrip(spark, sf_dir):
    """Whole document texts through CSV: quotes, commas and line breaks."""
    path = work_path(spark, "texts")
    read(spark, sf_dir, "documents").select("doc_id", "lang", "text").write.options(**CSV_WRITE).csv(path)
    back = read_csv(spark, path, "doc_id bigint, lang string, text string")
    return back.select("doc_id", "lang", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("digest"))


@query("csv_inferred_scan")
def csv_inferred_scan(spark, sf_dir):
    path = work_path(spark, "orders")
    read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").write.options(**CSV_WRITE).csv(path)
    return preview_csv(spark, path, rows=None).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint")).withColumn(
        "o_custkey", F.col("o_custkey").cast("bigint")
    )


@query("csv_preview")
def csv_preview(spark, sf_dir):
    """The first ten rows of a CSV file, with the types that these rows show."""
    path = work_path(spark, "preview")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    orders.orderBy("o_orderkey").write.options(**CSV_WRITE).csv(path)
    shown = preview_csv(spark, f"{path}/part-00000*")
    return shown.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("csv_tolerant_scan")
def csv_tolerant_scan(spark, sf_dir):
    """Every seventh event line has a field too few; it is kept as text."""
    path = work_path(spark, "tolerant")
    line = F.when(F.expr("event_id % 7 = 0"), F.concat_ws(",", F.lit("x"), "event_type")).otherwise(
        F.concat_ws(",", "event_id", "user_id", "event_type")
    )
    read(spark, sf_dir, "events").select(line).write.text(path)
    rows = read_csv_tolerant(spark, path, "event_id bigint, user_id bigint, event_type string", header=False)
    return rows.groupBy(
        F.col("_corrupt_record").isNotNull().alias("malformed"), F.col("_corrupt_record").alias("line")
    ).agg(F.count("*").alias("rows"), F.sum("user_id").alias("users"))


@query("conform_csv")
def conform_csv(spark, sf_dir):
    return conform_statistics(bronze_statistics(spark, sf_dir), recency="ingested").drop("_recency")


@query("payload_flatten")
def payload_flatten(spark, sf_dir):
    """Nested API documents to one typed row per video."""
    payloads = trending_payloads(spark, sf_dir).withColumn("date", F.date_format("moment", "yyyy-MM-dd"))
    return _flattened(payloads)


@query("payload_flatten_dotted")
def payload_flatten_dotted(spark, sf_dir):
    """The same videos from flat columns with dotted names."""
    return _flattened(_flat_payloads(spark, sf_dir, "."))


@query("payload_flatten_underscored")
def payload_flatten_underscored(spark, sf_dir):
    """The same videos from flat columns with double underscores."""
    return _flattened(_flat_payloads(spark, sf_dir, "__"))


@query("payload_json_scan")
def payload_json_scan(spark, sf_dir):
    """Payloads of one month each, landed as JSON by region, day and hour, read back and cleaned."""
    return _landed_payloads(spark, sf_dir, TWO_REGIONS)


@query("payload_json_scan_all")
def payload_json_scan_all(spark, sf_dir):
    return _landed_payloads(spark, sf_dir, None)


@query("json_decode_encode")
def json_decode_encode(spark, sf_dir):
    props = fn.decode_document("props", "k bigint")
    return read(spark, sf_dir, "events").select("event_id", props["k"].alias("k"), fn.encode_document(props).alias("encoded"))


# Silver

@query("date_parse_two_formats")
def date_parse_two_formats(spark, sf_dir):
    rows = bronze_statistics(spark, sf_dir)
    return rows.select("trending_date", fn.parse_trending_date("trending_date").alias("parsed")).distinct()


@query("null_fill_and_ratios")
def null_fill_and_ratios(spark, sf_dir):
    """Filled counters and rates of all rows, copies included."""
    rows = finish_statistics(prepare_statistics(bronze_statistics(spark, sf_dir), recency="ingested"), job_name="check")
    return rows.select("video_id", "description", "views", "likes", "dislikes", "comment_count", "like_ratio", "engagement_rate")


@query("clean_statistics")
def clean_statistics_rows(spark, sf_dir):
    return silver(spark, sf_dir).select(*CLEAN_COLUMNS)


@query("dedup_latest")
def dedup_latest(spark, sf_dir):
    """Rows per region before and after keeping the latest copy."""
    before = prepare_statistics(bronze_statistics(spark, sf_dir), recency="ingested")
    after = silver(spark, sf_dir)
    counts = before.select("region", F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select("region", F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return counts.groupBy("region").agg(
        F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"), (F.sum("b") - F.sum("a")).alias("removed")
    )


@query("statistics_watch")
def statistics_watch(spark, sf_dir):
    """The warn-only counts watched while silver is written."""
    return silver(spark, sf_dir).agg(*(metric.alias(name) for name, metric in statistics_metrics().items()))


@query("clean_reference")
def clean_reference_merge(spark, sf_dir):
    return reference(spark, sf_dir).drop("_processed_at", "_job_name")


@query("clean_reference_latest_file")
def clean_reference_latest_file(spark, sf_dir):
    return clean_reference(
        bronze_reference(spark, sf_dir), job_name="check", mode="latest_file"
    ).drop("_processed_at", "_job_name")


@query("reference_normalised")
def reference_normalised(spark, sf_dir):
    """Dotted columns for every nested field of a category item."""
    flat = normalise_reference(bronze_reference(spark, sf_dir).drop("date"))
    return flat.withColumnsRenamed({"snippet.title": "title", "snippet.assignable": "assignable"}).drop("_ingestion_timestamp")


@query("reference_json_scan")
def reference_json_scan(spark, sf_dir):
    """Category documents landed by region and day, two regions read back and counted."""
    return _landed_reference(spark, sf_dir, TWO_REGIONS)


@query("reference_json_scan_all")
def reference_json_scan_all(spark, sf_dir):
    return _landed_reference(spark, sf_dir, None)


def _landed_reference(spark, sf_dir, regions):
    path = work_path(spark, "categories")
    documents = bronze_reference(spark, sf_dir)
    land_payloads(
        documents.drop("_source_file", "date"), path, "reference", moment=F.lit(CHECKED_AT), mode="append"
    )
    back = read_reference_documents(spark, path, regions, one_per_line=True, partitions=("region", "date"))
    return back.select(F.explode("items").alias("item"), "region", "date").groupBy("region", "date").agg(
        F.count("*").alias("items"), F.count_distinct("item.id").alias("ids"), F.max("item.snippet.title").alias("last_title")
    )


@query("reference_files_scan")
def reference_files_scan(spark, sf_dir):
    """An explicit list of landed folders, their region read from each path."""
    path = work_path(spark, "listed")
    land_payloads(bronze_reference(spark, sf_dir).drop("_source_file", "date"), path, "reference", moment=F.lit(CHECKED_AT))
    keys = [f"{path}/region%3D{region}/date=2024-01-31" for region in ("asia", "africa")]
    listed = read_reference_files(spark, keys, one_per_line=True)
    return clean_reference(listed.drop("_source_file"), job_name="check").groupBy("region").agg(
        F.count("*").alias("categories"), F.min("category_id").alias("first_id"), F.max("category_id").alias("last_id")
    )


@query("category_lookup")
def category_names(spark, sf_dir):
    return category_lookup(reference(spark, sf_dir))


@query("stats_with_category")
def stats_with_category(spark, sf_dir):
    rows = with_category_names(silver(spark, sf_dir), reference(spark, sf_dir))
    return rows.select("video_id", "region", "trending_date_parsed", "category_id", "category_name")


# Gold

@query("trending_analytics")
def trending_table(spark, sf_dir):
    return _trending_output(trending_analytics(measured(spark, sf_dir)))


@query("channel_analytics")
def channel_table(spark, sf_dir):
    return _channel_output(channel_analytics(measured(spark, sf_dir), reference(spark, sf_dir)))


@query("channel_totals_unranked")
def channel_totals_unranked(spark, sf_dir):
    return _channel_output(channel_totals(measured(spark, sf_dir), reference(spark, sf_dir)))


@query("category_analytics")
def category_table(spark, sf_dir):
    return _category_output(category_analytics(measured(spark, sf_dir), reference(spark, sf_dir)))


@query("category_analytics_without_reference")
def category_table_without_reference(spark, sf_dir):
    return _category_output(category_analytics(measured(spark, sf_dir)))


# Reports

@query("region_targeting")
def region_targeting_report(spark, sf_dir):
    return region_targeting(trending_analytics(measured(spark, sf_dir)))


@query("category_momentum")
def category_momentum_report(spark, sf_dir):
    return category_momentum(category_analytics(measured(spark, sf_dir), reference(spark, sf_dir)), TWO_REGIONS)


@query("channel_partners")
def channel_partners_report(spark, sf_dir):
    return _joined_categories(channel_partners(channel_analytics(measured(spark, sf_dir), reference(spark, sf_dir))))


@query("channel_partners_top15")
def channel_partners_top15(spark, sf_dir):
    channels = channel_analytics(measured(spark, sf_dir), reference(spark, sf_dir))
    return _joined_categories(channel_partners(channels, limit=15))


@query("channel_top10_region")
def channel_top10_region(spark, sf_dir):
    channels = channel_totals(fn.region_filter(measured(spark, sf_dir), TARGET_REGION))
    top = channels.orderBy(F.desc("times_trending"), F.asc_nulls_last("channel_title")).limit(10)
    return top.select("channel_title", "total_views", "times_trending")


@query("registered_table_sql")
def registered_table_sql(spark, sf_dir):
    """Gold registered in the catalog, asked in plain SQL."""
    path = work_path(spark, "registered")
    table = f"gold_{path[-12:]}.trending"
    write_partitioned(trending_analytics(measured(spark, sf_dir)), path, table=table)
    return spark.sql(f"""
        SELECT region, count(*) AS days, max(total_views) AS best_day, min(trending_date_parsed) AS first_day
        FROM {table} WHERE total_videos > 1 GROUP BY region""")


@query("published_versions")
def published_versions(spark, sf_dir):
    """Two versions of a gold table: what a read begun before the second gives, and one begun after it."""
    path = work_path(spark, "published")
    table = f"gold_{path[-12:]}.trending"
    days = trending_analytics(measured(spark, sf_dir)).select("trending_date_parsed", "total_views", "region")
    publish(days.withColumn("delivery", F.lit(1)), path, table)
    before = spark.table(table)
    publish(days.where("region < 'b'").withColumn("delivery", F.lit(2)), path, table, mode="overwrite_partitions")
    readers = before.withColumn("reader", F.lit("before")).unionByName(spark.table(table).withColumn("reader", F.lit("after")))
    return readers.groupBy("reader", "region", "delivery").agg(F.count("*").alias("days"), F.max("total_views").alias("best_day"))


@query("large_rates")
def large_rates(spark, sf_dir):
    """Means of rates of any size, from one exact sum."""
    rate = F.when(F.expr("o_orderkey % 3 = 0"), F.floor("o_totalprice") * 100.0).otherwise(F.expr("o_orderkey % 40") * 0.5)
    rates = read(spark, sf_dir, "orders").select(F.expr("o_custkey % 25").alias("customer"), rate.cast("double").alias("engagement_rate"))
    return rates.groupBy("customer").agg(
        fn.rate_mean("engagement_rate").alias("mean_rate"), F.max("engagement_rate").alias("top_rate"))


@query("category_momentum_all")
def category_momentum_all(spark, sf_dir):
    return category_momentum(category_analytics(measured(spark, sf_dir), reference(spark, sf_dir)))


@query("publish_timing_all")
def publish_timing_all(spark, sf_dir):
    return publish_timing(trending_analytics(measured(spark, sf_dir)))


@query("publish_timing")
def publish_timing_report(spark, sf_dir):
    return publish_timing(trending_analytics(measured(spark, sf_dir)), TWO_REGIONS)


# Quality

@query("quality_report")
def quality_report_rows(spark, sf_dir):
    return _report_output(_report(spark, sf_dir))


@query("quality_failures")
def quality_failing_rows(spark, sf_dir):
    return _report_output(quality_failures(_report(spark, sf_dir)))


@query("quality_verdict")
def quality_gate_verdict(spark, sf_dir):
    return quality_verdict(_report(spark, sf_dir))


@query("quality_freshness")
def quality_freshness(spark, sf_dir):
    """Newest record against the cutoff, from timestamps and from text."""
    now = F.lit(CHECKED_AT)
    events = read(spark, sf_dir, "events")
    tables = {
        "stamped": events.select(F.col("ts").cast("timestamp").alias("_processed_at")),
        "text": events.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("_ingestion_timestamp")),
        "old": read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("timestamp").alias("_processed_at")),
        "unreadable": read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("_ingestion_timestamp")),
        "unstamped": read(spark, sf_dir, "lineitem"),
    }
    report = quality_report(spark, tables, {}, now=now).where(F.col("check") == "freshness")
    return report.select(
        "table", "passed",
        F.date_format("latest_record", "yyyy-MM-dd HH:mm:ss").alias("latest"),
        F.date_format("cutoff", "yyyy-MM-dd HH:mm:ss").alias("cutoff"),
    )


# Files, landing, coverage

@query("file_classification")
def file_classification(spark, sf_dir):
    return classify_files(_file_names(spark, sf_dir)).select("page_id", "name", "kind", "region", "target")


@query("object_key_regions")
def object_key_regions(spark, sf_dir):
    """Percent-encoded object keys decoded, region from path and from prefix."""
    files = _file_names(spark, sf_dir)
    key = F.url_decode(F.concat(F.lit("raw%2Fregion%3D"), F.upper(F.substring("name", 1, 2)), F.lit("%2Fa+b%2F"), F.col("name")))
    bare = F.concat(F.lit("raw/"), F.col("name"))
    return files.select(
        "page_id", key.alias("key"), fn.path_region(key).alias("key_region"),
        fn.path_region(bare).alias("bare_region"), fn.name_prefix_region(F.col("name")).alias("prefix_region"),
    )


@query("landing_metadata")
def landing_metadata(spark, sf_dir):
    landed = with_pipeline_metadata(trending_payloads(spark, sf_dir), F.col("moment"), "orders")
    return landed.groupBy("_pipeline_metadata.ingestion_id", "region", "date", "hour", "_pipeline_metadata.source").agg(
        F.count("*").alias("documents"), F.sum("_pipeline_metadata.video_count").alias("videos")
    )


@query("ingestion_coverage")
def ingestion_coverage_rows(spark, sf_dir):
    return _coverage(spark, sf_dir)


@query("ingestion_coverage_summary")
def ingestion_coverage_summary(spark, sf_dir):
    summary = coverage_summary(_coverage(spark, sf_dir))
    return summary.withColumns({name: F.array_join(name, ",") for name in ("failed_regions", "unexpected_regions")})


# Sinks, incremental runs, pipeline

@query("partition_overwrite")
def partition_overwrite(spark, sf_dir):
    """Gold written, one region written again: no row is lost or doubled."""
    path = work_path(spark, "gold")
    gold = trending_analytics(measured(spark, sf_dir))
    write_partitioned(gold, path)
    write_partitioned(fn.region_filter(spark.read.parquet(path), TARGET_REGION), path)
    return _trending_output(spark.read.parquet(path))


@query("incremental_vs_full")
def incremental_merge(spark, sf_dir):
    """Bronze CSV in two deliveries, merged by two incremental runs."""
    bronze_path, silver_path, checkpoint = (work_path(spark, name) for name in ("stream", "silver", "state"))
    bronze = bronze_statistics(spark, sf_dir).drop("ingested").withColumn("region", fn.normal_region("region"))
    late = F.expr("coalesce(try_cast(comment_count AS bigint), 0) % 2 = 1")
    for delivery in (bronze.where(~late), bronze.where(late)):
        delivery.write.mode("append").partitionBy("region").options(**DELIVERED).csv(bronze_path)
        update_statistics(
            stream_statistics_csv(spark, bronze_path), silver_path, checkpoint,
            job_name="check", recency=by_value(),
        ).awaitTermination()
    return spark.read.parquet(silver_path).select(*CLEAN_COLUMNS)


@query("pipeline_gold")
def pipeline_gold(spark, sf_dir):
    """Silver, gate and gold in one run; the report is read from gold."""
    rules = {
        # The test rows include negative views, which the default rules refuse.
        "clean_statistics": QualityRules(quality.STATISTICS_RULES.required),
        "clean_reference_data": quality.REFERENCE_RULES,
    }
    config = PipelineConfig(work_path(spark, "silver"), work_path(spark, "gold"), rules=rules)
    run_pipeline(spark, bronze_statistics(spark, sf_dir), bronze_reference(spark, sf_dir), config, recency="ingested")
    return region_targeting(spark.read.parquet(config.gold("trending_analytics")))


@query("full_then_update")
def full_then_update(spark, sf_dir):
    """A full run over one delivery and a merge of the next, with default settings: the newer file wins."""
    bronze_path, later_path, checkpoint = (work_path(spark, name) for name in ("first", "later", "state"))
    config = PipelineConfig(work_path(spark, "silver"), work_path(spark, "gold"))
    bronze = bronze_statistics(spark, sf_dir).drop("ingested").withColumn("region", fn.normal_region("region"))
    late = F.expr("coalesce(try_cast(comment_count AS bigint), 0) % 2 = 1")
    # Copies of a video share a file, so that within a delivery they share its time.
    for delivery, path in ((bronze.where(~late), bronze_path), (bronze.where(late), later_path)):
        with shuffles_freed(spark):
            delivery.repartition(8, "video_id").write.partitionBy("region").options(**DELIVERED).csv(path)
    write_statistics(read_statistics_csv(spark, bronze_path), config)
    silver_path = config.silver(config.statistics_table)
    update_statistics(stream_statistics_csv(spark, later_path), silver_path, checkpoint, job_name="check").awaitTermination()
    return spark.read.parquet(silver_path).select(*CLEAN_COLUMNS)


@query("reference_update")
def reference_update(spark, sf_dir):
    """Two deliveries of category files whose names sort against their age: the later file replaces its region."""
    bronze_path, silver_path, checkpoint = (work_path(spark, name) for name in ("categories", "reference", "state"))
    documents = bronze_reference(spark, sf_dir).withColumn("region", fn.normal_region("region"))
    newest = F.col("_source_file").isin([f"file{n}" for n in (6, 7, 8, 9, 10)])
    # One file a region: the first delivery holds all other documents.
    for delivery in (documents.where(~newest), documents.where(newest)):
        delivery.drop("_source_file", "date").repartition("region").write.mode("append").partitionBy("region").json(bronze_path)
        update_reference(
            stream_reference_documents(spark, bronze_path, one_per_line=True), silver_path, checkpoint, job_name="check"
        ).awaitTermination()
    return spark.read.parquet(silver_path).drop("_processed_at", "_job_name")


@query("gold_after_update")
def gold_after_update(spark, sf_dir):
    """The category table after a full run and two merges, each followed by a refresh of the touched days."""
    return _category_output(spark.read.parquet(_updated_gold(spark, sf_dir).gold("category_analytics")))


@query("daily_gold_after_update")
def daily_gold_after_update(spark, sf_dir):
    """The daily table, brought up to date in the same way."""
    return _trending_output(spark.read.parquet(_updated_gold(spark, sf_dir).gold("trending_analytics")))


@query("channels_after_updates")
def channels_after_updates(spark, sf_dir):
    """The channel table merged from its state by day, after two updates."""
    return _channel_output(spark.read.parquet(_updated_gold(spark, sf_dir).gold("channel_analytics")))


@lru_cache(maxsize=4)
def _updated_gold(spark: SparkSession, sf_dir: str, deliveries: int = 3) -> PipelineConfig:
    """Bronze in deliveries, the newer winning: a full run over the first, a merge and a refresh for each of the others.

    Three queries read the tables that one run leaves behind.
    """
    config = PipelineConfig(work_path(spark, "silver"), work_path(spark, "gold"), rules={})
    bronze = bronze_statistics(spark, sf_dir).withColumn("region", fn.normal_region("region"))
    part = F.expr(f"coalesce(try_cast(comment_count AS bigint), 0) % {deliveries}")
    staging, checkpoint = work_path(spark, "staging"), work_path(spark, "state")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        write_reference(bronze_reference(spark, sf_dir), config)
        for number in range(deliveries):
            delivery = bronze.where(part == number).withColumn("delivered", F.timestamp_seconds(F.lit(number)))
            if number == 0:
                write_statistics(delivery, config, recency="delivered")
                build_gold(spark, config)
                build_channel_state(spark, config)
            else:
                merge_statistics(
                    delivery, config.silver(config.statistics_table), staging, number, job_name="check", recency="delivered", changes=config.changes)
                update_gold(spark, config, checkpoint).awaitTermination()
    return config


# Files, audit columns, metrics

@query("file_routing")
def file_routing(spark, sf_dir):
    """All of bronze as a flat folder of files, routed byte for byte: rows by kind and region, and whether every file kept its digest."""
    flat, bronze_path = work_path(spark, "flat"), work_path(spark, "routed")
    prefix = F.upper(F.substring(fn.normal_region("region"), 1, 2)).alias("prefix")
    statistics = bronze_statistics(spark, sf_dir).drop("ingested").select(prefix, "*").drop("region")
    documents = bronze_reference(spark, sf_dir).select(prefix, F.to_json(F.struct("kind", "items")).alias("value"))
    for rows, form, ending in ((statistics, "csv", "videos.csv"), (documents, "text", "category_id.json")):
        staged = work_path(spark, "staged")
        options = CSV_WRITE if form == "csv" else {}
        rows.hint("rebalance", "prefix").write.partitionBy("prefix").format(form).options(**options).save(staged)
        _flatten(spark, staged, flat, ending)
    content = spark.read.format("binaryFile").load(flat)
    before = content.select(F.substring_index("path", "/", -1).alias("_name"), F.sha2("content", 256).alias("_before"))
    routed = route_files(spark, flat, bronze_path)
    same = routed.join(before, (F.col("name") == F.col("_name")) & (F.col("sha256") == F.col("_before")), "left")
    unchanged = same.groupBy("kind", "region").agg((F.count("*") == F.count("_name")).alias("unchanged"))
    scans = {
        "raw_stats": spark.read.schema("video_id string, region string").csv(f"{bronze_path}/raw_stats", header=True, quote='"', escape='"', multiLine=True),
        "raw_stats_reference_data": spark.read.schema("kind string, region string").json(f"{bronze_path}/raw_stats_reference_data"),
    }
    parts = [rows.groupBy("region").agg(F.count("*").alias("rows")).withColumn("kind", F.lit(kind)) for kind, rows in scans.items()]
    return parts[0].unionByName(parts[1]).join(unchanged, ["kind", "region"])


def _flatten(spark: SparkSession, source: str, target: str, ending: str) -> None:
    """Bring the few data files below ``prefix=`` folders to one folder, named by prefix, number and ending."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(target))
    for number, found in enumerate(files.globStatus(path(f"{source}/prefix=*/part-*"))):
        folder = found.getPath().getParent().getName()
        files.rename(found.getPath(), path(f"{target}/{folder.split('=')[1]}_{number}_{ending}"))


@query("reference_records_scan")
def reference_records_scan(spark, sf_dir):
    """The landed category files that a table of event records names: one record stands twice, one names no file."""
    path, records = _event_records(spark, sf_dir)
    named = read_reference_records(spark, path, records, one_per_line=True, partitions=("region", "date"), prefix="raw/")
    return clean_reference(named.drop("_source_file"), job_name="check").groupBy("region").agg(
        F.count("*").alias("categories"), F.min("category_id").alias("first_id"), F.max("category_id").alias("last_id"))


@query("event_record_status")
def event_record_status(spark, sf_dir):
    """Records and files of each region that they name."""
    path, records = _event_records(spark, sf_dir)
    status = record_status(spark, path, records, prefix="raw/")
    return status.groupBy(fn.path_region(F.col("file")).alias("region")).agg(
        F.min("copies").alias("least"), F.max("copies").alias("most"), F.bool_and("found").alias("found"))


def _event_records(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Landed category files, and records of those of two regions (twice for one of them) and of a file that isn't there."""
    path = work_path(spark, "recorded")
    land_payloads(bronze_reference(spark, sf_dir).drop("_source_file", "date"), path, "reference", moment=F.lit(CHECKED_AT))
    files = list_files(spark, path, "*.json").select(F.regexp_extract("path", r"(region=.*)$", 1).alias("file"))
    wanted = files.where(fn.path_region(F.col("file")).isin("asia", "africa"))
    records = wanted.union(wanted.where(fn.path_region(F.col("file")) == "asia")).union(
        spark.createDataFrame([("region=middle east/date=2024-01-31/no such file.json",)], "file string"))
    key = F.url_encode(F.concat(F.lit("raw/"), "file"))
    return path, records.select(key.alias("key"))


@query("schema_evolution")
def schema_evolution(spark, sf_dir):
    """Two deliveries of categories: the second, of two regions, has one more column and a wider type."""
    path = work_path(spark, "evolving")
    rows = reference(spark, sf_dir).select("category_id", "category_title", "assignable", "kind", "region")
    write_evolving(rows.withColumn("category_id", F.col("category_id").cast("int")).drop("assignable"), path)
    write_evolving(fn.region_filter(rows, TWO_REGIONS), path)
    return read_evolving(spark, path)


@query("empty_delivery_refused")
def empty_delivery_refused(spark, sf_dir):
    """A delivery of all documents without a category is refused, by the full run and by the update, and changes nothing."""
    config = PipelineConfig(work_path(spark, "silver"), work_path(spark, "gold"))
    documents = bronze_reference(spark, sf_dir)
    write_reference(documents, config)
    empty = documents.where("items is null or size(items) = 0").withColumn("region", fn.normal_region("region"))
    landed, silver_path = work_path(spark, "empty"), config.silver(config.reference_table)
    empty.drop("_source_file", "date").write.partitionBy("region").json(landed)
    attempts = {
        "full": lambda: write_reference(empty, config),
        "update": lambda: update_reference(
            stream_reference_documents(spark, landed, one_per_line=True), silver_path, work_path(spark, "state"), job_name="check").awaitTermination(),
    }
    refused = []
    for name, attempt in attempts.items():
        try:
            attempt()
        except (EmptyReferenceError, StreamingQueryException) as error:
            if "no category items found" in str(error):
                refused.append(name)
    return spark.read.parquet(silver_path).groupBy("region").agg(F.count("*").alias("categories")).withColumn("refused", F.lit(",".join(refused)))


@query("default_clock")
def default_clock(spark, sf_dir):
    """Processing times by the default clock lie between the start of the query and its end."""
    started = datetime.now(timezone.utc)
    stamped = silver(spark, sf_dir).groupBy("region").agg(
        F.count("*").alias("rows"), F.min("_processed_at").alias("_first"), F.max("_processed_at").alias("_last"))
    early = F.lit(started) - F.expr("INTERVAL 1 MINUTE")
    return stamped.select("region", "rows", ((F.col("_first") >= early) & (F.col("_last") <= F.current_timestamp())).alias("in_time"))


@query("source_provenance")
def source_provenance(spark, sf_dir):
    """The folder each category document came from, as the scan reports it."""
    path = work_path(spark, "provenance")
    documents = bronze_reference(spark, sf_dir).drop("_source_file", "date").withColumn("region", fn.normal_region("region"))
    documents.write.partitionBy("region").json(path)
    back = read_reference_documents(spark, path, one_per_line=True)
    listed = list_files(spark, path, "*.json").select(F.url_decode("path").alias("path"))
    folder = F.element_at(F.split(F.url_decode("_source_file"), "/"), -2)
    seen = back.select("region", folder.alias("folder"), F.url_decode("_source_file").alias("path"))
    return seen.join(listed, F.regexp_replace(seen["path"], "^file:/+", "/") == F.regexp_replace(listed["path"], "^file:/+", "/")).groupBy(
        "region", "folder").agg(F.count("*").alias("documents"))


@query("channel_sink")
def channel_sink(spark, sf_dir):
    """The channel table as the pipeline stores it."""
    return _channel_output(spark.read.parquet(_built_gold(spark, sf_dir).gold("channel_analytics")))


@query("category_sink")
def category_sink(spark, sf_dir):
    """The category table as the pipeline stores it."""
    return _category_output(spark.read.parquet(_built_gold(spark, sf_dir).gold("category_analytics")))


@query("write_metrics")
def write_metrics(spark, sf_dir):
    """What the writes of both silver tables count while they run."""
    config = PipelineConfig(work_path(spark, "silver"), work_path(spark, "gold"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        stats = write_statistics(bronze_statistics(spark, sf_dir), config, recency="ingested")
        categories = write_reference(bronze_reference(spark, sf_dir), config)
    return spark.createDataFrame([
        ("clean_statistics", stats["rows"], stats["null_video_id"], stats["negative_views"], stats["rows_in"]),
        ("clean_reference_data", categories["rows"], categories["null_category_id"], None, None),
    ], "`table` string, rows bigint, null_first bigint, negative_views bigint, rows_in bigint")


@query("optional_reference")
def optional_reference(spark, sf_dir):
    """Gold where the reference table is missing, and an empty delivery that changes nothing."""
    config = PipelineConfig(work_path(spark, "silver"), work_path(spark, "gold"), rules={})
    bronze = bronze_statistics(spark, sf_dir)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        run_pipeline(spark, bronze, None, config, recency="ingested")
        run_pipeline(spark, bronze.where("false"), None, config, recency="ingested")
    assert read_table_if_present(spark, config.silver(config.reference_table)) is None
    return _category_output(spark.read.parquet(config.gold("category_analytics")))


@query("audit_columns")
def audit_columns(spark, sf_dir):
    """Processing time and job of every layer, under a fixed clock."""
    clock = F.lit(CHECKED_AT)
    bronze, documents = bronze_statistics(spark, sf_dir), bronze_reference(spark, sf_dir)
    stats = clean_statistics(bronze, job_name="check", recency="ingested", processed_at=clock)
    categories = clean_reference(documents, job_name="check", processed_at=clock)
    gold = trending_analytics(stats, aggregated_at=clock)
    flat = normalise_reference(documents.drop("date"), ingested_at=clock)
    rows = stats.select(F.concat(F.lit("silver:"), "_job_name").alias("layer"), "_processed_at")
    rows = rows.union(categories.select(F.concat(F.lit("reference:"), "_job_name"), "_processed_at"))
    rows = rows.union(gold.select(F.lit("gold"), "_aggregated_at")).union(
        flat.select(F.lit("normalised"), F.to_timestamp(F.substring("_ingestion_timestamp", 1, 19), "yyyy-MM-dd'T'HH:mm:ss")))
    return rows.groupBy("layer", F.date_format("_processed_at", "yyyy-MM-dd HH:mm:ss").alias("stamp")).agg(F.count("*").alias("rows"))


@query("quality_unreadable")
def quality_unreadable(spark, sf_dir):
    """A table whose file fails while it is read, one that is not there, and one that is sound."""
    broken = work_path(spark, "broken")
    read(spark, sf_dir, "orders").select(F.lit("no parquet").alias("value")).write.text(broken)
    tables = {
        "broken": spark.read.schema("id bigint").option("recursiveFileLookup", "true").parquet(broken),
        "missing": f"{broken}/missing",
        "orders": read(spark, sf_dir, "orders"),
    }
    report = quality_report(spark, tables, {}, now=F.lit(CHECKED_AT), read_now=True)
    return report.where(F.col("check").isin("read_table", "row_count")).select("table", "check", "passed")


def _built_gold(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    config = PipelineConfig(work_path(spark, "silver"), work_path(spark, "gold"), rules={})
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        run_pipeline(spark, bronze_statistics(spark, sf_dir), bronze_reference(spark, sf_dir), config, recency="ingested")
    return config


CSV_WRITE = {
    "header": True, "quote": '"', "escape": '"', "compression": "none",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
#: Whole tables as deliveries stay on disk beside silver; compressed they take a fraction.
DELIVERED = {**CSV_WRITE, "compression": "gzip"}


def _landed_payloads(spark: SparkSession, sf_dir: str, regions) -> DataFrame:
    path = work_path(spark, "payloads")
    payloads = trending_payloads(spark, sf_dir).withColumn("moment", F.date_trunc("month", "moment"))
    land_payloads(payloads, path, moment=F.col("moment"), source="orders")
    landed = read_trending_documents(spark, path, regions, one_per_line=True)
    return clean_statistics(landed, job_name="check").select(*CLEAN_COLUMNS)


def _flattened(df: DataFrame) -> DataFrame:
    return conform_statistics(df).drop("_recency").withColumn("region", fn.normal_region("region"))


def _flat_payloads(spark: SparkSession, sf_dir: str, separator: str) -> DataFrame:
    payloads = trending_payloads(spark, sf_dir).withColumn("date", F.date_format("moment", "yyyy-MM-dd"))
    videos = payloads.select(F.explode("items").alias("_item"), "region", "date")
    leaves = fn.flatten_struct(videos, "_item")
    flat = videos.select(*leaves, "region", "date")
    return flat.toDF(*(name.replace(".", separator) for name in flat.columns))


def _trending_output(df: DataFrame) -> DataFrame:
    return rounded(df.drop("_aggregated_at"), "avg_views_per_video", "avg_like_ratio", "avg_engagement_rate")


def _joined_categories(df: DataFrame) -> DataFrame:
    return df.withColumn("categories", F.array_join("categories", "|"))


def _channel_output(df: DataFrame) -> DataFrame:
    return rounded(_joined_categories(df.drop("_aggregated_at")), "avg_views_per_video", "avg_engagement_rate")


def _category_output(df: DataFrame) -> DataFrame:
    return rounded(df.drop("_aggregated_at"), "avg_engagement_rate")


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables: silver, its raw rows with strict limits, and reference without titles."""
    strict = QualityRules(quality.STATISTICS_RULES.required + ("channel_id",), ("views",), max_null_percent=1.0, max_value=9_000)
    raw = prepare_statistics(bronze_statistics(spark, sf_dir), recency="ingested")
    tables = {
        "clean_statistics": silver(spark, sf_dir).drop("_processed_at"),
        "raw_statistics": raw,
        "clean_reference_data": reference(spark, sf_dir).drop("_processed_at"),
    }
    rules = {
        "clean_statistics": quality.STATISTICS_RULES,
        "raw_statistics": strict,
        "clean_reference_data": QualityRules(("category_id", "region"), min_rows=1_000_000_000),
    }
    return quality_report(spark, tables, rules, now=F.lit(CHECKED_AT))


def _report_output(report: DataFrame) -> DataFrame:
    return report.select(
        "check", "table", "column", "value", "threshold", "negative_count", "extreme_count", "passed",
        F.array_join(F.coalesce("missing_columns", F.array().cast("array<string>")), ",").alias("missing"),
    )


def _file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file name per page, from its URL: all four kinds of names."""
    host = F.regexp_extract("url", r"//([a-z]+)\.", 1)
    two = F.substring(host, 1, 2)
    name = (
        F.when(F.expr("page_id % 4 = 0"), F.concat(F.upper(two), F.lit("videos.csv")))
        .when(F.expr("page_id % 4 = 1"), F.concat(F.upper(two), F.lit("_category_id.json")))
        .when(F.expr("page_id % 4 = 2"), F.concat(host, F.lit("_notes.csv")))
        .otherwise(F.concat(F.lit("."), host, F.lit("_Store")))
    )
    return read(spark, sf_dir, "pages").select("page_id", name.alias("name"))


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = with_pipeline_metadata(trending_payloads(spark, sf_dir), F.col("moment"), "orders")
    expected = read(spark, sf_dir, "region").where("r_name <> 'AFRICA'").select(F.col("r_name").alias("region"))
    return ingestion_coverage(landed, expected, ["20000101_000000"])
