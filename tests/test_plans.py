"""The physical plans stay the ones the library is designed around."""

import pytest
from pyspark.sql import functions as F

from conftest import bronze
from trendlake import clean_statistics, functions as fn, with_category_names
from trendlake.operators.aggregates import category_analytics, channel_analytics, channel_totals, trending_analytics
from trendlake.session import broadcast_if_small


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    df = bronze(spark, *(dict(video_id=f"v{i}", region=r) for i in range(3) for r in ("US", "us", "de")))
    clean_statistics(df, job_name="j").write.partitionBy("region").parquet(path)
    return spark.read.parquet(path)


def test_region_filter_prunes_partitions(silver):
    text = plan(fn.region_filter(silver, " US "))
    assert "PartitionFilters: [isnotnull(region" in text or "PartitionFilters: [(lower(trim(region" in text
    assert "DataFilters: []" in text


def test_dedup_limits_groups_on_both_sides_of_the_shuffle(spark):
    text = plan(clean_statistics(bronze(spark, {}), job_name="j"))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text and "Final" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_gold_reads_narrow_columns(silver):
    for df in (trending_analytics(silver), channel_totals(silver), category_analytics(silver)):
        text = plan(df)
        assert text.count("FileScan parquet") == 1
        assert "description" not in text and "thumbnail" not in text and "tags" not in text


def test_small_lookup_is_broadcast_and_a_large_one_is_not(spark, silver):
    names = spark.range(50).select(F.col("id").alias("category_id"), F.lit("n").alias("category_name"))
    assert "BroadcastHashJoin" in plan(with_category_names(silver, names))
    assert "ResolvedHint" in broadcast_if_small(names)._jdf.queryExecution().analyzed().toString()
    for bounds in ({"max_rows": 49}, {"max_bytes": 100}):
        assert "ResolvedHint" not in broadcast_if_small(names, **bounds)._jdf.queryExecution().analyzed().toString()


def test_large_lookup_joins_by_shuffle_with_equal_results(spark, silver):
    names = spark.range(200_000).select(F.col("id").alias("category_id"), F.concat(F.lit("n"), "id").alias("category_name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = with_category_names(silver, names)
        assert "BroadcastHashJoin" not in plan(named) and "SortMergeJoin" in plan(named)
        assert {r["category_name"] for r in named.collect()} == {"n10"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_channels_need_no_distinct_count(silver):
    text = plan(channel_totals(silver))
    assert "distinct" not in text
    first = text[text.rindex("Exchange hashpartitioning"):]
    assert "partial_collect_set" not in first


def test_ranking_expands_the_channels_once(spark, silver):
    """The sample, the sizes and the rows of the numbering stand on one shuffle of the channel totals."""
    ranked = channel_analytics(silver, spark.range(50).selectExpr("id category_id", "concat('n', id) category_name"))
    ranked.collect()
    final = ranked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Generate explode") == 1 and final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_no_python_in_any_plan(spark, silver):
    for df in (clean_statistics(bronze(spark, {}), job_name="j"), trending_analytics(silver), channel_totals(silver)):
        assert "Python" not in plan(df) and "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)
