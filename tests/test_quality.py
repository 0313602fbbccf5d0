from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from trendlake import quality_failures, quality_report, quality_verdict, require_quality
from trendlake.operators.quality import QualityGateError, QualityRules

NOW = datetime(2024, 1, 31, 12)
CUTOFF = NOW - timedelta(hours=48)


def report(spark, df, rules=QualityRules(), **options):
    return quality_report(spark, {"t": df}, {"t": rules}, now=F.lit(NOW), **options)


def one(df, check, column=None):
    found = [r for r in df.collect() if r["check"] == check and (column is None or r["column"] == column)]
    assert len(found) == 1
    return found[0]


@pytest.mark.parametrize("count, passed", [(9, False), (10, True), (0, False)])
def test_row_count(spark, count, passed):
    row = one(report(spark, spark.range(count)), "row_count")
    assert (row["value"], row["threshold"], row["passed"]) == (count, 10, passed)


@pytest.mark.parametrize("nulls, of, value, passed", [(5, 100, 5.0, True), (50_001, 1_000_000, 5.0, False), (6, 100, 6.0, False), (0, 0, 0.0, True)])
def test_null_share_is_tested_before_rounding(spark, nulls, of, value, passed):
    df = spark.range(of).select(F.when(F.col("id") >= nulls, F.col("id")).alias("c"))
    row = one(report(spark, df, QualityRules(("c",))), "null_pct")
    assert (row["column"], row["value"], row["threshold"], row["passed"]) == ("c", value, 5.0, passed)


def test_not_a_number_counts_as_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "c double")
    assert one(report(spark, df, QualityRules(("c",))), "null_pct")["value"] == 50.0


def test_missing_columns_fail_twice(spark):
    df = report(spark, spark.range(20), QualityRules(("id", "b", "a")))
    assert one(df, "null_pct", "a")["passed"] is False
    schema = one(df, "schema")
    assert (schema["passed"], schema["missing_columns"]) == (False, ["b", "a"])
    assert one(report(spark, spark.range(20), QualityRules(("id",))), "schema")["missing_columns"] == []


@pytest.mark.parametrize("views, negative, extreme", [(-1, 1, 0), (50_000_000_001, 0, 1), (50_000_000_000, 0, 0), (None, 0, 0)])
def test_value_range(spark, views, negative, extreme):
    df = spark.createDataFrame([(views,), (0,)], "views bigint")
    row = one(report(spark, df, QualityRules(range_columns=("views",))), "value_range", "views")
    assert (row["negative_count"], row["extreme_count"], row["passed"]) == (negative, extreme, negative + extreme == 0)


def test_value_range_skipped_without_the_column(spark):
    df = report(spark, spark.range(3), QualityRules(range_columns=("views",)))
    assert df.where("check = 'value_range'").isEmpty()


@pytest.mark.parametrize("values, kind, passed", [
    ([CUTOFF, datetime(2020, 1, 1)], "timestamp", True),
    ([CUTOFF - timedelta(microseconds=1)], "timestamp", False),
    ([None], "timestamp", False),
    ([], "timestamp", False),
    (["2024-01-30T00:00:00+00:00"], "string", True),
    (["2024-01-01T00:00:00"], "string", False),
    (["soon", "2024-01-01T00:00:00"], "string", True),
])
def test_freshness(spark, values, kind, passed):
    df = spark.createDataFrame([(v,) for v in values], f"_ingestion_timestamp {kind}")
    assert one(report(spark, df), "freshness")["passed"] is passed


def test_freshness_prefers_processing_time_and_passes_without_any(spark):
    df = spark.range(1).select(F.lit(CUTOFF).alias("_processed_at"), F.lit("2000-01-01").alias("_ingestion_timestamp"))
    row = one(report(spark, df), "freshness")
    assert (row["passed"], row["latest_record"], row["cutoff"]) == (True, CUTOFF, CUTOFF)
    assert one(report(spark, spark.range(1)), "freshness")["passed"] is True


def test_verdict_failures_and_gate(spark):
    tables = {"good": spark.range(20), "gone": "/nowhere/at/all", "small": spark.range(1)}
    df = quality_report(spark, tables, {"good": QualityRules(("id",))})
    assert rows(quality_failures(df), "table", "check") == [("gone", "read_table"), ("small", "row_count")]
    assert quality_verdict(df).first()[:] == (False, 6, 8)
    with pytest.raises(QualityGateError) as error:
        require_quality(df)
    assert {f["table"] for f in error.value.failures} == {"gone", "small"}
    require_quality(quality_report(spark, {"good": spark.range(20)}, {}))
    assert quality_verdict(quality_report(spark, {}, {})).first()[:] == (True, 0, 0)


def test_a_file_that_fails_while_read_fails_its_own_table(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.parquet").write_bytes(b"no parquet")
    tables = {"bad": spark.read.schema("id bigint").parquet(str(tmp_path / "bad")), "t": str(tmp_path / "t")}
    df = quality_report(spark, tables, {}, read_now=True)
    assert one(df.where("`table` = 't'"), "row_count")["value"] == 100
    assert not one(df.where("`table` = 'bad'"), "read_table")["passed"]


def test_one_pass_reads_only_checked_columns(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(10).select("id", F.lit(1).alias("views"), F.lit("text").alias("description")).write.parquet(path)
    df = quality_report(spark, {"t": path}, {"t": QualityRules(("id",), ("views",))})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "ReadSchema: struct<id:bigint,views:int>" in plan
