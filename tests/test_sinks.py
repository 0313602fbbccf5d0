import datetime
import shutil
import time
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import rows
from trendlake import write_partitioned
from trendlake.operators.sinks import SchemaChangeError, null_metrics, observed, read_evolving, write_evolving
from trendlake.session import shuffles_freed
from trendlake.sources.tables import read_table, read_table_if_present


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k bigint, region string")


def test_staged_partitions_are_moved(spark, tmp_path):
    path, staged = str(tmp_path / "t"), tmp_path / "staged"
    write_partitioned(frame(spark, (1, "us"), (2, "de"), (3, None)), path)
    frame(spark, (4, "us"), (5, "fr"), (6, None)).write.partitionBy("region").parquet(str(staged))
    files = {p.name: p.stat().st_mtime_ns for p in staged.rglob("*.parquet")}
    df = spark.read.schema("k bigint, region string").parquet(str(staged))
    for _ in range(2):  # a repeated move finds nothing left
        assert write_partitioned(df, path, staged=str(staged)) == {}
        assert rows(spark.read.parquet(path), "k", "region") == [(2, "de"), (4, "us"), (5, "fr"), (6, None)]
    assert files.items() <= {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}.items()
    assert not list(staged.rglob("*.parquet"))
    with pytest.raises(ValueError):
        write_partitioned(df, path, staged=str(staged), mode="append")


def test_a_write_frees_its_shuffles(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name, None), []
    with shuffles_freed(spark):
        seen.append(spark.conf.get(name))
    assert seen == ["true"] and spark.conf.get(name, None) == before

    folders = [Path(f.toString()) for f in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def held():
        return {f.name for folder in folders for f in folder.rglob("shuffle_*.data")}

    earlier = held()
    write_partitioned(spark.range(20_000).selectExpr("id AS k", "CAST(id % 3 AS string) AS region").repartition(3, "k"), str(tmp_path / "t"))
    deadline = time.time() + 20
    while held() - earlier and time.time() < deadline:
        time.sleep(0.2)
    assert not held() - earlier


def test_only_touched_regions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(frame(spark, (1, "us"), (2, "us"), (3, "de")), path)
    for _ in range(2):
        assert write_partitioned(frame(spark, (9, "us")), path)["rows"] == 1
    assert rows(spark.read.parquet(path), "k", "region") == [(3, "de"), (9, "us")]
    write_partitioned(frame(spark, (4, "us")), path, mode="append")
    assert spark.read.parquet(path).count() == 3
    write_partitioned(frame(spark, (5, "fr")), path, mode="overwrite")
    assert rows(spark.read.parquet(path), "k", "region") == [(5, "fr")]
    with pytest.raises(ValueError):
        write_partitioned(frame(spark), path, mode="other")


def test_metrics_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "us"), (None, None, "us")], "a bigint, b string, region string")
    counts = write_partitioned(df, str(tmp_path / "t"), metrics={**null_metrics(["a", "b"]), "negative": F.count_if(F.col("a") < 0)})
    assert counts == {"rows": 2, "null_a": 1, "null_b": 2, "negative": 0}


def test_one_region_becomes_few_files(spark, tmp_path):
    df = spark.range(0, 10_000, 1, 64).select("id", F.lit("us").alias("region"))
    write_partitioned(df, str(tmp_path / "t"))
    assert len(list((tmp_path / "t" / "region=us").glob("*.snappy.parquet"))) <= 8


def test_registered_table_learns_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(frame(spark, (1, "us")), path, table="sink_db.items")
    assert rows(spark.table("sink_db.items"), "k", "region") == [(1, "us")]
    wider = frame(spark, (2, "de")).withColumn("extra", F.lit("x"))
    write_partitioned(wider, path, table="sink_db.items")
    assert rows(spark.table("sink_db.items"), "k", "region", "extra") == [(1, "us", None), (2, "de", "x")]
    assert rows(read_table(spark, path, merge_schema=True), "k", "extra", "region") == [(1, None, "us"), (2, "x", "de")]
    assert spark.sql("SHOW PARTITIONS sink_db.items").count() == 2


def test_only_written_partitions_are_registered(spark, tmp_path):
    path = str(tmp_path / "t")
    columns = "k bigint, region string, day date"
    day = datetime.date(2024, 1, 1)
    frame = lambda *data: spark.createDataFrame(list(data), columns)
    write_partitioned(frame((1, "us", day), (2, None, None), (3, "it's", day)), path, ("region", "day"), table="sink_db.days")
    assert rows(spark.table("sink_db.days")) == rows(spark.read.parquet(path)) and spark.sql("SHOW PARTITIONS sink_db.days").count() == 3
    shutil.copytree(tmp_path / "t" / "region=us", tmp_path / "t" / "region=by-hand")
    write_partitioned(frame((4, "de", day)), path, ("region", "day"), table="sink_db.days")
    assert rows(spark.table("sink_db.days"), "k", "region") == [(1, "us"), (2, None), (3, "it's"), (4, "de")]
    # Replaced as a whole: partitions that are gone are forgotten.
    write_partitioned(frame((5, "fr", day)), path, ("region", "day"), mode="overwrite", table="sink_db.days")
    assert rows(spark.table("sink_db.days"), "k", "region", "day") == [(5, "fr", day)]


def test_first_registration_takes_up_what_is_stored(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(frame(spark, (1, "us")), path)
    write_partitioned(frame(spark, (2, "de")), path, table="sink_db.adopted")
    assert rows(spark.table("sink_db.adopted"), "k", "region") == [(1, "us"), (2, "de")]


def test_metrics_are_taken_by_the_writing_stage(spark):
    """Behind the last shuffle: Spark counts a task of the last stage once, however often its stage runs."""
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("region")).groupBy("region").agg(F.count("*").alias("n"))
    out = observed(df, Observation(), ("region",), {"negative": F.count_if(F.col("n") < 0)}, True, True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange") and "REBALANCE" in plan


def test_columns_are_added_and_types_widened(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_of = lambda schema, *data: spark.createDataFrame(list(data), schema)
    write_evolving(rows_of("a int, b float, c decimal(5,1), gone string, region string", (1, 0.5, None, "g", "us"), (2, 1.5, None, "h", "de")), path, table="sink_db.evolving")
    write_evolving(rows_of("A bigint, b double, c decimal(9,3), more string, region string", (2 ** 40, 0.25, None, "m", "de")), path, table="sink_db.evolving")
    expected = [(1, 0.5, None, "g", "us", None), (2 ** 40, 0.25, None, None, "de", "m")]
    names = ("a", "b", "c", "gone", "region", "more")
    for table in (read_evolving(spark, path), spark.table("sink_db.evolving")):
        assert rows(table, *names) == sorted(expected, key=repr)
        assert dict(table.dtypes) == {"a": "bigint", "b": "double", "c": "decimal(9,3)", "gone": "string", "region": "string", "more": "string"}
    # A narrower delivery is widened on its way in; one that doesn't fit writes nothing.
    write_evolving(rows_of("a smallint, region string", (7, "us")), path, table="sink_db.evolving")
    assert rows(read_evolving(spark, path), "a", "region") == [(2 ** 40, "de"), (7, "us")]
    with pytest.raises(SchemaChangeError):
        write_evolving(rows_of("a string, region string", ("x", "fr")), path)
    assert rows(read_evolving(spark, path), "a", "region") == [(2 ** 40, "de"), (7, "us")]


def test_optional_table(spark, tmp_path):
    assert read_table_if_present(spark, None) is None
    assert read_table_if_present(spark, str(tmp_path / "nothing")) is None
    assert read_table_if_present(spark, "no_such_table") is None
    spark.range(1).write.parquet(str(tmp_path / "t"))
    assert read_table_if_present(spark, str(tmp_path / "t")).count() == 1
