"""What default settings must not do: mix layouts, lose history, prefer old rows, stop on large values."""

import os
import random
import warnings

import pytest
from pyspark.sql import functions as F

from conftest import CSV_COLUMNS, bronze, rows
from trendlake import PipelineConfig, channel_analytics, clean_statistics, functions as fn, ingestion_coverage, run_pipeline, trending_analytics
from trendlake.operators.aggregates import category_analytics
from trendlake.operators.landing import coverage_summary
from trendlake.operators.ranking import number_rows
from trendlake.operators.reference import EmptyReferenceError, clean_reference
from trendlake.operators.sinks import StoredLayoutError, stored_partitions, write_partitioned
from trendlake.plans.pipeline import build_gold, write_reference, write_statistics
from trendlake.session import shared_folder
from trendlake.sources.bronze import read_reference_files, read_statistics_csv
from trendlake.streaming import merge_statistics


def config(tmp_path, **options):
    return PipelineConfig(str(tmp_path / "silver"), str(tmp_path / "gold"), rules={}, **options)


def test_full_run_then_merge_with_defaults(spark, tmp_path):
    own = config(tmp_path)
    write_statistics(bronze(spark, dict(views="1"), dict(video_id="a")), own)
    merge_statistics(bronze(spark, dict(video_id="b")), own.silver("clean_statistics"), str(tmp_path / "staging"), 0, job_name="j")
    assert rows(spark.read.parquet(own.silver("clean_statistics")), "video_id") == [("a",), ("b",), ("v1",)]
    assert stored_partitions(spark, own.silver("clean_statistics")) == ("region", "trending_date_parsed")


def test_another_stored_layout_is_refused(spark, tmp_path):
    own = config(tmp_path, statistics_partitions=("region",))
    write_statistics(bronze(spark, {}), own)
    before = rows(spark.read.parquet(own.silver("clean_statistics")), "video_id")
    with pytest.raises(StoredLayoutError):
        merge_statistics(bronze(spark, dict(video_id="b")), own.silver("clean_statistics"), str(tmp_path / "s"), 0, job_name="j")
    with pytest.raises(StoredLayoutError):
        write_partitioned(spark.range(1).withColumn("other", F.lit(1)), own.silver("clean_statistics"), ("other",))
    assert rows(spark.read.parquet(own.silver("clean_statistics")), "video_id") == before


def test_full_run_over_another_day_keeps_history(spark, tmp_path):
    own = config(tmp_path)
    write_statistics(bronze(spark, dict(video_id="a")), own)
    write_statistics(bronze(spark, dict(video_id="c", trending_date="17.15.11")), own)
    assert rows(spark.read.parquet(own.silver("clean_statistics")), "video_id") == [("a",), ("c",)]


def test_older_late_row_does_not_replace_a_newer_one(spark, tmp_path):
    own, stamp = config(tmp_path), "timestamp'2024-01-0{} 00:00:00'"
    write_statistics(bronze(spark, dict(views="5")).withColumn("at", F.expr(stamp.format(2))), own, recency="at")
    merge_statistics(
        bronze(spark, dict(views="900")).withColumn("at", F.expr(stamp.format(1))), own.silver("clean_statistics"),
        str(tmp_path / "staging"), 0, job_name="j", recency="at")
    assert rows(spark.read.parquet(own.silver("clean_statistics")), "views") == [(5,)]


def test_corrected_csv_replaces_the_earlier_one(spark, tmp_path):
    def deliver(name, views, time):
        folder = tmp_path / "bronze" / "region=us"
        folder.mkdir(parents=True, exist_ok=True)
        plain = dict(zip(CSV_COLUMNS, bronze(spark, dict(views=views)).first()))
        names = [c for c in CSV_COLUMNS if c != "region"]
        (folder / name).write_text(",".join(names) + "\n" + ",".join(plain[c] for c in names) + "\n")
        os.utime(folder / name, (time, time))

    deliver("z.csv", "300", 1_600_000_000)
    deliver("a.csv", "200", 1_700_000_000)
    clean = clean_statistics(read_statistics_csv(spark, str(tmp_path / "bronze")), job_name="j")
    assert rows(clean, "views") == [(200,)]


def test_newest_category_file_by_time_not_by_name(spark, tmp_path):
    folder = tmp_path / "region=us"
    folder.mkdir()
    for name, title, time in (("9.json", "Old", 1_600_000_000), ("10.json", "New", 1_700_000_000)):
        (folder / name).write_text('{"items": [{"id": "1", "snippet": {"title": "%s"}}]}' % title)
        os.utime(folder / name, (time, time))
    files = read_reference_files(spark, [str(folder / "9.json"), str(folder / "10.json")])
    assert rows(clean_reference(files, job_name="j", mode="latest_file"), "category_title") == [("New",)]


def test_empty_reference_is_refused(spark, tmp_path):
    empty = spark.createDataFrame([("k", [], "us")], "kind string, items array<struct<kind:string,id:string,snippet:struct<title:string,assignable:boolean>>>, region string")
    with pytest.raises(EmptyReferenceError):
        write_reference(empty, config(tmp_path))


def test_coverage_of_runs_without_landings_and_unexpected_regions(spark):
    landed = spark.createDataFrame([(("r1", "us", 2),), (("r1", "xx", 1),)], "_pipeline_metadata struct<ingestion_id:string,region:string,video_count:bigint>")
    coverage = ingestion_coverage(landed, "us,gb", ["r0"])
    assert rows(coverage, "ingestion_id", "region", "landed", "expected") == [
        ("r0", "gb", False, True), ("r0", "us", False, True), ("r1", "gb", False, True), ("r1", "us", True, True), ("r1", "xx", True, False)]
    assert rows(coverage_summary(coverage)) == [("r0", 2, 0, ["gb", "us"], []), ("r1", 2, 1, ["gb"], ["xx"])]
    assert rows(coverage_summary(ingestion_coverage(landed.limit(0), "us,gb", ["r9"]))) == [("r9", 2, 0, ["gb", "us"], [])]


def test_large_counters_stop_nothing(spark):
    large = str(2 ** 63 - 1)
    clean = clean_statistics(bronze(spark, *(dict(video_id=v, views="1", likes=large, dislikes="1", comment_count=large) for v in "ab")), job_name="j")
    assert clean.first()["engagement_rate"] == pytest.approx((2 * (2 ** 63 - 1) + 1) * 100)
    for gold in (trending_analytics(clean), channel_analytics(clean), category_analytics(clean)):
        row = gold.first()
        assert row["total_likes"] is None and row["avg_engagement_rate"] == pytest.approx((2 * (2 ** 63 - 1) + 1) * 100)


def test_means_do_not_depend_on_the_order_of_rows(spark):
    values = [1_000_100.0] + [round(random.Random(1).random() * 50 + i / 7, 4) for i in range(999)]
    found = set()
    for seed in range(5):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "rate double").repartition(1 + seed)
        found.add(df.agg(fn.rate_mean("rate")).first()[0])
    assert len(found) == 1 and found.pop() == pytest.approx(sum(values) / 1000)


def test_building_gold_starts_no_job(spark, tmp_path):
    path = str(tmp_path / "s")
    clean_statistics(bronze(spark, {}), job_name="j").write.parquet(path)
    stats, names = spark.read.parquet(path), spark.range(3).selectExpr("id category_id", "'n' category_name")
    spark.sparkContext.setJobGroup("gold-build", "building")
    try:
        frames = [trending_analytics(stats), channel_analytics(stats, names), category_analytics(stats, names)]
        for frame in frames:
            frame._jdf.queryExecution().executedPlan()
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("gold-build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_pipeline_leaves_no_work_files_and_no_stale_gold(spark, tmp_path):
    def files():
        return sorted(os.path.join(d, f) for d, _, names in os.walk(shared_folder(spark).removeprefix("file:")) for f in names)

    own, before = config(tmp_path), files()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        run_pipeline(spark, bronze(spark, {}, dict(region="de")), None, own)
        assert files() == before
        import shutil

        kept = tmp_path / "silver2" / "clean_statistics"
        shutil.copytree(tmp_path / "silver" / "clean_statistics" / "region=us", kept / "region=us")
        later = PipelineConfig(str(tmp_path / "silver2"), own.gold_path, rules={})
        build_gold(spark, later)
    for name in ("trending_analytics", "channel_analytics", "category_analytics"):
        assert rows(spark.read.parquet(own.gold(name)), "region") == [("us",)]


def test_ranks_in_pieces_equal_one_window(spark):
    draw = random.Random(4)
    table = [(draw.choice(["a", "b", None]), draw.choice([None, 0, 0, 0, -3, -7, 1, 5, 5, 1000, 2 ** 62, 2 ** 62 + 1]), draw.choice([None, "", "a", "é", "zz", f"n{i}"]) or f"x{i}", i)
             for i in range(400)]
    df = spark.createDataFrame(table, "g string, n bigint, label string, i long").dropDuplicates(["g", "n", "label"])
    out = number_rows(df, "g", "n", "label", "rank").collect()
    for g in ("a", "b", None):
        own = sorted((r for r in out if r["g"] == g), key=lambda r: (r["n"] is None, -(r["n"] or 0), r["label"].encode()))
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
