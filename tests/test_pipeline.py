from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import bronze, rows
from trendlake import PipelineConfig, run_pipeline
from trendlake.operators.quality import QualityGateError, QualityRules
from trendlake.operators.reference import reference_items
from trendlake.operators.statistics import latest_statistics, prepare_statistics
from trendlake.plans import pipeline
from trendlake.plans.pipeline import finished_in_files, write_statistics
from trendlake.session import work_path

DOCUMENTS = """
    SELECT 'k' AS kind, array(named_struct('kind', 'c', 'id', '10', 'snippet', named_struct('title', 'Film', 'assignable', true))) AS items, 'US' AS region
"""


def videos(spark, count, **changes):
    return bronze(spark, *(dict(video_id=f"v{i}", channel_title=f"c{i % 3}", **changes) for i in range(count)), dict(video_id="v0", channel_title="c0", views="900"))


def config(tmp_path, **changes):
    rules = {
        "clean_statistics": QualityRules(("video_id", "title", "channel_title", "views", "region"), ("views",)),
        "clean_reference_data": QualityRules(("category_id", "region"), min_rows=1),
    }
    return PipelineConfig(str(tmp_path / "silver"), str(tmp_path / "gold"), rules=rules, **changes)


def test_whole_run_is_repeatable(spark, tmp_path):
    settings = config(tmp_path, silver_database="run_silver", gold_database="run_gold")
    for _ in range(2):
        written = run_pipeline(spark, videos(spark, 12), spark.sql(DOCUMENTS), settings)
    counts = written["clean_statistics"]
    assert (counts["rows_in"], counts["rows"], counts["null_title"], counts["negative_views"]) == (13, 12, 0, 0)
    assert written["clean_reference_data"]["rows"] == 1
    assert {name: written[name]["rows"] for name in ("trending_analytics", "channel_analytics", "category_analytics")} == {
        "trending_analytics": 1, "channel_analytics": 3, "category_analytics": 1,
    }
    assert rows(spark.table("run_gold.channel_analytics"), "rank_in_region", "total_videos", "categories", "region") == [
        (1, 4, ["Film"], "us"), (2, 4, ["Film"], "us"), (3, 4, ["Film"], "us"),
    ]
    assert spark.table("run_silver.clean_statistics").count() == 12
    assert spark.sql("SELECT channel_title FROM run_gold.channel_analytics WHERE region = 'us' ORDER BY times_trending DESC LIMIT 10").count() == 3


def test_silver_holds_one_shuffle_at_a_time(spark, tmp_path, monkeypatch):
    """The latest rows are stored, and their shuffle is given up, before the one that sizes the files; they go after it."""
    plans, paths, write = [], [], pipeline.write_partitioned

    def watched(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        assert all(list(Path(path).glob("*.parquet")) for path in paths)
        return write(df, *args, **kwargs)

    monkeypatch.setattr(pipeline, "work_path", lambda *args: paths.append(work_path(*args)) or paths[-1])
    monkeypatch.setattr(pipeline, "write_partitioned", watched)
    nothing = dict(views=None, likes="bad", dislikes=None, comment_count=None, title=None, trending_date=None)
    counts = write_statistics(bronze(spark, dict(views="5"), dict(views="7"), dict(video_id="x", **nothing)), config(tmp_path))
    assert (counts["rows_in"], counts["rows"], counts["null_title"]) == (3, 2, 1)
    assert len(paths) == len(plans) == 1 and plans[0].count("Exchange ") == 1 and "Window" not in plans[0]
    assert not Path(paths[0]).exists()
    silver = spark.read.parquet(str(tmp_path / "silver" / "clean_statistics"))
    assert rows(silver, "video_id", "views", "likes", "engagement_rate") == [("v1", 7, 7, 157.1429), ("x", 0, 0, 0.0)]


@pytest.mark.parametrize("partitions", [("region", "trending_date_parsed"), ("region", "_job_name")])
def test_derived_columns_are_not_shuffled_for_the_files(spark, tmp_path, partitions):
    settings = config(tmp_path, statistics_partitions=partitions)
    df = finished_in_files(latest_statistics(prepare_statistics(videos(spark, 5))), settings)
    above, below = df._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
    assert ("AS like_ratio" in above) == ("_job_name" not in partitions) and ("AS like_ratio" in below) == ("_job_name" in partitions)
    assert rows(df, "video_id") == [(f"v{i}",) for i in range(5)]


def test_failed_gate_stops_before_gold(spark, tmp_path):
    with pytest.raises(QualityGateError) as error:
        run_pipeline(spark, videos(spark, 12, views="-1"), spark.sql(DOCUMENTS), config(tmp_path))
    assert [f["check"] for f in error.value.failures] == ["value_range"]
    assert (tmp_path / "silver" / "clean_statistics").is_dir() and not (tmp_path / "gold").exists()


def test_stale_silver_fails_the_gate(spark, tmp_path):
    with pytest.raises(QualityGateError):
        run_pipeline(spark, videos(spark, 12), spark.sql(DOCUMENTS), config(tmp_path), now=F.current_timestamp() + F.expr("INTERVAL 3 DAYS"))


def test_empty_input_keeps_what_is_there(spark, tmp_path):
    settings = config(tmp_path)
    run_pipeline(spark, videos(spark, 12), spark.sql(DOCUMENTS), settings)
    written = run_pipeline(spark, videos(spark, 12).limit(0), None, settings)
    assert "clean_statistics" not in written and written["trending_analytics"]["rows"] == 1


def test_one_region_is_rebuilt_alone(spark, tmp_path):
    settings = config(tmp_path)
    both = videos(spark, 12).unionByName(videos(spark, 12).withColumn("region", F.lit("de")))
    run_pipeline(spark, both, spark.sql(DOCUMENTS), settings)
    changed = both.withColumn("views", F.lit("1"))
    run_pipeline(spark, changed, None, settings, regions=["DE"])
    gold = spark.read.parquet(settings.gold("trending_analytics"))
    assert rows(gold, "region", "total_views") == [("de", 12), ("us", 3100)]


def test_unique_texts_of_silver_take_no_dictionary(spark, tmp_path):
    write_statistics(videos(spark, 12), config(tmp_path))
    [file, *_] = (tmp_path / "silver" / "clean_statistics").rglob("*.parquet")
    group = pq.read_metadata(file).row_group(0)
    columns = {c.path_in_schema: c.encodings for c in map(group.column, range(group.num_columns))}
    dictionary = {name for name, kinds in columns.items() if any("DICTIONARY" in kind for kind in kinds)}
    assert not dictionary & {"video_id", "title", "thumbnail_link", "description"} and {"channel_title", "tags"} <= dictionary


def test_search_for_categories_shuffles_nothing(spark):
    items = reference_items(spark.sql(DOCUMENTS))
    assert "Exchange" not in items._jdf.queryExecution().executedPlan().toString() and items.count() == 1
