"""Gold from changed days: equal to a full build, and only these days are read."""

import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import bronze, rows
from trendlake import PipelineConfig, channel_analytics
from trendlake.operators.aggregates import category_analytics, channel_totals
from trendlake.operators.channel_state import categories_from_parts, channel_parts, channel_videos, totals_from_state
from trendlake.plans import refresh
from trendlake.plans.pipeline import build_gold, write_reference, write_statistics
from trendlake.plans.refresh import compact_channel_state, refresh_gold, update_gold
from trendlake.schemas import SILVER_PARTITIONS
from trendlake.sources.tables import of_partitions
from trendlake.streaming import merge_statistics

TABLES = ("trending_analytics", "channel_analytics", "category_analytics")
DOCUMENTS = """
    SELECT 'k' AS kind, array(named_struct('kind', 'c', 'id', '10', 'snippet', named_struct('title', 'Film', 'assignable', true)),
                              named_struct('kind', 'c', 'id', '11', 'snippet', named_struct('title', 'Autos', 'assignable', true))) AS items, 'US' AS region
"""


def config(tmp_path, name="gold"):
    return PipelineConfig(str(tmp_path / "silver"), str(tmp_path / name), rules={})


def first(spark):
    """Three days in two regions, with rows without a date and without a channel."""
    return bronze(spark, *(
        dict(video_id=f"v{i % 9}", trending_date=day, region=region, channel_title=f"c{i % 4}" if i % 7 else None, category_id=str(10 + i % 3), views=str(i * 10), likes=str(i))
        for i, (day, region) in enumerate([(d, r) for d in ("17.14.11", "17.15.11", "17.16.11", "xx") for r in ("US", "de")] * 5)))


def merged(spark, own, tmp_path, number, *records):
    merge_statistics(bronze(spark, *records), own.silver(own.statistics_table), str(tmp_path / "staging"), number, job_name="j", changes=own.changes)


def tables(spark, own):
    return {name: rows(spark.read.parquet(own.gold(name)).drop("_aggregated_at")) for name in TABLES}


def rebuilt(spark, tmp_path, own):
    full = config(tmp_path, "full")
    build_gold(spark, full)
    return tables(spark, full)


def update(spark, own, tmp_path):
    update_gold(spark, own, str(tmp_path / "gold-state")).awaitTermination()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Silver of a full run and a merge, and gold from it."""
    path = tmp_path_factory.mktemp("built")
    own = config(path)
    write_reference(spark.sql(DOCUMENTS), own)
    write_statistics(first(spark), own)
    merged(spark, own, path, 0, dict(video_id="n0", trending_date="17.14.11", channel_title="c9"))
    update(spark, own, path)
    return path


@pytest.fixture
def lake(built, tmp_path):
    for name in ("silver", "gold", "staging"):
        shutil.copytree(built / name, tmp_path / name)
    return config(tmp_path)


def test_state_gives_the_channel_totals(spark, lake):
    stats = spark.read.parquet(lake.silver("clean_statistics"))
    reference = spark.read.parquet(lake.silver("clean_reference_data"))
    for names in (reference, None):
        state = totals_from_state(channel_parts(stats), channel_videos(stats), names)
        assert state.dtypes == channel_totals(stats, names).dtypes
        assert rows(state) == rows(channel_totals(stats, names))


def test_two_updates_equal_a_full_build(spark, tmp_path, lake):
    assert tables(spark, lake) == rebuilt(spark, tmp_path, lake)
    # A changed channel, a new day, a new region, a day without a date, a channel that loses its only video of a day.
    merged(spark, lake, tmp_path, 1, dict(video_id="v1", trending_date="17.15.11", channel_title="other", views="7777"), dict(video_id="n1", trending_date="17.20.11"),
           dict(video_id="n0", trending_date="17.14.11", channel_title="c8", views="900"))
    update(spark, lake, tmp_path)
    assert tables(spark, lake) == rebuilt(spark, tmp_path, lake)
    merged(spark, lake, tmp_path, 2, dict(video_id="n2", trending_date=None, region="fr"), dict(video_id="n3", trending_date="bad", channel_title=None, views="99999"))
    update(spark, lake, tmp_path)
    before = tables(spark, lake)
    compact_channel_state(spark, lake)
    assert [p.name for p in (tmp_path / "gold" / "channel_days").iterdir() if p.is_dir()] == ["_version=3"]
    merged(spark, lake, tmp_path, 3, dict(video_id="n4", trending_date="17.15.11", views="1"))
    update(spark, lake, tmp_path)
    found = tables(spark, lake)
    assert found != before and found == rebuilt(spark, tmp_path, lake)
    assert {r[-1] for r in found["trending_analytics"]} == {"us", "de", "fr"} and len(found["channel_analytics"]) > 8
    before = [p.stat().st_mtime_ns for p in sorted((tmp_path / "gold").rglob("*.parquet"))]
    update(spark, lake, tmp_path)
    assert [p.stat().st_mtime_ns for p in sorted((tmp_path / "gold").rglob("*.parquet"))] == before


def test_other_regions_are_not_written(spark, tmp_path, lake):
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold").rglob("*.parquet") if "region=de" in str(p)}
    merged(spark, lake, tmp_path, 1, dict(video_id="n1", trending_date="17.15.11", region="us"))
    update(spark, lake, tmp_path)
    assert stamps and all(p.exists() and p.stat().st_mtime_ns == t for p, t in stamps.items())


def test_refresh_that_died_is_finished_by_the_repeated_batch(spark, tmp_path, lake, monkeypatch):
    merged(spark, lake, tmp_path, 1, dict(video_id="n0", trending_date="17.14.11", channel_title="c8", views="900"))
    changes, staging = spark.read.parquet(lake.changes), str(tmp_path / "refresh")
    calls, write = [], refresh.write_partitioned

    def die(df, path, *args, **kwargs):
        calls.append(path)
        if len(calls) == 3:
            # Killed while the state is half replaced.
            for file in (tmp_path / "gold" / "channel_analytics").rglob("*.parquet"):
                file.unlink()
            raise RuntimeError("lost")
        return write(df, path, *args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(refresh, "write_partitioned", die)
        with pytest.raises(RuntimeError):
            refresh_gold(changes, lake, staging, 7)
    spark.catalog.refreshByPath(lake.gold("channel_analytics"))
    refresh_gold(changes, lake, staging, 7)
    assert {r[0] for r in tables(spark, lake)["channel_analytics"]} == {r[0] for r in rebuilt(spark, tmp_path, lake)["channel_analytics"]}


def test_state_is_written_once(spark, tmp_path, lake):
    """New state is moved from staging into gold."""
    merged(spark, lake, tmp_path, 1, dict(video_id="n0", trending_date="17.14.11", channel_title="c8", views="900"))
    staging = tmp_path / "refresh"
    for _ in range(2):
        refresh_gold(spark.read.parquet(lake.changes), lake, str(staging), 7)
        assert not [p for name in ("channel_parts", "channel_videos", "channel_days") for p in (staging / name).rglob("*.parquet")]
        assert {r[0] for r in tables(spark, lake)["channel_analytics"]} == {r[0] for r in rebuilt(spark, tmp_path, lake)["channel_analytics"]}


def scanned(df):
    """Partitions read by the scans of an executed plan."""
    df.collect()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            metric = node.metrics().get("numPartitions")
            found.append(metric.get().value() if metric.isDefined() else None)
        for name in ("executedPlan", "plan"):
            if node.nodeName().startswith(("AdaptiveSparkPlan",)) and name == "executedPlan" or "QueryStage" in node.nodeName() and name == "plan":
                walk(getattr(node, name)())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_only_the_listed_days_are_scanned(spark, lake):
    stats = spark.read.parquet(lake.silver("clean_statistics"))
    assert stats.select(*SILVER_PARTITIONS).distinct().count() == 8
    days = spark.createDataFrame([("us", date(2017, 11, 14), 1), ("de", None, 2), ("nowhere", date(2017, 11, 14), 1)], "region string, trending_date_parsed date, rows bigint")
    few = of_partitions(stats, days, SILVER_PARTITIONS).select("video_id", *SILVER_PARTITIONS)
    assert scanned(few) == [2] and rows(few.select(*SILVER_PARTITIONS).distinct()) == [("de", None), ("us", date(2017, 11, 14))]


def test_channel_table_of_nothing(spark, lake):
    nothing = spark.read.parquet(lake.silver("clean_statistics")).limit(0)
    assert rows(totals_from_state(channel_parts(nothing), channel_videos(nothing))) == [] and channel_analytics(nothing).count() == 0


def test_state_gives_the_category_table(spark, lake):
    stats = spark.read.parquet(lake.silver("clean_statistics"))
    reference = spark.read.parquet(lake.silver("clean_reference_data"))
    for names in (reference, None):
        full = category_analytics(stats, names).drop("_aggregated_at")
        state = categories_from_parts(channel_parts(stats), names).drop("_aggregated_at")
        assert state.dtypes == full.dtypes and rows(state) == rows(full)
