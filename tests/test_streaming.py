import json
from datetime import date, datetime

import pytest

from conftest import bronze, rows
from trendlake import clean_statistics
from trendlake.streaming import (
    merge_statistics, stream_reference_documents, stream_trending_documents, update_reference, update_statistics,
)
from trendlake.streaming import incremental
from trendlake.sources.bronze import read_trending_documents

KEPT = ("video_id", "region", "trending_date_parsed", "views", "title")


def deliver(root, region, day, hour, *videos):
    folder = root / f"region={region}" / f"date={day}" / f"hour={hour}"
    folder.mkdir(parents=True, exist_ok=True)
    items = [
        {"id": v, "snippet": {"title": f"{v}@{hour}"}, "statistics": {"viewCount": str(n)}} for v, n in videos
    ]
    (folder / f"{region}{day}{hour}.json").write_text(json.dumps({"items": items}, indent=2))


def run(spark, root, target, checkpoint, **options):
    query = update_statistics(
        stream_trending_documents(spark, str(root)), str(target), str(checkpoint), job_name="j", **options
    )
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


@pytest.mark.parametrize("partitions", [("region", "trending_date_parsed"), ("region",)])
def test_two_runs_equal_one(spark, tmp_path, partitions):
    root, silver, state = tmp_path / "bronze", tmp_path / "silver", tmp_path / "state"
    deliver(root, "us", "2026-04-01", "08", ("a", 1), ("b", 5))
    deliver(root, "us", "2026-04-01", "14", ("a", 3))
    deliver(root, "de", "2026-04-01", "08", ("a", 7))
    assert run(spark, root, silver, state, partition_by=partitions) == [3]
    # An earlier hour arriving late must not replace a later one.
    deliver(root, "us", "2026-04-01", "10", ("a", 2), ("b", 6), ("c", 1))
    deliver(root, "us", "2026-04-02", "08", ("a", 9))
    assert run(spark, root, silver, state, partition_by=partitions) == [2]
    assert run(spark, root, silver, state, partition_by=partitions) == []
    merged = spark.read.parquet(str(silver))
    full = clean_statistics(read_trending_documents(spark, str(root)), job_name="j", keep_recency=True)
    assert rows(merged, *KEPT, "_recency") == rows(full, *KEPT, "_recency")
    assert ("a", "us", date(2026, 4, 1), 3, "a@14") in rows(merged, *KEPT)
    untouched = merged.where("region = 'de'").first()["_processed_at"]
    assert untouched <= merged.where("views = 9").first()["_processed_at"]


def at(spark, *records):
    return bronze(spark, *records, at="timestamp")


def merge(batch, tmp_path, number):
    merge_statistics(batch, str(tmp_path / "silver"), str(tmp_path / "staging"), number, job_name="j", recency="at")


def test_repeated_batch_changes_nothing(spark, tmp_path):
    batch = at(spark, dict(at=datetime(2024, 1, 1)), dict(video_id="x", trending_date=None, at=datetime(2024, 1, 1)))
    merge(batch, tmp_path, 0)
    first = rows(spark.read.parquet(str(tmp_path / "silver")))
    merge(batch, tmp_path, 0)
    merge(batch, tmp_path, 1)
    assert rows(spark.read.parquet(str(tmp_path / "silver"))) == first and len(first) == 2


def test_run_that_died_while_replacing_is_finished(spark, tmp_path, monkeypatch):
    merge(at(spark, dict(views="1", at=datetime(2024, 1, 1)), dict(video_id="old", at=datetime(2024, 1, 1))), tmp_path, 0)

    def die(*args, **kwargs):
        # What a crash between removing and moving a partition leaves behind.
        for file in (tmp_path / "silver" / "region=us").rglob("*"):
            if file.is_file():
                file.write_bytes(b"")
                file.unlink()
        raise RuntimeError("lost")

    batch = at(spark, dict(views="2", at=datetime(2024, 1, 2)))
    with monkeypatch.context() as patched:
        patched.setattr(incremental, "write_partitioned", die)
        with pytest.raises(RuntimeError):
            merge(batch, tmp_path, 1)
    merge(batch, tmp_path, 1)
    spark.catalog.refreshByPath(str(tmp_path / "silver"))
    assert rows(spark.read.parquet(str(tmp_path / "silver")), "video_id", "views") == [("old", 200), ("v1", 2)]


def test_merge_writes_its_rows_once(spark, tmp_path):
    """The merged partitions are moved from staging, where nothing of the batch is left but its days."""
    batch = at(spark, dict(at=datetime(2024, 1, 1)), dict(video_id="x", trending_date=None, at=datetime(2024, 1, 1)))
    for number in range(2):
        merge(batch, tmp_path, number)
        assert {p.parts[len(tmp_path.parts) + 1] for p in (tmp_path / "staging").rglob("*.parquet")} == {"days", "batch"}
        assert spark.read.parquet(str(tmp_path / "silver")).count() == 2


def test_empty_batch_writes_nothing(spark, tmp_path):
    merge(at(spark, dict(video_id=None)), tmp_path, 0)
    assert not (tmp_path / "silver").exists()


def test_new_category_files_replace_their_region(spark, tmp_path):
    root, silver, state = tmp_path / "bronze", tmp_path / "silver", str(tmp_path / "state")

    def document(region, name, *titles):
        folder = root / f"region={region}"
        folder.mkdir(parents=True, exist_ok=True)
        items = [{"id": str(i), "snippet": {"title": t}} for i, t in enumerate(titles)]
        (folder / name).write_text(json.dumps({"items": items}, indent=2))

    def update():
        update_reference(stream_reference_documents(spark, str(root)), str(silver), state, job_name="j").awaitTermination()

    document("us", "1.json", "Film", "Autos")
    document("de", "1.json", "Aktion")
    update()
    document("us", "2.json", "Movies")
    update()
    assert rows(spark.read.parquet(str(silver)), "category_id", "category_title", "region") == [(0, "Aktion", "de"), (0, "Movies", "us")]


def test_merge_moves_rows_once(spark):
    """Copies are found and files are laid out behind one shuffle, by ranges of region, day and video."""
    silver = clean_statistics(bronze(spark, {}), job_name="j").localCheckpoint()
    merged = incremental._latest(incremental._in_ranges(silver, ("region", "trending_date_parsed")))
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1 and "rangepartitioning(region" in text
