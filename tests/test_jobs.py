import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from trendlake import jobs
from trendlake.operators.quality import QualityGateError

HEADER = "video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,dislikes,comment_count,thumbnail_link,comments_disabled,ratings_disabled,video_error_or_removed,description\n"


def run(spark, *arguments):
    return jobs.run(spark, jobs.parser().parse_args([str(a) for a in arguments]))


@pytest.fixture
def lake(tmp_path):
    for region in ("US", "jp"):
        folder = tmp_path / "bronze" / f"region={region}"
        folder.mkdir(parents=True)
        (folder / "videos.csv").write_text(HEADER + "".join(f"v{i},17.14.11,t,c,10,p,x,100,1,1,1,l,False,False,False,d\n" for i in range(12)))
    folder = tmp_path / "categories" / "region=US" / "date=2026-04-01"
    folder.mkdir(parents=True)
    items = [{"kind": "c", "id": str(i), "snippet": {"title": f"name {i}", "assignable": True}} for i in range(12)]
    (folder / "x.json").write_text(json.dumps({"items": items}, indent=2))
    return tmp_path


def test_steps_in_order(spark, lake):
    silver, gold = lake / "silver", lake / "gold"
    assert run(spark, "silver", "--bronze", lake / "bronze", "--silver", silver, "--regions", "us, GB")["rows"] == 12
    assert run(spark, "reference", "--bronze", lake / "categories", "--silver", silver)["rows"] == 12
    assert run(spark, "check", "--silver", silver) is None
    assert run(spark, "gold", "--silver", silver, "--gold", gold)["channel_analytics"]["rows"] == 1
    table = spark.read.parquet(str(gold / "category_analytics"))
    assert rows(table, "category_name", "region", "video_count", "view_share_pct") == [("name 10", "us", 12, 100.0)]


def test_check_without_reference_fails(spark, lake):
    run(spark, "silver", "--bronze", lake / "bronze", "--silver", lake / "silver")
    with pytest.raises(QualityGateError):
        run(spark, "check", "--silver", lake / "silver")


def test_update_adds_new_files_to_a_full_run(spark, lake):
    run(spark, "silver", "--bronze", lake / "bronze", "--silver", lake / "silver")
    arguments = ("update", "--bronze", lake / "bronze", "--silver", lake / "silver", "--checkpoint", lake / "state")
    run(spark, *arguments)
    folder = lake / "bronze" / "region=US"
    (folder / "more.csv").write_text(HEADER + "v0,17.14.11,t,c,10,p,x,500,1,1,1,l,False,False,False,d\n")
    run(spark, *arguments)
    refresh = ("update-gold", "--silver", lake / "silver", "--gold", lake / "gold", "--checkpoint", lake / "gold-state")
    run(spark, *refresh)
    assert rows(spark.read.parquet(str(lake / "gold" / "trending_analytics")), "region", "total_views") == [("jp", 1200), ("us", 1600)]
    table = spark.read.parquet(str(lake / "silver" / "clean_statistics"))
    assert table.count() == 24 and rows(table.where("views = 500"), "video_id", "region") == [("v0", "us")]


def test_route_coverage_and_reference_updates(spark, tmp_path):
    from trendlake import land_payloads

    flat, bronze = tmp_path / "flat", tmp_path / "bronze"
    flat.mkdir()
    (flat / "USvideos.csv").write_text(HEADER + "v0,17.14.11,t,c,10,p,x,500,1,1,1,l,False,False,False,d\n")
    (flat / "DE_category_id.json").write_text('{"kind": "k", "items": [{"id": "1", "snippet": {"title": "Film"}}]}')
    run(spark, "route", "--files", flat, "--bronze", bronze)
    assert run(spark, "silver", "--bronze", bronze / "raw_stats", "--silver", tmp_path / "silver")["rows"] == 1
    assert spark.read.json(str(bronze / "raw_stats_reference_data")).first()["region"] == "DE"

    payloads = spark.sql("SELECT 'us' AS region, array(named_struct('id', 'v')) AS items")
    land_payloads(payloads, str(tmp_path / "landed"), moment=F.lit("2026-03-02 04:05:06").cast("timestamp"))
    (summary, missing) = sorted(run(spark, "coverage", "--bronze", tmp_path / "landed", "--regions", "us,gb", "--runs", "r9"), key=lambda r: r["ingestion_id"])
    assert summary["failed_regions"] == ["gb"] and missing["failed_regions"] == ["gb", "us"]

    folder = tmp_path / "categories" / "region=us" / "date=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text('{"items": [{"id": "1", "snippet": {"title": "Film"}}]}')
    run(spark, "update-reference", "--bronze", tmp_path / "categories", "--silver", tmp_path / "silver", "--checkpoint", tmp_path / "state", "--max-files", "5")
    assert rows(spark.read.parquet(str(tmp_path / "silver" / "clean_reference_data")), "category_title", "region") == [("Film", "us")]
