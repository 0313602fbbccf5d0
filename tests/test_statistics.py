import json
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import CSV_COLUMNS, bronze, rows
from trendlake import clean_statistics, schemas
from trendlake.operators.statistics import GOLD_COLUMNS, conform_statistics, finish_statistics, statistics_format
from trendlake.sources.bronze import read_statistics_csv, read_trending_documents


def test_csv_values_are_cast_or_null(spark):
    df = clean_statistics(bronze(
        spark,
        dict(video_id="a", category_id="bad", views="xx", likes=None, dislikes="2.0", comments_disabled="maybe"),
        dict(video_id="b", region=" uS ", comments_disabled="True", trending_date="17.32.13"),
        dict(video_id=None),
    ), job_name="job")
    assert rows(df, "video_id", "category_id", "views", "likes", "dislikes", "comments_disabled", "region", "trending_date_parsed") == [
        ("a", None, 0, 0, 2, None, "us", date(2017, 11, 14)),
        ("b", 10, 200, 7, 1, True, "us", None),
    ]
    assert df.columns[-6:] == ["trending_date_parsed", "like_ratio", "engagement_rate", "_processed_at", "_job_name", "_recency"]
    assert dict(df.dtypes)["views"] == "bigint" and dict(df.dtypes)["_processed_at"] == "timestamp"


def test_rates(spark):
    df = clean_statistics(bronze(
        spark, dict(video_id="a"), dict(video_id="b", views="0"), dict(video_id="c", views="-4"),
    ), job_name="job")
    assert rows(df, "video_id", "like_ratio", "engagement_rate") == [("a", 3.5, 5.5), ("b", 0.0, 0.0), ("c", 0.0, 0.0)]


def test_latest_copy_wins_by_recency(spark):
    df = bronze(
        spark,
        dict(views="900", at=datetime(2024, 1, 1)), dict(views="100", at=datetime(2024, 1, 2)),
        dict(views="500", at=None), dict(region="us ", views="50", at=datetime(2023, 1, 2)),
        at="timestamp",
    )
    assert rows(clean_statistics(df, job_name="j", recency="at"), "views") == [(100,)]
    # Without a recency the largest counters are the latest.
    assert rows(clean_statistics(df, job_name="j"), "views") == [(900,)]


def test_null_dates_are_one_day(spark):
    df = bronze(spark, dict(trending_date="xx", views="1"), dict(trending_date=None, views="2"), dict(views="3"))
    assert rows(clean_statistics(df, job_name="j"), "views", "trending_date_parsed") == [(2, None), (3, date(2017, 11, 14))]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["1", "2", None]), st.sampled_from(["x", "y", None])), min_size=1, max_size=12))
def test_survivor_does_not_depend_on_partitioning(spark, copies):
    records = [dict(video_id=v, views=n, title=t) for v, n, t in copies]
    forward = bronze(spark, *records).repartition(5)
    backward = bronze(spark, *records[::-1]).coalesce(1)
    kept = [rows(clean_statistics(df, job_name="j").drop("_processed_at")) for df in (forward, backward)]
    assert kept[0] == kept[1]
    assert len(kept[0]) == len({v for v, _, _ in copies})


def test_one_key_with_a_third_of_all_rows(spark):
    df = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 5000)).alias("video_id"),
        F.col("id").cast("string").alias("views"), F.lit("US").alias("region"), F.lit("17.14.11").alias("trending_date"),
        *(F.lit(None).cast("string").alias(c) for c in CSV_COLUMNS if c not in ("video_id", "views", "region", "trending_date")),
    )
    clean = clean_statistics(df, job_name="j")
    assert clean.count() == 5001
    assert rows(clean.where("video_id = 'hot'"), "views") == [(59_997,)]


VIDEO = {
    "id": "v1",
    "snippet": {
        "title": "t", "channelTitle": "c", "categoryId": "10", "publishedAt": "p", "tags": ["a", "b"],
        "description": "line\nline", "thumbnails": {"default": {"url": "http://x"}},
    },
    "statistics": {"viewCount": "200", "likeCount": "7", "commentCount": "3"},
}
BARE = {"id": "v2", "snippet": {"title": "t2", "channelTitle": "c"}, "statistics": {"viewCount": "5"}}


def write_document(folder, document, name="x.json"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(document, indent=2, ensure_ascii=False))


def test_api_documents(spark, tmp_path):
    day = tmp_path / "region=us" / "date=2026-04-01" / "hour=08"
    write_document(day, {"kind": "k", "items": [VIDEO, BARE]})
    write_document(day, {"kind": "k", "items": []}, "empty.json")
    write_document(day, {"kind": "k"}, "none.json")
    write_document(tmp_path / "region=GB" / "date=2026-04-01" / "hour=09", {"items": [VIDEO]})
    df = read_trending_documents(spark, str(tmp_path))
    assert statistics_format(df) == "documents"
    assert df.where("region = 'us'").select("hour").distinct().collect()[0][0] == "08"
    clean = clean_statistics(df, job_name="j", keep_recency=True)
    assert rows(clean, "video_id", "region", "trending_date", "tags", "views", "likes", "dislikes", "thumbnail_link", "description", "_recency") == [
        ("v1", "gb", "26.01.04", "a|b", 200, 7, 0, "http://x", "line\nline", datetime(2026, 4, 1, 9)),
        ("v1", "us", "26.01.04", "a|b", 200, 7, 0, "http://x", "line\nline", datetime(2026, 4, 1, 8)),
        ("v2", "us", "26.01.04", None, 5, 0, 0, None, None, datetime(2026, 4, 1, 8)),
    ]
    assert read_trending_documents(spark, str(tmp_path), ["US"]).count() == 3
    given_day = clean_statistics(df, job_name="j", snapshot_date=date(2025, 2, 3))
    assert given_day.select("trending_date_parsed").distinct().collect()[0][0] == date(2025, 2, 3)


def test_newer_ingestion_of_one_day_wins(spark, tmp_path):
    for hour, views in (("08", "10"), ("14", "5")):
        document = {"items": [{"id": "v", "snippet": {"title": "t"}, "statistics": {"viewCount": views}}]}
        write_document(tmp_path / "region=us" / "date=2026-04-01" / f"hour={hour}", document)
    clean = clean_statistics(read_trending_documents(spark, str(tmp_path)), job_name="j")
    assert rows(clean, "views") == [(5,)]


@pytest.mark.parametrize("separator", [".", "__"])
def test_flat_api_rows(spark, separator):
    names = ["snippet.title", "snippet.channelTitle", "snippet.categoryId", "snippet.publishedAt", "snippet.description",
             "statistics.viewCount", "statistics.likeCount", "statistics.commentCount"]
    columns = ["id", *(n.replace(".", separator) for n in names), "region"]
    df = spark.createDataFrame([("v1", "t", "c", "10", "p", "d", "200", "7", "3", "US")], columns)
    assert statistics_format(df) == "api"
    clean = clean_statistics(df, job_name="j", snapshot_date=date(2026, 4, 1))
    assert rows(clean, "video_id", "title", "category_id", "views", "dislikes", "comments_disabled", "tags", "region") == [
        ("v1", "t", 10, 200, 0, False, None, "us")
    ]


def test_rows_without_a_day_get_today(spark):
    df = spark.createDataFrame([("v1", "t", "US")], "id string, snippet__title string, region string")
    today = spark.range(1).select(F.current_date()).first()[0]
    assert clean_statistics(df, job_name="j").first()["trending_date_parsed"] == today


def test_mixed_forms_make_one_table(spark, tmp_path):
    write_document(tmp_path / "region=us" / "date=2026-04-01" / "hour=08", {"items": [VIDEO]})
    api = conform_statistics(read_trending_documents(spark, str(tmp_path)))
    csv = conform_statistics(bronze(spark, dict(video_id="old")))
    both = csv.unionByName(api)
    assert rows(both, "video_id", "category_id") == [("old", 10), ("v1", 10)]


def test_csv_files_with_quotes_and_line_breaks(spark, tmp_path):
    folder = tmp_path / "region=US"
    folder.mkdir()
    header = "video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,dislikes,comment_count,thumbnail_link,comments_disabled,ratings_disabled,video_error_or_removed,description\n"
    (folder / "USvideos.csv").write_text(
        header + 'v1,17.14.11,"He said ""no"", twice",Kanal ü,10,p,"a|""b""",200,7,1,3,http://x,False,False,False,"one\ntwo, three"\n'
    )
    other = tmp_path / "region=jp"
    other.mkdir()
    (other / "x.csv").write_text(header)
    df = clean_statistics(read_statistics_csv(spark, str(tmp_path), ["us"]), job_name="j")
    assert rows(df, "title", "channel_title", "tags", "views", "description", "region") == [
        ('He said "no", twice', "Kanal ü", 'a|"b"', 200, "one\ntwo, three", "us")
    ]


def test_chosen_columns_are_those_of_all_columns(spark):
    """Copies that tie in recency and counters: what is left out decides nothing that is given."""
    raw = bronze(
        spark, dict(title="a", channel_title="x", category_id="2"), dict(title="b", channel_title="y", category_id="1", tags="z"),
        dict(title="b", channel_title="y", category_id="3", description="e"), dict(title="b", channel_title=None, category_id="4"),
        dict(video_id="v2", tags="a"), dict(video_id="v2", tags="b", description=None), dict(video_id="v3", trending_date="x"))
    for columns in (GOLD_COLUMNS, ("region",), ("tags", "video_id")):
        full = clean_statistics(raw, job_name="j").select(*columns)
        chosen = clean_statistics(raw, job_name="j", columns=columns)
        assert chosen.dtypes == full.dtypes and rows(chosen) == rows(full)
    shuffled = clean_statistics(raw, job_name="j", columns=GOLD_COLUMNS)._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")[0]
    assert not any(name in shuffled for name in ("description", "thumbnail", "tags", "publish_time"))


def test_rates_round_as_round_does(spark):
    """Also in the middle between two units, below 0 and for counters that don't fit a bigint together."""
    df = spark.range(4_000).selectExpr(
        "cast(if(id % 50 = 0, 9223372036854775800, id * 7 % 4001 - 900) as bigint) likes", "cast(if(id % 75 = 0, 9223372036854775800, id % 9) as bigint) dislikes",
        "cast(if(id % 4 = 0, 9223372036854775800 - id, -id) as bigint) comment_count", "cast(elt(1 + id % 5, 20000, 3, 800000, 1, 16 + id) as bigint) views")
    rest = [F.lit(None).cast(kind).alias(name) for name, kind in schemas.STATISTICS.items() if name not in df.columns]
    wide = df.select("*", *rest, F.lit(None).cast("date").alias("trending_date_parsed"))
    exact = "cast(likes as decimal(20,0)) + cast(dislikes as decimal(20,0)) + cast(comment_count as decimal(20,0))"
    expected = ["round(likes / views * 100, 4) = like_ratio", f"round(cast({exact} as double) / views * 100, 4) = engagement_rate"]
    found = finish_statistics(wide, job_name="j", keep_recency=False)
    assert found.where(" and ".join(f"({e})" for e in expected)).count() == 4_000
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "rint" in text.lower() and "2305843009213693952" in text
