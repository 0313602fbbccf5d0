import hashlib
import json
from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from trendlake import classify_files, ingestion_coverage, land_payloads, list_files, write_partitioned
from trendlake.operators.landing import coverage_summary
from trendlake.sources.bronze import (
    preview_csv, read_csv_tolerant, read_reference_documents, read_reference_records, read_trending_documents, record_status,
)
from trendlake.sources.files import route_files, route_reference, route_statistics

MOMENT = datetime(2026, 3, 2, 4, 5, 6)
PAYLOADS = """
    SELECT 'k' AS kind, array(named_struct('id', 'v1'), named_struct('id', 'v2')) AS items, ' US' AS region
    UNION ALL SELECT 'k', array(), 'gb' UNION ALL SELECT 'k', NULL, 'DE'
"""


def test_payloads_land_with_metadata(spark, tmp_path):
    land_payloads(spark.sql(PAYLOADS), str(tmp_path), moment=F.lit(MOMENT), source="api")
    assert (tmp_path / "region=us" / "date=2026-03-02" / "hour=04").is_dir()
    df = read_trending_documents(spark, str(tmp_path), one_per_line=True)
    assert rows(df, "region", "date", "hour", "_pipeline_metadata") == [
        (region, "2026-03-02", "04", ("20260302_040506", region, "2026-03-02T04:05:06.000000Z", videos, "api"))
        for region, videos in (("de", 0), ("gb", 0), ("us", 2))
    ]


def test_reference_payloads_land_by_day(spark, tmp_path):
    land_payloads(spark.sql(PAYLOADS), str(tmp_path), "reference", moment=F.lit(MOMENT))
    assert (tmp_path / "region=gb" / "date=2026-03-02").is_dir()
    df = read_reference_documents(spark, str(tmp_path), ["US"], one_per_line=True, partitions=("region", "date"))
    assert rows(df, "region", "_pipeline_metadata.video_count", "_pipeline_metadata.source") == [("us", None, "api")]


def test_coverage(spark, tmp_path):
    land_payloads(spark.sql(PAYLOADS), str(tmp_path), moment=F.lit(MOMENT))
    landed = read_trending_documents(spark, str(tmp_path), one_per_line=True)
    coverage = ingestion_coverage(landed, "US,gb, fr")
    run = "20260302_040506"
    assert rows(coverage.where("expected").drop("expected")) == [(run, "fr", 0, 0, False), (run, "gb", 1, 0, True), (run, "us", 1, 2, True)]
    assert rows(coverage_summary(coverage)) == [(run, 3, 2, ["fr"], ["de"])]
    expected = spark.createDataFrame([("US",), ("gb",), (" fr",)], "region string")
    assert rows(ingestion_coverage(landed, expected)) == rows(coverage)
    none = ingestion_coverage(landed, ["xx"])
    assert rows(none.where("expected")) == [(run, "xx", 0, 0, False, True)]


def make_files(folder):
    header = "video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,dislikes,comment_count,thumbnail_link,comments_disabled,ratings_disabled,video_error_or_removed,description\n"
    (folder / "USvideos.csv").write_text(header + "v1,17.14.11,t,c,1,p,x,1,1,1,1,l,False,False,False,d\n")
    (folder / "notes.csv").write_text(header)
    (folder / "CA_category_id.json").write_text(json.dumps({"kind": "k", "items": [{"id": "1", "snippet": {"title": "Film"}}]}))
    (folder / "other.txt").write_text("x")


def test_listing_and_routing(spark, tmp_path):
    make_files(tmp_path)
    files = list_files(spark, str(tmp_path))
    assert rows(classify_files(files), "name", "kind", "region", "target") == [
        ("CA_category_id.json", "raw_stats_reference_data", "CA", "raw_stats_reference_data/region=CA/CA_category_id.json"),
        ("USvideos.csv", "raw_stats", "US", "raw_stats/region=US/USvideos.csv"),
        ("notes.csv", "raw_stats", "unknown", "raw_stats/region=unknown/notes.csv"),
    ]
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_routed_rows_carry_their_region(spark, tmp_path):
    make_files(tmp_path)
    csv = route_statistics(spark, str(tmp_path / "*.csv"))
    assert rows(csv, "video_id", "region") == [("v1", "US")]
    write_partitioned(csv, str(tmp_path / "bronze"))
    assert (tmp_path / "bronze" / "region=US").is_dir()
    documents = route_reference(spark, str(tmp_path / "*.json"))
    assert rows(documents, "region", "items.id") == [("CA", ["1"])]


def test_files_are_routed_byte_for_byte(spark, tmp_path):
    flat, bronze = tmp_path / "flat", tmp_path / "bronze"
    flat.mkdir()
    make_files(flat)
    broken = b'a,b\r\n"never closed, \xff\xfe\x00 1,2,3,4\n\n' * 3
    (flat / "DE_broken.csv").write_bytes(broken)
    (flat / "GB plus+per%20cent.json").write_bytes(b"{not json")
    for _ in range(2):
        routed = route_files(spark, str(flat), "file://" + str(bronze))
        found = {r["name"]: r for r in routed.collect()}
        assert set(found) == {p.name for p in flat.iterdir()} - {"other.txt"}
        for name, row in found.items():
            copy = bronze / row["kind"] / f"region={row['region']}" / name
            assert copy.read_bytes() == (flat / name).read_bytes() and row["length"] == copy.stat().st_size
            assert row["sha256"] == hashlib.sha256(copy.read_bytes()).hexdigest()
        assert len([p for p in bronze.rglob("*") if p.is_file()]) == len(found)
    assert found["DE_broken.csv"]["region"] == "DE" and found["GB plus+per%20cent.json"]["kind"] == "raw_stats_reference_data"


def test_files_named_by_a_table_of_records(spark, tmp_path):
    for region, name in (("us", "a+b.json"), ("us", "left out.json"), ("middle east", "c d.json"), ("fr", "never.json")):
        folder = tmp_path / f"region={region}"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(json.dumps({"kind": name, "items": [{"id": "1", "snippet": {"title": "Film"}}]}, indent=2))
    keys = ["raw%2Fregion%3Dus%2Fa%2Bb.json", "raw/region%3Dmiddle+east/c%20d.json", "raw%2Fregion%3Dus%2Fa%2Bb.json", "raw/region=us/none.json", "other/region=us/left+out.json", None]
    records = spark.createDataFrame([(k,) for k in keys], "key string")
    named = read_reference_records(spark, str(tmp_path), records, prefix="raw/")
    assert rows(named, "kind", "region") == [("a+b.json", "us"), ("c d.json", "middle east")]
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert rows(record_status(spark, "file://" + str(tmp_path), records, prefix="raw/")) == [
        ("region=middle east/c d.json", 1, True), ("region=us/a+b.json", 2, True), ("region=us/none.json", 1, False)]
    assert read_reference_records(spark, str(tmp_path), records.limit(0)).count() == 0


def test_preview_and_tolerant_csv(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b\n" + "".join(f"{i},t{i}\n" for i in range(30)) + "bad\n1,2,3\n")
    preview = preview_csv(spark, str(path))
    assert preview.count() == 10
    df = read_csv_tolerant(spark, str(path), "a int, b string").cache()
    assert df.where("_corrupt_record IS NULL").count() == 30
    assert rows(df.where("_corrupt_record IS NOT NULL"), "_corrupt_record") == [("1,2,3",), ("bad",)]
