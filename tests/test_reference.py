import json
import warnings
from datetime import datetime

import pytest

from conftest import rows
from trendlake import category_lookup, clean_reference, with_category_names
from trendlake.operators.reference import EmptyReferenceError, normalise_reference, validate_reference
from trendlake.sources.bronze import read_reference_documents, read_reference_files


def item(identifier, title, assignable=True):
    return {"kind": "category", "id": identifier, "snippet": {"title": title, "assignable": assignable}}


@pytest.fixture
def folder(tmp_path):
    documents = {
        "region=US/date=2026-04-01/a.json": {"kind": "list", "items": [item("1", " Film "), item("x", "?"), item("1", "Film II")]},
        "region=US/date=2026-04-02/b.json": {"kind": "list", "items": [item("1", "Film III"), item("2", "Autos", False)]},
        "region=us/date=2026-04-01/c.json": {"kind": "list", "items": [item("3", "Music")]},
        "region=de/date=2026-04-01/d.json": {"kind": "list", "items": [item("1", "Aktion")]},
        "region=fr/date=2026-04-01/e.json": {"kind": "list", "items": []},
        "region=fr/date=2026-04-01/f.json": {"kind": "list"},
    }
    for name, document in documents.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(document, indent=2))
    return tmp_path


def read(spark, folder):
    return read_reference_documents(spark, str(folder), partitions=("region", "date"))


def test_merge_keeps_the_newest_of_each_category(spark, folder):
    df = clean_reference(read(spark, folder), job_name="j")
    assert rows(df, "category_id", "category_title", "assignable", "kind", "region") == [
        (1, "Aktion", True, "category", "de"),
        (1, "Film III", True, "category", "us"),
        (2, "Autos", False, "category", "us"),
        (3, "Music", True, "category", "us"),
    ]


def test_latest_file_replaces_its_region(spark, folder):
    df = clean_reference(read(spark, folder), job_name="j", mode="latest_file")
    assert rows(df, "category_id", "category_title", "region") == [
        (1, "Aktion", "de"), (1, "Film III", "us"), (2, "Autos", "us"),
    ]
    with pytest.raises(ValueError):
        clean_reference(read(spark, folder), job_name="j", mode="other")


def test_last_item_of_a_document_wins(spark, folder):
    df = read(spark, folder).where("date = '2026-04-01'")
    assert (1, "Film II", "us") in rows(clean_reference(df, job_name="j"), "category_id", "category_title", "region")


def test_normalised_items(spark, folder):
    files = [str(folder / "region=US/date=2026-04-01/a.json").replace("region=US", "region%3DUS")]
    df = normalise_reference(read_reference_files(spark, files))
    assert df.columns == ["kind", "id", "snippet.title", "snippet.assignable", "_ingestion_timestamp", "_source_file", "region"]
    assert rows(df, "id", "`snippet.title`", "region") == [("1", "Film II", "us"), ("x", "?", "us")]
    assert datetime.fromisoformat(df.first()["_ingestion_timestamp"]).tzinfo is not None
    assert validate_reference(df) == []


def test_documents_without_items_are_flattened_whole(spark):
    df = spark.sql("SELECT 'list' AS kind, named_struct('a', 1) AS page, 'US' AS region")
    flat = normalise_reference(df)
    assert flat.columns[:2] == ["kind", "page.a"]
    assert validate_reference(flat) == ["id", "snippet.title"]


def test_empty_reference_is_refused(spark, folder):
    df = normalise_reference(read(spark, folder).where("region = 'fr'"))
    with pytest.raises(EmptyReferenceError):
        validate_reference(df)


STATS = [(1, "v1"), (2, "v2"), (9, "v3"), (None, "v4")]


@pytest.mark.parametrize("layout", [
    "SELECT '1' AS id, 'Film' AS `snippet.title`, 'us' AS region UNION ALL SELECT '2', 'Autos', 'us' UNION ALL SELECT 'x', 'bad', 'us'",
    "SELECT '1' AS id, 'Film' AS snippet_title, 'us' AS region UNION ALL SELECT '2', 'Autos', 'us'",
    "SELECT 1L AS category_id, 'Film' AS category_title, 'us' AS region UNION ALL SELECT 1L, 'Zed', 'vn' UNION ALL SELECT 2L, 'Autos', 'us'",
    "SELECT 1 AS category_id, 'Film' AS category_name UNION ALL SELECT 2, 'Autos'",
])
def test_lookup_layouts(spark, layout):
    stats = spark.createDataFrame(STATS, "category_id bigint, video_id string")
    named = with_category_names(stats, spark.sql(layout))
    assert rows(named, "video_id", "category_name") == [("v1", "Film"), ("v2", "Autos"), ("v3", "Unknown"), ("v4", "Unknown")]


def test_unknown_layout_warns_and_no_reference_is_unknown(spark):
    stats = spark.createDataFrame(STATS, "category_id bigint, video_id string")
    with pytest.warns(UserWarning):
        assert category_lookup(spark.sql("SELECT 1 AS number")) is None
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        named = with_category_names(stats)
    assert {row["category_name"] for row in named.collect()} == {"Unknown"}
