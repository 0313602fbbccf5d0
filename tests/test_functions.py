from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from trendlake import functions as fn


@pytest.mark.parametrize("text, expected", [
    ("17.14.11", date(2017, 11, 14)),
    ("2017-11-14", date(2017, 11, 14)),
    ("17.32.13", None),
    ("17.14.13", None),
    ("xx", None),
    (None, None),
    ("00.01.01", date(2000, 1, 1)),
])
def test_trending_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "d string").select(fn.parse_trending_date("d").alias("d"))
    assert df.first()["d"] == expected


def test_short_date_reads_back(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2000-01-01', DATE'2099-12-31', INTERVAL 13 DAYS)) AS day")
    assert df.where(~F.col("day").eqNullSafe(fn.parse_trending_date(fn.short_date(F.col("day"))))).isEmpty()


def test_region_filter_accepts_any_spelling(spark):
    df = spark.createDataFrame([("US",), ("us",), (" Us ",), ("gb",), (None,)], "region string")
    assert fn.region_filter(df, "us, GB ").count() == 4
    assert fn.region_filter(df, ["Us"]).count() == 3
    assert fn.region_filter(df, None).count() == 5


def test_file_names(spark):
    names = ["USvideos.csv", "CA_category_id.json", "notes.csv", ".DS_Store", "GB_x.txt"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n", fn.is_data_file(F.col("n")), fn.file_kind(F.col("n")), fn.file_region(F.col("n")), fn.name_prefix_region(F.col("n"))
    )
    assert [tuple(r) for r in df.collect()] == [
        ("USvideos.csv", True, "raw_stats", "US", "unknown"),
        ("CA_category_id.json", True, "raw_stats_reference_data", "CA", "CA"),
        ("notes.csv", True, "raw_stats", "unknown", "unknown"),
        (".DS_Store", False, "raw_stats_unknown", "unknown", "unknown"),
        ("GB_x.txt", False, "raw_stats_unknown", "GB", "GB"),
    ]


def test_region_from_path(spark):
    paths = ["a/region=US/b.json", "region=de/x", "a/b.json", "a/subregion=US/b", "region=a/region=b/c"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(fn.path_region(F.col("p")))
    assert [r[0] for r in df.collect()] == ["US", "de", "unknown", "unknown", "a"]


def test_field_in_every_spelling(spark):
    nested = spark.sql("SELECT named_struct('title', 'a', 'deep', named_struct('x', 1)) AS snippet")
    dotted = spark.sql("SELECT 'a' AS `snippet.title`, 1 AS `snippet.deep.x`")
    lined = spark.sql("SELECT 'a' AS snippet__title, 1 AS snippet__deep__x")
    for df in (nested, dotted, lined):
        assert df.select(fn.field(df, "snippet.title")).first()[0] == "a"
        assert df.select(fn.field(df, "snippet.deep.x")).first()[0] == 1
        assert fn.field(df, "snippet.none") is None
        assert df.select(fn.field_or(df, "snippet.none", default=F.lit(7))).first()[0] == 7


def test_flatten_struct(spark):
    df = spark.sql("SELECT named_struct('id', 1, 'snippet', named_struct('title', 'a', 'tags', array('x'))) AS item, 2 AS other")
    assert df.select(*fn.flatten_struct(df, "item")).columns == ["id", "snippet.title", "snippet.tags"]
    assert df.select(*fn.flatten_struct(df)).columns == ["item.id", "item.snippet.title", "item.snippet.tags", "other"]


def test_share_of_nothing_is_null(spark):
    df = spark.sql("SELECT 1L AS part, 0L AS whole UNION ALL SELECT 1L, 3L").select(
        fn.share_percent(F.col("part"), F.col("whole"), 2).alias("s")
    )
    assert rows(df) == [(33.33,), (None,)]


def test_rate_mean_does_not_depend_on_order(spark):
    rates = [(round(i * 0.0137 % 97, 4),) for i in range(5000)] + [(None,)]
    forward = spark.createDataFrame(rates, "r double").repartition(7)
    backward = spark.createDataFrame(rates[::-1], "r double").coalesce(1)
    first, second = (df.agg(fn.rate_mean("r").alias("m")).first()["m"] for df in (forward, backward))
    assert first == second
    assert first == pytest.approx(sum(r[0] for r in rates[:-1]) / 5000, rel=1e-12)


def test_rate_mean_of_huge_and_of_no_values(spark):
    huge = spark.createDataFrame([(2e9,), (1.0,)], "r double").agg(fn.rate_mean("r")).first()[0]
    assert huge == pytest.approx(1000000000.5)
    assert spark.createDataFrame([(None,)], "r double").agg(fn.rate_mean("r")).first()[0] is None
    assert spark.createDataFrame([], "v bigint").agg(fn.count_mean("v")).first()[0] is None


def test_merged_parts_of_huge_rates_are_exact(spark):
    """Rates near 10^19, whose sums pass the range of a bigint, merged from parts of rows that count and rows that don't."""
    rates = [(True, 1, 9_223_372_036_854_775_807.0), (True, 2, 9_000_000_000_000_000_000.0), (True, 1, 5.0), (False, 3, 7.0), (True, 2, None)]
    rows_in = spark.createDataFrame(rates, "keep boolean, part int, r double")
    parts = rows_in.groupBy("keep", "part").agg(*fn.rate_parts("r"))
    merged = parts.groupBy("part").agg(*fn.merged_rate_parts("r", F.col("keep")))
    assert merged.where("part = 3").select("_r_units", "_r_rows").first()[:] == (None, None)
    found = merged.agg(fn.rate_mean_of_parts("r").alias("m")).first()["m"]
    assert found == pytest.approx((9_223_372_036_854_775_807 + 9_000_000_000_000_000_000 + 5) / 3, rel=1e-15)
    assert found == rows_in.where("keep").agg(fn.rate_mean("r").alias("m")).first()["m"]
