"""The test tables in bronze shape.

The tables are not about videos, so each bronze column is computed from a
table column. The expressions are plain SQL that Spark and DuckDB both read;
the few functions with different names are filled in per engine, so that both
sides start from the same bronze rows. Everything after that is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK = {
    "short": "date_format({}, 'yy.dd.MM')".format,
    "iso": "date_format({}, 'yyyy-MM-dd')".format,
    "key": "get_json_object({}, '$.k')".format,
}
DUCKDB = {
    "short": "strftime({}, '%y.%d.%m')".format,
    "iso": "strftime({}, '%Y-%m-%d')".format,
    "key": "json_extract_string({}, '$.k')".format,
}


def events_columns(engine: dict) -> dict[str, str]:
    """Bronze statistics from events: dirty values of every kind."""
    return {
        "video_id": "CASE WHEN event_id % 131 = 0 THEN NULL ELSE 'v' || CAST(user_id * 3 + event_id % 3 AS STRING) END",
        "trending_date": "CASE WHEN event_id % 211 = 0 THEN '17.32.13' WHEN event_id % 223 = 0 THEN 'xx' "
        f"WHEN event_id % 227 = 0 THEN NULL WHEN event_id % 4 = 0 THEN {engine['iso']('ts')} "
        f"ELSE {engine['short']('ts')} END",
        "title": "CASE WHEN event_id % 41 = 0 THEN NULL ELSE 'title ' || CAST(event_id AS STRING) END",
        "channel_title": "CASE WHEN event_id % 61 = 0 THEN NULL ELSE 'ch' || CAST(user_id AS STRING) END",
        "category_id": "CASE WHEN event_id % 101 = 0 THEN 'bad' ELSE CAST(event_id % 27 AS STRING) END",
        "publish_time": f"{engine['iso']('ts')} || 'T00:00:00.000Z'",
        "tags": "event_type || '|' || CAST(event_id % 5 AS STRING)",
        "views": "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'xx' "
        "WHEN event_id % 83 = 0 THEN '0' WHEN event_id % 307 = 0 THEN '-5' "
        "ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS STRING) END",
        # Rows without views carry counters near 2^63, so that totals pass the range of a bigint.
        "likes": f"CASE WHEN event_id % 97 = 0 THEN '9223372036854775800' ELSE {engine['key']('props')} END",
        "dislikes": "CASE WHEN event_id % 10 = 0 THEN CAST(event_id % 7 AS STRING) || '.0' ELSE CAST(event_id % 7 AS STRING) END",
        "comment_count": "CAST(event_id % 11 AS STRING)",
        "thumbnail_link": "'http://thumbs/' || CAST(event_id AS STRING)",
        "comments_disabled": "CASE event_id % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE 'maybe' END",
        "ratings_disabled": "CASE WHEN event_id % 19 = 0 THEN 'True' ELSE 'False' END",
        "video_error_or_removed": "'False'",
        "description": "props",
        "region": "CASE event_id % 3 WHEN 0 THEN r_name WHEN 1 THEN lower(r_name) ELSE ' ' || r_name || ' ' END",
        "ingested": "ts",
    }


def lineitem_columns(engine: dict) -> dict[str, str]:
    """Bronze statistics from lineitem: the large, mostly clean part."""
    return {
        "video_id": "'p' || CAST(l_partkey AS STRING)",
        "trending_date": engine["iso"]("date_trunc('month', l_shipdate)"),
        "title": "'part ' || CAST(l_partkey AS STRING)",
        "channel_title": "'s' || CAST(l_suppkey AS STRING)",
        "category_id": "CAST(l_linenumber + l_partkey % 20 AS STRING)",
        "publish_time": engine["iso"]("l_shipdate"),
        "tags": "l_returnflag || '|' || l_linestatus",
        "views": "CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING)",
        "likes": "CAST(CAST(l_quantity AS BIGINT) AS STRING)",
        "dislikes": "CAST(NULL AS STRING)",
        "comment_count": "CAST(l_orderkey % 50 AS STRING)",
        "thumbnail_link": "CAST(NULL AS STRING)",
        "comments_disabled": "CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END",
        "ratings_disabled": "'false'",
        "video_error_or_removed": "CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END",
        "description": "CAST(l_orderkey AS STRING)",
        "region": "r_name",
        "ingested": "l_shipdate",
    }


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bronze_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of events and all of lineitem as one bronze table of text."""
    region = read(spark, sf_dir, "region")
    events = read(spark, sf_dir, "events").join(region, F.expr("user_id % 5 = r_regionkey"))
    lines = read(spark, sf_dir, "lineitem").join(region, F.expr("l_suppkey % 5 = r_regionkey"))
    return _project(events, events_columns(SPARK)).unionByName(_project(lines, lineitem_columns(SPARK)))


BRONZE_SQL = f"""
SELECT {", ".join(f"{sql} AS {name}" for name, sql in events_columns(DUCKDB).items())}
FROM events JOIN region ON user_id % 5 = r_regionkey
UNION ALL
SELECT {", ".join(f"{sql} AS {name}" for name, sql in lineitem_columns(DUCKDB).items())}
FROM lineitem JOIN region ON l_suppkey % 5 = r_regionkey
"""


def bronze_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as one category document of up to two items."""
    region = read(spark, sf_dir, "region")
    return read(spark, sf_dir, "part").join(region, F.expr("p_partkey % 5 = r_regionkey")).selectExpr(
        "'categories' AS kind",
        """CASE WHEN p_partkey % 19 = 0 THEN NULL
                WHEN p_partkey % 17 = 0 THEN filter(array(item0), x -> false)
                ELSE array(item0, item1) END AS items""".replace(
            "item0", _item("CAST(p_partkey % 24 AS STRING)", "' ' || p_type || ' '", "p_size % 2 = 0")
        ).replace(
            "item1", _item("CASE WHEN p_partkey % 5 = 0 THEN 'x1' ELSE CAST(p_partkey % 24 AS STRING) END", "p_name", "p_size % 3 = 0")
        ),
        "r_name AS region",
        "'2024-01-0' || CAST(p_partkey % 9 + 1 AS STRING) AS date",
        "'file' || CAST(p_partkey AS STRING) AS _source_file",
    )


def _item(identifier: str, title: str, assignable: str) -> str:
    return (
        f"named_struct('kind', 'category', 'id', {identifier}, "
        f"'snippet', named_struct('title', {title}, 'assignable', {assignable}))"
    )


REFERENCE_ITEMS_SQL = """
SELECT 0 AS pos, CAST(p_partkey % 24 AS STRING) AS id, ' ' || p_type || ' ' AS title, p_size % 2 = 0 AS assignable,
       'category' AS kind, r_name AS region, '2024-01-0' || CAST(p_partkey % 9 + 1 AS STRING) AS date,
       'file' || CAST(p_partkey AS STRING) AS source_file
FROM part JOIN region ON p_partkey % 5 = r_regionkey WHERE p_partkey % 19 <> 0 AND p_partkey % 17 <> 0
UNION ALL
SELECT 1, CASE WHEN p_partkey % 5 = 0 THEN 'x1' ELSE CAST(p_partkey % 24 AS STRING) END, p_name, p_size % 3 = 0,
       'category', r_name, '2024-01-0' || CAST(p_partkey % 9 + 1 AS STRING), 'file' || CAST(p_partkey AS STRING)
FROM part JOIN region ON p_partkey % 5 = r_regionkey WHERE p_partkey % 19 <> 0 AND p_partkey % 17 <> 0
"""


def trending_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one API answer with two, no or missing videos."""
    region = read(spark, sf_dir, "region")
    first = _video("'o' || CAST(o_orderkey AS STRING)", "o_orderstatus", "o_custkey % 30", "floor(o_totalprice)")
    second = _video("'q' || CAST(o_orderkey % 700 AS STRING)", "o_orderpriority", "o_orderkey % 30", "floor(o_totalprice / 2)")
    return read(spark, sf_dir, "orders").join(region, F.expr("o_custkey % 5 = r_regionkey")).selectExpr(
        "'videos' AS kind",
        f"""CASE WHEN o_orderkey % 19 = 0 THEN NULL
                 WHEN o_orderkey % 17 = 0 THEN filter(array({first}), x -> false)
                 ELSE array({first}, {second}) END AS items""",
        "r_name AS region",
        "o_orderdate AS moment",
    )


def _video(identifier: str, title: str, category: str, views: str) -> str:
    return f"""named_struct('id', {identifier},
        'snippet', named_struct('title', {title}, 'channelTitle', 'c' || CAST(o_custkey AS STRING),
            'categoryId', CAST({category} AS STRING), 'publishedAt', CAST(CAST(o_orderdate AS DATE) AS STRING),
            'tags', array(o_orderstatus, o_orderpriority), 'description', o_orderpriority,
            'thumbnails', named_struct('default', named_struct('url', 'http://thumbs/' || {identifier}))),
        'statistics', named_struct('viewCount', CAST(CAST({views} AS BIGINT) AS STRING),
            'likeCount', CAST(o_custkey % 100 AS STRING), 'dislikeCount', CAST(NULL AS STRING),
            'commentCount', CAST(o_orderkey % 10 AS STRING)))"""


def _videos_sql(identifier: str, title: str, category: str, views: str) -> str:
    return f"""
SELECT {identifier} AS video_id, strftime(o_orderdate, '%y.%d.%m') AS trending_date, {title} AS title,
    'c' || CAST(o_custkey AS STRING) AS channel_title, CAST({category} AS BIGINT) AS category_id,
    strftime(o_orderdate, '%Y-%m-%d') AS publish_time, o_orderstatus || '|' || o_orderpriority AS tags,
    CAST({views} AS BIGINT) AS views, CAST(o_custkey % 100 AS BIGINT) AS likes, CAST(NULL AS BIGINT) AS dislikes,
    CAST(o_orderkey % 10 AS BIGINT) AS comment_count, 'http://thumbs/' || {identifier} AS thumbnail_link,
    false AS comments_disabled, false AS ratings_disabled, false AS video_error_or_removed,
    o_orderpriority AS description, lower(r_name) AS region
FROM orders JOIN region ON o_custkey % 5 = r_regionkey WHERE o_orderkey % 19 <> 0 AND o_orderkey % 17 <> 0
"""


VIDEOS_SQL = _videos_sql(
    "'o' || CAST(o_orderkey AS STRING)", "o_orderstatus", "o_custkey % 30", "floor(o_totalprice)"
) + "UNION ALL" + _videos_sql(
    "'q' || CAST(o_orderkey % 700 AS STRING)", "o_orderpriority", "o_orderkey % 30", "floor(o_totalprice / 2)"
)


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*(F.expr(sql).alias(name) for name, sql in columns.items()))
