"""DuckDB counterparts of the registered queries, written independently."""

from __future__ import annotations

from .adapter import BRONZE_SQL, REFERENCE_ITEMS_SQL, VIDEOS_SQL

TWO = "('asia', 'africa')"
_TIE = (
    "views DESC NULLS LAST, likes DESC NULLS LAST, dislikes DESC NULLS LAST, comment_count DESC NULLS LAST, "
    "trending_date DESC NULLS LAST, title DESC NULLS LAST, channel_title DESC NULLS LAST, category_id DESC NULLS LAST, "
    "publish_time DESC NULLS LAST, tags DESC NULLS LAST, thumbnail_link DESC NULLS LAST, comments_disabled DESC NULLS LAST, "
    "ratings_disabled DESC NULLS LAST, video_error_or_removed DESC NULLS LAST, description DESC NULLS LAST"
)
_CLEAN = (
    "video_id, trending_date, title, channel_title, category_id, publish_time, tags, views, likes, dislikes, "
    "comment_count, thumbnail_link, comments_disabled, ratings_disabled, video_error_or_removed, description, region, "
    "trending_date_parsed, like_ratio, engagement_rate"
)
_DATE = (
    r"CASE WHEN regexp_matches(trending_date, '^\d{2}\.\d{2}\.\d{2}$') "
    "THEN CAST(try_strptime('20' || trending_date, '%Y.%d.%m') AS DATE) ELSE TRY_CAST(trending_date AS DATE) END"
)


def _half_up(value: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal text of a double; large doubles have no such digits."""
    return f"CASE WHEN abs({value}) < 1e15 THEN CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE) ELSE {value} END"


def _rate_mean(rate: str) -> str:
    return f"avg(CAST({rate} AS DECIMAL(28,4)))"


_RATE = "CASE WHEN views > 0 THEN " + _half_up("{} / views * 100", 4) + " ELSE 0.0 END"
_RATES = f"{_RATE.replace('{}', 'likes')} AS like_ratio, {_RATE.replace('{}', '(likes::HUGEINT + dislikes + comment_count)')} AS engagement_rate"


def _filled(source: str) -> str:
    return f"""
SELECT * REPLACE (lower(trim(region)) AS region, coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
                  coalesce(dislikes, 0) AS dislikes, coalesce(comment_count, 0) AS comment_count),
       {_DATE} AS trending_date_parsed
FROM {source} WHERE video_id IS NOT NULL"""


def _latest(source: str, first: str = "") -> str:
    return f"""
SELECT *, {_RATES} FROM (
    SELECT * FROM {source}
    QUALIFY row_number() OVER (PARTITION BY video_id, region, trending_date_parsed ORDER BY {first}{_TIE}) = 1)"""


_BOOLEAN = "CASE lower({0}) WHEN 'true' THEN true WHEN 'false' THEN false END AS {0}"

# Named steps; each may use those above it.
STEPS = {
    "bronze": BRONZE_SQL,
    "typed": f"""
SELECT video_id, trending_date, title, channel_title, TRY_CAST(category_id AS BIGINT) AS category_id, publish_time, tags,
       TRY_CAST(views AS BIGINT) AS views, TRY_CAST(likes AS BIGINT) AS likes, TRY_CAST(dislikes AS BIGINT) AS dislikes,
       TRY_CAST(comment_count AS BIGINT) AS comment_count, thumbnail_link,
       {_BOOLEAN.format('comments_disabled')}, {_BOOLEAN.format('ratings_disabled')},
       {_BOOLEAN.format('video_error_or_removed')}, description, region, ingested
FROM bronze""",
    "filled": _filled("typed"),
    "silver": _latest("filled", "ingested DESC NULLS LAST, "),
    "silver_by_value": _latest("filled"),
    # The second delivery is newer than the first; within one, the counters decide.
    "delivered": _latest("(SELECT *, comment_count % 2 AS delivery FROM filled)", "delivery DESC, "),
    "items": REFERENCE_ITEMS_SQL,
    "categories": """
SELECT TRY_CAST(id AS BIGINT) AS category_id, trim(title) AS category_title, assignable, kind, lower(region) AS region,
       date, source_file, pos
FROM items WHERE TRY_CAST(id AS BIGINT) IS NOT NULL""",
    "reference": """
SELECT category_id, category_title, assignable, kind, region FROM categories
QUALIFY row_number() OVER (PARTITION BY category_id, region ORDER BY date DESC, source_file DESC, pos DESC) = 1""",
    "lookup": """
SELECT category_id, arg_min(category_title, region) AS category_name FROM reference GROUP BY category_id""",
    "named": """
SELECT silver.*, coalesce(lookup.category_name, 'Unknown') AS category_name
FROM silver LEFT JOIN lookup ON silver.category_id = lookup.category_id""",
    "trending": f"""
SELECT region, trending_date_parsed, count(video_id) AS total_videos, TRY_CAST(sum(views) AS BIGINT) AS total_views,
       TRY_CAST(sum(likes) AS BIGINT) AS total_likes, TRY_CAST(sum(dislikes) AS BIGINT) AS total_dislikes,
       TRY_CAST(sum(comment_count) AS BIGINT) AS total_comments, avg(views) AS avg_views_per_video,
       {_rate_mean('like_ratio')} AS avg_like_ratio, {_rate_mean('engagement_rate')} AS avg_engagement_rate, max(views) AS max_views,
       count(DISTINCT channel_title) AS unique_channels, count(DISTINCT category_id) AS unique_categories
FROM silver GROUP BY region, trending_date_parsed""",
    "channel": f"""
SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY total_views DESC NULLS LAST, channel_title ASC NULLS LAST) AS INTEGER) AS rank_in_region
FROM (SELECT channel_title, region, count(DISTINCT video_id) AS total_videos, TRY_CAST(sum(views) AS BIGINT) AS total_views,
             TRY_CAST(sum(likes) AS BIGINT) AS total_likes, TRY_CAST(sum(comment_count) AS BIGINT) AS total_comments,
             avg(views) AS avg_views_per_video, {_rate_mean('engagement_rate')} AS avg_engagement_rate, max(views) AS peak_views,
             count(trending_date_parsed) AS times_trending, min(trending_date_parsed) AS first_trending,
             max(trending_date_parsed) AS last_trending,
             coalesce(string_agg(DISTINCT category_name, '|' ORDER BY category_name), '') AS categories
      FROM named GROUP BY channel_title, region)""",
    "category": f"""
SELECT *, {_half_up('total_views / nullif(sum(total_views) OVER (PARTITION BY region, trending_date_parsed), 0) * 100', 2)} AS view_share_pct
FROM (SELECT category_name, category_id, region, trending_date_parsed, count(video_id) AS video_count,
             TRY_CAST(sum(views) AS BIGINT) AS total_views, TRY_CAST(sum(likes) AS BIGINT) AS total_likes,
             TRY_CAST(sum(comment_count) AS BIGINT) AS total_comments, {_rate_mean('engagement_rate')} AS avg_engagement_rate,
             count(DISTINCT channel_title) AS unique_channels
      FROM named GROUP BY category_name, category_id, region, trending_date_parsed)""",
    "videos": VIDEOS_SQL,
    "monthly_videos": r"""
SELECT * REPLACE (strftime(CAST(date_trunc('month', CAST(publish_time AS DATE)) AS DATE), '%y.%d.%m') AS trending_date) FROM videos""",
    "monthly_filled": _filled("monthly_videos"),
    "monthly_silver": _latest("monthly_filled"),
    "landed": """
SELECT strftime(o_orderdate, '%Y%m%d_%H%M%S') AS ingestion_id, lower(r_name) AS region, strftime(o_orderdate, '%Y-%m-%d') AS date,
       strftime(o_orderdate, '%H') AS hour, CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 17 = 0 THEN 0 ELSE 2 END AS videos
FROM orders JOIN region ON o_custkey % 5 = r_regionkey""",
    "coverage": """
SELECT ingestion_id, region, coalesce(documents, 0) AS documents, coalesce(videos, 0) AS videos, documents IS NOT NULL AS landed,
       wanted IS NOT NULL AS expected
FROM (SELECT ingestion_id, region, true AS wanted FROM (SELECT DISTINCT ingestion_id FROM landed UNION SELECT '20000101_000000')
      CROSS JOIN (SELECT lower(r_name) AS region FROM region WHERE r_name <> 'AFRICA'))
FULL JOIN (SELECT ingestion_id, region, count(*) AS documents, CAST(sum(videos) AS BIGINT) AS videos FROM landed GROUP BY ALL)
USING (ingestion_id, region)""",
    "names": r"""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN upper(host[1:2]) || 'videos.csv' WHEN 1 THEN upper(host[1:2]) || '_category_id.json'
    WHEN 2 THEN host || '_notes.csv' ELSE '.' || host || '_Store' END AS name
FROM (SELECT page_id, regexp_extract(url, '//([a-z]+)\.', 1) AS host FROM pages)""",
}

# The same tables over three deliveries that follow each other: of copies the newest delivery wins.
STEPS["delivered_of_three"] = _latest("(SELECT *, comment_count % 3 AS delivery FROM filled)", "delivery DESC, ")
STEPS["named_updated"] = STEPS["named"].replace("silver", "delivered_of_three")
STEPS["trending_updated"] = STEPS["trending"].replace("FROM silver", "FROM delivered_of_three")
STEPS["channel_updated"] = STEPS["channel"].replace("FROM named", "FROM named_updated")
STEPS["category_updated"] = STEPS["category"].replace("FROM named", "FROM named_updated")


def _after(body: str) -> str:
    """``body`` with the steps it needs, in order."""
    needed: set[str] = set()
    names = list(STEPS)

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
        for name in names:
            if name in words and name not in needed:
                needed.add(name)
                visit(STEPS[name])

    visit(body)
    steps = ", ".join(f"{name} AS ({STEPS[name]})" for name in names if name in needed)
    return f"WITH {steps} {body}" if steps else body


_AVERAGES = f"{_half_up('avg_views_per_video', 4)} AS avg_views_per_video, {_half_up('avg_engagement_rate', 4)} AS avg_engagement_rate"
_TRENDING = f"SELECT * REPLACE ({_AVERAGES}, {_half_up('avg_like_ratio', 4)} AS avg_like_ratio) FROM trending"
_REGION_REPORT = f"""SELECT region, CAST(sum(total_views) AS BIGINT) AS total_views, {_half_up('avg(avg_engagement_rate)', 4)} AS avg_engagement_rate,
    CAST(sum(unique_channels) AS BIGINT) AS unique_channels,
    {_half_up('avg(avg_engagement_rate) * ln(CAST(sum(total_views) AS DOUBLE) + 1)', 4)} AS engagement_quality_score
    FROM trending GROUP BY region"""
_PARTNERS = f"""SELECT channel_title, region, times_trending, total_views, {_half_up('avg_engagement_rate', 4)} AS avg_engagement_rate,
    rank_in_region, categories FROM channel
    ORDER BY times_trending DESC NULLS LAST, channel_title ASC NULLS LAST, region ASC NULLS LAST"""


def _null_check(table: str, source: str, column: str, limit: str) -> str:
    share = f"coalesce(count_if({column} IS NULL) / nullif(count(*), 0) * 100, 0)"
    return f"""SELECT 'null_pct' AS "check", '{table}' AS "table", '{column}' AS "column", round({share}, 2) AS value, {limit} AS threshold,
        NULL AS negative_count, NULL AS extreme_count, {share} <= {limit} AS passed, '' AS missing FROM {source}"""


def _quality(table: str, source: str, required: list[str], minimum: int, limit: str, absent: list[str], maximum: int | None) -> str:
    rows = [
        f"""SELECT 'row_count' AS "check", '{table}' AS "table", NULL AS "column", CAST(count(*) AS DOUBLE) AS value, CAST({minimum} AS DOUBLE) AS threshold,
        CAST(NULL AS BIGINT) AS negative_count, CAST(NULL AS BIGINT) AS extreme_count, count(*) >= {minimum} AS passed, '' AS missing FROM {source}"""
    ]
    rows += [_null_check(table, source, column, limit) for column in required]
    rows += [f"SELECT 'null_pct', '{table}', '{column}', NULL, NULL, NULL, NULL, false, ''" for column in absent]
    rows.append(f"SELECT 'schema', '{table}', NULL, NULL, NULL, NULL, NULL, {'false' if absent else 'true'}, '{','.join(absent)}'")
    if maximum is not None:
        rows.append(f"""SELECT 'value_range', '{table}', 'views', NULL, NULL, CAST(count_if(views < 0) AS BIGINT), CAST(count_if(views > {maximum}) AS BIGINT),
        count_if(views < 0) = 0 AND count_if(views > {maximum}) = 0, '' FROM {source}""")
    rows.append(f"SELECT 'freshness', '{table}', NULL, NULL, NULL, NULL, NULL, true, ''")
    return " UNION ALL ".join(rows)


_CRITICAL = ["video_id", "title", "channel_title", "views", "region"]
_REPORT = " UNION ALL ".join([
    _quality("clean_statistics", "silver", _CRITICAL, 10, "5.0::DOUBLE", [], 50_000_000_000),
    _quality("raw_statistics", "filled", _CRITICAL, 10, "1.0::DOUBLE", ["channel_id"], 9_000),
    _quality("clean_reference_data", "reference", ["category_id", "region"], 1_000_000_000, "5.0::DOUBLE", [], None),
])

_FRESH = """SELECT '{0}' AS "table", max({1}) >= TIMESTAMP '2024-01-29' AS passed, strftime(max({1}), '%Y-%m-%d %H:%M:%S') AS latest,
    '2024-01-29 00:00:00' AS cutoff FROM {2}"""

_BODIES = {
    "scan_region_pruned": f"SELECT video_id, region, trending_date, views FROM bronze WHERE lower(trim(region)) IN {TWO}",
    "csv_bronze_scan": f"SELECT {_CLEAN} FROM silver_by_value WHERE region IN {TWO}",
    "csv_text_roundtrip": "SELECT doc_id, lang, length(text) AS chars, md5(text) AS digest FROM documents",
    "csv_inferred_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "csv_tolerant_scan": """SELECT event_id % 7 = 0 AS malformed, CASE WHEN event_id % 7 = 0 THEN 'x,' || event_type END AS line,
        count(*) AS rows, CAST(sum(CASE WHEN event_id % 7 <> 0 THEN user_id END) AS BIGINT) AS users FROM events GROUP BY 1, 2""",
    "conform_csv": "SELECT * EXCLUDE (ingested) FROM typed",
    "payload_flatten": "SELECT * FROM videos",
    "payload_flatten_dotted": "SELECT * FROM videos",
    "payload_flatten_underscored": "SELECT * FROM videos",
    "payload_json_scan": f"SELECT {_CLEAN} FROM monthly_silver WHERE region IN {TWO}",
    "json_decode_encode": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        '{"k":' || json_extract_string(props, '$.k') || '}' AS encoded FROM events""",
    "date_parse_two_formats": f"SELECT DISTINCT trending_date, {_DATE} AS parsed FROM bronze",
    "null_fill_and_ratios": f"SELECT video_id, description, views, likes, dislikes, comment_count, {_RATES} FROM filled",
    "clean_statistics": f"SELECT {_CLEAN} FROM silver",
    "dedup_latest": """SELECT region, rows_before, rows_after, rows_before - rows_after AS removed
        FROM (SELECT region, count(*) AS rows_before FROM filled GROUP BY region)
        JOIN (SELECT region, count(*) AS rows_after FROM silver GROUP BY region) USING (region)""",
    "statistics_watch": """SELECT CAST(count_if(video_id IS NULL) AS BIGINT) AS null_video_id, CAST(count_if(title IS NULL) AS BIGINT) AS null_title,
        CAST(count_if(channel_title IS NULL) AS BIGINT) AS null_channel_title, CAST(count_if(views IS NULL) AS BIGINT) AS null_views,
        CAST(count_if(views < 0) AS BIGINT) AS negative_views FROM silver""",
    "clean_reference": "SELECT * FROM reference",
    "clean_reference_latest_file": """SELECT category_id, category_title, assignable, kind, region FROM categories
        JOIN (SELECT lower(r_name) AS region, max(('2024-01-0' || CAST(p_partkey % 9 + 1 AS STRING)) || 'file' || CAST(p_partkey AS STRING)) AS newest
              FROM part JOIN region ON p_partkey % 5 = r_regionkey GROUP BY 1) USING (region)
        WHERE date || source_file = newest
        QUALIFY row_number() OVER (PARTITION BY category_id, region ORDER BY pos DESC) = 1""",
    "reference_normalised": """SELECT kind, id, title, assignable, source_file AS _source_file, lower(region) AS region FROM items
        QUALIFY row_number() OVER (PARTITION BY id, region, source_file ORDER BY pos DESC) = 1""",
    "reference_json_scan": f"""SELECT lower(region) AS region, '2024-01-31' AS date, count(*) AS items, count(DISTINCT id) AS ids, max(title) AS last_title
        FROM items WHERE lower(region) IN {TWO} GROUP BY 1""",
    "reference_files_scan": f"""SELECT region, count(DISTINCT category_id) AS categories, min(category_id) AS first_id, max(category_id) AS last_id
        FROM categories WHERE region IN {TWO} GROUP BY region""",
    "registered_table_sql": """SELECT region, count(*) AS days, max(total_views) AS best_day, min(trending_date_parsed) AS first_day
        FROM trending WHERE total_videos > 1 GROUP BY region""",
    "published_versions": """SELECT 'before' AS reader, region, 1 AS delivery, count(*) AS days, max(total_views) AS best_day FROM trending GROUP BY region
        UNION ALL SELECT 'after', region, CASE WHEN region < 'b' THEN 2 ELSE 1 END, count(*), max(total_views) FROM trending GROUP BY region""",
    "large_rates": """SELECT o_custkey % 25 AS customer, avg(CAST(engagement_rate AS DECIMAL(28,4))) AS mean_rate, max(engagement_rate) AS top_rate FROM (
        SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) * 100.0 ELSE o_orderkey % 40 * 0.5 END AS engagement_rate
        FROM orders) GROUP BY 1""",
    "full_then_update": f"SELECT {_CLEAN} FROM delivered",
    "reference_update": """SELECT category_id, category_title, assignable, kind, region FROM (
        SELECT TRY_CAST(id AS BIGINT) AS category_id, trim(title) AS category_title, assignable, kind, lower(region) AS region, pos,
               CAST(substr(source_file, 5) AS BIGINT) AS part_key FROM items WHERE TRY_CAST(id AS BIGINT) IS NOT NULL)
        WHERE part_key = CASE region WHEN 'africa' THEN 10 WHEN 'america' THEN 6 WHEN 'asia' THEN 7 WHEN 'europe' THEN 8 ELSE 9 END
        QUALIFY row_number() OVER (PARTITION BY category_id, region ORDER BY pos DESC) = 1""",
    "file_routing": """SELECT kind, region, count(*) AS rows, true AS unchanged FROM (
        SELECT upper(substr(trim(region), 1, 2)) AS region, 'raw_stats' AS kind FROM bronze
        UNION ALL SELECT upper(substr(r_name, 1, 2)), 'raw_stats_reference_data' FROM part JOIN region ON p_partkey % 5 = r_regionkey) GROUP BY ALL""",
    "csv_preview": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
    "reference_records_scan": f"""SELECT region, count(DISTINCT category_id) AS categories, min(category_id) AS first_id, max(category_id) AS last_id
        FROM categories WHERE region IN {TWO} GROUP BY region""",
    "event_record_status": """SELECT lower(r_name) AS region, CASE r_name WHEN 'ASIA' THEN 2 ELSE 1 END AS least, CASE r_name WHEN 'ASIA' THEN 2 ELSE 1 END AS most,
        r_name <> 'MIDDLE EAST' AS found FROM region WHERE r_name IN ('ASIA', 'AFRICA', 'MIDDLE EAST')""".replace("THEN 2 ELSE 1 END", "THEN 2::BIGINT ELSE 1::BIGINT END"),
    "schema_evolution": f"SELECT category_id, category_title, CASE WHEN region IN {TWO} THEN assignable END AS assignable, kind, region FROM reference",
    "empty_delivery_refused": "SELECT region, count(*) AS categories, 'full,update' AS refused FROM reference GROUP BY region",
    "default_clock": "SELECT region, count(*) AS rows, true AS in_time FROM silver GROUP BY region",
    "gold_after_update": f"SELECT * REPLACE ({_half_up('avg_engagement_rate', 4)} AS avg_engagement_rate) FROM category_updated",
    "daily_gold_after_update": f"SELECT * REPLACE ({_AVERAGES}, {_half_up('avg_like_ratio', 4)} AS avg_like_ratio) FROM trending_updated",
    "channels_after_updates": f"SELECT * REPLACE ({_AVERAGES}) FROM channel_updated",
    "source_provenance": """SELECT lower(r_name) AS region, 'region=' || lower(r_name) AS folder, count(*) AS documents
        FROM part JOIN region ON p_partkey % 5 = r_regionkey GROUP BY ALL""",
    "channel_sink": f"SELECT * REPLACE ({_AVERAGES}) FROM channel",
    "category_sink": f"SELECT * REPLACE ({_half_up('avg_engagement_rate', 4)} AS avg_engagement_rate) FROM category",
    "write_metrics": """SELECT 'clean_statistics' AS "table", count(*) AS rows, CAST(count_if(video_id IS NULL) AS BIGINT) AS null_first,
        CAST(count_if(views < 0) AS BIGINT) AS negative_views, CAST((SELECT count(*) FROM filled) AS BIGINT) AS rows_in FROM silver
        UNION ALL SELECT 'clean_reference_data', count(*), CAST(count_if(category_id IS NULL) AS BIGINT), NULL, NULL FROM reference""",
    "optional_reference": f"SELECT * REPLACE ('Unknown' AS category_name, {_half_up('avg_engagement_rate', 4)} AS avg_engagement_rate) FROM category",
    "audit_columns": """SELECT layer, '2024-01-31 00:00:00' AS stamp, count(*) AS rows FROM (
        SELECT 'silver:check' AS layer FROM silver UNION ALL SELECT 'reference:check' FROM reference
        UNION ALL SELECT 'gold' FROM trending UNION ALL SELECT 'normalised' FROM (
            SELECT 1 FROM items QUALIFY row_number() OVER (PARTITION BY id, region, source_file ORDER BY pos DESC) = 1)) GROUP BY layer""",
    "quality_unreadable": """SELECT 'broken' AS "table", 'read_table' AS "check", false AS passed UNION ALL
        SELECT 'missing', 'read_table', false UNION ALL SELECT 'orders', 'row_count', (SELECT count(*) >= 10 FROM orders)""",
    "category_momentum_all": "SELECT region, trending_date_parsed, category_name, view_share_pct FROM category",
    "publish_timing_all": f"""SELECT trending_date_parsed, region, CAST(sum(total_views) AS BIGINT) AS total_views,
        {_half_up('avg(avg_engagement_rate)', 4)} AS avg_engagement_rate, {_half_up('avg(avg_like_ratio)', 4)} AS avg_like_ratio
        FROM trending GROUP BY trending_date_parsed, region""",
    "payload_json_scan_all": f"SELECT {_CLEAN} FROM monthly_silver",
    "reference_json_scan_all": """SELECT lower(region) AS region, '2024-01-31' AS date, count(*) AS items, count(DISTINCT id) AS ids, max(title) AS last_title
        FROM items GROUP BY 1""",
    "category_lookup": "SELECT * FROM lookup",
    "stats_with_category": "SELECT video_id, region, trending_date_parsed, category_id, category_name FROM named",
    "trending_analytics": _TRENDING,
    "channel_analytics": f"SELECT * REPLACE ({_AVERAGES}) FROM channel",
    "channel_totals_unranked": f"SELECT * EXCLUDE (rank_in_region) REPLACE ({_AVERAGES}) FROM channel",
    "category_analytics": f"SELECT * REPLACE ({_half_up('avg_engagement_rate', 4)} AS avg_engagement_rate) FROM category",
    "category_analytics_without_reference": f"SELECT * REPLACE ('Unknown' AS category_name, {_half_up('avg_engagement_rate', 4)} AS avg_engagement_rate) FROM category",
    "region_targeting": _REGION_REPORT,
    "category_momentum": f"SELECT region, trending_date_parsed, category_name, view_share_pct FROM category WHERE region IN {TWO}",
    "channel_partners": _PARTNERS,
    "channel_partners_top15": f"{_PARTNERS} LIMIT 15",
    "channel_top10_region": """SELECT channel_title, total_views, times_trending FROM channel WHERE region = 'asia'
        ORDER BY times_trending DESC, channel_title ASC NULLS LAST LIMIT 10""",
    "publish_timing": f"""SELECT trending_date_parsed, region, CAST(sum(total_views) AS BIGINT) AS total_views,
        {_half_up('avg(avg_engagement_rate)', 4)} AS avg_engagement_rate, {_half_up('avg(avg_like_ratio)', 4)} AS avg_like_ratio
        FROM trending WHERE region IN {TWO} GROUP BY trending_date_parsed, region""",
    "quality_report": _REPORT,
    "quality_failures": f"SELECT * FROM ({_REPORT}) WHERE NOT passed",
    "quality_verdict": f"""SELECT bool_and(passed) AS quality_passed, CAST(count_if(passed) AS BIGINT) AS checks_passed,
        count(*) AS checks_total FROM ({_REPORT})""",
    "quality_freshness": " UNION ALL ".join([
        _FRESH.format("stamped", "ts", "events"),
        _FRESH.format("text", "date_trunc('second', ts)", "events"),
        _FRESH.format("old", "o_orderdate", "orders"),
        "SELECT 'unreadable', true, NULL, NULL",
        "SELECT 'unstamped', true, NULL, NULL",
    ]),
    "file_classification": """SELECT page_id, name, kind, region, kind || '/region=' || region || '/' || name AS target FROM (
        SELECT page_id, name, CASE WHEN name LIKE '%.csv' THEN 'raw_stats' ELSE 'raw_stats_reference_data' END AS kind,
               CASE WHEN regexp_matches(name, '^[A-Z]{2}') THEN name[1:2] ELSE 'unknown' END AS region
        FROM names WHERE name LIKE '%.csv' OR name LIKE '%.json')""",
    "object_key_regions": """SELECT page_id, 'raw/region=' || upper(name[1:2]) || '/a b/' || name AS key, upper(name[1:2]) AS key_region,
        'unknown' AS bare_region, CASE WHEN length(split_part(name, '_', 1)) = 2 THEN split_part(name, '_', 1) ELSE 'unknown' END AS prefix_region
        FROM names""",
    "landing_metadata": """SELECT ingestion_id, region, date, hour, 'orders' AS source, count(*) AS documents, CAST(sum(videos) AS BIGINT) AS videos
        FROM landed GROUP BY ingestion_id, region, date, hour""",
    "ingestion_coverage": "SELECT * FROM coverage",
    "ingestion_coverage_summary": """SELECT ingestion_id, CAST(count_if(expected) AS BIGINT) AS regions_total,
        CAST(count_if(expected AND landed) AS BIGINT) AS regions_landed,
        coalesce(string_agg(region, ',' ORDER BY region) FILTER (NOT landed), '') AS failed_regions,
        coalesce(string_agg(region, ',' ORDER BY region) FILTER (NOT expected), '') AS unexpected_regions FROM coverage GROUP BY ingestion_id""",
    "partition_overwrite": _TRENDING,
    "incremental_vs_full": f"SELECT {_CLEAN} FROM silver_by_value",
    "pipeline_gold": _REGION_REPORT,
}

ORACLES = {name: _after(body) for name, body in _BODIES.items()}
