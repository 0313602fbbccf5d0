"""The three gold tables.

All of them start from silver statistics. Spark aggregates on the map side and
shuffles distinct counts on (group, value) first, so a hot region, day or
channel is spread over the cluster before it is brought together. A total that
passes 2^63 is NULL, and so is the mean taken from it; it never stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    count_mean, rate_mean, rate_mean_of_sums, rate_sums, share_percent, whole_sum_of, whole_sums,
)
from .lookup import with_category_names
from .ranking import number_rows

AGGREGATED_AT = "_aggregated_at"

# Gold names of the summed counters.
_TOTAL_NAMES = {
    "views": "total_views",
    "likes": "total_likes",
    "dislikes": "total_dislikes",
    "comment_count": "total_comments",
}
#: What a row of the daily table stands for.
_DAY = ("region", "trending_date_parsed")


def trending_analytics(stats: DataFrame, aggregated_at: Column | None = None) -> DataFrame:
    """Daily figures per region."""
    totals = stats.groupBy("region", "trending_date_parsed").agg(
        F.count("video_id").alias("total_videos"),
        *_totals("views", "likes", "dislikes", "comment_count"),
        count_mean("views").alias("avg_views_per_video"),
        rate_mean("like_ratio").alias("avg_like_ratio"),
        rate_mean("engagement_rate").alias("avg_engagement_rate"),
        F.max("views").alias("max_views"),
        F.count_distinct("channel_title").alias("unique_channels"),
        F.count_distinct("category_id").alias("unique_categories"),
    )
    return stamped(totals, aggregated_at)


def channel_analytics(
    stats: DataFrame, reference: DataFrame | None = None, aggregated_at: Column | None = None
) -> DataFrame:
    """Figures per channel and region, ranked by views within the region.

    ``categories`` is sorted, and channels with equal views are ranked by
    name, so the table is the same on every run.
    """
    return stamped(rank_channels(channel_totals(stats, reference)), aggregated_at)


def channel_totals(stats: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """The channel table before ranking.

    Every row is shuffled once, as it is, to the other rows of its video; the first
    one there stands for the video, so no distinct count is left. Behind that
    shuffle each row goes out twice, with its counters and with its category: the set
    of names, for which Spark has no compiled aggregate, is built from one row
    per channel and category. (Written out, as the rows of a built-in grouping set
    are not recognized where ranking uses this plan several times.)
    """
    by_name = "category_name" in stats.columns and reference is None
    category = "category_name" if by_name else "category_id"
    place = ("channel_title", "region")
    counters = ("views", "likes", "comment_count")
    rows = stats.select(*place, *counters, "engagement_rate", "trending_date_parsed", "video_id", category)
    # Rows without a video are no video; they are dealt out by their hash.
    dealt = rows.withColumn("_dealt", F.when(F.col("video_id").isNull(), F.xxhash64(*rows.columns)))
    # The sort behind the shuffle starts with the video, which tells most rows apart.
    of_video = Window.partitionBy("video_id", *place, "_dealt").orderBy(F.lit(0))
    together = dealt.repartition(*place, "video_id", "_dealt")
    first = together.withColumn("_first_row", F.col("video_id").isNotNull() & (F.row_number().over(of_video) == 1))
    both = first.withColumn("_of_category", F.explode(F.array(F.lit(False), F.lit(True))))
    both = both.withColumn(category, F.when(F.col("_of_category"), F.col(category)))
    of_videos = ~F.col("_of_category")

    def of_rows(name: str) -> Column:
        return F.when(of_videos, F.col(name))

    both = both.withColumns({name: of_rows(name) for name in (*counters, "engagement_rate", "trending_date_parsed")})
    # One row per channel and category is left for the lookup, and one without a category for the videos.
    parts = both.groupBy(*place, "_of_category", category).agg(
        F.count_if(of_videos & F.col("_first_row")).alias("_videos"),
        *(total for name in counters for total in whole_sums(name)),
        F.count("views").alias("_view_rows"),
        *rate_sums("engagement_rate"),
        F.max("views").alias("_peak"),
        F.count("trending_date_parsed").alias("_days"),
        F.min("trending_date_parsed").alias("_first"),
        F.max("trending_date_parsed").alias("_last"),
    )
    named = with_category_names(parts, reference).withColumn("_name", F.when(F.col("_of_category"), F.col("category_name")))
    return named.groupBy(*place).agg(
        F.sum("_videos").alias("total_videos"),
        *(whole_sum_of(name).alias(_TOTAL_NAMES[name]) for name in counters),
        F.try_divide(whole_sum_of("views"), F.sum("_view_rows")).alias("avg_views_per_video"),
        rate_mean_of_sums("engagement_rate").alias("avg_engagement_rate"),
        F.max("_peak").alias("peak_views"),
        F.sum("_days").alias("times_trending"),
        F.min("_first").alias("first_trending"),
        F.max("_last").alias("last_trending"),
        F.array_sort(F.collect_set("_name")).alias("categories"),
    )


def rank_channels(channels: DataFrame) -> DataFrame:
    """``rank_in_region`` by total views, names breaking ties; NULL where it passes the gold column's 2^31."""
    ranked = number_rows(channels, "region", "total_views", "channel_title", "rank_in_region")
    return ranked.withColumn("rank_in_region", F.col("rank_in_region").try_cast("int"))


def category_analytics(
    stats: DataFrame, reference: DataFrame | None = None, aggregated_at: Column | None = None
) -> DataFrame:
    """Daily figures per category and region, with the share of the day's views."""
    name = ["category_name"] if "category_name" in stats.columns and reference is None else []
    totals = stats.groupBy(*name, "category_id", "region", "trending_date_parsed").agg(
        F.count("video_id").alias("video_count"),
        *_totals("views", "likes", "comment_count"),
        rate_mean("engagement_rate").alias("avg_engagement_rate"),
        F.count_distinct("channel_title").alias("unique_channels"),
    )
    return stamped(with_view_share(with_category_names(totals, reference)), aggregated_at)


def daily_parts(stats: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Partial figures of silver by category, region and day, for the category table and the daily one.

    Sums meet in the tasks that read silver. Distinct channels of a category and
    of a whole day come as rows of their own, so that their shuffles hold nothing
    but the channel beside its group. Names that silver itself holds are kept
    apart where there is no ``reference``.
    """
    keys = ("category_id", *_DAY)
    if "category_name" in stats.columns and reference is None:
        keys = ("category_name", *keys)
    sums = stats.groupBy(*keys).agg(
        F.count("video_id").alias("_videos"),
        *(total for name in _TOTAL_NAMES for total in whole_sums(name)),
        F.count("views").alias("_view_rows"),
        F.max("views").alias("_peak"),
        *rate_sums("like_ratio"), *rate_sums("engagement_rate"),
    )
    channels = _channels(stats, *keys).unionByName(
        _channels(stats, *_DAY).withColumnRenamed("_channels", "_channels_of_day"), allowMissingColumns=True)
    return sums.unionByName(channels, allowMissingColumns=True)


def categories_of_parts(parts: DataFrame, reference: DataFrame | None = None, aggregated_at: Column | None = None) -> DataFrame:
    """The category table, equal to ``category_analytics`` over the rows that ``daily_parts`` were taken of."""
    name = ["category_name"] if "category_name" in parts.columns else []
    totals = parts.where(F.col("_channels_of_day").isNull()).groupBy(*name, "category_id", *_DAY).agg(
        F.sum("_videos").alias("video_count"),
        *(whole_sum_of(name).alias(_TOTAL_NAMES[name]) for name in ("views", "likes", "comment_count")),
        rate_mean_of_sums("engagement_rate").alias("avg_engagement_rate"),
        F.max("_channels").alias("unique_channels"),
    )
    return stamped(with_view_share(with_category_names(totals, reference)), aggregated_at)


def days_of_parts(parts: DataFrame, aggregated_at: Column | None = None) -> DataFrame:
    """The daily table, equal to ``trending_analytics`` over the same rows."""
    totals = parts.groupBy(*_DAY).agg(
        F.sum("_videos").alias("total_videos"),
        *(whole_sum_of(name).alias(total) for name, total in _TOTAL_NAMES.items()),
        F.try_divide(whole_sum_of("views"), F.sum("_view_rows")).alias("avg_views_per_video"),
        rate_mean_of_sums("like_ratio").alias("avg_like_ratio"),
        rate_mean_of_sums("engagement_rate").alias("avg_engagement_rate"),
        F.max("_peak").alias("max_views"),
        F.max("_channels_of_day").alias("unique_channels"),
        F.count_distinct("category_id").alias("unique_categories"),
    )
    return stamped(totals, aggregated_at)


def _channels(stats: DataFrame, *group: str) -> DataFrame:
    """Distinct channels of each group."""
    return stats.select(*group, "channel_title").distinct().groupBy(*group).agg(F.count("channel_title").alias("_channels"))


def with_view_share(categories: DataFrame) -> DataFrame:
    """``view_share_pct``: percent of all views of the region on that day.

    A window partition holds one row per category, never detail rows.
    """
    day = Window.partitionBy("region", "trending_date_parsed")
    share = share_percent(F.col("total_views"), F.try_sum("total_views").over(day), 2)
    leading = ["category_name", "category_id", "region", "trending_date_parsed"]
    rest = [c for c in categories.columns if c not in leading]
    return categories.select(*leading, *rest, share.alias("view_share_pct"))


def stamped(df: DataFrame, aggregated_at: Column | None = None) -> DataFrame:
    return df.withColumn(AGGREGATED_AT, F.current_timestamp() if aggregated_at is None else aggregated_at)


def _totals(*counters: str) -> list[Column]:
    return [F.try_sum(name).alias(_TOTAL_NAMES[name]) for name in counters]
