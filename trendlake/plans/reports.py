"""The reports read from gold. Every function takes a region filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import region_filter

Regions = str | Iterable[str] | None


def region_targeting(trending: DataFrame, regions: Regions = None) -> DataFrame:
    """Where to target: reach and engagement per region.

    Averages are taken over days. The score is NULL where a region's views do
    not add up to a positive number.
    """
    rate = F.avg("avg_engagement_rate")
    views = F.try_sum("total_views")
    return region_filter(trending, regions).groupBy("region").agg(
        views.alias("total_views"),
        F.round(rate, 4).alias("avg_engagement_rate"),
        F.sum("unique_channels").alias("unique_channels"),
        F.round(rate * F.ln(views.cast("double") + 1), 4).alias("engagement_quality_score"),
    )


def category_momentum(category: DataFrame, regions: Regions = None) -> DataFrame:
    """What to align with: each category's share of views over time."""
    return (
        region_filter(category, regions)
        .select("region", "trending_date_parsed", "category_name", "view_share_pct")
        .orderBy(F.asc_nulls_last("trending_date_parsed"), "region", "category_name")
    )


def channel_partners(channel: DataFrame, regions: Regions = None, limit: int | None = None) -> DataFrame:
    """Whom to partner with: channels by how often they trend."""
    ranked = region_filter(channel, regions).select(
        "channel_title", "region", "times_trending", "total_views",
        F.round(F.col("avg_engagement_rate").cast("double"), 4).alias("avg_engagement_rate"),
        "rank_in_region", "categories",
    ).orderBy(
        F.desc_nulls_last("times_trending"), F.asc_nulls_last("channel_title"), F.asc_nulls_last("region")
    )
    return ranked if limit is None else ranked.limit(limit)


def publish_timing(trending: DataFrame, regions: Regions = None) -> DataFrame:
    """When to publish: views and engagement by day."""
    return region_filter(trending, regions).groupBy("trending_date_parsed", "region").agg(
        F.try_sum("total_views").alias("total_views"),
        F.round(F.avg(F.col("avg_engagement_rate").cast("double")), 4).alias("avg_engagement_rate"),
        F.round(F.avg(F.col("avg_like_ratio").cast("double")), 4).alias("avg_like_ratio"),
    ).orderBy(F.asc_nulls_last("trending_date_parsed"), F.asc_nulls_last("region"))
