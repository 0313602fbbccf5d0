"""Read schemas of the bronze files (DDL text) and the columns of silver."""

from __future__ import annotations

#: Statistics columns every bronze form is brought to, with silver types.
STATISTICS = {
    "video_id": "string",
    "trending_date": "string",
    "title": "string",
    "channel_title": "string",
    "category_id": "bigint",
    "publish_time": "string",
    "tags": "string",
    "views": "bigint",
    "likes": "bigint",
    "dislikes": "bigint",
    "comment_count": "bigint",
    "thumbnail_link": "string",
    "comments_disabled": "boolean",
    "ratings_disabled": "boolean",
    "video_error_or_removed": "boolean",
    "description": "string",
    "region": "string",
}
COUNTERS = ("views", "likes", "dislikes", "comment_count")

#: Historical CSV export. All text: silver does the casts, so a bad value
#: turns into NULL there and never breaks the scan.
CSV_STATISTICS = ", ".join(f"{name} string" for name in STATISTICS if name != "region")

_METADATA = (
    "_pipeline_metadata struct<ingestion_id: string, region: string, "
    "ingestion_timestamp: string, video_count: bigint, source: string>"
)

#: One document per API answer; ``items`` holds the videos.
API_STATISTICS = f"""
    kind string,
    items array<struct<
        id: string,
        snippet: struct<
            title: string, channelTitle: string, categoryId: string,
            publishedAt: string, tags: array<string>, description: string,
            thumbnails: struct<default: struct<url: string>>>,
        statistics: struct<
            viewCount: string, likeCount: string, dislikeCount: string,
            commentCount: string>>>,
    {_METADATA}
"""

#: One document per region; ``items`` holds the categories.
API_REFERENCE = f"""
    kind string,
    items array<struct<
        kind: string, id: string,
        snippet: struct<title: string, assignable: boolean>>>,
    {_METADATA}
"""


def with_partitions(schema: str, *names: str) -> str:
    """``schema`` plus text partition columns.

    Declared rather than inferred: hour=08 would otherwise become 8.
    """
    return ", ".join([schema.strip(), *(f"{name} string" for name in names)])


#: How silver statistics are stored, by full runs and by merges alike: a day is
#: what a merge rewrites.
SILVER_PARTITIONS = ("region", "trending_date_parsed")

#: Silver statistics as stored; ``_recency`` orders copies in later merges.
SILVER_STATISTICS = ", ".join(
    [f"{name} {kind}" for name, kind in STATISTICS.items()]
    + [
        "trending_date_parsed date", "like_ratio double", "engagement_rate double",
        "_processed_at timestamp", "_job_name string", "_recency timestamp",
    ]
)
