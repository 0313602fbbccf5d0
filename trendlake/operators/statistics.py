"""Bronze statistics, in any of their forms, to silver."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import (
    field, field_or, has_field, normal_region, parse_trending_date, share_percent,
    short_date, total_order, try_timestamp,
)
from ..sources.bronze import FILE_TIME
from .dedup import latest_rows

#: What makes a snapshot row unique.
IDENTITY = ("video_id", "region", "trending_date_parsed")
RECENCY = "_recency"
#: The silver columns that the gold tables read.
GOLD_COLUMNS = (
    "video_id", "region", "trending_date_parsed", "channel_title", "category_id", *schemas.COUNTERS, "like_ratio", "engagement_rate",
)

# Where the API form keeps each statistics column.
_API_FIELDS = {
    "video_id": "id",
    "title": "snippet.title",
    "channel_title": "snippet.channelTitle",
    "category_id": "snippet.categoryId",
    "publish_time": "snippet.publishedAt",
    "tags": "snippet.tags",
    "views": "statistics.viewCount",
    "likes": "statistics.likeCount",
    "dislikes": "statistics.dislikeCount",
    "comment_count": "statistics.commentCount",
    "thumbnail_link": "snippet.thumbnails.default.url",
    "description": "snippet.description",
}
#: Three numbers up to this fit a bigint together.
_THIRD = 2 ** 61
# The API never reports these flags.
_API_FALSE = ("comments_disabled", "ratings_disabled", "video_error_or_removed")


def statistics_format(df: DataFrame) -> str:
    """``documents`` (videos in an ``items`` array), ``api`` (one video per row) or ``csv``."""
    items = df.schema["items"].dataType if "items" in df.columns else None
    if isinstance(items, T.ArrayType) and isinstance(items.elementType, T.StructType):
        return "documents"
    return "api" if has_field(df, "snippet.title") else "csv"


def conform_statistics(
    bronze: DataFrame, snapshot_date: date | None = None, recency: Column | str | None = None
) -> DataFrame:
    """The 17 typed statistics columns plus ``_recency``, from any bronze form."""
    form = statistics_format(bronze)
    if form == "documents":
        bronze = bronze.select("*", F.explode("items").alias("_video")).drop("items", "kind")
        bronze = bronze.select("*", "_video.*").drop("_video")
    sources = _csv_columns(bronze) if form == "csv" else _api_columns(bronze, snapshot_date)
    if recency is None:
        recency = _default_recency(bronze)
    elif isinstance(recency, str):
        recency = F.col(recency)
    return bronze.select(
        *(_typed(bronze, sources[name], kind).alias(name) for name, kind in schemas.STATISTICS.items()),
        recency.alias(RECENCY),
    )


def clean_statistics(
    bronze: DataFrame,
    *,
    job_name: str,
    snapshot_date: date | None = None,
    recency: Column | str | None = None,
    processed_at: Column | None = None,
    keep_recency: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Silver statistics: typed, filled, de-duplicated, with derived rates.

    ``recency`` orders copies of one snapshot row, newest kept; the default is
    the bronze ingestion time, or that of the file. Copies that tie there are ordered by their
    counters, then by all other columns, so the survivor never depends on how
    the input is partitioned. ``keep_recency`` retains the ordering column, which
    later merges need to tell an older late row from a newer one. With ``columns``
    only these are given, and the shuffle carries no others than they need.
    """
    rows = prepare_statistics(bronze, snapshot_date, recency)
    silver = finish_statistics(
        latest_statistics(rows, columns), job_name=job_name, processed_at=processed_at, keep_recency=keep_recency
    )
    return silver if columns is None else silver.select(*columns)


def prepare_statistics(
    bronze: DataFrame, snapshot_date: date | None = None, recency: Column | str | None = None
) -> DataFrame:
    """Conformed rows with identity columns and filled counters, copies included."""
    rows = conform_statistics(bronze, snapshot_date, recency)
    return rows.where(F.col("video_id").isNotNull()).withColumns({
        "region": normal_region("region"),
        "trending_date_parsed": parse_trending_date("trending_date"),
        **{name: F.coalesce(name, F.lit(0)) for name in schemas.COUNTERS},
    })


def latest_statistics(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per video, region and day.

    Where only some ``columns`` of it are wanted, ties are ordered no further than
    the last of these: copies that still tie there are equal in all of them.
    """
    others = [c for c in schemas.STATISTICS if c not in IDENTITY and c not in schemas.COUNTERS]
    if columns is not None:
        others = others[:max((others.index(c) + 1 for c in columns if c in others), default=0)]
    order = total_order([RECENCY, *schemas.COUNTERS, *others])
    return latest_rows(rows, IDENTITY, order)


def finish_statistics(
    rows: DataFrame, *, job_name: str, processed_at: Column | None = None, keep_recency: bool = True
) -> DataFrame:
    """Derived rates and audit columns, in silver column order."""
    # Three counters near 2^63 don't fit a bigint together; decimals cost more, so only these take them.
    parts = ("likes", "dislikes", "comment_count")
    fits = F.greatest(*parts).between(-_THIRD, _THIRD) & F.least(*parts).between(-_THIRD, _THIRD)
    likes, dislikes, comments = map(F.col, parts)
    exact = sum((F.col(name).cast("decimal(20,0)") for name in parts[1:]), likes.cast("decimal(20,0)"))
    reactions = F.when(fits, (likes + dislikes + comments).cast("double")).otherwise(exact.cast("double"))
    return rows.select(
        *schemas.STATISTICS,
        "trending_date_parsed",
        _rate(F.col("likes")).alias("like_ratio"),
        _rate(reactions).alias("engagement_rate"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("_processed_at"),
        F.lit(job_name).alias("_job_name"),
        *([RECENCY] if keep_recency else []),
    )


def _rate(part: Column) -> Column:
    """Percent of views to 4 places; 0 for rows without views.

    ``round`` takes a double to decimal text and back. A small share that isn't
    near the middle of two units is the nearest whole number of them; others are left to ``round``.
    """
    views = F.col("views")
    units = F.try_divide(part, views) * F.lit(100) * F.lit(10_000.0)
    whole = F.rint(units)
    clear = (F.abs(units) < 1e10) & (F.abs(F.abs(units - whole) - 0.5) > 1e-3)
    share = F.when(clear, whole.cast("bigint") / F.lit(10_000)).otherwise(share_percent(part, views, 4))
    return F.when(views > 0, share).otherwise(F.lit(0.0))


def _csv_columns(df: DataFrame) -> dict[str, Column]:
    return {name: F.col(name) for name in schemas.STATISTICS}


def _api_columns(df: DataFrame, snapshot_date: date | None) -> dict[str, Column]:
    columns = {name: field_or(df, source) for name, source in _API_FIELDS.items()}
    if not has_field(df, _API_FIELDS["dislikes"]):
        columns["dislikes"] = F.lit(0)
    tags = _API_FIELDS["tags"]
    if has_field(df, tags) and isinstance(df.select(field(df, tags)).schema[0].dataType, T.ArrayType):
        columns["tags"] = F.array_join(columns["tags"], "|")
    columns.update({name: F.lit(False) for name in _API_FALSE})
    columns["region"] = field_or(df, "region", "_pipeline_metadata.region")
    if snapshot_date is not None:
        day = F.lit(snapshot_date)
    elif "date" in df.columns:
        day = F.coalesce(F.try_to_date(F.col("date").cast("string")), F.current_date())
    else:
        day = F.current_date()
    columns["trending_date"] = short_date(day)
    return columns


def _default_recency(df: DataFrame) -> Column:
    """Ingestion time from the metadata, else from the date and hour folders, else the file's own time."""
    moments = []
    stamp = field(df, "_pipeline_metadata.ingestion_timestamp")
    if stamp is not None:
        moments.append(try_timestamp(stamp))
    if "date" in df.columns:
        hour = F.coalesce(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit("00")) if "hour" in df.columns else F.lit("00")
        text = F.concat_ws(" ", F.col("date").cast("string"), F.concat(hour, F.lit(":00:00")))
        moments.append(text.try_cast("timestamp"))
    if FILE_TIME in df.columns:
        moments.append(F.col(FILE_TIME))
    return F.coalesce(*moments) if moments else F.lit(None).cast("timestamp")


def _typed(df: DataFrame, column: Column, kind: str) -> Column:
    """``column`` as ``kind``, NULL when it does not read as one.

    Whole numbers written with a fraction ("10.0") lose the fraction.
    """
    if kind == "bigint" and df.select(column).schema[0].dataType == T.StringType():
        whole = F.regexp_extract(F.trim(column), r"^([+-]?\d+)\.\d*$", 1)
        return F.coalesce(column.try_cast(kind), whole.try_cast(kind))
    return column.try_cast(kind)
