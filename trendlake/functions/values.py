"""Dates, regions, ratios and orderings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def normal_region(region: Column | str) -> Column:
    """Region code without padding, in lower case."""
    column = F.col(region) if isinstance(region, str) else region
    return F.lower(F.trim(column))


def region_list(regions: str | Iterable[str]) -> list[str]:
    """Region argument as normalised codes; a string may hold a comma list."""
    parts = regions.split(",") if isinstance(regions, str) else regions
    return [part.strip().lower() for part in parts]


def region_filter(df: DataFrame, regions: str | Iterable[str] | None, column: str = "region") -> DataFrame:
    """Keep the given regions, whatever their spelling; None keeps all.

    The predicate only touches the region column, so on a table partitioned
    by region it ends up among the partition filters of the scan.
    """
    if regions is None:
        return df
    return df.where(normal_region(column).isin(region_list(regions)))


def short_date(moment: Column) -> Column:
    """Date or timestamp as year.day.month text."""
    return F.date_format(moment, K.SHORT_DATE_FORMAT)


def parse_trending_date(text: Column | str) -> Column:
    """Date from year.day.month text, or from ISO text; NULL when it is neither."""
    column = F.col(text) if isinstance(text, str) else text
    return F.when(
        column.rlike(K.SHORT_DATE_PATTERN), F.try_to_date(column, K.SHORT_DATE_FORMAT)
    ).otherwise(F.try_to_date(column))


def try_timestamp(column: Column | str) -> Column:
    """Timestamp from a timestamp or from ISO text; NULL when unreadable."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("timestamp")


def share_percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` in percent of ``whole``; NULL when the whole is 0 or NULL."""
    return F.round(F.try_divide(part, whole) * F.lit(100), digits)


def total_order(columns: Iterable[str]) -> list[Column]:
    """Descending order over all given columns.

    Rows that still tie are equal in every column, so whichever comes first
    makes no difference to the result.
    """
    return [F.desc_nulls_last(F.col(f"`{name}`")) for name in columns]


def decode_document(text: Column | str, schema: str) -> Column:
    """A JSON document as a struct; unreadable text gives a struct of NULLs, and fields that are missing are NULL."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def encode_document(document: Column) -> Column:
    """A struct as JSON text, without its NULL fields."""
    return F.to_json(document)
