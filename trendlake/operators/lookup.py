"""Category names for category ids."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import UNKNOWN_CATEGORY
from ..functions import field

# Column pairs a reference table may use for id and name.
_LAYOUTS = (
    ("id", "snippet.title"),
    ("id", "snippet_title"),
    ("category_id", "category_title"),
    ("category_id", "category_name"),
)


def category_lookup(reference: DataFrame | None) -> DataFrame | None:
    """One name per category id, or None when the layout is not known.

    Where regions disagree on a name, the first region in alphabetical order
    decides.
    """
    if reference is None:
        return None
    for id_name, title_name in _LAYOUTS:
        identifier, title = field(reference, id_name), field(reference, title_name)
        if identifier is not None and title is not None:
            break
    else:
        warnings.warn(f"no category title among the reference columns {reference.columns}", stacklevel=2)
        return None
    region = F.col("region") if "region" in reference.columns else F.lit("")
    named = reference.select(
        identifier.try_cast("bigint").alias("category_id"),
        F.struct(region.alias("region"), title.cast("string").alias("name")).alias("_entry"),
    ).where(F.col("category_id").isNotNull() & F.col("_entry.name").isNotNull())
    return (
        named.groupBy("category_id").agg(F.min("_entry").alias("_entry"))
        .select("category_id", F.col("_entry.name").alias("category_name"))
    )


def with_category_names(stats: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """``stats`` with a ``category_name`` that is never NULL.

    Works on detail rows and on rows already aggregated by ``category_id``;
    the library joins after aggregating wherever it can. There is no broadcast
    hint: Spark broadcasts the lookup when its measured size is below its
    threshold, and splits hot categories of a shuffled join.
    """
    lookup = category_lookup(reference)
    if lookup is not None:
        stats = stats.withColumn("category_id", F.col("category_id").try_cast("bigint")).drop("category_name")
        stats = stats.join(lookup, "category_id", "left")
    if "category_name" not in stats.columns:
        return stats.withColumn("category_name", F.lit(UNKNOWN_CATEGORY))
    return stats.fillna(UNKNOWN_CATEGORY, subset=["category_name"])
