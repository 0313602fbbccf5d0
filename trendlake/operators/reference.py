"""Category documents to silver reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ISO_TIMESTAMP_FORMAT
from ..functions import field, field_or, flatten_struct, normal_region, total_order, try_timestamp
from ..sources.bronze import FILE_TIME
from .dedup import latest_rows


class EmptyReferenceError(ValueError):
    """The reference documents hold no category at all."""


def clean_reference(
    bronze: DataFrame,
    *,
    job_name: str,
    mode: str = "merge",
    recency: Column | str | None = None,
    processed_at: Column | None = None,
) -> DataFrame:
    """Silver reference: one row per category and region.

    Of several copies the one from the newest document wins, within a document
    the last one. ``mode="latest_file"`` lets the newest document of a region
    replace the region as a whole; ``"merge"`` combines all documents.
    """
    rows = reference_items(bronze, mode, recency)
    order = total_order(["_recency", "_source_file", "_position", "category_title", "assignable", "kind"])
    return latest_rows(rows, ("category_id", "region"), order).select(
        "category_id", "category_title", "assignable", "kind", "region",
        (F.current_timestamp() if processed_at is None else processed_at).alias("_processed_at"),
        F.lit(job_name).alias("_job_name"),
    )


def reference_items(bronze: DataFrame, mode: str = "merge", recency: Column | str | None = None) -> DataFrame:
    """The category items that ``clean_reference`` takes into account, copies included."""
    if mode not in ("merge", "latest_file"):
        raise ValueError(f"unknown mode {mode!r}")
    documents = _located(bronze, recency)
    if mode == "latest_file":
        documents = _newest_document(documents)
    rows = documents.select(
        "_recency", "_source_file", "region", F.posexplode("items").alias("_position", "_item")
    )
    return rows.select(
        F.col("_item.id").try_cast("bigint").alias("category_id"),
        F.trim(F.col("_item.snippet.title").cast("string")).alias("category_title"),
        F.col("_item.snippet.assignable").try_cast("boolean").alias("assignable"),
        F.col("_item.kind").cast("string").alias("kind"),
        "region", "_recency", "_source_file", "_position",
    ).where(F.col("category_id").isNotNull())


def normalise_reference(bronze: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Category items with every nested field as a dotted column.

    Documents without an ``items`` array are flattened as they are. Duplicate
    ids of one document keep the last item.
    """
    documents = _located(bronze)
    if "items" in bronze.columns:
        rows = documents.select("_source_file", "region", F.posexplode("items").alias("_position", "_item"))
        leaves = flatten_struct(rows, "_item")
    else:
        content = bronze.drop("region", "_source_file", FILE_TIME)
        rows = documents.withColumn("_position", F.lit(0))
        leaves = flatten_struct(content)
    flat = rows.select(*leaves, "_source_file", "region", "_position")
    if "id" in flat.columns:
        content = [c for c in flat.columns if c not in ("id", "region", "_source_file", "_position")]
        flat = latest_rows(flat, ("id", "region", "_source_file"), total_order(["_position", *content]))
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return flat.select(
        *[f"`{c}`" for c in flat.columns if c not in ("_position", "_source_file", "region")],
        F.date_format(stamp, ISO_TIMESTAMP_FORMAT).alias("_ingestion_timestamp"),
        "_source_file",
        "region",
    )


def validate_reference(reference: DataFrame, required: tuple[str, ...] = ("id", "snippet.title")) -> list[str]:
    """Missing column names; raises when there is not a single category."""
    if reference.isEmpty():
        raise EmptyReferenceError("no category items found")
    return missing_fields(reference, required)


def missing_fields(reference: DataFrame, required: tuple[str, ...]) -> list[str]:
    return sorted(name for name in required if field(reference, name) is None)


def _located(bronze: DataFrame, recency: Column | str | None = None) -> DataFrame:
    """Documents with normalised region, source file and recency."""
    if recency is None:
        stamp = field(bronze, "_pipeline_metadata.ingestion_timestamp")
        moments = [] if stamp is None else [try_timestamp(stamp)]
        if "date" in bronze.columns:
            moments.append(try_timestamp(F.col("date").cast("string")))
        if FILE_TIME in bronze.columns:
            moments.append(F.col(FILE_TIME))
        recency = F.coalesce(*moments) if moments else F.lit(None).cast("timestamp")
    elif isinstance(recency, str):
        recency = F.col(recency)
    return bronze.withColumns({
        "_recency": recency,
        "_source_file": field_or(bronze, "_source_file"),
        "region": normal_region(field_or(bronze, "region", "_pipeline_metadata.region").cast("string")),
    })


def _newest_document(documents: DataFrame) -> DataFrame:
    """Documents of the newest file of each region.

    The region table is aggregated on the map side and is as small as the
    number of regions, so the join stays cheap however large one region is.
    """
    file = F.struct(F.col("_recency"), F.col("_source_file"))
    newest = documents.groupBy(F.col("region").alias("_region")).agg(F.max(file).alias("_newest"))
    return documents.join(
        newest, F.col("region").eqNullSafe(F.col("_region")) & file.eqNullSafe(F.col("_newest")), "left_semi"
    )
