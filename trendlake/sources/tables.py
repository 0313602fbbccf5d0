"""Silver and gold tables, by registered name or by path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small


def read_table(spark: SparkSession, name: str, merge_schema: bool = False) -> DataFrame:
    """A table from the catalog, or Parquet files when ``name`` is a path.

    ``merge_schema`` unites the columns of files written before and after a
    column was added. It opens every file footer, so it is for small tables;
    a table registered in the catalog knows all its columns without it.
    """
    if "/" in name:
        return spark.read.option("mergeSchema", merge_schema).parquet(name)
    return spark.table(name)


def read_table_if_present(
    spark: SparkSession, name: str | None, merge_schema: bool = True
) -> DataFrame | None:
    """The table, or None when it is not there or cannot be read."""
    if name is None:
        return None
    try:
        return read_table(spark, name, merge_schema)
    except AnalysisException:
        return None



def partition_key(columns: Sequence[str], prefix: str = "") -> Column:
    """The values of partition columns as one text; NULL differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"{prefix}{name}").cast("string")), F.lit("")) for name in columns]
    return F.concat_ws("/", *parts)


def of_partitions(table: DataFrame, partitions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a stored table in the partitions that ``partitions`` lists, with their number of ``rows``.

    One equality over all partition columns, against a broadcast list with a
    filter: Spark then evaluates it on the folders before the scan, so other
    partitions are not read. No list passes through Python, and one too long to
    be broadcast is joined by a shuffle.
    """
    listed = partitions.where("rows > 0").select(partition_key(columns).alias("_listed"))
    return table.join(broadcast_if_small(listed), partition_key(columns) == F.col("_listed"), "left_semi")
