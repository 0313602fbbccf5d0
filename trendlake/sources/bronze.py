"""Bronze scans. Schemas are explicit; regions prune partitions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import path_region, region_filter
from ..session import broadcast_if_small
from .tables import of_partitions

Paths = str | Sequence[str]

#: When the file of a row was last written; the last resort to tell newer copies from older ones.
FILE_TIME = "_file_time"

_CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def with_file_time(df: DataFrame) -> DataFrame:
    return df.withColumn(FILE_TIME, F.col("_metadata.file_modification_time"))


def read_statistics_csv(
    spark: SparkSession, path: Paths, regions: Iterable[str] | None = None, base_path: str | None = None,
    quoted_breaks: bool = True,
) -> DataFrame:
    """Historical CSV files below ``region=`` folders, with each file's time.

    Quoted fields may hold commas, quotes and line breaks. Files with quoted
    line breaks can't be split, so at scale they should be landed as many
    files; ``quoted_breaks=False`` promises there are none and splits them.
    """
    reader = spark.read.schema(schemas.with_partitions(schemas.CSV_STATISTICS, "region"))
    reader = reader.options(**{**_CSV_OPTIONS, "multiLine": quoted_breaks})
    return region_filter(with_file_time(_based(reader, base_path).csv(path)), regions)


def read_csv(spark: SparkSession, path: Paths, schema: str) -> DataFrame:
    """Any header CSV with quoted multi-line text and a given schema."""
    return spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)


def preview_csv(spark: SparkSession, path: Paths, rows: int | None = 10) -> DataFrame:
    """First rows of a CSV with an inferred schema; ``rows=None`` gives all.

    The types of a preview come from the rows it shows, so no more is read.
    """
    if rows is None:
        return spark.read.options(inferSchema=True, **_CSV_OPTIONS).csv(path)
    first = spark.read.options(**_CSV_OPTIONS).csv(path).limit(rows)
    shown = first.collect()
    text = ", ".join(f"`{name}` string" for name in first.columns)
    kinds = spark.createDataFrame(shown, text).select(*(_kind_of(name) for name in first.columns)).first() if shown else None
    return spark.createDataFrame(shown, text).select(*(
        F.col(f"`{name}`").try_cast(kinds[i] if kinds else "string").alias(name) for i, name in enumerate(first.columns)
    ))


def _kind_of(name: str):
    """Aggregate: the narrowest type that reads every value of a text column."""
    column = F.col(f"`{name}`")
    reads = [(kind, F.count(column.try_cast(kind)) == F.count(column)) for kind in ("int", "bigint", "double", "timestamp", "boolean")]
    chain = F.when(F.count(column) == 0, "string")
    for kind, fits in reads:
        chain = chain.when(fits, kind)
    return chain.otherwise("string")


def read_csv_tolerant(
    spark: SparkSession, path: Paths, schema: str, corrupt_column: str = "_corrupt_record", header: bool = True
) -> DataFrame:
    """CSV in which malformed lines are kept, as text, in ``corrupt_column``."""
    return (
        spark.read.schema(f"{schema}, {corrupt_column} string")
        .options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt_column, quote='"', escape='"')
        .csv(path)
    )


def read_trending_documents(
    spark: SparkSession,
    path: Paths,
    regions: Iterable[str] | None = None,
    one_per_line: bool = False,
    base_path: str | None = None,
) -> DataFrame:
    """API documents below ``region=/date=/hour=`` folders.

    Files from the API hold one indented document each. Files written by
    ``land_payloads`` hold one document per line (``one_per_line=True``) and
    can be split among tasks.
    """
    schema = schemas.with_partitions(schemas.API_STATISTICS, "region", "date", "hour")
    reader = spark.read.schema(schema).option("multiLine", not one_per_line)
    return region_filter(_based(reader, base_path).json(path), regions)


def read_reference_documents(
    spark: SparkSession,
    path: Paths,
    regions: Iterable[str] | None = None,
    one_per_line: bool = False,
    partitions: Sequence[str] = ("region",),
    base_path: str | None = None,
) -> DataFrame:
    """Category documents with the file each came from."""
    schema = schemas.with_partitions(schemas.API_REFERENCE, *partitions)
    reader = spark.read.schema(schema).option("multiLine", not one_per_line)
    frame = with_file_time(_based(reader, base_path).json(path).withColumn("_source_file", F.col("_metadata.file_path")))
    return region_filter(frame, regions)


def read_reference_files(spark: SparkSession, keys: Sequence[str], one_per_line: bool = False) -> DataFrame:
    """An explicit list of new category files, region taken from each path.

    ``keys`` may be percent-encoded, as in storage notifications.
    """
    from urllib.parse import unquote_plus

    return (
        spark.read.schema(schemas.API_REFERENCE)
        .option("multiLine", not one_per_line)
        .json([unquote_plus(key) for key in keys])
        .withColumn(FILE_TIME, F.col("_metadata.file_modification_time"))
        .withColumn("_source_file", F.url_decode(F.col("_metadata.file_path")))
        .withColumn("region", path_region(F.col("_source_file")))
    )


def read_reference_records(
    spark: SparkSession, path: str, records: DataFrame, key: str = "key", one_per_line: bool = False,
    partitions: Sequence[str] = ("region",), prefix: str = "",
) -> DataFrame:
    """The category documents that event records name, from a table of their keys.

    Keys are percent-encoded and, behind ``prefix``, relative to ``path``; a key
    that stands more than once is read once, one without a file gives nothing
    (see ``record_status``). The folders that the keys lie in prune the scan,
    and a semi join on the file path keeps the named files; no list of them
    passes the driver.
    """
    keys = _record_keys(records, key, prefix).select("_key").distinct()
    folders = keys.select(*(F.regexp_extract("_key", rf"(?:^|/){name}=([^/]*)/", 1).alias(name) for name in partitions))
    documents = read_reference_documents(spark, path, one_per_line=one_per_line, partitions=partitions)
    documents = of_partitions(documents, folders.groupBy(*partitions).agg(F.count("*").alias("rows")), partitions)
    named = documents.withColumn("_source_file", _below(spark, path, F.col("_source_file")))
    return named.join(broadcast_if_small(keys), F.col("_source_file") == F.col("_key"), "left_semi")


def record_status(spark: SparkSession, path: str, records: DataFrame, key: str = "key", prefix: str = "") -> DataFrame:
    """``file, copies, found``: one row per distinct key, how often it stands in the records, and whether its file is there."""
    keys = _record_keys(records, key, prefix).groupBy("_key").agg(F.count("*").alias("copies"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # Listed paths are not encoded.
    there = files.select(_below(spark, path, F.replace("path", F.lit("%"), F.lit("%25"))).alias("_file")).withColumn("_there", F.lit(True))
    return keys.join(there, F.col("_key") == F.col("_file"), "left").select(
        F.col("_key").alias("file"), "copies", F.coalesce("_there", F.lit(False)).alias("found"))


def _record_keys(records: DataFrame, key: str, prefix: str) -> DataFrame:
    decoded = records.select(F.url_decode(F.col(key)).alias("_key")).where(F.col("_key").startswith(prefix))
    return decoded.select(F.substring("_key", F.lit(len(prefix) + 1), F.length("_key")).alias("_key"))


def _below(spark: SparkSession, path: str, file_path: Column) -> Column:
    """An encoded file path, decoded and relative to ``path``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()
    # In a path a plus is a plus; decoding would make it a blank.
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    whole = F.regexp_replace(decoded, r"^(\w+):/+", "$1:/")
    return F.substring(whole, F.lit(len(root) + 2), F.length(whole))


def read_bronze_table(spark: SparkSession, table: str, regions: Iterable[str] | None = None) -> DataFrame:
    """A registered bronze table, restricted to regions in any spelling."""
    return region_filter(spark.table(table), regions)


def _based(reader, base_path: str | None):
    return reader.option("basePath", base_path) if base_path else reader
