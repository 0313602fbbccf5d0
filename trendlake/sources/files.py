"""File listings and their routing into bronze."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import file_kind, file_region, is_data_file
from ..session import work_path
from .bronze import read_csv, read_reference_documents


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below ``path``: name, path, size, time. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=pattern, recursiveFileLookup=True)
        .load(path)
        .select(F.substring_index("path", "/", -1).alias("name"), "path", "length", "modificationTime")
    )


def classify_files(files: DataFrame, name: str = "name") -> DataFrame:
    """Keep data files; add ``kind``, ``region`` and the bronze ``target`` key."""
    column = F.col(name)
    return (
        files.where(is_data_file(column))
        .withColumn("kind", file_kind(column))
        .withColumn("region", file_region(column))
        .withColumn("target", F.concat(F.col("kind"), F.lit("/region="), F.col("region"), F.lit("/"), column))
    )


ROUTED = "name string, kind string, region string, path string, length bigint, sha256 string"


def route_files(spark: SparkSession, path: str, bronze_path: str) -> DataFrame:
    """Bring the files of a flat folder into bronze as they are, by kind and region.

    CSV files and category documents land below ``raw_stats/region=`` and
    ``raw_stats_reference_data/region=`` under their own names, byte for byte:
    nothing is parsed, so malformed lines stay. Each file is streamed by one task
    and appears when it is complete; a repeated task replaces it. Files without a
    byte are not listed. Returns one row per file, with the digest of what was
    copied.
    """
    files = classify_files(list_files(spark, path))
    wanted = files.select("name", "kind", "region", "path", F.concat(F.lit(bronze_path.rstrip("/") + "/"), "target").alias("to"))
    copied = wanted.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(_copy_files, ROUTED)
    done = work_path(spark, "routed-files")
    copied.write.parquet(done)
    return spark.read.schema(ROUTED).parquet(done)


def _copy_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            length, digest = _copy(row["path"], row["to"])
            rows.append({"name": row["name"], "kind": row["kind"], "region": row["region"], "path": row["to"], "length": length, "sha256": digest})
        if rows:
            yield pa.RecordBatch.from_pylist(rows)


def _copy(source: str, target: str, part_bytes: int = 8 << 20) -> tuple[int, str]:
    """Stream a file to another place; the target is only ever absent or whole."""
    (reader, from_path), (writer, to_path) = _store(source), _store(target)
    folder, name = to_path.rsplit("/", 1)
    writer.create_dir(folder, recursive=True)
    waiting, digest, length = f"{folder}/.{name}.{uuid.uuid4().hex}", hashlib.sha256(), 0
    with reader.open_input_stream(from_path, compression=None) as given, writer.open_output_stream(waiting, compression=None) as taken:
        while part := given.read(part_bytes):
            digest.update(part)
            taken.write(part)
            length += len(part)
    writer.move(waiting, to_path)
    return length, digest.hexdigest()


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path within it."""
    if ":" not in uri.split("/", 1)[0]:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def route_statistics(spark: SparkSession, path: str) -> DataFrame:
    """CSV files of a flat folder as bronze rows, region from the file name."""
    return (
        read_csv(spark, path, schemas.CSV_STATISTICS)
        .withColumn("region", file_region(F.col("_metadata.file_name")))
    )


def route_reference(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Category documents of a flat folder, region from the file name."""
    return (
        read_reference_documents(spark, path, one_per_line=one_per_line, partitions=())
        .withColumn("region", file_region(F.substring_index("_source_file", "/", -1)))
    )
