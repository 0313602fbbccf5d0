"""Writing silver and gold: Parquet, Snappy, partitioned, repeatable."""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..session import shuffles_freed


class StoredLayoutError(ValueError):
    """The table is stored under other partition columns than the write would use."""


def stored_partitions(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Partition columns of the table at ``path``, from its first folders; None without data."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names: list[str] = []
    while True:
        if not files.exists(folder):
            return None
        inner = [s for s in files.listStatus(folder) if not s.getPath().getName().startswith(("_", "."))]
        if not inner:
            return None
        if inner[0].isFile():
            return tuple(names)
        folder = inner[0].getPath()
        names.append(folder.getName().split("=", 1)[0])


def require_layout(spark: SparkSession, path: str, partition_by: Sequence[str]) -> None:
    """Refuse to mix layouts: a table with two of them can't be read any more."""
    stored = stored_partitions(spark, path)
    if stored is not None and stored != tuple(partition_by):
        raise StoredLayoutError(f"{path} is partitioned by {list(stored)}, not by {list(partition_by)}")


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("region",),
    *,
    mode: str = "overwrite_partitions",
    table: str | None = None,
    rebalance: bool = True,
    metrics: dict[str, Column] | None = None,
    unlike: Sequence[str] = (),
    staged: str | None = None,
) -> dict[str, int]:
    """Write ``df`` and return ``rows`` and any further ``metrics`` of the write.

    ``overwrite_partitions`` replaces the partitions ``df`` has rows for and
    leaves the others alone, so a repeated run changes nothing; ``overwrite``
    replaces the table. A table stored under other partition columns is refused
    unless it is replaced. The metrics are collected by the tasks that write,
    behind any shuffle, so they cost no extra job, and a stage that is run again
    after a loss counts once; a ``null_`` or ``negative_`` one over 0 is warned of.

    A registered ``table`` learns the partitions that this write has rows for,
    and no others; on its first registration it takes up what was stored before.

    ``rebalance`` lets adaptive execution size the files: small partitions are
    joined and a partition that holds much of the data is split. Turn it off
    where one more shuffle costs more than many files do. ``unlike`` names columns
    whose values hardly repeat within a partition, so that no dictionary is tried for them.

    ``staged`` names the folder that ``df`` is read from, where it lies in the layout of the
    table: its partitions are moved to their places (``move_partitions``), not written
    again, and nothing is counted. In another file system they are written.
    """
    overwrite = {"overwrite_partitions": ("overwrite", "dynamic"), "overwrite": ("overwrite", "static"), "append": ("append", "static")}
    if mode not in overwrite:
        raise ValueError(f"unknown mode {mode!r}")
    save_mode, partition_mode = overwrite[mode]
    spark = df.sparkSession
    if mode != "overwrite":
        require_layout(spark, path, partition_by)
    if staged is not None:
        if mode != "overwrite_partitions" or table is not None or metrics:
            raise ValueError("staged partitions are moved as they are, into a table without a name")
        if move_partitions(spark, staged, path, partition_by):
            return {}
    known = table is not None and spark.catalog.tableExists(table)
    adopt = table is not None and not known and mode != "overwrite" and stored_partitions(spark, path) is not None
    observation = Observation()
    with shuffles_freed(spark):
        (
            observed(df, observation, partition_by, metrics or {}, rebalance, table is not None).write.mode(save_mode)
            .option("partitionOverwriteMode", partition_mode)
            .option("compression", "snappy")
            .options(**{f"parquet.enable.dictionary#{name}": "false" for name in unlike})
            .partitionBy(*partition_by)
            .parquet(path)
        )
    counts = dict(observation.get)
    written = counts.pop(_WRITTEN, None)
    if table is not None:
        if known and mode == "overwrite":
            spark.sql(f"DROP TABLE {table}")
        register_table(spark, table, path, df, partition_by, None if adopt else [r.asDict() for r in written or []])
    warn_of(counts, path)
    return counts


def move_partitions(spark: SparkSession, staged: str, path: str, partition_by: Sequence[str]) -> bool:
    """Replace partitions of the table at ``path`` by those that lie below ``staged``, which gives them away.

    A run that dies on the way leaves the rest below ``staged``, so moving once
    more finishes it, and once all have moved it changes nothing. False, with
    nothing done, if both lie in different file systems.
    """
    source, target = _hadoop(spark, staged), _hadoop(spark, path)
    files, others = (folder.getFileSystem(spark._jsc.hadoopConfiguration()) for folder in (source, target))
    if files.getUri().toString() != others.getUri().toString():
        return False

    def move(folder, place, depth: int) -> None:
        if depth == 0:
            files.delete(place, True)
            files.mkdirs(place.getParent())
            if not files.rename(folder, place):
                raise OSError(f"{folder} can't be moved to {place}")
            return
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if status.isDirectory() and "=" in name:
                move(status.getPath(), _hadoop(spark, f"{place}/{name}"), depth - 1)

    if files.exists(source):
        move(source, target, len(partition_by))
    spark.catalog.refreshByPath(path)
    return True


#: The metric that holds the partitions a write has rows for.
_WRITTEN = "_written"


def observed(
    df: DataFrame, observation: Observation, partition_by: Sequence[str], metrics: dict[str, Column], rebalance: bool, partitions: bool
) -> DataFrame:
    """``df`` as it is written, with its metrics taken behind the shuffle that sizes the files."""
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    extra = [F.collect_set(F.struct(*partition_by)).alias(_WRITTEN)] if partitions and partition_by else []
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *(m.alias(n) for n, m in metrics.items()), *extra)


def warn_of(counts: dict[str, int], path: str) -> None:
    """Warn of NULLs and negative values in watched columns; nothing is refused."""
    found = [f"{name} {n}" for name, n in counts.items() if name.startswith(("null_", "negative_")) and n]
    if found:
        warnings.warn(f"{path}: {', '.join(found)}", stacklevel=3)


def register_table(
    spark: SparkSession, table: str, path: str, df: DataFrame | None = None, partition_by: Sequence[str] = (),
    partitions: Iterable[dict] | None = None,
) -> None:
    """Make the files at ``path`` known as ``table``.

    A known table learns new columns and the given ``partitions``; without a list
    of them it takes up all that lie below ``path``. A table whose column types
    have become wider is defined anew over the same files.
    """
    if "." in table:
        ensure_database(spark, table.rsplit(".", 1)[0])
    if df is not None and spark.catalog.tableExists(table):
        known = {f.name.lower(): f.dataType for f in spark.table(table).schema}
        if any(known.get(f.name.lower(), f.dataType) != f.dataType for f in df.schema):
            spark.sql(f"DROP TABLE {table}")
            partitions = None
    if not spark.catalog.tableExists(table):
        if df is None:
            spark.catalog.createTable(table, path=path, source="parquet")
        else:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            parted = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parted} LOCATION '{path}'")
    elif df is not None:
        new = [f for f in df.schema.fields if f.name.lower() not in known]
        if new:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    if partition_by and partitions is None:
        spark.catalog.recoverPartitions(table)
    elif partition_by:
        specs = [f"PARTITION ({', '.join(f'`{c}` = {_literal(p[c])}' for c in partition_by)})" for p in partitions]
        for at in range(0, len(specs), 500):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs[at:at + 500])}")
    spark.catalog.refreshTable(table)


def _literal(value) -> str:
    if value is None:
        return "null"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


class SchemaChangeError(ValueError):
    """A column has come with a type that the stored one can't be widened to."""


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: From a type to the wider ones that files of it can be read as.
_WIDER = {T.FloatType(): [T.DoubleType()], **{kind: [*_WHOLE[i + 1:], *([T.DoubleType()] if i < 3 else [])] for i, kind in enumerate(_WHOLE)}}


def wider_type(name: str, one: T.DataType, other: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    if one == other or other in _WIDER.get(one, []):
        return other
    if one in _WIDER.get(other, []):
        return one
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        scale = max(one.scale, other.scale)
        digits = max(one.precision - one.scale, other.precision - other.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    raise SchemaChangeError(f"column {name} is {one.simpleString()} and comes as {other.simpleString()}")


def merged_schema(stored: T.StructType | None, incoming: T.StructType) -> T.StructType:
    """All columns of both, the stored ones first, each with the wider type."""
    if stored is None:
        return incoming
    come = {f.name.lower(): f for f in incoming}
    fields = [T.StructField(f.name, wider_type(f.name, f.dataType, come[f.name.lower()].dataType) if f.name.lower() in come else f.dataType) for f in stored]
    names = {f.name.lower() for f in stored}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in incoming if f.name.lower() not in names])


def write_evolving(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("region",), *, mode: str = "overwrite_partitions", table: str | None = None,
    metrics: dict[str, Column] | None = None,
) -> dict[str, int]:
    """``write_partitioned`` for deliveries whose columns change.

    Added columns are NULL in older files, missing ones are written as NULL, and
    wider types hold for the whole table: older files are read as the wider type,
    none is rewritten. The table's schema is kept beside its files; a change that
    can't be widened raises ``SchemaChangeError`` and writes nothing.
    """
    spark = df.sparkSession
    schema = df.schema if mode == "overwrite" else merged_schema(stored_schema(spark, path), df.schema)
    come = {c.lower(): c for c in df.columns}
    out = df.select(*(
        (F.col(f"`{come[f.name.lower()]}`") if f.name.lower() in come else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
    if mode != "overwrite":
        _keep_schema(spark, path, schema)
    counts = write_partitioned(out, path, partition_by, mode=mode, table=table, metrics=metrics)
    _keep_schema(spark, path, schema)
    return counts


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept beside the files at ``path``, else that of the files; None without a table."""
    file = _hadoop(spark, f"{path}/{_SCHEMA_FILE}")
    files = file.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(file):
        stream = files.open(file)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return T.StructType.fromJson(json.loads(text))
    return spark.read.parquet(path).schema if has_table(spark, path) else None


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``write_evolving``, with all its columns in their widest types."""
    return spark.read.schema(stored_schema(spark, path)).parquet(path)


#: Hidden from readers of the folder, like all names with an underscore.
_SCHEMA_FILE = "_table_schema.json"


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    file = _hadoop(spark, f"{path}/{_SCHEMA_FILE}")
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True)
    stream.write(bytearray(schema.json().encode()))
    stream.close()


def _hadoop(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def null_metrics(columns: Sequence[str]) -> dict[str, Column]:
    """Warn-only counts of NULLs, one per column."""
    return {f"null_{name}": F.count_if(F.col(name).isNull()) for name in columns}


def statistics_metrics() -> dict[str, Column]:
    """What is watched while silver statistics are written."""
    return {
        **null_metrics(K.WATCHED_STATISTICS_COLUMNS),
        "negative_views": F.count_if(F.col("views") < 0),
    }


def reference_metrics() -> dict[str, Column]:
    """What is watched while silver reference is written."""
    return null_metrics(K.WATCHED_REFERENCE_COLUMNS)


def has_table(spark: SparkSession, path: str) -> bool:
    """Whether Parquet files can be read at ``path``."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True
