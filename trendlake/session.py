"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "trendlake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is written for.

    ANSI mode stays on; the library uses ``try_`` forms for raw text.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and work tables.

    Taken from ``spark.checkpoint.dir``, or the directory already set on the
    context. Only a local master may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="trendlake-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder; what is there goes when the session ends."""
    path = f"{shared_folder(spark)}/trendlake/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a work table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run meanwhile remove their shuffle files as soon as they end.

    Otherwise these stay until the driver collects its garbage, so a job of many
    writes holds the shuffles of all of them on disk. For writes, which run once.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only when ``df`` is measured to be small.

    At most ``max_rows + 1`` rows are looked at, so the check itself stays
    bounded. Beyond either bound ``df`` comes back without a hint and the join
    shuffles both sides, where adaptive execution splits skewed keys.
    """
    texts = [c for c, t in df.dtypes if t == "string"]
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(16 * len(df.columns)))
    probe = df.limit(max_rows + 1).agg(
        F.count("*").alias("rows"), F.sum(width.cast("bigint")).alias("bytes")
    ).first()
    fits = probe["rows"] <= max_rows and (probe["bytes"] or 0) <= max_bytes
    return F.broadcast(df) if fits else df
