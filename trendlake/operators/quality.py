"""Quality report and gate.

Each table is read once: a single aggregate computes everything the rules
need, and the resulting row is unfolded into one report row per rule.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import try_timestamp
from ..sources.tables import read_table

REPORT_SCHEMA = (
    "check string, `table` string, `column` string, value double, threshold double, "
    "missing_columns array<string>, negative_count bigint, extreme_count bigint, "
    "latest_record timestamp, cutoff timestamp, passed boolean, message string"
)
# Timestamp columns looked at, in order of preference.
_TIMESTAMP_COLUMNS = ("_processed_at", "_ingestion_timestamp")


@dataclass(frozen=True)
class QualityRules:
    """Limits and columns of one table."""

    required: tuple[str, ...] = ()
    range_columns: tuple[str, ...] = ()
    min_rows: int = K.MIN_ROW_COUNT
    max_null_percent: float = K.MAX_NULL_PERCENT
    max_value: int = K.MAX_VIEWS
    freshness_hours: int = K.FRESHNESS_HOURS


STATISTICS_RULES = QualityRules(K.CRITICAL_STATISTICS_COLUMNS, ("views",))
REFERENCE_RULES = QualityRules(K.CRITICAL_REFERENCE_COLUMNS)


class QualityGateError(RuntimeError):
    """Raised by the gate; ``failures`` holds the failing report rows."""

    def __init__(self, failures):
        super().__init__("; ".join(f"{row['table']}: {row['message']}" for row in failures))
        self.failures = failures


def quality_report(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | str],
    rules: Mapping[str, QualityRules],
    *,
    now: Column | None = None,
    read_now: bool = False,
) -> DataFrame:
    """One row per rule and table, over whole tables.

    ``tables`` maps a label to a DataFrame, a table name or a path. A table
    that cannot be resolved becomes a failing ``read_table`` row. With
    ``read_now`` each table is measured at once, so that a file that fails while
    it is read fails its own table only, and the others are still reported;
    the driver gets one row per rule.
    """
    now = F.current_timestamp() if now is None else now
    reports = []
    for label, source in tables.items():
        try:
            df = read_table(spark, source) if isinstance(source, str) else source
        except AnalysisException as error:
            reports.append(_unreadable(spark, label, str(error)))
            continue
        report = _table_report(df, label, rules.get(label, QualityRules()), now)
        if read_now:
            try:
                report = spark.createDataFrame(report.collect(), REPORT_SCHEMA)
            except (PySparkException, Py4JJavaError) as error:
                report = _unreadable(spark, label, str(error).split("\n")[0])
        reports.append(report)
    if not reports:
        return spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, reports)


def quality_failures(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed"))


def quality_verdict(report: DataFrame) -> DataFrame:
    """One row: overall verdict and counts of checks."""
    return report.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("quality_passed"),
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
    )


def require_quality(report: DataFrame) -> None:
    """Raise unless every rule passed. A report has a handful of rows."""
    failures = quality_failures(report).collect()
    if failures:
        raise QualityGateError(failures)


def _table_report(df: DataFrame, label: str, rules: QualityRules, now: Column) -> DataFrame:
    cutoff = now - F.make_dt_interval(hours=F.lit(rules.freshness_hours))
    present = [name for name in rules.required if name in df.columns]
    ranged = [name for name in rules.range_columns if name in df.columns]
    stamp = next((name for name in _TIMESTAMP_COLUMNS if name in df.columns), None)

    wanted = [F.count(F.lit(1)).alias("rows"), F.first(now).alias("now")]
    wanted += [F.count_if(_missing(df, name)).alias(f"null:{name}") for name in present]
    for name in ranged:
        column = F.col(f"`{name}`")
        wanted += [
            F.count_if(column < 0).alias(f"negative:{name}"),
            F.count_if(column > rules.max_value).alias(f"extreme:{name}"),
        ]
    if stamp:
        moment = try_timestamp(f"`{stamp}`")
        wanted += [
            F.max(moment).alias("latest"),
            F.count_if(F.col(f"`{stamp}`").isNotNull() & moment.isNull()).alias("unreadable"),
        ]
    measured = df.agg(*wanted)
    measured = measured.withColumn("cutoff", cutoff)

    entries = [_row_count(rules)]
    entries += [_null_percent(name, name in present, rules) for name in rules.required]
    entries.append(_columns_present([name for name in rules.required if name not in present]))
    entries += [_value_range(name, rules) for name in ranged]
    entries.append(_freshness(stamp is not None))
    return measured.select(F.inline(F.array(*(_entry(label, **entry) for entry in entries))))


def _missing(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    return column.isNull() | F.isnan(column) if dict(df.dtypes)[name] in ("double", "float") else column.isNull()


def _row_count(rules: QualityRules) -> dict:
    rows = F.col("rows")
    return dict(
        check="row_count", value=rows, threshold=F.lit(rules.min_rows), passed=rows >= rules.min_rows,
        message=F.format_string(f"%d rows, at least {rules.min_rows} needed", rows),
    )


def _null_percent(name: str, present: bool, rules: QualityRules) -> dict:
    if not present:
        return dict(check="null_pct", column=name, passed=F.lit(False), message=F.lit(f"column {name} is missing"))
    percent = F.coalesce(F.try_divide(F.col(f"`null:{name}`"), F.col("rows")) * 100, F.lit(0.0))
    return dict(
        check="null_pct", column=name, value=F.round(percent, 2), threshold=F.lit(rules.max_null_percent),
        passed=percent <= rules.max_null_percent,
        message=F.format_string(f"{name}: %.2f%% NULL, at most {rules.max_null_percent}%% allowed", percent),
    )


def _columns_present(missing: list[str]) -> dict:
    return dict(
        check="schema", missing_columns=F.array(*map(F.lit, missing)).cast("array<string>"),
        passed=F.lit(not missing),
        message=F.lit("missing columns: " + ", ".join(missing) if missing else "all expected columns present"),
    )


def _value_range(name: str, rules: QualityRules) -> dict:
    negative, extreme = F.col(f"`negative:{name}`"), F.col(f"`extreme:{name}`")
    return dict(
        check="value_range", column=name, negative_count=negative, extreme_count=extreme,
        passed=(negative == 0) & (extreme == 0),
        message=F.format_string(f"{name}: %d negative, %d above {rules.max_value}", negative, extreme),
    )


def _freshness(stamped: bool) -> dict:
    """Unreadable or absent timestamps pass; readable but absent values fail."""
    if not stamped:
        return dict(check="freshness", passed=F.lit(True), message=F.lit("no timestamp column, freshness not checked"))
    latest, cutoff, readable = F.col("latest"), F.col("cutoff"), F.col("unreadable") == 0
    text = F.concat_ws("", F.lit("latest "), F.coalesce(latest.cast("string"), F.lit("none")), F.lit(", cutoff "), cutoff.cast("string"))
    return dict(
        check="freshness", latest_record=F.when(readable, latest), cutoff=F.when(readable, cutoff),
        passed=~readable | F.coalesce(latest >= cutoff, F.lit(False)),
        message=F.when(readable, text).otherwise(F.lit("unreadable timestamps, freshness not checked")),
    )


def _entry(label: str, *, check: str, passed: Column, message: Column, column: str | None = None, **values: Column) -> Column:
    def value(name: str, kind: str) -> Column:
        return values.get(name, F.lit(None)).cast(kind).alias(name)

    return F.struct(
        F.lit(check).alias("check"), F.lit(label).alias("table"), F.lit(column).cast("string").alias("column"),
        value("value", "double"), value("threshold", "double"), value("missing_columns", "array<string>"),
        value("negative_count", "bigint"), value("extreme_count", "bigint"),
        value("latest_record", "timestamp"), value("cutoff", "timestamp"),
        passed.alias("passed"), message.cast("string").alias("message"),
    )


def _unreadable(spark: SparkSession, label: str, reason: str) -> DataFrame:
    entry = _entry(label, check="read_table", passed=F.lit(False), message=F.lit(reason))
    return spark.range(1).select(F.inline(F.array(entry)))
