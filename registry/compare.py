"""Run registered queries next to their SQL and compare the results.

    python -m registry.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from trendlake import build_session

from .oracle import ORACLES
from .queries import QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def difference(spark_rows, spark_columns, sql_rows, sql_columns) -> str | None:
    """None when both hold the same rows in any order, else what differs first."""
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} != {sorted(sql_columns)}"
    order = sorted(spark_columns)

    def normal(rows, columns):
        places = [columns.index(name) for name in order]
        return sorted((tuple(row[p] for p in places) for row in rows), key=repr)

    left, right = normal(spark_rows, spark_columns), normal(sql_rows, sql_columns)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b and not all(_same(x, y) for x, y in zip(a, b)):
            return f"{dict(zip(order, a))} != {dict(zip(order, b))}"
    return None


def _same(x, y) -> bool:
    if isinstance(x, float) and isinstance(y, float):
        return x == y or (math.isnan(x) and math.isnan(y))
    return x == y and type(x) is type(y)


def check(spark, connection, sf_dir: str, name: str) -> str | None:
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    if name not in ORACLES:
        return None
    result = connection.execute(ORACLES[name])
    columns = [item[0] for item in result.description]
    return difference(rows, df.columns, result.fetchall(), columns)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = check(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
