"""Finding a field whichever way the reader spelled it.

A nested field ``snippet.title`` may arrive as a real struct, as a flat column
literally named ``snippet.title``, or as ``snippet__title``/``snippet_title``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEPARATORS = (".", "__")


def _in_struct(schema: T.StructType, path: list[str]) -> bool:
    for position, name in enumerate(path):
        if not isinstance(schema, T.StructType) or name not in schema.fieldNames():
            return False
        if position + 1 < len(path):
            schema = schema[name].dataType
    return True


def _quoted(path: list[str]) -> str:
    return ".".join(f"`{name}`" for name in path)


def field(df: DataFrame, name: str, separators: tuple[str, ...] = _SEPARATORS) -> Column | None:
    """The column for a dotted ``name``, or None when ``df`` has no such field."""
    path = name.split(".")
    for separator in separators:
        flat = separator.join(path)
        if flat in df.columns:
            return F.col(f"`{flat}`")
    return F.col(_quoted(path)) if _in_struct(df.schema, path) else None


def has_field(df: DataFrame, name: str) -> bool:
    return field(df, name) is not None


def field_or(df: DataFrame, *names: str, default: Column | None = None) -> Column:
    """First field that exists, else ``default``, else a NULL."""
    for name in names:
        found = field(df, name)
        if found is not None:
            return found
    return F.lit(None).cast("string") if default is None else default


def flatten_struct(df: DataFrame, column: str | None = None) -> list[Column]:
    """Every leaf below ``column`` (or below the row) under its dotted name.

    Arrays and maps stay whole.
    """
    def leaves(schema: T.StructType, source: list[str], label: list[str]) -> list[Column]:
        found = []
        for item in schema.fields:
            here, there = source + [item.name], label + [item.name]
            if isinstance(item.dataType, T.StructType):
                found += leaves(item.dataType, here, there)
            else:
                found.append(F.col(_quoted(here)).alias(".".join(there)))
        return found

    if column is None:
        return leaves(df.schema, [], [])
    return leaves(df.schema[column].dataType, [column], [])
