"""What file names and paths say about their content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _or_unknown(text: Column) -> Column:
    return F.when(F.length(text) > 0, text).otherwise(F.lit(K.UNKNOWN_REGION))


def is_data_file(name: Column) -> Column:
    """CSV and JSON files only."""
    return name.endswith(".csv") | name.endswith(".json")


def file_kind(name: Column) -> Column:
    """Bronze area a file belongs to, from its suffix."""
    return (
        F.when(name.endswith(".csv"), K.STATISTICS_KIND)
        .when(name.endswith(".json"), K.REFERENCE_KIND)
        .otherwise(K.UNKNOWN_KIND)
    )


def file_region(name: Column) -> Column:
    """Two leading capitals of the file name, else ``unknown``."""
    return _or_unknown(F.regexp_extract(name, K.REGION_IN_FILE_NAME, 1))


def name_prefix_region(name: Column) -> Column:
    """Part before the first underscore when it has two characters, else ``unknown``."""
    prefix = F.substring_index(name, "_", 1)
    return F.when(F.length(prefix) == 2, prefix).otherwise(F.lit(K.UNKNOWN_REGION))


def path_region(path: Column) -> Column:
    """Value of the first ``region=`` path segment, else ``unknown``."""
    return _or_unknown(F.regexp_extract(path, K.REGION_IN_PATH, 1))
