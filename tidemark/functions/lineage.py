"""Columns that say where a row came from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scanned_file() -> Column:
    """URI of the file a row was read from; must be taken directly above the scan."""
    return F.col("_metadata.file_path")


def plain_path(uri: Column) -> Column:
    """The path a file's URI stands for, as a file listing shows it: escapes resolved, a plus stays a plus."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def file_name(path: str | Column) -> Column:
    """Last component of a path."""
    return F.substring_index(path, "/", -1)


def feed_name(path: str | Column) -> Column:
    """Table a file belongs to: ``x/t.parquet`` and ``x/t.parquet/part-0.parquet`` -> ``t.parquet``."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(folder.endswith(".parquet"), folder).otherwise(file_name(path))
