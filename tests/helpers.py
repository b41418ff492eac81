"""Helpers of the tests; no module of this name may lie in another test folder."""

from __future__ import annotations

from pathlib import Path


def put_file(df, path: Path) -> None:
    """Write one Parquet file under an exact name."""
    df.toPandas().to_parquet(path, coerce_timestamps="us", schema=_arrow(df))


def _arrow(df):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)
