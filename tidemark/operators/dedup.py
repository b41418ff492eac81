"""One row per business key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``, which should end in a unique combination.

    Spark plans ``row_number() = 1`` as a group limit on both sides of the shuffle, so every
    task sends at most one row per key, however many copies a key has.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(ranked)).filter("_copy = 1").drop("_copy")


def keep_latest(df: DataFrame, keys: Sequence[str], newest_first: str) -> DataFrame:
    """The row with the highest ``newest_first`` per key; all other columns break ties.

    A key with a NULL part does not identify a row: such rows are merged only if they are equal in all
    columns but ``newest_first``.
    """
    rest = [c for c in df.columns if c not in keys and c != newest_first]
    unknown = reduce(or_, [F.col(k).isNull() for k in keys])
    known = df.withColumn("_rest", F.when(unknown, F.struct(*rest))) if rest else df
    order = [F.desc(newest_first), *[F.asc(c) for c in rest]]
    return keep_first(known, [*keys, "_rest"] if rest else keys, order).drop("_rest")
