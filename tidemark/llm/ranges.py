"""Cut a table into ranges of ids of about equal row count."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = -(1 << 63)  # a null id sorts before all others


def id_of(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_points(df: DataFrame, ranges: int, column: str = "doc_id") -> list[int]:
    """Ids at which at most ``ranges`` ranges begin; any set of points gives right results."""
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    row = df.agg(F.percentile_approx(id_of(column), shares, 20 * ranges).alias("p")).first()
    return sorted(set(row["p"] or []))


def range_index(points: list[int], column: str = "doc_id") -> Column:
    """0 for ids below the first point, and so on. Only the ids pass through Python."""
    edges = np.array(points, np.int64)

    @F.pandas_udf("int")
    def index(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(np.int64), side="right").astype(np.int32))

    return index(id_of(column)) if points else F.lit(0)
