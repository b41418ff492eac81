"""Silver -> gold: aggregate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import pickup_month
from tidemark.plans.bronze import month_slice
from tidemark.plans.sinks import WriteOptions, drop_partitions, write_table
from tidemark.schema import TRIPS, TripColumns


def daily_company(df: DataFrame, c: TripColumns = TRIPS) -> DataFrame:
    """Trips, total and mean miles per day and company."""
    return df.groupBy(F.to_date(c.pickup).alias("pickup_date"), c.company).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(c.miles).alias("total_miles"),
        F.avg(c.miles).alias("mean_miles"),
    )


def hour_weekday(df: DataFrame, c: TripColumns = TRIPS) -> DataFrame:
    """Trips per hour of day and weekday (1 = Sunday)."""
    return df.groupBy(
        F.hour(c.pickup).alias("pickup_hour"), F.dayofweek(c.pickup).alias("pickup_dayofweek")
    ).agg(F.count(F.lit(1)).alias("trips"))


def location_month(df: DataFrame, n: int = 3, c: TripColumns = TRIPS) -> DataFrame:
    """The ``n`` busiest pickup locations of each month with their rank."""
    by_month = Window.partitionBy("pickup_month").orderBy(F.desc("trips"), F.asc(c.location))
    return (
        df.groupBy(pickup_month(c.pickup).alias("pickup_month"), c.location)
        .agg(F.count(F.lit(1)).alias("trips"))
        .withColumn("rank", F.row_number().over(by_month))
        .filter(f"rank <= {int(n)}")
    )


def touched_months(df: DataFrame) -> list[str | None]:
    """Months present in new bronze rows; a list as long as the calendar."""
    return [row[0] for row in df.select("pickup_month").distinct().toLocalIterator()]


def refresh_location_month(
    layer: DataFrame, target: str, months: Sequence[str | None] | None = None, n: int = 3
) -> None:
    """Rebuild the monthly leaderboard, or only its partitions for ``months``.

    The month predicate prunes the partitions read; only the partitions written are replaced. The
    ranking leaves each month in one task, so the write needs no further shuffle. Months that have
    become empty lose their partition.
    """
    rows = layer if months is None else month_slice(layer, months)
    options = WriteOptions(refresh="table" if months is None else "partitions")
    write_table(location_month(rows, n), target, options)
    if months is not None:
        filled = touched_months(rows)
        drop_partitions(layer.sparkSession, target, "pickup_month", [m for m in months if m not in filled])


def read_location_month(spark: SparkSession, path: str) -> DataFrame:
    schema = "PULocationID long, trips long, rank int, pickup_month string"
    return spark.read.schema(schema).parquet(path)
