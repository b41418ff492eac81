"""Analysis queries over a trip table. Every ordering ends with a unique key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.lineage import scanned_file
from tidemark.functions.measures import hash_fraction, speed_mph
from tidemark.functions.temporal import calendar_features
from tidemark.schema import TRIPS, TripColumns

GIB = 1024**3
HOURS = list(range(24))


def dataset_overview(scan: DataFrame) -> DataFrame:
    """Columns, rows, files, non-empty scan partitions and size of a file scan.

    Rows are first counted per file and partition; the distinct counts run over that small
    table. No data column is read.
    """
    files = scan.select(scanned_file().alias("path"), F.col("_metadata.file_size").alias("bytes"))
    parts = files.groupBy("path", "bytes", F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    first_part = F.row_number().over(Window.partitionBy("path").orderBy("part")) == 1
    return parts.withColumn("first_part", first_part).agg(
        F.lit(len(scan.columns)).alias("column_count"),
        F.sum("n").alias("row_count"),
        F.count_if("first_part").alias("file_count"),
        F.count_distinct("part").alias("partition_count"),
        (F.sum(F.when(F.col("first_part"), F.col("bytes"))) / F.lit(GIB)).alias("size_gb"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def missing_values(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column, from one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls")


def temporal_features(df: DataFrame, c: TripColumns = TRIPS) -> DataFrame:
    return df.withColumns(calendar_features(c.pickup))


def trip_speed(df: DataFrame, c: TripColumns = TRIPS) -> DataFrame:
    return df.withColumn("speed_mph", speed_mph(c.miles, c.seconds))


def speed_anomalies(df: DataFrame, max_mph: float = 200.0, c: TripColumns = TRIPS) -> DataFrame:
    """Trips with a positive duration that are faster than ``max_mph``."""
    return trip_speed(df, c).filter((F.col(c.seconds) > 0) & (F.col("speed_mph") > max_mph))


def hourly_demand(df: DataFrame, c: TripColumns = TRIPS) -> DataFrame:
    return (
        df.groupBy(F.hour(c.pickup).alias("pickup_hour"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy("pickup_hour")
    )


def volume_by(df: DataFrame, key: str, alias: str = "trips") -> DataFrame:
    """Trips per key, most first."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias)).orderBy(F.desc(alias), key)


def top_by_volume(df: DataFrame, key: str, n: int = 20, alias: str = "trips") -> DataFrame:
    """The ``n`` keys with the most trips."""
    return volume_by(df, key, alias).limit(n)


def longest_trips_per_day(df: DataFrame, n: int = 5, c: TripColumns = TRIPS) -> DataFrame:
    """The ``n`` longest trips of each pickup date with their rank.

    Ranking sorts whole rows, so rows that cannot rank are dropped first: see ``_could_rank``.
    """
    dated = df.withColumn("pickup_date", F.to_date(c.pickup))
    per_day = Window.partitionBy("pickup_date").orderBy(F.desc(c.miles), F.asc(c.trip_id))
    return (
        _could_rank(dated, n, c)
        .withColumn("rank", F.row_number().over(per_day))
        .filter(f"rank <= {int(n)}")
    )


def _could_rank(dated: DataFrame, n: int, c: TripColumns) -> DataFrame:
    """Rows that may be among the ``n`` longest of their date, without a sort.

    The trips of a date are split by id into parts. If ``n`` parts have a maximum of at least x,
    then ``n`` trips are at least x long, and a shorter one cannot rank. Dates with trips in fewer
    parts keep all rows. The input is read twice, the first time only three columns of it. The
    limits are broadcast: a date has at most 3.7 million values, whatever the size of the data.
    """
    part = F.pmod(F.xxhash64(c.trip_id), F.lit(8 * n))
    longest = (
        dated.filter(F.col(c.miles).isNotNull())
        .groupBy(F.col("pickup_date").alias("limit_date"), part.alias("part"))
        .agg(F.max(c.miles).alias("miles"))
        .groupBy("limit_date")
        .agg(F.get(F.sort_array(F.collect_list("miles"), asc=False), F.lit(n - 1)).alias("limit"))
    )
    return (
        dated.join(longest, F.col("pickup_date").eqNullSafe(F.col("limit_date")), "left")
        .filter(F.col("limit").isNull() | (F.col(c.miles) >= F.col("limit")))
        .drop("limit_date", "limit")
    )


def fare_distance_corr(df: DataFrame, c: TripColumns = TRIPS) -> DataFrame:
    """Pearson correlation over the pairs where both values are present."""
    return df.agg(F.corr(c.miles, c.fare).alias("corr"))


def distance_histogram(
    df: DataFrame, low: float, high: float, bins: int = 50, c: TripColumns = TRIPS
) -> DataFrame:
    """Trips per equal-width distance bin; bin 0 lies below ``low``, bin ``bins + 1`` from ``high`` on, NaN included."""
    inside = F.width_bucket(F.col(c.miles), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    bin_no = F.when(F.isnan(c.miles), F.lit(bins + 1).cast("long")).otherwise(inside)
    return (
        df.filter(F.col(c.miles).isNotNull())
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy("bin")
    )


def fare_distance_grid(
    df: DataFrame, miles_step: float, fare_step: float, c: TripColumns = TRIPS
) -> DataFrame:
    """Trips and mean fare per (distance, fare) cell: the density behind a scatter plot."""
    return (
        df.filter(F.col(c.miles).isNotNull() & F.col(c.fare).isNotNull())
        .groupBy(
            F.floor(F.col(c.miles) / F.lit(float(miles_step))).cast("int").alias("miles_cell"),
            F.floor(F.col(c.fare) / F.lit(float(fare_step))).cast("int").alias("fare_cell"),
        )
        .agg(F.count(F.lit(1)).alias("trips"), F.avg(c.fare).alias("mean_fare"))
    )


def stable_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a hash of ``key``.

    Unlike ``DataFrame.sample`` the choice does not depend on how the data is partitioned.
    """
    return df.filter(hash_fraction(key) < F.lit(float(fraction)))


def demand_grid(df: DataFrame, c: TripColumns = TRIPS) -> DataFrame:
    """Trips for every hour x company combination, with zeros where a company had none.

    The 24 hours are fixed, so the product needs no join: pivot the hours into one row per
    company, fill the gaps, and turn them back into rows.
    """
    wide = (
        df.withColumn("pickup_hour", F.hour(c.pickup))
        .groupBy(c.company)
        .pivot("pickup_hour", HOURS)
        .agg(F.count(F.lit(1)))
    )
    cells = [
        F.struct(F.lit(h).alias("pickup_hour"), F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias("trips"))
        for h in HOURS
    ]
    return wide.select(c.company, F.inline(F.array(*cells)))
