from __future__ import annotations

import math
from datetime import datetime

import pytest
from helpers import rows_of

from pyspark.sql import functions as F

from tidemark.operators import explore


def at(hour: int, day: int = 1) -> datetime:
    return datetime(2024, 1, day, hour)


def test_ties_are_broken_by_id_and_by_key(trips):
    df = trips(*[(i, at(1), 5.0, 10, i % 3, "c") for i in range(9)])
    longest = explore.longest_trips_per_day(df, n=2)
    assert [(r.trip_id, r["rank"]) for r in longest.orderBy("rank").collect()] == [(0, 1), (1, 2)]
    assert [tuple(r) for r in explore.top_by_volume(df, "PULocationID", 2).collect()] == [(0, 3), (1, 3)]


def test_longest_trips_with_fewer_trips_than_ranks(trips):
    df = trips((1, at(1), None, 10), (2, at(2), 1.0, 10), (3, at(3, 2), 2.0, 10))
    got = {(r.trip_id, r["rank"]) for r in explore.longest_trips_per_day(df).collect()}
    assert got == {(2, 1), (1, 2), (3, 1)}


def test_longest_trips_equal_a_plain_ranking(spark):
    """Dates with many trips, few ids, one hot id, ties, NULL and NaN distances, and no date."""
    rows = spark.range(20_000).selectExpr(
        "case when id % 7 = 0 then 1 when id % 7 = 1 then id % 3 else id end as trip_id",
        "case when id % 50 = 0 then null else"
        " timestamp_ntz'2024-01-01 05:00:00' + make_dt_interval(cast(id % 7 as int)) end as pickup_datetime",
        "case when id % 11 = 0 then null when id % 997 = 0 then double('NaN')"
        " when id % 7 = 6 and id > 700 then null else double(pmod(hash(id), 300)) end as trip_miles",
        "id as serial",
    )
    for n in (1, 5, 40):
        plain = rows.withColumn("pickup_date", F.to_date("pickup_datetime")).selectExpr(
            "pickup_date", "trip_id", "trip_miles",
            "row_number() over (partition by pickup_date order by trip_miles desc, trip_id) as rank",
        )
        got = explore.longest_trips_per_day(rows, n).select(plain.columns)
        # Compared as text: NaN is not equal to itself.
        assert str(rows_of(got)) == str(rows_of(plain.filter(f"rank <= {n}")))


def test_correlation_ignores_incomplete_pairs(trips):
    pairs = [(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 9.0)]
    df = trips(*[(i, at(1), m, 1, 1, "c", f) for i, (m, f) in enumerate(pairs)])
    assert explore.fare_distance_corr(df).first()[0] == pytest.approx(0.998626, abs=1e-6)


def test_histogram_edges(trips):
    miles = [-0.1, 0.0, 9.99, 10.0, 499.9, 500.0, None]
    df = trips(*[(i, at(1), m) for i, m in enumerate(miles)])
    assert rows_of(explore.distance_histogram(df, 0, 500)) == [(0, 1), (1, 2), (2, 1), (50, 1), (51, 1)]


def test_grid_skips_incomplete_pairs(trips):
    df = trips((1, at(1), 4.9, 1, 1, "c", 9.0), (2, at(1), 5.0, 1, 1, "c", 11.0), (3, at(1), 5.0))
    assert rows_of(explore.fare_distance_grid(df, 5, 10)) == [(0, 0, 1, 9.0), (1, 1, 1, 11.0)]


def test_anomalies_need_a_duration(trips):
    df = trips((1, at(1), 100.0, 60), (2, at(1), 100.0, 0), (3, at(1), 1.0, 60), (4, at(1), 100.0, None))
    assert [r.trip_id for r in explore.speed_anomalies(df).collect()] == [1]


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(50_000)
    picked = rows_of(explore.stable_sample(df, "id", 0.01))
    assert picked == rows_of(explore.stable_sample(df.repartition(13), "id", 0.01))
    assert 400 < len(picked) < 600
    assert explore.stable_sample(df, "id", 1.0).count() == 50_000


def test_demand_grid_has_every_hour_for_every_company(trips):
    df = trips((1, at(3), 1.0, 1, 1, "a"), (2, at(3), 1.0, 1, 1, "a"), (3, at(23), 1.0, 1, 1, "b"))
    grid = explore.demand_grid(df)
    assert grid.count() == 48
    assert rows_of(grid.filter("trips > 0")) == [("a", 3, 2), ("b", 23, 1)]


def test_missing_values_counts_null_not_nan(trips):
    df = trips((1, at(1), math.nan), (2, None, None))
    got = {r.column_name: r.nulls for r in explore.missing_values(df).collect()}
    assert (got["trip_miles"], got["pickup_datetime"], got["trip_id"], got["trip_time"]) == (1, 1, 0, 2)


def test_overview_counts_each_file_once(spark, raw_dir):
    overview = explore.dataset_overview(spark.read.parquet(str(raw_dir))).first()
    size = sum(f.stat().st_size for f in raw_dir.glob("*.parquet"))
    assert (overview.column_count, overview.row_count, overview.file_count) == (7, 400, 4)
    assert overview.size_gb == pytest.approx(size / 1024**3)
    assert overview.partition_count == spark.read.parquet(str(raw_dir)).rdd.getNumPartitions()


def test_overview_of_a_file_split_over_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(200_000).select(F.col("id"), F.rand(1).alias("x")).coalesce(1).write.option(
        "parquet.block.size", 200_000
    ).parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        overview = explore.dataset_overview(spark.read.parquet(path)).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert overview.file_count == 1 and overview.partition_count > 1 and overview.row_count == 200_000
