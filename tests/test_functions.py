from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.functions.lineage import feed_name, file_name
from tidemark.functions.measures import hash_fraction, speed_mph
from tidemark.functions.temporal import calendar_features, pickup_month


def test_speed_is_null_without_duration(trips):
    noon = datetime(2024, 1, 1, 12)
    df = trips((1, noon, 3.0, 0), (2, noon, 3.0, None), (3, noon, 3.0, 60))
    speeds = {r.trip_id: r.s for r in df.select("trip_id", speed_mph("trip_miles", "trip_time").alias("s")).collect()}
    assert speeds == {1: None, 2: None, 3: 180.0}


def test_calendar_at_month_edges(trips):
    df = trips(
        (1, datetime(2024, 1, 31, 23, 59, 59, 999999)), (2, datetime(2024, 2, 1)), (3, datetime(2024, 2, 29, 5)), (4, None)
    )
    got = df.withColumns({**calendar_features("pickup_datetime"), "pickup_month": pickup_month("pickup_datetime")})
    columns = ["pickup_hour", "pickup_dayofweek", "pickup_month_num", "pickup_date", "pickup_month"]
    assert [tuple(r) for r in got.orderBy("trip_id").select(columns).collect()] == [
        (23, 4, 1, date(2024, 1, 31), "2024-01"),
        (0, 5, 2, date(2024, 2, 1), "2024-02"),
        (5, 5, 2, date(2024, 2, 29), "2024-02"),
        (None, None, None, None, None),
    ]


def test_names_of_files_and_feeds(spark):
    paths = spark.createDataFrame([("s3://b/x/t.parquet",), ("s3://b/t.parquet/part-0.snappy.parquet",)], "p string")
    got = [tuple(r) for r in paths.select(file_name("p"), feed_name("p")).collect()]
    assert got == [("t.parquet", "t.parquet"), ("part-0.snappy.parquet", "t.parquet")]


def test_hash_fraction_is_spread_over_the_unit_interval(spark):
    stats = spark.range(20_000).select(hash_fraction("id").alias("h")).agg(F.min("h"), F.max("h"), F.avg("h")).first()
    assert 0 <= stats[0] < 0.01 and 0.99 < stats[1] < 1 and abs(stats[2] - 0.5) < 0.01
