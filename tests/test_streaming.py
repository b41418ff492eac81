from __future__ import annotations

import time
from datetime import datetime, timedelta, timezone

import pytest
from helpers import put_file, rows_of

from pyspark.sql import functions as F

from tidemark.plans import bronze
from tidemark.plans.bronze import read_bronze
from tidemark.schema import BRONZE_SCHEMA, TRIP_SCHEMA
from tidemark.sources.feeds import directory_feed, read_feed
from tidemark.streaming import jobs

AT = datetime(2024, 6, 1, tzinfo=timezone.utc)


@pytest.fixture
def feed(spark, raw_dir):
    return directory_feed(spark, str(raw_dir))


@pytest.fixture
def stream(spark, feed, raw_dir):
    """The raw folder as a stream; one file per trigger unless told otherwise."""
    return lambda files=1: jobs.read_stream(spark, feed.at(str(raw_dir)), files)


def test_stream_equals_batch_and_takes_new_files_only(spark, feed, stream, raw_dir, trips, tmp_path):
    target, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        return jobs.run_to_files(jobs.bronze(stream(), ingested_at=AT), target, progress, "pickup_month")

    run()
    want = rows_of(bronze.transform(read_feed(spark, feed), ingested_at=AT).select(BRONZE_SCHEMA.fieldNames()))
    assert rows_of(read_bronze(spark, target).select(BRONZE_SCHEMA.fieldNames())) == want
    run()
    assert read_bronze(spark, target).count() == len(want)
    put_file(trips((999, datetime(2024, 3, 1), 1.0, 1)), raw_dir / "trips-5.parquet")
    run()
    assert read_bronze(spark, target).count() == len(want) + 1


@pytest.mark.parametrize("files", [1, 100])
def test_closed_windows_equal_the_batch_counts(spark, feed, stream, tmp_path, files):
    target = str(tmp_path / "out")
    delay = timedelta(days=7)
    jobs.run_to_files(jobs.hourly_demand(stream(files), "7 days"), target, str(tmp_path / "progress"))
    rows = read_feed(spark, feed)
    last = rows.agg(F.max("pickup_datetime")).first()[0]
    twin = rows.groupBy(F.date_trunc("hour", "pickup_datetime").cast("timestamp_ntz").alias("window_start")).count()
    want = [(r[0], r[1]) for r in twin.collect() if r[0] + timedelta(hours=1) <= last - delay]
    got = spark.read.parquet(target).select("window_start", "trips")
    assert rows_of(got) == sorted(want, key=str)
    assert want


def test_rows_behind_the_watermark_are_counted_and_left_out(spark, raw_dir, trips, stream, tmp_path):
    late = [(900 + i, datetime(2024, 1, 1, 12), 1.0, 1) for i in range(5)]
    time.sleep(0.02)
    put_file(trips(*late), raw_dir / "trips-late.parquet")
    target = str(tmp_path / "out")
    query = jobs.run_to_files(jobs.hourly_demand(stream(), "7 days"), target, str(tmp_path / "progress"))
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped > 0
    noon = spark.read.parquet(target).filter(F.col("window_start") == F.lit(datetime(2024, 1, 1, 12)).cast("timestamp_ntz"))
    assert noon.agg(F.sum("trips")).first()[0] == 1


@pytest.mark.parametrize("two_steps", [False, True])
@pytest.mark.parametrize("files", [1, 100])
def test_copies_come_out_once(spark, feed, stream, tmp_path, two_steps, files):
    target = str(tmp_path / "out")
    delivered = stream(files).unionByName(stream(files)).unionByName(stream(files))
    once = jobs.dedup(delivered, ["trip_id"], "7 days", two_steps)
    jobs.run_to_files(once, target, str(tmp_path / "progress"))
    got = spark.read.schema(TRIP_SCHEMA).parquet(target)
    assert rows_of(got) == rows_of(read_feed(spark, feed).drop("source_file"))


def test_copies_in_a_later_batch_are_dropped(spark, stream, raw_dir, trips, tmp_path):
    """A copy delivered within the delay but in another trigger, and from another input partition."""
    target, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    once = jobs.dedup(stream(), ["trip_id"], "7 days")
    jobs.run_to_files(once, target, progress)
    time.sleep(0.02)
    copy = [(306, datetime(2024, 1, 28, 6), 6.0, 1, 9, "c0"), (777, datetime(2024, 1, 28, 6), 6.0, 1, 9, "c0")]
    put_file(trips(*copy), raw_dir / "trips-copy.parquet")
    jobs.run_to_files(jobs.dedup(stream(), ["trip_id"], "7 days"), target, progress)
    ids = [r.trip_id for r in spark.read.parquet(target).collect()]
    assert len(ids) == len(set(ids)) == 401 and 777 in ids


def test_a_replayed_batch_replaces_itself_and_another_stream_adds(spark, feed, stream, tmp_path):
    target, first = str(tmp_path / "out"), tmp_path / "first"
    want = rows_of(bronze.transform(read_feed(spark, feed), ingested_at=AT).select(BRONZE_SCHEMA.fieldNames()))

    def published(checkpoint):
        jobs.publish_partitions(jobs.bronze(stream(), ingested_at=AT), target, str(checkpoint))
        return rows_of(spark.read.schema(BRONZE_SCHEMA).parquet(target).select(BRONZE_SCHEMA.fieldNames()))

    assert published(first) == want
    assert published(first) == want
    last = max((first / "commits").glob("[0-9]*"), key=lambda file: int(file.name))
    for name in (last, last.with_name(f".{last.name}.crc")):  # as if the driver was lost before the commit
        name.unlink(missing_ok=True)
    assert published(first) == want
    assert published(tmp_path / "second") == sorted(want + want, key=str)
