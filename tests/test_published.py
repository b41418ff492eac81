from __future__ import annotations

import time
from datetime import datetime, timedelta, timezone

import pytest
from helpers import put_file, rows_of

from pyspark.sql import functions as F

from tidemark.plans.bronze import transform
from tidemark.plans.snapshots import ConcurrentChange, SnapshotTable
from tidemark.sources.feeds import directory_feed, read_feed
from tidemark.streaming import jobs, published

AT = datetime(2024, 6, 1, tzinfo=timezone.utc)


@pytest.fixture
def feed(spark, raw_dir):
    return directory_feed(spark, str(raw_dir))


@pytest.fixture
def stream(spark, feed, raw_dir):
    return lambda files=1: jobs.bronze(jobs.read_stream(spark, feed.at(str(raw_dir)), files, lineage=False), ingested_at=AT)


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "table"), ("pickup_month",))


def batch_rows(spark, feed):
    return rows_of(transform(read_feed(spark, feed).drop("source_file"), ingested_at=AT))


def forget_last_commit(progress):
    """As if the driver was lost after the batch was published and before the stream knew."""
    last = max((progress / "commits").glob("[0-9]*"), key=lambda file: int(file.name))
    for name in (last, last.with_name(f".{last.name}.crc")):
        name.unlink(missing_ok=True)


def test_folding_keeps_rows_and_a_repeated_batch_adds_nothing(spark, feed, stream, table, tmp_path):
    progress, want = tmp_path / "progress", batch_rows(spark, feed)
    published.publish(stream(), table, str(progress))
    assert rows_of(table.read()) == want
    assert max(map(len, table.current().folders.values())) == 4
    before = table.current()
    after = published.fold(table)
    assert [len(held) for held in after.folders.values()] == [1] and rows_of(table.read()) == want
    assert rows_of(table.read(before)) == want
    forget_last_commit(progress)
    published.publish(stream(), table, str(progress))
    assert rows_of(table.read()) == want
    assert published.fold(table).number == table.current().number  # nothing to fold, nothing written


def test_a_repeated_batch_before_a_fold_adds_nothing(spark, feed, stream, table, tmp_path):
    progress = tmp_path / "progress"
    published.publish(stream(), table, str(progress))
    forget_last_commit(progress)
    published.publish(stream(), table, str(progress))
    assert rows_of(table.read()) == batch_rows(spark, feed)
    published.publish(stream(), table, str(tmp_path / "another"))
    assert table.read().count() == 2 * len(batch_rows(spark, feed))


def test_rows_appended_while_folding_stay(spark, table, monkeypatch):
    frame = lambda *ids: spark.createDataFrame([(i, f"2024-0{i % 2 + 1}") for i in ids], "id long, pickup_month string")
    for ids in ((1, 2), (3, 4)):
        table.commit(frame(*ids), "append")
    stage = SnapshotTable.stage

    def slow(self, rows):
        monkeypatch.setattr(SnapshotTable, "stage", stage)
        staged = self.stage(rows)
        self.commit(frame(5, 6), "append")
        return staged

    monkeypatch.setattr(SnapshotTable, "stage", slow)
    found = published.fold(table)
    assert sorted(r.id for r in table.read().collect()) == [1, 2, 3, 4, 5, 6]
    assert {len(held) for held in found.folders.values()} == {2}


def test_a_fold_starts_again_when_its_partitions_were_replaced(spark, table, monkeypatch):
    frame = lambda *ids: spark.createDataFrame([(i, "2024-01") for i in ids], "id long, pickup_month string")
    for ids in ((1,), (2,)):
        table.commit(frame(*ids), "append")
    stage = SnapshotTable.stage

    def slow(self, rows):
        monkeypatch.setattr(SnapshotTable, "stage", stage)
        staged = self.stage(rows)
        self.commit(frame(7), "replace")
        return staged

    monkeypatch.setattr(SnapshotTable, "stage", slow)
    published.fold(table)
    assert [r.id for r in table.read().collect()] == [7]


def test_guarded_appends_refuse_partitions_changed_since(spark, table):
    frame = lambda i, month: spark.createDataFrame([(i, month)], "id long, pickup_month string")
    base = table.commit(frame(1, "a"), "append")
    table.commit(frame(2, "a"), "append")
    with pytest.raises(ConcurrentChange):
        table.commit(frame(3, "a"), "guarded", base=base)
    table.commit(frame(3, "b"), "guarded", base=base)
    assert table.read().count() == 3


def test_an_empty_table_is_not_folded(table):
    assert published.fold(table) is None


def test_copies_come_out_once_whatever_their_distance(spark, feed, stream, table, raw_dir, trips, tmp_path):
    progress = tmp_path / "progress"
    order = [F.col("trip_miles")]
    published.publish_once(stream(), table, str(progress), ["trip_id"], order)
    want = batch_rows(spark, feed)
    assert rows_of(table.read()) == want
    time.sleep(0.02)
    put_file(
        trips(
            (1, datetime(2024, 1, 2, 1), 1.0, 1, 1, "c1"),  # held since the first batch
            (777, datetime(2024, 1, 2, 1), 2.0, 1, 9, "c0"),
            (777, datetime(2024, 1, 2, 1), 1.0, 1, 9, "c0"),
            (None, datetime(2024, 1, 2, 1), 3.0, 1, 9, "c0"),
            (None, datetime(2024, 1, 2, 1), 4.0, 1, 9, "c0"),
        ),
        raw_dir / "trips-copies.parquet",
    )
    for _ in range(2):
        published.publish_once(stream(), table, str(progress), ["trip_id"], order)
        rows = table.read().collect()
        assert len(rows) == len(want) + 2
        assert [r.trip_miles for r in rows if r.trip_id == 777] == [1.0]
        assert [r.trip_miles for r in rows if r.trip_id is None] == [3.0]
        forget_last_commit(progress)


def test_windows_with_late_rows_equal_the_batch(spark, feed, raw_dir, trips, tmp_path):
    late = [(900 + i, datetime(2024, 1, 1, 12), 1.0, 1) for i in range(5)]
    time.sleep(0.02)
    put_file(trips(*late, (999, None, 1.0, 1)), raw_dir / "trips-late.parquet")
    demand = published.WindowedDemand.at(spark, str(tmp_path / "demand"))
    progress = tmp_path / "progress"

    def run():
        rows = jobs.read_stream(spark, feed.at(str(raw_dir)), 1, lineage=False)
        demand.run(rows, str(progress), timedelta(days=7))
        return {r.window_start: (r.trips, r.late_trips) for r in demand.windows().collect()}

    got = run()
    whole = read_feed(spark, directory_feed(spark, str(raw_dir))).filter("pickup_datetime IS NOT NULL")
    hour = F.date_trunc("hour", "pickup_datetime").cast("timestamp_ntz").alias("h")
    want = {r.h: r["count"] for r in whole.groupBy(hour).count().collect()}
    assert {k: trips for k, (trips, _) in got.items()} == want
    assert got[datetime(2024, 1, 1, 12)] == (want[datetime(2024, 1, 1, 12)], 5)
    assert sum(n for _, n in got.values()) == 5
    assert sorted(r.trip_id for r in demand.late_rows.read().collect()) == [900, 901, 902, 903, 904]
    last = whole.agg(F.max("pickup_datetime")).first()[0]
    assert demand.watermark() == last - timedelta(days=7)
    closed = {r.window_start for r in demand.windows(closed_only=True).collect()}
    assert closed == {h for h in want if h + timedelta(hours=1) <= last - timedelta(days=7)}
    forget_last_commit(progress)
    assert run() == got
    demand.fold()
    assert {r.window_start: (r.trips, r.late_trips) for r in demand.windows().collect()} == got
    forget_last_commit(progress)
    assert run() == got and demand.watermark() == last - timedelta(days=7)


def test_a_batch_lost_between_late_rows_and_counts_is_completed(spark, trips, tmp_path, monkeypatch):
    demand = published.WindowedDemand.at(spark, str(tmp_path / "demand"))
    hour = timedelta(hours=1)
    demand.add(trips((1, datetime(2024, 1, 3), 1.0, 1)), "s", 0, hour)
    second = trips((2, datetime(2024, 1, 1), 1.0, 1))
    commit = SnapshotTable.commit

    def lost(self, *arguments, **named):
        if self.root.endswith("counts"):
            raise RuntimeError("lost")
        return commit(self, *arguments, **named)

    monkeypatch.setattr(SnapshotTable, "commit", lost)
    with pytest.raises(RuntimeError):
        demand.add(second, "s", 1, hour)
    monkeypatch.setattr(SnapshotTable, "commit", commit)
    for _ in range(2):
        demand.add(second, "s", 1, hour)
    assert demand.late_rows.read().count() == 1
    assert sorted((r.trips, r.late_trips) for r in demand.windows().collect()) == [(1, 0), (1, 1)]


def test_an_empty_batch_counts_nothing(spark, trips, tmp_path):
    demand = published.WindowedDemand.at(spark, str(tmp_path / "demand"))
    demand.add(trips().limit(0), "s", 0, timedelta(hours=1))
    demand.add(trips((1, datetime(2024, 1, 3), 1.0, 1)), "s", 1, timedelta(hours=1))
    assert [(r.trips, r.late_trips) for r in demand.windows().collect()] == [(1, 0)]
