"""Silver and gold kept up to date equal silver and gold built anew."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

import pytest
from helpers import put_file, rows_of
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import gold, gold_deltas, layers, silver
from tidemark.plans.bronze import IngestOptions, transform
from tidemark.plans.gold_deltas import GoldTables, file_changes, signed
from tidemark.plans.silver_upsert import silver_table, upsert
from tidemark.plans.sinks import WriteOptions
from tidemark.sources.feeds import directory_feeds

T0 = datetime(2024, 5, 1)


@pytest.fixture
def delivery(trips):
    def build(day: int, *rows, source="f1"):
        """(id, month, miles) rows, delivered on a day."""
        made = trips(*[(i, datetime(2024, month, 1 + (i or 0) % 20, (i or 0) % 24) if month else None, miles, 60, (i or 0) % 3, " ab ") for i, month, miles in rows])
        return transform(made.withColumn("source_file", F.lit(source)), ingested_at=T0 + timedelta(days=day))

    return build


def shown(rows: DataFrame) -> list[tuple]:
    return rows_of(rows.drop("key_bucket").select(*sorted(c for c in rows.columns if c != "key_bucket")))


def test_upserts_equal_silver_over_all_deliveries(spark, tmp_path, delivery):
    table = silver_table(spark, str(tmp_path / "silver"))
    deliveries = [
        delivery(1, *[(i, 1 + i % 3, 1.0 + i) for i in range(60)], (None, 1, 2.0), (5, None, 3.0)),
        delivery(2, *[(i, 1 + i % 3, 100.0 + i) for i in range(40, 90, 7)], (None, 1, 2.0), (None, 1, 9.0)),
        delivery(0, *[(i, 1 + i % 3, 7.0) for i in range(50, 120)]),  # older than what is there
        delivery(2, *[(i, 1 + i % 3, 50.0) for i in range(40, 90, 7)]),  # as new, other values
        delivery(3, (1, 1, float("nan")), (2, 3, -1.0), (200, 7, 5.0), (200, 7, 5.0)),
    ]
    held = None
    for rows in deliveries:
        merge = upsert(table, rows, buckets=3)
        changes = merge.changes.drop("key_bucket")
        held = changes if held is None else held.unionByName(changes)
    wanted = silver.silver(reduce(DataFrame.unionByName, deliveries))
    assert shown(table.read()) == shown(wanted)
    columns = [c for c in held.columns if c != "sign"]
    summed = held.groupBy(*columns).agg(F.sum("sign").alias("n")).filter("n <> 0")
    assert shown(summed.drop("n")) == shown(wanted) and summed.filter("n <> 1").isEmpty()


def test_a_repeated_delivery_writes_nothing(spark, tmp_path, delivery):
    table = silver_table(spark, str(tmp_path / "silver"))
    rows = delivery(1, *[(i, 1 + i % 3, 1.0 + i) for i in range(30)], (None, 1, 2.0))
    first = upsert(table, rows)
    again = upsert(table, rows)
    assert again.written == [] and again.snapshot.number == first.snapshot.number and again.changes.isEmpty()
    older = upsert(table, delivery(0, *[(i, 1 + i % 3, 5.0) for i in range(30)]))
    assert older.written == []


def test_only_changed_buckets_are_read_and_written(spark, tmp_path, delivery, monkeypatch):
    table = silver_table(spark, str(tmp_path / "silver"))
    upsert(table, delivery(1, *[(i, 1 + i % 6, 1.0) for i in range(300)]), buckets=8)
    before = table.current()
    read, asked = type(table).read, []

    def watched(self, at=None, only=None):
        found = read(self, at, only)
        asked.append((only, found))
        return found

    monkeypatch.setattr(type(table), "read", watched)
    merge = upsert(table, delivery(2, (7, 2, 9.0), (8, 3, 9.0)), buckets=8)
    assert len(merge.written) == 2 and {name.split("/")[0] for name in merge.written} == {"pickup_month=2024-02", "pickup_month=2024-03"}
    untouched = {name: folders for name, folders in before.folders.items() if name not in merge.written}
    assert untouched.items() <= merge.snapshot.folders.items()
    for only, found in asked:
        assert set(only) <= set(merge.written)
        assert all(any(f"/{name}/" in path for name in merge.written) for path in found.inputFiles())


def rebuilt(rows: DataFrame) -> list[list[tuple]]:
    daily = gold.daily_company(rows)
    return [
        rows_of(daily.withColumns({"total_miles": F.round("total_miles", 6), "mean_miles": F.round("mean_miles", 6)})),
        rows_of(gold.hour_weekday(rows)),
        rows_of(gold.location_month(rows).select("pickup_month", "PULocationID", "trips", "rank")),
    ]


def refreshed(tables: GoldTables) -> list[list[tuple]]:
    daily = tables.daily_company()
    return [
        rows_of(daily.withColumns({"total_miles": F.round("total_miles", 6), "mean_miles": F.round("mean_miles", 6)})),
        rows_of(tables.hour_weekday()),
        rows_of(tables.location_month()),
    ]


def test_gold_follows_files_that_come_change_and_go(spark, tmp_path, delivery):
    tables = GoldTables(spark, str(tmp_path / "gold"))
    one = delivery(1, *[(i, 1 + i % 3, 0.1 * (i + 1)) for i in range(50)], source="f1")
    two = delivery(1, *[(i, 3 + i % 2, 0.7) for i in range(50, 80)], (3, None, 1.0), source="f2")
    paths = lambda *names: spark.createDataFrame([(n,) for n in names], "path string")
    tables.apply("1", signed(one.unionByName(two), 1))
    assert refreshed(tables) == rebuilt(one.unionByName(two))

    changed = delivery(2, *[(i, 1, 5.5) for i in range(10)], source="f1")
    held = one.unionByName(two)
    written = tables.apply("2", file_changes(tables, held, paths("f1"), changed))
    assert written["daily_company"] == ["pickup_month=2024-01", "pickup_month=2024-02", "pickup_month=2024-03"]
    assert refreshed(tables) == rebuilt(changed.unionByName(two))

    written = tables.apply("3", file_changes(tables, changed.unionByName(two), paths("f1"), changed.limit(0)))
    assert written["location_month"] == ["pickup_month=2024-01"]
    assert refreshed(tables) == rebuilt(two)
    tables.apply("4", file_changes(tables, two, paths("f2"), two.limit(0)))
    assert refreshed(tables) == [[], [], []]


def test_a_repeated_batch_counts_once_after_any_failure(spark, tmp_path, delivery, monkeypatch):
    tables = GoldTables(spark, str(tmp_path / "gold"))
    one, two = delivery(1, *[(i, 1, 2.0) for i in range(20)]), delivery(2, *[(i, 2, 3.0) for i in range(20, 50)])
    tables.apply("1", signed(one, 1))
    tables.apply("1", signed(one, 1))
    assert refreshed(tables) == rebuilt(one)
    add = GoldTables._add
    for lost in gold_deltas.TOTALS:

        def fails(self, name, batch, deltas, lost=lost):
            if name == lost:
                raise OSError("lost")
            return add(self, name, batch, deltas)

        monkeypatch.setattr(GoldTables, "_add", fails)
        with pytest.raises(OSError):
            tables.apply("2", signed(two, 1))
    monkeypatch.setattr(GoldTables, "_add", add)
    tables.apply("2")
    assert refreshed(tables) == rebuilt(one.unionByName(two))
    with pytest.raises(ValueError):
        tables.apply("3")


def test_new_rows_are_scanned_once(spark, tmp_path, delivery):
    path = str(tmp_path / "rows")
    delivery(1, *[(i, 1, 2.0) for i in range(20)]).write.parquet(path)
    from tidemark.schema import TRIPS

    plan = gold_deltas._grouped(signed(spark.read.parquet(path), 1), TRIPS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "trip_time" not in plan


def test_a_stopped_run_is_finished_by_the_next(spark, tmp_path, raw_dir, monkeypatch):
    """The first run is lost after silver, before gold; new files arrive; the next run counts everything once."""
    root = str(tmp_path / "lake")
    options = IngestOptions(write=WriteOptions(), ingested_at=T0)
    files = sorted(raw_dir.glob("*.parquet"))
    apply = GoldTables.apply

    def lost(self, *arguments):
        raise OSError("lost")

    monkeypatch.setattr(GoldTables, "apply", lost)
    with pytest.raises(OSError):
        layers.refresh_layers(spark, directory_feeds(spark, [str(f) for f in files[:2]]), root, options, buckets=2)
    monkeypatch.setattr(GoldTables, "apply", apply)
    feeds = directory_feeds(spark, [str(f) for f in files])
    done = layers.refresh_layers(spark, feeds, root, options, buckets=2)
    idle = layers.refresh_layers(spark, feeds, root, options, buckets=2)
    assert idle.written == {} and done.written["silver"]
    assert refreshed(done.gold) == rebuilt(done.silver.read())
    assert done.silver.read().count() == sum(spark.read.parquet(str(f)).filter("trip_miles > 0 and trip_time > 0").count() for f in files)


def test_a_changed_file_renews_its_trips(spark, tmp_path, raw_dir):
    root = str(tmp_path / "lake")
    run = lambda day: layers.refresh_layers(
        spark, directory_feeds(spark, str(raw_dir)), root, IngestOptions(write=WriteOptions(), ingested_at=T0 + timedelta(days=day)), buckets=2
    )
    run(0)
    path = raw_dir / "trips-1.parquet"
    put_file(spark.read.parquet(str(path)).withColumn("trip_miles", F.col("trip_miles") * 3), path)
    done = run(1)
    assert refreshed(done.gold) == rebuilt(done.silver.read())
    assert done.silver.read().agg(F.max("trip_miles")).first()[0] == 24.0


def test_deltas_are_grouped_in_tasks_of_bounded_size(spark, tmp_path, delivery):
    """Rows are dealt out before they are grouped, so that no task groups all that a split of a file holds."""
    rows = signed(delivery(1, *[(i, 1 + i % 3, 1.0) for i in range(30)]), 1)
    plan = gold_deltas._grouped(rows, gold_deltas.TRIPS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RebalancePartitions")


def test_merged_rows_are_written_once(spark, tmp_path, delivery, monkeypatch):
    """What a commit publishes is what was staged; a first delivery is not written beside it."""
    from tidemark.plans import silver_upsert

    table, kept = silver_table(spark, str(tmp_path / "silver")), []
    plain = silver_upsert.materialise
    monkeypatch.setattr(silver_upsert, "materialise", lambda df, name: kept.append(name) or plain(df, name))
    first = upsert(table, delivery(1, *[(i, 1 + i % 3, 1.0) for i in range(30)]))
    assert kept == [] and first.changes.count() == 30
    second = upsert(table, delivery(2, *[(i, 1 + i % 3, 2.0) for i in range(20, 40)]))
    assert kept == ["delivery"] and second.changes.count() == 30 and table.read().count() == 40
