from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

import pytest
from helpers import put_file, rows_of

from pyspark.sql import functions as F

from tidemark.plans import bronze, gold, incremental, layers
from tidemark.plans.bronze import FILE_LOOP, IngestOptions, ingest, ingest_with_fallback, read_bronze
from tidemark.plans.sinks import WriteOptions, read_table, write_csv_by, write_table
from tidemark.sources.feeds import directory_feed, directory_feeds, table_feed

AT = datetime(2024, 6, 1, tzinfo=timezone.utc)
OPTIONS = IngestOptions(ingested_at=AT, write=WriteOptions(refresh="table"))


@pytest.fixture
def feed(spark, raw_dir):
    return directory_feed(spark, str(raw_dir))


def test_no_input_writes_nothing(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    feed = directory_feed(spark, str(tmp_path / "raw"))
    assert ingest(spark, [feed], str(tmp_path / "out"), OPTIONS).count() == 0
    assert not (tmp_path / "out").exists()


def test_unknown_mode_and_refresh_are_errors(spark, feed, tmp_path):
    with pytest.raises(ValueError, match="unknown mode"):
        ingest(spark, [feed], str(tmp_path / "out"), replace(OPTIONS, mode="half_batch"))
    with pytest.raises(ValueError, match="unknown refresh"):
        WriteOptions(refresh="rows")


def test_file_loop_equals_full_batch_and_can_be_repeated(spark, feed, tmp_path):
    loop, batch = str(tmp_path / "loop"), str(tmp_path / "batch")
    ingest(spark, [feed], batch, OPTIONS)
    want = rows_of(read_bronze(spark, batch))
    assert len(want) == spark.read.parquet(*feed.paths).filter("trip_miles > 0 and trip_time > 0").count()
    for _ in range(2):
        ingest(spark, [feed], loop, replace(OPTIONS, mode=FILE_LOOP, write=WriteOptions()))
        assert rows_of(read_bronze(spark, loop)) == want


def test_rows_carry_their_file_and_ingestion_time(spark, feed, tmp_path):
    ingest(spark, [feed], str(tmp_path / "out"), OPTIONS)
    out = read_bronze(spark, str(tmp_path / "out"))
    assert {r.source_file.rsplit("/", 1)[-1] for r in out.select("source_file").distinct().collect()} == {
        f"trips-{i}.parquet" for i in range(4)
    }
    assert [r[0] for r in out.select(F.unix_timestamp("ingestion_timestamp")).distinct().collect()] == [int(AT.timestamp())]


def test_run_metrics(spark, feed, tmp_path):
    counted = replace(OPTIONS, mode=FILE_LOOP, count_rows=True)
    metrics = ingest(spark, [feed], str(tmp_path / "out"), counted).collect()
    exact = bronze.file_metrics(spark.read.parquet(*feed.paths).withColumn("source_file", F.col("_metadata.file_name")))
    want = {r.source_file: (r.rows_in, r.rows_kept) for r in exact.collect()}
    assert {m.source: (m.rows_in, m.rows_out) for m in metrics} == want
    assert {(m.status, m.mode, m.files) for m in metrics} == {("ok", FILE_LOOP, 1)}
    whole = ingest(spark, [feed], str(tmp_path / "all"), OPTIONS).first()
    assert (whole.source, whole.files, whole.rows_in) == ("ALL_FILES", 4, None)
    assert whole.rows_out == sum(kept for _, kept in want.values())


def test_rows_read_come_from_footers_and_filters_stay_in_the_scan(spark, feed):
    plan = bronze.rows_read(spark, [feed])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<>" in plan
    assert bronze.rows_read(spark, [feed]).first().n == spark.read.parquet(*feed.paths).count()


def test_one_bad_file_does_not_stop_the_others(spark, raw_dir, tmp_path):
    (raw_dir / "trips-0.parquet").write_bytes(b"junk")
    feed = directory_feed(spark, str(raw_dir))
    target = str(tmp_path / "out")
    with pytest.raises(Exception):
        ingest(spark, [feed], target, replace(OPTIONS, mode=FILE_LOOP))
    metrics = ingest(spark, [feed], target, replace(OPTIONS, mode=FILE_LOOP, keep_going=True)).collect()
    assert [m.status for m in metrics] == ["failed", "ok", "ok", "ok"]
    assert metrics[0].error and metrics[0].rows_out is None
    assert read_bronze(spark, target).count() == sum(m.rows_out for m in metrics[1:])


def test_fallback_rebuilds_what_the_loop_left(spark, feed, tmp_path):
    def fail_on_second(source):
        if source.name == "trips-1.parquet":
            raise OSError("gone")

    target, batch = str(tmp_path / "out"), str(tmp_path / "batch")
    metrics = ingest_with_fallback(spark, [feed], target, replace(OPTIONS, before_source=fail_on_second))
    assert [(m.mode, m.status) for m in metrics.collect()] == [("file_loop", "failed"), ("full_batch", "ok")]
    ingest(spark, [feed], batch, OPTIONS)
    assert rows_of(read_bronze(spark, target)) == rows_of(read_bronze(spark, batch))


def test_fallback_is_not_used_when_the_loop_works(spark, feed, tmp_path):
    metrics = ingest_with_fallback(spark, [feed], str(tmp_path / "out"), OPTIONS)
    assert {(m.mode, m.status) for m in metrics.collect()} == {("file_loop", "ok")}


def test_refreshing_partitions_keeps_other_months(spark, trips, tmp_path):
    target = str(tmp_path / "out")
    january = bronze.derive(trips((1, datetime(2024, 1, 31, 23, 59, 59, 999999), 1.0, 1)).selectExpr("*", "'a' as source_file"), AT)
    february = bronze.derive(trips((2, datetime(2024, 2, 1), 1.0, 1)).selectExpr("*", "'a' as source_file"), AT)
    write_table(january.unionByName(february), target)
    write_table(february.withColumn("trip_id", F.lit(3).cast("long")), target)
    assert {(r.trip_id, r.pickup_month) for r in read_bronze(spark, target).collect()} == {(1, "2024-01"), (3, "2024-02")}
    write_table(february, target, WriteOptions(refresh="table"))
    assert [r.trip_id for r in read_bronze(spark, target).collect()] == [2]


@pytest.mark.parametrize("codec", ["none", "snappy", "zstd"])
@pytest.mark.parametrize("layout", [{}, {"rebalance": True}, {"coalesce_n": 2}])
def test_layouts_keep_all_rows_and_the_cap(spark, trips, tmp_path, codec, layout):
    target = str(tmp_path / "out")
    rows = trips(*[(i, datetime(2024, 1 + i % 3, 1), 1.0, 1) for i in range(1000)]).selectExpr("*", "'a' as source_file")
    options = WriteOptions(refresh="table", compression=codec, max_records_per_file=50, **layout)
    write_table(bronze.derive(rows, AT), target, options)
    sizes = read_bronze(spark, target).groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(r["count"] for r in sizes) == 1000
    assert max(r["count"] for r in sizes) <= 50


def test_a_month_holding_most_rows_is_spread_over_files(spark, tmp_path):
    """The layout shuffle splits a hot partition value instead of giving it to one task."""
    rows = spark.range(0, 400_000, 1, 16).select(
        "id", F.rand(3).alias("x"), F.when(F.col("id") % 4 > 0, "2024-01").otherwise("2024-02").alias("pickup_month")
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256KB")
    try:
        write_table(rows, str(tmp_path / "out"), WriteOptions(refresh="table", rebalance=True))
    finally:
        spark.conf.set(key, before)
    written = spark.read.parquet(str(tmp_path / "out"))
    files = written.filter("pickup_month = '2024-01'").groupBy(F.col("_metadata.file_path")).count().collect()
    assert written.count() == 400_000
    assert len(files) > 3 and max(r["count"] for r in files) < 200_000


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1, None), ("c", 2, 'say "x"')], "mode string, n int, note string")
    write_csv_by(df, str(tmp_path / "csv"), "mode")
    back = spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "csv"))
    assert rows_of(back.select(df.columns)) == rows_of(df)


def test_gold_refresh_replaces_only_touched_months(spark, trips, tmp_path):
    def layer(*rows):
        return bronze.derive(trips(*rows).selectExpr("*", "'a' as source_file"), AT)

    table, target = str(tmp_path / "bronze"), str(tmp_path / "gold")
    write_table(layer((1, datetime(2024, 1, 1), 1.0, 1, 7), (2, datetime(2024, 2, 1), 1.0, 1, 8)), table)
    gold.refresh_location_month(read_bronze(spark, table), target)
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "gold" / "pickup_month=2024-01").iterdir()}
    late = layer((3, datetime(2024, 2, 2), 1.0, 1, 9), (4, datetime(2024, 2, 2), 1.0, 1, 9), (5, None, 1.0, 1, 9))
    write_table(late, table, mode="append")
    gold.refresh_location_month(read_bronze(spark, table), target, gold.touched_months(late))
    got = gold.read_location_month(spark, target)
    assert rows_of(got) == rows_of(gold.location_month(read_bronze(spark, table)).select(got.columns))
    assert untouched == {f: f.stat().st_mtime_ns for f in (tmp_path / "gold" / "pickup_month=2024-01").iterdir()}


def test_layers(spark, feed, tmp_path):
    done = layers.run_layers(spark, [feed], str(tmp_path / "lake"), OPTIONS)
    kept = read_bronze(spark, done.bronze).count()
    clean = layers.read_silver(spark, done.silver)
    assert done.metrics.first().rows_out == kept == clean.count()
    assert {"pickup_hour", "speed_mph"} <= set(clean.columns)
    assert spark.read.parquet(done.gold_daily_company).agg(F.sum("trips")).first()[0] == kept
    assert spark.read.parquet(done.gold_hour_weekday).agg(F.sum("trips")).first()[0] == kept
    assert gold.read_location_month(spark, done.gold_location_month).count() == 3


@pytest.mark.parametrize("mode", ["full_batch", FILE_LOOP])
def test_columns_beyond_the_trip_schema_reach_silver(spark, data_dir, tmp_path, mode):
    events = table_feed(data_dir, "events")
    wider = replace(events, binding=(*events.binding, ("props", "props")))
    feeds = [table_feed(data_dir, "orders"), wider]
    done = layers.run_layers(spark, feeds, str(tmp_path / "lake"), replace(OPTIONS, mode=mode))
    schema = bronze.bronze_schema(spark, feeds)
    kept = read_bronze(spark, done.bronze, schema).filter("props is not null").count()
    assert kept == spark.read.parquet(events.paths[0]).filter("get_json_object(props, '$.k') > 0").count()
    assert spark.read.parquet(done.silver).select("pickup_month", "speed_mph").schema["pickup_month"].dataType.simpleString() == "string"
    assert layers.read_silver(spark, done.silver).count() == read_bronze(spark, done.bronze).count()


def test_silver_keeps_the_newest_copy_of_a_trip(spark, trips, tmp_path):
    from tidemark.plans import silver

    seen = trips((1, datetime(2024, 1, 1), 1.0, 60, 1, " a "), (1, datetime(2024, 1, 1), 2.0, 60, 1, "A"), (2, datetime(2024, 1, 1), float("nan"), 60, 1, "A"))
    raw = seen.selectExpr("*", "'f' as source_file")
    first = bronze.derive(raw.filter("trip_miles = 1"), AT)
    again = bronze.derive(raw.filter("trip_miles <> 1"), AT.replace(month=7))
    (row,) = silver.silver(first.unionByName(again)).collect()
    assert (row.trip_id, row.trip_miles, row.hvfhs_license_num, row.speed_mph) == (1, 2.0, "A", 120.0)


def test_raw_files_of_one_directory_limit(spark, raw_dir, trips):
    put_file(trips((999, datetime(2024, 3, 1), 1.0, 1)), raw_dir / "a-first.parquet")
    assert [p.rsplit("/", 1)[-1] for p in directory_feed(spark, str(raw_dir), file_limit=2).paths] == [
        "a-first.parquet",
        "trips-0.parquet",
    ]


def test_a_failed_rebuild_leaves_the_old_table(spark, feed, tmp_path):
    target = str(tmp_path / "table")
    whole = replace(OPTIONS, write=replace(OPTIONS.write, refresh="table"))
    ingest(spark, [feed], target, whole)
    before = read_bronze(spark, target).count()
    junk = tmp_path / "junk.parquet"
    junk.write_bytes(b"junk")
    bad = replace(feed, paths=(*feed.paths, str(junk)))
    with pytest.raises(Exception):
        ingest(spark, [bad], target, whole)
    assert before > 0 and read_bronze(spark, target).count() == before
    ingest(spark, [feed], target, whole)
    assert read_bronze(spark, target).count() == before


def test_a_second_run_adds_its_files_and_keeps_the_rows_of_others(spark, trips, tmp_path):
    """20 rows of January, then a file with 5 of February and 1 of January: 26 rows in both modes."""
    put_file(trips(*[(i, datetime(2024, 1, 2), 1.0, 60) for i in range(20)]), tmp_path / "a.parquet")
    put_file(
        trips(*[(20 + i, datetime(2024, 2, 1), 1.0, 60) for i in range(5)], (25, datetime(2024, 1, 31), 1.0, 60)),
        tmp_path / "b.parquet",
    )
    whole = directory_feed(spark, str(tmp_path))
    a, b = whole.per_path()
    for mode in (bronze.FULL_BATCH, FILE_LOOP):
        plain, logged, ledger = (str(tmp_path / f"{mode}-{name}") for name in ("plain", "logged", "ledger"))
        options = IngestOptions(mode=mode, ingested_at=AT)
        for feed in (a, b, b, whole):
            ingest(spark, [feed], plain, options)
        for feed in (a, whole):
            incremental.ingest_new(spark, [feed], logged, ledger, options)
        assert incremental.ingest_new(spark, [whole], logged, ledger, options).count() == 0
        for target in (plain, logged):
            assert sorted(r.trip_id for r in read_bronze(spark, target).collect()) == list(range(26))
        done = incremental.ingested_files(incremental.read_ledger(spark, ledger)).collect()
        assert {(r.path.rsplit("/", 1)[-1], r.rows, r.known) for r in done} == {
            ("a.parquet", 20, True),
            ("b.parquet", 6, True),
        }


def test_changed_and_interrupted_files_are_taken_once(spark, trips, tmp_path, monkeypatch):
    target, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    raw = tmp_path / "raw"
    raw.mkdir()
    put_file(trips(*[(i, datetime(2024, 1, 2), 1.0, 60) for i in range(3)]), raw / "a+ä 1.parquet")
    put_file(trips((9, datetime(2024, 3, 1), 1.0, 60)), raw / "b.parquet")
    feed = directory_feed(spark, str(raw))
    options = IngestOptions(ingested_at=AT)
    record = incremental._record

    def lost(files, ledger, run_id, state):
        if state == incremental.DONE:
            raise RuntimeError("driver lost")
        record(files, ledger, run_id, state)

    monkeypatch.setattr(incremental, "_record", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        incremental.ingest_new(spark, [feed], target, ledger, options)
    monkeypatch.setattr(incremental, "_record", record)
    incremental.ingest_new(spark, [feed], target, ledger, options)
    assert sorted(r.trip_id for r in read_bronze(spark, target).collect()) == [0, 1, 2, 9]
    put_file(trips((7, datetime(2024, 2, 2), 1.0, 60)), raw / "a+ä 1.parquet")
    spark.catalog.refreshByPath(str(raw))
    incremental.ingest_new(spark, [feed], target, ledger, options)
    rows = spark.read.schema(bronze.BRONZE_SCHEMA).parquet(target)
    assert {(r.trip_id, r.pickup_month) for r in rows.collect()} == {(7, "2024-02"), (9, "2024-03")}
    assert not (tmp_path / "table" / "pickup_month=2024-01").exists()


def test_tolerant_ingest_reports_and_skips_junk_in_both_modes(spark, raw_dir, tmp_path):
    (raw_dir / "trips-0.parquet").write_bytes(b"junk")
    feed = directory_feed(spark, str(raw_dir))
    for mode in (bronze.FULL_BATCH, FILE_LOOP):
        metrics = ingest(spark, [feed], str(tmp_path / mode), replace(OPTIONS, mode=mode, tolerant=True)).collect()
        assert (metrics[0].source, metrics[0].status) == ("trips-0.parquet", "skipped") and metrics[0].error
        assert {m.status for m in metrics[1:]} == {"ok"}
        assert read_bronze(spark, str(tmp_path / mode)).count() == sum(m.rows_out for m in metrics[1:]) > 0


def test_files_of_different_types_and_more_columns(spark, trips, tmp_path):
    base = trips(*[(i, datetime(2024, 1, 2), 1.0, 60) for i in range(3)])
    put_file(base.drop("trip_id"), tmp_path / "1.parquet")
    put_file(base.selectExpr("* except (trip_time)", "cast(trip_time as long) trip_time", "'x' as flag"), tmp_path / "2.parquet")
    put_file(base.selectExpr("* except (trip_time)", "cast(trip_time as double) trip_time", "1 as flag"), tmp_path / "3.parquet")
    found = directory_feeds(spark, str(tmp_path))
    for mode in (bronze.FULL_BATCH, FILE_LOOP):
        ingest(spark, found, str(tmp_path / mode), replace(OPTIONS, mode=mode, write=WriteOptions()))
        rows = read_table(spark, str(tmp_path / mode), "pickup_month") if mode == bronze.FULL_BATCH else None
        count = read_bronze(spark, str(tmp_path / mode)).count()
        assert count == 9
        if rows is not None:
            assert sorted(str(r.flag) for r in rows.collect()) == ["1"] * 3 + ["None"] * 3 + ["x"] * 3
            assert rows.filter("trip_id IS NULL").count() == 3


def test_few_files_for_each_month_come_from_many_tasks(spark, trips, tmp_path):
    """``coalesce_n`` bounds the files of a partition, not the tasks: no task holds the whole table."""
    rows = bronze.transform(trips(*[(i, datetime(2024, 1 + i % 12, 1 + i % 28), 1.0, 5, i % 7, "c") for i in range(600)]))
    for most in (1, 3):
        target = tmp_path / f"bronze-{most}"
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the table were large
        write_table(rows.repartition(4), str(target), WriteOptions(coalesce_n=most, refresh="table"))
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        months = {folder.name: [f.name for f in folder.glob("*.parquet")] for folder in target.glob("pickup_month=*")}
        assert len(months) == 12 and max(len(names) for names in months.values()) <= most
        assert len({name.split("-")[1] for names in months.values() for name in names}) > 1
        assert spark.read.parquet(str(target)).count() == 600
