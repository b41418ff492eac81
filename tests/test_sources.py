from __future__ import annotations

import os

from helpers import rows_of

from tidemark.functions.lineage import file_name, scanned_file
from tidemark.schema import TRIP_SCHEMA
from tidemark.sources import feeds, files


def names(df) -> list[str]:
    return sorted(r[0] for r in df.select(file_name("path")).collect())


def test_catalog_lists_the_top_level_parquet_files(spark, raw_dir):
    (raw_dir / "notes.txt").write_text("x")
    (raw_dir / "older").mkdir()
    (raw_dir / "older" / "trips-9.parquet").write_bytes((raw_dir / "trips-0.parquet").read_bytes())
    listed = {r.path.rsplit("/", 1)[-1]: r.bytes for r in files.catalog(spark, str(raw_dir)).collect()}
    expected = [f for f in os.listdir(raw_dir) if f.endswith(".parquet")]
    assert listed == {f: os.path.getsize(raw_dir / f) for f in expected}


def test_catalog_limit_keeps_the_first_names(spark, raw_dir):
    assert names(files.catalog(spark, str(raw_dir), 2)) == ["trips-0.parquet", "trips-1.parquet"]
    assert len(names(files.catalog(spark, str(raw_dir), 0))) == 4


def test_junk_is_skipped_and_reported(spark, raw_dir):
    (raw_dir / "trips-2b.parquet").write_bytes(b"junk")
    rows, report = files.tolerant_read(spark, files.catalog(spark, str(raw_dir)), TRIP_SCHEMA)
    assert rows.count() == 400
    got = {r.path.rsplit("/", 1)[-1]: (r.status, r.rows) for r in report.collect()}
    assert got.pop("trips-2b.parquet") == ("skipped", 0)
    assert got == {f"trips-{i}.parquet": ("ok", 100) for i in range(4)}


def test_only_junk_reads_as_no_rows(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"junk")
    rows, report = files.tolerant_read(spark, files.catalog(spark, str(tmp_path)), TRIP_SCHEMA)
    assert rows.count() == 0 and report.first().status == "skipped"


def test_new_files_are_those_not_in_the_log(spark, raw_dir):
    listing = files.catalog(spark, str(raw_dir))
    first_two = spark.read.schema(TRIP_SCHEMA).parquet(*files.catalog_paths(listing)[:2])
    assert names(files.new_files(listing, files.seen_files(first_two))) == ["trips-2.parquet", "trips-3.parquet"]
    everything = files.seen_files(spark.read.schema(TRIP_SCHEMA).parquet(str(raw_dir)))
    assert files.new_files(listing, everything).count() == 0


def test_unread_narrows_feeds(spark, raw_dir):
    feed = feeds.directory_feed(spark, str(raw_dir))
    log = files.seen_files(spark.read.schema(TRIP_SCHEMA).parquet(*feed.paths[:3]))
    (left,) = feeds.unread(spark, [feed], log)
    assert left.paths == feed.paths[3:]
    assert feeds.read_feed(spark, left).count() == 100


def test_feeds_with_one_shape_share_a_scan(spark, raw_dir):
    feed = feeds.directory_feed(spark, str(raw_dir))
    merged = feeds.read_feeds(spark, feed.per_path())
    assert "Union" not in merged._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(merged) == rows_of(feeds.read_feed(spark, feed))


def test_source_file_survives_a_shuffle(spark, raw_dir):
    scan = spark.read.schema(TRIP_SCHEMA).parquet(str(raw_dir)).withColumn("source_file", scanned_file())
    assert scan.repartition(3).select("source_file").distinct().count() == 4


def test_columns_beyond_the_trip_schema_pass_through(spark, data_dir):
    feed = feeds.table_feed(data_dir, "events")
    wider = feeds.Feed(feed.name, feed.paths, feed.schema, (*feed.binding, ("props", "props")))
    assert feeds.read_feed(spark, wider).columns[-1] == "props"
    both = feeds.read_feeds(spark, [wider, feeds.table_feed(data_dir, "orders")])
    assert both.filter("props is null").count() == spark.read.parquet(f"{data_dir}/orders.parquet").count()


def test_any_file_name_is_read_and_recognised(spark, raw_dir, tmp_path):
    source = (raw_dir / "trips-0.parquet").read_bytes()
    folder = tmp_path / "odd names"
    folder.mkdir()
    for name in ("trips 1", "50%", "a+b", "größe", "plain%20"):
        (folder / f"{name}.parquet").write_bytes(source)
    listing = files.catalog(spark, str(folder))
    rows, report = files.tolerant_read(spark, listing, TRIP_SCHEMA)
    assert rows.count() == 500 and {r.status for r in report.collect()} == {"ok"}
    seen = files.seen_files(spark.read.schema(TRIP_SCHEMA).parquet(str(folder)))
    assert files.new_files(listing, seen).count() == 0


def test_an_empty_file_is_ok_and_a_skipped_one_has_its_error(spark, tmp_path):
    empty = str(tmp_path / "in")
    spark.createDataFrame([], TRIP_SCHEMA).coalesce(1).write.parquet(empty)
    (tmp_path / "in" / "junk.parquet").write_bytes(b"junk")
    _, report = files.tolerant_read(spark, files.catalog(spark, empty), TRIP_SCHEMA)
    found = {r.status: (r.rows, r.error is None) for r in report.collect()}
    assert found["skipped"] == (0, False) and found.get("ok", (0, True)) == (0, True)
