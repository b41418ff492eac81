"""Register of queries: one per operator, with the equivalent SQL where there is one."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import wraps

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracles import ORACLES
from tidemark.functions.lineage import feed_name, file_name
from tidemark.operators import dedup, explore, quality, runs
from tidemark.plans import bronze, gold, layers, silver
from tidemark.plans.bronze import FILE_LOOP, IngestOptions
from tidemark.plans.gold_deltas import GoldTables, file_changes, signed
from tidemark.plans.incremental import ingest_new
from tidemark.plans.silver_upsert import silver_table, upsert
from tidemark.plans.sinks import WriteOptions, write_csv_by, write_table
from tidemark.plans.snapshots import SnapshotTable
from tidemark.schema import BRONZE_SCHEMA, TRIP_SCHEMA, schema_issues, union_all
from tidemark.scratch import new_dir
from tidemark.sources import feeds, files
from tidemark.streaming import jobs, published

try:  # the subpackage for training text is optional
    from tidemark.llm.queries import ORACLES as TEXT_ORACLES
    from tidemark.llm.queries import QUERIES as TEXT_QUERIES
except ImportError:
    TEXT_QUERIES, TEXT_ORACLES = {}, {}
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
FEEDS = ("events", "orders", "lineitem")
FILE_CAP = 500
TEST_BUCKETS = 2  # a month of the test tables fits one file
INGESTED_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
MONTHLY = WriteOptions(refresh="table", rebalance=True)
QUALITY_RULES = {**quality.TRIP_RULES, "trip_miles_plausible": "trip_miles <= 100"}

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    """Register under the function's name; pin the zone in which NTZ times become event times."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    _QUERIES[function.__name__] = run
    return run


def _shown(df: DataFrame) -> DataFrame:
    """Bronze rows with comparable lineage: table name instead of a URI, zone-free time."""
    return df.withColumns(
        {
            "source_file": feed_name("source_file"),
            "ingestion_timestamp": F.col("ingestion_timestamp").cast("timestamp_ntz"),
        }
    )


def _all_feeds(sf_dir: str) -> list[feeds.Feed]:
    return [feeds.table_feed(sf_dir, table) for table in FEEDS]


def _trips(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return feeds.read_trips(spark, sf_dir, table)


def _options(**changes) -> IngestOptions:
    return IngestOptions(**{"write": MONTHLY, "ingested_at": INGESTED_AT, **changes})


def _run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as run results: kind = mode, hour and user = settings, value = seconds."""
    failed = F.col("event_type") == "error"
    return feeds.raw_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("processing_mode"),
        F.hour("ts").alias("shuffle_partitions"),
        F.col("user_id").alias("config_id"),
        F.when(failed, runs.STATUS_FAILED).otherwise(runs.STATUS_OK).alias("status"),
        F.col("value").alias("seconds"),
        F.get_json_object("props", "$.k").try_cast("int").alias("files_processed"),
        F.when(failed, F.concat(F.lit("run "), F.col("event_id"), F.lit(" failed"))).alias("error"),
        F.col("ts").alias("logged_at"),
    )


# --- sources ---------------------------------------------------------------------------------


@_query
def file_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two raw files by name, their bytes, and the rows a scan takes from each."""
    found = files.catalog(spark, [feeds.table_path(sf_dir, table) for table in FEEDS], limit=2)
    scans = [files.seen_files(feeds.raw_table(spark, sf_dir, table)) for table in FEEDS]
    rows = scans[0].unionByName(scans[1]).unionByName(scans[2])
    return found.join(rows, "path").select(
        file_name("path").alias("file_name"),
        (F.col("bytes") > 0).alias("has_bytes"),
        F.col("modificationTime").isNotNull().alias("has_time"),
        F.col("rows").alias("row_count"),
    )


@_query
def drifting_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered as three files: integer seconds, seconds as double and a new column, long seconds."""
    raw = new_dir(spark, "raw")
    trips = feeds.read_trips(spark, sf_dir, "events")
    shapes = {
        "1": trips,
        "2": trips.withColumns({"trip_time": F.col("trip_time").cast("double"), "tips": F.col("trip_miles") / 4}),
        "3": trips.withColumn("trip_time", F.col("trip_time").cast("long")),
    }
    for number, shape in shapes.items():
        part = shape.filter(F.col("trip_id") % 3 == int(number) - 1)
        part.write.parquet(f"{raw}/trips {number}.parquet")
    target = new_dir(spark, "bronze")
    found = feeds.directory_feeds(spark, [f"{raw}/trips {number}.parquet" for number in shapes])
    bronze.ingest(spark, found, target, _options())
    rows = spark.read.schema(bronze.bronze_schema(spark, found)).parquet(target)
    return _shown(rows).withColumn("source_file", F.replace("source_file", F.lit("%20"), F.lit(" ")))


@_query
def tolerant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events next to a file that is not Parquet: rows of the good one, a report on both."""
    broken = new_dir(spark, "raw") + "/broken.parquet"
    events = feeds.table_path(sf_dir, "events")
    spark.range(1).select(F.lit("not a parquet file").alias("value")).write.text(broken)
    found = files.catalog(spark, [events, broken], pattern="*")
    rows, report = files.tolerant_read(spark, found, feeds.EVENTS_SCHEMA)
    kept = (
        rows.filter("value > 0")
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("kept"))
    )
    return (
        report.join(kept, "path", "left")
        .groupBy(feed_name("path").alias("file_name"), "status")
        .agg(F.sum("rows").alias("rows_read"), F.sum(F.coalesce("kept", F.lit(0))).alias("rows_kept"))
    )


@_query
def dataset_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    overview = explore.dataset_overview(feeds.raw_table(spark, sf_dir, "lineitem"))
    return overview.select(
        "column_count",
        "row_count",
        "file_count",
        (F.col("partition_count") >= 1).alias("has_partitions"),
        (F.col("size_gb") > 0).alias("has_bytes"),
    )


@_query
def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and orders are in the ingestion log; only what is new is read."""
    scans = [feeds.raw_table(spark, sf_dir, table) for table in ("events", "orders")]
    ingested = files.seen_files(scans[0]).unionByName(files.seen_files(scans[1]))
    fresh = feeds.read_feeds(spark, feeds.unread(spark, _all_feeds(sf_dir), ingested))
    return _per_table(bronze.file_metrics(fresh))


@_query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables of different shape under one schema; columns they lack are NULL."""
    bound = [
        feeds.bind(feeds.raw_table(spark, sf_dir, table), tuple(feeds.BINDINGS[table].items())) for table in FEEDS
    ]
    return union_all(bound, TRIP_SCHEMA)


@_query
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders bound without casts, compared with the trip schema."""
    raw = feeds.raw_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("o_totalprice").alias("trip_miles"),
        F.col("o_orderpriority").alias("trip_time"),
        F.col("o_orderstatus").alias("hvfhs_license_num"),
        "o_custkey",
    )
    return schema_issues(raw, TRIP_SCHEMA)


# --- bronze ----------------------------------------------------------------------------------


@_query
def bronze_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(bronze.derive(feeds.read_trips(spark, sf_dir, "events", lineage=True), INGESTED_AT))


@_query
def bronze_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.read_trips(spark, sf_dir, "lineitem", lineage=True)
    return _shown(bronze.transform(rows, ingested_at=INGESTED_AT))


@_query
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "bronze")
    rows = bronze.transform(feeds.read_trips(spark, sf_dir, "lineitem", lineage=True), ingested_at=INGESTED_AT)
    write_table(rows, target, MONTHLY)
    return _shown(bronze.read_bronze(spark, target))


@_query
def bronze_full_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "bronze")
    bronze.ingest(spark, _all_feeds(sf_dir), target, _options())
    return _shown(bronze.read_bronze(spark, target))


@_query
def bronze_file_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "bronze")
    bronze.ingest(spark, _all_feeds(sf_dir), target, _options(mode=FILE_LOOP))
    return _shown(bronze.read_bronze(spark, target))


@_query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events first, then all feeds through the same ledger, then a run that finds nothing new."""
    target, ledger = new_dir(spark, "bronze"), new_dir(spark, "ledger")
    options = _options(write=WriteOptions(rebalance=True))
    everything = _all_feeds(sf_dir)
    for arrived in (everything[:1], everything, everything):
        ingest_new(spark, arrived, target, ledger, options)
    return _shown(bronze.read_bronze(spark, target))


@_query
def bronze_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file loop fails at its second source; the full batch takes over."""
    target = new_dir(spark, "bronze")

    def fail_on_orders(source: feeds.Feed) -> None:
        if source.name.startswith("orders"):
            raise OSError("source not available")

    bronze.ingest_with_fallback(spark, _all_feeds(sf_dir), target, _options(before_source=fail_on_orders))
    return _shown(bronze.read_bronze(spark, target))


@_query
def bronze_file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per month respect the row cap, a fixed one so small that months need several files."""
    rows = feeds.read_trips(spark, sf_dir, "lineitem")
    target = new_dir(spark, "bronze")
    capped = WriteOptions(refresh="table", rebalance=True, max_records_per_file=FILE_CAP)
    write_table(bronze.transform(rows, ingested_at=INGESTED_AT), target, capped)
    sizes = bronze.read_bronze(spark, target).groupBy(
        "pickup_month", F.col("_metadata.file_path").alias("path")
    ).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("pickup_month").agg(
        F.sum("n").alias("row_count"),
        F.count_if(F.col("n") > FILE_CAP).alias("files_over_cap"),
        (F.count(F.lit(1)) * F.lit(FILE_CAP) >= F.sum("n")).alias("enough_files"),
    )


@_query
def bronze_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per month, codec and files under other codecs and degrees of parallelism."""
    rows = bronze.transform(feeds.read_trips(spark, sf_dir, "orders"), ingested_at=INGESTED_AT)
    found = []
    for codec, tasks in (("zstd", 1), ("gzip", 2), ("none", 3)):
        target = new_dir(spark, "bronze")
        write_table(rows.repartition(4), target, WriteOptions(compression=codec, coalesce_n=tasks, refresh="table"))
        path = F.col("_metadata.file_path")
        seen = bronze.read_bronze(spark, target).groupBy("pickup_month", path.alias("path")).agg(F.count(F.lit(1)).alias("n"))
        suffix = F.regexp_extract("path", r"([a-z]*)[.]parquet$", 1)
        written = F.when(F.col("path").rlike(r"[.](zstd|gz)[.]parquet$"), suffix).otherwise("none")
        found.append(
            seen.groupBy(F.lit(codec).alias("asked"), written.alias("codec"), "pickup_month").agg(
                F.sum("n").alias("trips"), (F.count(F.lit(1)) <= tasks).alias("few_files")
            )
        )
    return found[0].unionByName(found[1]).unionByName(found[2])


@_query
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and written by each source of a run whose writes shuffle."""
    counted = _options(mode=FILE_LOOP, count_rows=True)
    metrics = bronze.ingest(spark, _all_feeds(sf_dir), new_dir(spark, "bronze"), counted)
    return metrics.select("source", "status", "files", "rows_in", "rows_out")


@_query
def month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "bronze")
    rows = bronze.transform(feeds.read_trips(spark, sf_dir, "orders", lineage=True), ingested_at=INGESTED_AT)
    write_table(rows, target, MONTHLY)
    return _shown(bronze.month_slice(bronze.read_bronze(spark, target), ["1997-01"]))


def _per_table(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(feed_name("source_file").alias("file_name")).agg(
        F.sum("rows_in").alias("rows_in"),
        F.sum("rows_kept").alias("rows_kept"),
        F.sum("rows_dropped").alias("rows_dropped"),
    )


@_query
def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_table(bronze.file_metrics(feeds.read_feeds(spark, _all_feeds(sf_dir))))


# --- quality ---------------------------------------------------------------------------------


@_query
def dq_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keep_valid(_trips(spark, sf_dir))


@_query
def dq_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = quality.tag(_trips(spark, sf_dir), QUALITY_RULES)
    return tagged.withColumn("failed_rules", F.array_join("failed_rules", ","))


@_query
def dq_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quality.rejected(_trips(spark, sf_dir), QUALITY_RULES)
    return rejected.withColumn("failed_rules", F.array_join("failed_rules", ","))


@_query
def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.metrics(_trips(spark, sf_dir), QUALITY_RULES).withColumn(
        "failure_rate", F.round("failure_rate", 9)
    )


@_query
def dq_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = quality.alerts(_trips(spark, sf_dir), QUALITY_RULES, max_failure_rate=0.05)
    return alerts.withColumn("failure_rate", F.round("failure_rate", 9))


@_query
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.read_feeds(spark, _all_feeds(sf_dir), lineage=False)
    layer_bronze = bronze.transform(raw, ingested_at=INGESTED_AT)
    layer_silver = silver.silver(layer_bronze)
    return quality.suite({"raw": raw, "bronze": layer_bronze, "silver": layer_silver}, QUALITY_RULES)


# --- analysis --------------------------------------------------------------------------------


@_query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.row_count(_trips(spark, sf_dir, "lineitem"))


@_query
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.missing_values(feeds.read_feeds(spark, _all_feeds(sf_dir), lineage=False))


@_query
def temporal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.temporal_features(_trips(spark, sf_dir))


@_query
def hourly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.hourly_demand(_trips(spark, sf_dir))


@_query
def top_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.top_by_volume(_trips(spark, sf_dir), "PULocationID")


@_query
def busiest_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.top_by_volume(_trips(spark, sf_dir, "lineitem"), "PULocationID", alias="trip_count")


@_query
def company_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.volume_by(_trips(spark, sf_dir), "hvfhs_license_num")


@_query
def distance_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.distance_histogram(_trips(spark, sf_dir), 0, 500)


@_query
def distance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.stable_sample(_trips(spark, sf_dir).select("trip_id", "trip_miles"), "trip_id", 0.01)


@_query
def fare_distance_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.fare_distance_corr(_trips(spark, sf_dir, "lineitem")).select(F.round("corr", 6).alias("corr"))


@_query
def fare_distance_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = explore.fare_distance_grid(_trips(spark, sf_dir, "lineitem"), 5, 10_000)
    return grid.withColumn("mean_fare", F.round("mean_fare", 4))


@_query
def trip_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.trip_speed(_trips(spark, sf_dir))


@_query
def speed_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.speed_anomalies(_trips(spark, sf_dir))


@_query
def longest_trips_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.longest_trips_per_day(_trips(spark, sf_dir))


@_query
def demand_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.demand_grid(_trips(spark, sf_dir))


# --- silver and gold -------------------------------------------------------------------------


@_query
def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.raw_table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return dedup.keep_first(lines, keys, [F.asc(c) for c in lines.columns if c not in keys])


@_query
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean(feeds.read_feeds(spark, _all_feeds(sf_dir), lineage=False))


@_query
def silver_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.features(quality.keep_valid(_trips(spark, sf_dir)))


@_query
def gold_daily_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = gold.daily_company(quality.keep_valid(_trips(spark, sf_dir)))
    return table.withColumns(
        {"total_miles": F.round("total_miles", 4), "mean_miles": F.round("mean_miles", 6)}
    )


@_query
def gold_hour_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hour_weekday(quality.keep_valid(_trips(spark, sf_dir)))


@_query
def gold_location_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.location_month(_trips(spark, sf_dir, "lineitem"))


@_query
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over events and lineitem; then orders arrive and only their months are rebuilt."""
    layer, target = new_dir(spark, "bronze"), new_dir(spark, "gold")
    early = [feed for feed in _all_feeds(sf_dir) if feed.name != "orders"]
    bronze.ingest(spark, early, layer, _options())
    gold.refresh_location_month(bronze.read_bronze(spark, layer), target)
    late = bronze.transform(feeds.read_trips(spark, sf_dir, "orders", lineage=True), ingested_at=INGESTED_AT)
    write_table(late, layer, MONTHLY, mode="append")
    gold.refresh_location_month(bronze.read_bronze(spark, layer), target, gold.touched_months(late))
    return gold.read_location_month(spark, target)


@_query
def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, then orders and lineitem added, then one month of orders replaced; every snapshot stays readable."""
    table = SnapshotTable(spark, new_dir(spark, "snapshots"), ("pickup_month",))
    layers_of = {t: bronze.transform(_trips(spark, sf_dir, t), ingested_at=INGESTED_AT) for t in FEEDS}
    first = table.commit(layers_of["events"])
    table.commit(layers_of["orders"].unionByName(layers_of["lineitem"]), "append")
    orders = layers_of["orders"].filter("pickup_month = '1997-01'")
    last = table.commit(orders.withColumn("trip_miles", F.col("trip_miles") * 2))
    table.stage(layers_of["events"])  # a writer lost before its commit: no reader sees this
    rows = {"first": table.read(first), "last": table.read(), "month": table.read(last, ["pickup_month=1997-01"])}
    totals = [
        found.groupBy(F.lit(name).alias("snapshot"), "pickup_month").agg(
            F.count(F.lit(1)).alias("trips"), F.round(F.sum("trip_miles"), 2).alias("miles")
        )
        for name, found in rows.items()
    ]
    return totals[0].unionByName(totals[1]).unionByName(totals[2])


def _deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Lineitem in two overlapping deliveries, the later one with other miles; then the first one once more."""
    trips = _trips(spark, sf_dir, "lineitem")
    first = bronze.transform(trips.filter("trip_id % 3 <> 0"), ingested_at=INGESTED_AT)
    revised = trips.filter("trip_id % 2 = 0").withColumn("trip_miles", F.col("trip_miles") + 1000)
    return [first, bronze.transform(revised, ingested_at=INGESTED_AT + timedelta(days=1)), first]


@_query
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of two overlapping deliveries: the newest copy of each trip."""
    table = silver_table(spark, new_dir(spark, "silver"))
    for delivery in _deliveries(spark, sf_dir):
        upsert(table, delivery, buckets=TEST_BUCKETS)
    rows = table.read().drop("key_bucket")
    return rows.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


def _gold_rows(tables: GoldTables) -> DataFrame:
    """The three gold tables, one below the other."""
    daily, hours, months = tables.daily_company(), tables.hour_weekday(), tables.location_month()
    text = lambda name: F.col(name).cast("string")
    none = F.lit(None).cast("double")
    shown = [
        daily.select(F.lit("daily_company"), text("pickup_date"), text("hvfhs_license_num"), "trips", F.round("total_miles", 4)),
        hours.select(F.lit("hour_weekday"), text("pickup_hour"), text("pickup_dayofweek"), "trips", none),
        months.select(F.lit("location_month"), text("pickup_month"), F.concat("rank", F.lit("-"), "PULocationID"), "trips", none),
    ]
    names = ["gold_table", "first_key", "second_key", "trips", "miles"]
    return shown[0].toDF(*names).union(shown[1].toDF(*names)).union(shown[2].toDF(*names))


@_query
def gold_delta_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold by signed deltas: events and orders come, lineitem is added, orders change, events are removed."""
    layer = {t: bronze.transform(feeds.read_trips(spark, sf_dir, t, lineage=True), ingested_at=INGESTED_AT) for t in FEEDS}
    tables = GoldTables(spark, new_dir(spark, "gold"))
    held = layer["events"].unionByName(layer["orders"])
    tables.apply("1-come", signed(held, 1))
    tables.apply("2-added", signed(layer["lineitem"], 1))
    tables.apply("2-added", signed(layer["lineitem"], 1))  # repeated by mistake: counts once
    changed = files.seen_files(feeds.raw_table(spark, sf_dir, "orders")).select("path")
    tables.apply("3-changed", file_changes(tables, held, changed, layer["orders"].filter("trip_id % 2 = 0")))
    removed = files.seen_files(feeds.raw_table(spark, sf_dir, "events")).select("path")
    tables.apply("4-removed", file_changes(tables, held, removed, layer["events"].limit(0)))
    return _gold_rows(tables)


@_query
def layers_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers after two incremental runs and one that finds nothing new: gold of silver of bronze."""
    root, everything = new_dir(spark, "layers"), _all_feeds(sf_dir)
    options = _options(write=WriteOptions(rebalance=True))
    for arrived in (everything[:1], everything, everything):
        refreshed = layers.refresh_layers(spark, arrived, root, options, buckets=TEST_BUCKETS)
    return _gold_rows(refreshed.gold)


# --- runs ------------------------------------------------------------------------------------


@_query
def best_run_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.best_run_per_group(_run_results(spark, sf_dir), "config_id")


@_query
def factor_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = ["processing_mode", "shuffle_partitions", "config_id"]
    table = runs.factor_marginals(_run_results(spark, sf_dir), factors)
    return table.withColumn("mean_seconds", F.round("mean_seconds", 6))


@_query
def success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = runs.success_rate(_run_results(spark, sf_dir), "config_id")
    return table.withColumn("success_rate", F.round("success_rate", 9))


@_query
def run_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    slow = runs.run_regressions(_run_results(spark, sf_dir), "processing_mode")
    shown = slow.select("run_id", "processing_mode", "seconds", "typical_seconds")
    return shown.withColumn("typical_seconds", F.round("typical_seconds", 6))


@_query
def run_metrics_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "runs")
    table = _run_results(spark, sf_dir).drop("logged_at")
    write_csv_by(table, target, "processing_mode")
    return spark.read.schema(table.schema).option("header", True).csv(target)


@_query
def audit_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("status") == runs.STATUS_FAILED
    file = F.concat(F.lit("file-"), F.col("files_processed"))
    module = F.concat(F.lit("mode_"), F.col("processing_mode"))
    fields = runs.audit_fields(
        "logged_at",
        level=F.when(failed, "ERROR").otherwise("INFO"),
        message=F.concat(F.lit("run "), F.col("status")),
        context={
            "job": F.col("processing_mode"),
            "layer": F.lit("bronze"),
            "run_id": F.col("run_id"),
            "file_name": F.when(F.col("files_processed") > 0, file),
            "exception": F.col("error"),
        },
        origin={
            "logger": F.concat(F.lit("jobs."), module),
            "module": module,
            "function": F.when(failed, "on_failure").otherwise("on_success"),
            "line": F.col("shuffle_partitions"),
        },
    )
    return runs.audit_json(_run_results(spark, sf_dir), fields)


# --- streams ---------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    """Events as a stream. The glob also matches a single file; a plain path must be a folder."""
    feed = feeds.table_feed(sf_dir, "events").at(f"{sf_dir}/events[.]parquet")
    return jobs.read_stream(spark, feed, lineage=lineage)


@_query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "stream")
    rows = jobs.bronze(_event_stream(spark, sf_dir), ingested_at=INGESTED_AT)
    jobs.run_to_files(rows, target, new_dir(spark, "progress"), "pickup_month")
    return _shown(bronze.read_bronze(spark, target))


@_query
def stream_hourly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "stream")
    windows = jobs.hourly_demand(_event_stream(spark, sf_dir, lineage=False), "1 hour")
    jobs.run_to_files(windows, target, new_dir(spark, "progress"))
    return spark.read.schema(windows.schema).parquet(target)


@_query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice comes out once."""
    target = new_dir(spark, "stream")
    first, again = (_event_stream(spark, sf_dir, lineage=False) for _ in range(2))
    once = jobs.dedup(first.unionByName(again), ["trip_id"], "1 hour")
    jobs.run_to_files(once, target, new_dir(spark, "progress"))
    return spark.read.schema(once.schema).parquet(target)


@_query
def stream_upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_dir(spark, "stream")
    rows = jobs.bronze(_event_stream(spark, sf_dir), ingested_at=INGESTED_AT)
    jobs.publish_partitions(rows, target, new_dir(spark, "progress"))
    return _shown(spark.read.schema(BRONZE_SCHEMA).parquet(target).drop("stream_id", "batch_id"))


def _arrivals(spark: SparkSession, sf_dir: str, wanted: list[str], run: Callable[[DataFrame], object]) -> None:
    """Events arrive in deliveries, each chosen by a predicate; after each one the stream takes what is new."""
    raw, trips = new_dir(spark, "arrivals"), _trips(spark, sf_dir)
    for number, rows in enumerate(wanted):
        trips.filter(rows).write.parquet(f"{raw}/delivery-{number}")
        feed = feeds.directory_feed(spark, raw).at(f"{raw}/*")
        run(jobs.read_stream(spark, feed, None, lineage=False))


THIRDS = ["trip_id % 3 = 0", "trip_id % 3 = 1", "trip_id % 3 = 2"]


@_query
def stream_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of a stream, published in one step each, then folded: the rows, and the folders of their month."""
    table = SnapshotTable(spark, new_dir(spark, "stream"), ("pickup_month",))
    progress = new_dir(spark, "progress")
    _arrivals(spark, sf_dir, THIRDS, lambda s: published.publish(jobs.bronze(s, ingested_at=INGESTED_AT), table, progress))
    folders = published.fold(table).folders
    rows = table.read().withColumn("folders", F.lit(max(len(held) for held in folders.values())))
    return rows.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


@_query
def stream_late_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of a stream whose later batches come late for most of them, the last windows included."""
    demand = published.WindowedDemand.at(spark, new_dir(spark, "stream"))
    progress = new_dir(spark, "progress")
    _arrivals(spark, sf_dir, THIRDS, lambda s: demand.run(s, progress, timedelta(hours=1)))
    return demand.windows()


@_query
def stream_dedup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies batches apart, behind any watermark, come out once."""
    table = SnapshotTable(spark, new_dir(spark, "stream"), ("pickup_month",))
    progress = new_dir(spark, "progress")
    rows = lambda s: jobs.bronze(s, ingested_at=INGESTED_AT)
    copies = ["trip_id % 3 <> 0", "trip_id % 3 <> 1", "true"]
    order = [F.col("ingestion_timestamp")]
    _arrivals(spark, sf_dir, copies, lambda s: published.publish_once(rows(s), table, progress, ["trip_id"], order))
    return table.read().withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


# --- contract --------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Raw -> bronze -> silver -> gold, then the longest trips per day of the silver table."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    tables = layers.run_layers(spark, _all_feeds(SMOKE_DIR), new_dir(spark, "layers"), _options())
    return explore.longest_trips_per_day(layers.read_silver(spark, tables.silver))


def core_queries() -> dict[str, Query]:
    """The queries of the layered tables, without those of the optional subpackage."""
    return dict(_QUERIES)


def queries() -> dict[str, Query]:
    pipeline = {"pipeline": corpus_pipeline.run} if corpus_pipeline else {}
    return {**_QUERIES, **TEXT_QUERIES, **pipeline}


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}
    return {**ORACLES, **TEXT_ORACLES, **pipeline}
