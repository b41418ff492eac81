"""Raw -> bronze: validate, derive, publish by month, and report on the run."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from time import perf_counter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.temporal import pickup_month
from tidemark.operators.quality import TRIP_RULES, Rules, keep_valid
from tidemark.operators.runs import STATUS_FAILED, STATUS_OK
from tidemark.plans.sinks import WriteOptions, replace_files, write_table
from tidemark.schema import BRONZE_SCHEMA, TRIPS, TripColumns
from tidemark.sources.feeds import Feed, read_feeds
from tidemark.sources.files import catalog, catalog_paths, file_report

log = logging.getLogger(__name__)

FULL_BATCH = "full_batch"
FILE_LOOP = "file_loop"
ALL_FILES = "ALL_FILES"
STATUS_SKIPPED = "skipped"

RUN_SCHEMA = (
    "run_id string, mode string, source string, status string, files long,"
    " rows_in long, rows_out long, seconds double, error string"
)


@dataclass(frozen=True)
class IngestOptions:
    """Options of an ingestion run.

    ``count_rows`` also counts the rows read, exactly and under every layout: from the footers, in a job of its
    own, so that the filters of the write stay in its scan (:func:`rows_read`). ``keep_going`` records a failed
    source and continues with the next one. ``tolerant`` sorts out unreadable files before anything is
    written and reports each as a source of its own with the status ``skipped``. ``ingested_at`` fixes the ingestion timestamp so that a
    run can be repeated. ``before_source`` is called before each source of a file loop is read.
    """

    mode: str = FULL_BATCH
    write: WriteOptions = field(default_factory=WriteOptions)
    rules: Rules = field(default_factory=lambda: TRIP_RULES)
    count_rows: bool = False
    keep_going: bool = False
    tolerant: bool = False
    ingested_at: datetime | None = None
    before_source: Callable[[Feed], None] | None = None


def derive(df: DataFrame, ingested_at: datetime | None = None, c: TripColumns = TRIPS) -> DataFrame:
    """Add pickup date, pickup month and ingestion time."""
    stamp: Column = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return df.withColumns(
        {
            "pickup_date": F.to_date(c.pickup),
            "pickup_month": pickup_month(c.pickup),
            "ingestion_timestamp": stamp.cast("timestamp"),
        }
    )


def transform(df: DataFrame, rules: Rules = TRIP_RULES, ingested_at: datetime | None = None) -> DataFrame:
    """Raw trips -> bronze rows; needs no shuffle."""
    return derive(keep_valid(df, rules), ingested_at)


def bronze_schema(spark: SparkSession, feeds: Sequence[Feed]) -> T.StructType:
    """Schema of the bronze table of these feeds, with the columns they pass through."""
    return transform(read_feeds(spark, feeds)).schema


def read_bronze(spark: SparkSession, path: str, schema: T.StructType = BRONZE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def month_slice(bronze: DataFrame, months: Sequence[str | None]) -> DataFrame:
    """Rows of some months; ``None`` stands for rows without a pickup time.

    The predicate is on the partition column, so files of other months are not read.
    """
    wanted = F.col("pickup_month").isin([m for m in months if m is not None])
    return bronze.filter(wanted | F.col("pickup_month").isNull() if None in months else wanted)


def rows_read(spark: SparkSession, feeds: Sequence[Feed]) -> DataFrame:
    """One row with the number of rows in the feeds' files, ``n``: a scan of no column, which opens footers only."""
    return read_feeds(spark, feeds, lineage=False).agg(F.count(F.lit(1)).alias("n"))


def file_metrics(scan: DataFrame, rules: Rules = TRIP_RULES) -> DataFrame:
    """Rows read, kept and dropped per source file."""
    passed = F.lit(True)
    for predicate in rules.values():
        passed = passed & F.coalesce(F.expr(predicate), F.lit(False))
    return (
        scan.groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(passed).alias("rows_kept"))
        .withColumn("rows_dropped", F.col("rows_in") - F.col("rows_kept"))
    )


def ingest(
    spark: SparkSession,
    feeds: Sequence[Feed],
    target: str,
    options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """Publish the feeds as a bronze table and return one row of run metrics per source.

    ``full_batch`` writes everything in one job, ``file_loop`` one file after another. By default the
    rows of the feeds' files are replaced and all other rows of the table stay, so runs over other
    files add up and a repeated run changes nothing. With ``write.refresh="table"`` the feeds become
    the whole table: the first write replaces it, the rest append. Without input nothing is written.
    """
    if options.mode not in (FULL_BATCH, FILE_LOOP):
        raise ValueError(f"unknown mode: {options.mode}")
    run_id = uuid.uuid4().hex
    present, records = readable(spark, feeds) if options.tolerant else (list(feeds), [])
    published = False
    for source, unit in sources(present, options.mode):
        mode = "append" if published else "overwrite"
        record = publish(spark, source, unit, target, options, mode)
        published = published or record[1] == STATUS_OK
        records.append(record)
    if not records:
        log.info("run %s: no input files", run_id)
    return run_metrics(spark, run_id, options.mode, records)


def run_metrics(spark: SparkSession, run_id: str, mode: str, records: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame([(run_id, mode, *record) for record in records], RUN_SCHEMA)


def sources(feeds: Sequence[Feed], mode: str) -> list[tuple[str, list[Feed]]]:
    """What is written in one job each: everything, or every file by itself."""
    present = [feed for feed in feeds if feed.paths]
    if mode == FULL_BATCH:
        return [(ALL_FILES, present)] if present else []
    return [(single.name, [single]) for feed in present for single in feed.per_path()]


def readable(spark: SparkSession, feeds: Sequence[Feed]) -> tuple[list[Feed], list[tuple]]:
    """The feeds without their unreadable files, and a run record for each of those."""
    good, skipped = [], []
    for feed in feeds:
        if not feed.paths:
            continue
        report = file_report(spark, catalog(spark, feed.paths), feed.schema)
        good.append(feed.at(*catalog_paths(report.filter("status = 'ok'"))))
        bad = report.filter("status = 'skipped'").orderBy("path").toLocalIterator()
        skipped += [(row.path.rsplit("/", 1)[-1], STATUS_SKIPPED, 1, None, None, 0.0, row.error) for row in bad]
    return good, skipped


def publish(
    spark: SparkSession,
    source: str,
    feeds: Sequence[Feed],
    target: str,
    options: IngestOptions,
    mode: str = "overwrite",
    known_new: bool = False,
) -> tuple:
    """Write the rows of some feeds and return the record of the run; see :func:`ingest`."""
    started = perf_counter()
    files = sum(len(feed.paths) for feed in feeds)
    rows_out = Observation()
    try:
        if options.before_source and options.mode == FILE_LOOP:
            options.before_source(feeds[0])
        bronze = transform(read_feeds(spark, feeds), options.rules, options.ingested_at)
        if options.write.refresh == "table":
            write_table(bronze, target, options.write, mode, rows_out)
        else:
            paths = catalog(spark, [path for feed in feeds for path in feed.paths]).select("path")
            replace_files(bronze, paths, target, options.write, rows_out, known_new)
        read_count = rows_read(spark, feeds).first()["n"] if options.count_rows else None
    except Exception as failure:
        if not options.keep_going:
            raise
        log.exception("source %s failed", source)
        return (source, STATUS_FAILED, files, None, None, perf_counter() - started, str(failure))
    return (source, STATUS_OK, files, read_count, rows_out.get["n"], perf_counter() - started, None)


def ingest_with_fallback(
    spark: SparkSession, feeds: Sequence[Feed], target: str, options: IngestOptions = IngestOptions()
) -> DataFrame:
    """File loop first; when it fails, rebuild the table as one full batch.

    The full batch replaces whatever the loop had written. The metrics keep the failed attempt.
    """
    try:
        return ingest(spark, feeds, target, replace(options, mode=FILE_LOOP, keep_going=False))
    except Exception as failure:
        log.warning("file loop failed, falling back to full batch", exc_info=True)
        attempt = ("", FILE_LOOP, ALL_FILES, STATUS_FAILED, 0, None, None, None, str(failure))
    whole = replace(options, mode=FULL_BATCH, write=replace(options.write, refresh="table"))
    done = ingest(spark, feeds, target, whole)
    return spark.createDataFrame([attempt], RUN_SCHEMA).unionByName(done)
