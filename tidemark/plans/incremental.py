"""Runs that take only files not taken before, remembered in a ledger table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.runs import STATUS_OK
from tidemark.plans.bronze import IngestOptions, publish, readable, run_metrics, sources
from tidemark.plans.sinks import table_exists
from tidemark.scratch import materialise
from tidemark.sources.feeds import Feed
from tidemark.sources.files import catalog, seen_files

LEDGER_SCHEMA = (
    "path string, bytes long, modificationTime timestamp, rows long, run_id string, state string,"
    " recorded_at timestamp"
)
STARTED, DONE = "started", "done"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the ledger: two per file and run, ``started`` and ``done``."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def ingested_files(ledger: DataFrame) -> DataFrame:
    """The last record of each file; ``known`` says whether its rows are in the table for certain."""
    last = F.max_by(F.struct("bytes", "modificationTime", "rows", "run_id", "state"), "recorded_at")
    return ledger.groupBy("path").agg(last.alias("last")).select(
        "path", "last.*", (F.col("last.state") == DONE).alias("known")
    )


def pending(spark: SparkSession, feed: Feed, ledger: DataFrame) -> DataFrame:
    """Files of a feed that are new, changed since they were taken, or left by an interrupted run.

    ``seen`` marks those the table may hold rows of.
    """
    found = catalog(spark, feed.paths).alias("found")
    taken = ingested_files(ledger).alias("taken")
    same = F.expr("known AND found.bytes = taken.bytes AND found.modificationTime = taken.modificationTime")
    return (
        found.join(taken, "path", "left")
        .filter(~F.coalesce(same, F.lit(False)))
        .select("path", "found.bytes", "found.modificationTime", F.col("known").isNotNull().alias("seen"))
    )


def ingest_new(
    spark: SparkSession,
    feeds: Sequence[Feed],
    target: str,
    ledger: str,
    options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """Add the files the ledger does not know to a bronze table; one row of run metrics per source.

    A file is known by path, size and modification time. It is recorded as started before its rows
    are written and as done afterwards, with the number of rows its footer names. New files are
    appended; the rows of a changed file, or of one an interrupted run left as started, are replaced,
    so no file counts twice. One run at a time may work on a table.
    """
    if options.write.refresh == "table":
        raise ValueError("an incremental run keeps the table; refresh must be 'partitions'")
    run_id = uuid.uuid4().hex
    fresh, seen = [], set()
    for feed in feeds:
        if not feed.paths:
            continue
        todo = pending(spark, feed, read_ledger(spark, ledger)).select("path", "seen")
        names = sorted(tuple(row) for row in todo.toLocalIterator())
        seen |= {path for path, before in names if before}
        fresh.append(feed.at(*[path for path, _ in names]))
    present, records = readable(spark, fresh) if options.tolerant else (fresh, [])
    for source, unit in sources(present, options.mode):
        paths = [path for feed in unit for path in feed.paths]
        files = materialise(catalog(spark, paths), "listing")  # the versions this run takes
        _record(files.withColumn("rows", F.lit(None)), ledger, run_id, STARTED)
        record = publish(spark, source, unit, target, options, "append", known_new=not seen.intersection(paths))
        if record[1] == STATUS_OK:
            scans = [seen_files(spark.read.schema(feed.schema).parquet(*feed.paths)) for feed in unit if feed.paths]
            counted = files.join(reduce(DataFrame.unionByName, scans), "path", "left")
            _record(counted.withColumn("rows", F.coalesce("rows", F.lit(0))), ledger, run_id, DONE)
        records.append(record)
    return run_metrics(spark, run_id, options.mode, records)


TAKEN_SCHEMA = "path string, run_id string, batch long, state string"


def next_batch(spark: SparkSession, ledger: str, taken: str) -> tuple[int, DataFrame] | None:
    """A numbered batch of files (``path``, ``run_id``) that bronze holds and a later layer has not finished.

    A batch is written down before work on it begins, so a run after a failure gets the same files under the
    same number; files that came since then make a batch of their own.
    """
    held = ingested_files(read_ledger(spark, ledger)).filter("known").select("path", "run_id")
    number = 0
    if table_exists(spark, taken):
        records = spark.read.schema(TAKEN_SCHEMA).parquet(taken)
        last = records.groupBy("batch").agg(F.bool_or(F.col("state") == DONE).alias("done")).orderBy(F.desc("batch")).first()
        if last and not last["done"]:
            return last["batch"], records.filter(F.col("batch") == last["batch"]).select("path", "run_id")
        number = last["batch"] if last else 0
        held = held.join(records, ["path", "run_id"], "left_anti")
    files = materialise(held, "batch")
    if files.isEmpty():
        return None
    _note(files, taken, number + 1, STARTED)
    return number + 1, files


def finish_batch(files: DataFrame, taken: str, number: int) -> None:
    _note(materialise(files, "finished"), taken, number, DONE)


def _note(files: DataFrame, taken: str, number: int, state: str) -> None:
    noted = files.select("path", "run_id", F.lit(number).cast("long").alias("batch"), F.lit(state).alias("state"))
    noted.coalesce(1).write.mode("append").parquet(taken)


def _record(files: DataFrame, ledger: str, run_id: str, state: str) -> None:
    stamped = files.select(
        "path",
        "bytes",
        "modificationTime",
        F.col("rows").cast("long").alias("rows"),
        F.lit(run_id).alias("run_id"),
        F.lit(state).alias("state"),
        F.current_timestamp().alias("recorded_at"),
    )
    stamped.coalesce(1).write.mode("append").parquet(ledger)
