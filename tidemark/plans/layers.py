"""The whole run: raw -> bronze -> silver -> gold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lineage import plain_path
from tidemark.plans import gold, silver
from tidemark.plans.bronze import IngestOptions, bronze_schema, ingest, read_bronze
from tidemark.plans.gold_deltas import GoldTables
from tidemark.plans.incremental import finish_batch, ingest_new, next_batch
from tidemark.plans.silver_upsert import BUCKETS, silver_table, upsert
from tidemark.plans.sinks import WriteOptions, write_table
from tidemark.plans.snapshots import SnapshotTable
from tidemark.schema import SILVER_SCHEMA
from tidemark.sources.feeds import Feed


@dataclass(frozen=True)
class Layers:
    """Where a run put its tables, and its ingestion metrics."""

    bronze: str
    silver: str
    gold_daily_company: str
    gold_hour_weekday: str
    gold_location_month: str
    metrics: DataFrame


def run_layers(
    spark: SparkSession, feeds: Sequence[Feed], root: str, options: IngestOptions = IngestOptions()
) -> Layers:
    """Publish all layers under ``root``; each layer is built from the table before it."""
    paths = {
        name: f"{root}/{folder}"
        for name, folder in {
            "bronze": "bronze/trips",
            "silver": "silver/trips",
            "gold_daily_company": "gold/daily_company",
            "gold_hour_weekday": "gold/hour_weekday",
            "gold_location_month": "gold/location_month",
        }.items()
    }
    whole = replace(options, write=replace(options.write, refresh="table"))
    metrics = ingest(spark, feeds, paths["bronze"], whole)
    layer = silver.silver(read_bronze(spark, paths["bronze"], bronze_schema(spark, feeds)))
    write_table(layer, paths["silver"], WriteOptions(refresh="table", rebalance=True))

    clean = read_silver(spark, paths["silver"], layer.schema)
    gold.daily_company(clean).write.mode("overwrite").parquet(paths["gold_daily_company"])
    gold.hour_weekday(clean).write.mode("overwrite").parquet(paths["gold_hour_weekday"])
    gold.refresh_location_month(clean, paths["gold_location_month"])
    return Layers(**paths, metrics=metrics)


@dataclass(frozen=True)
class Refreshed:
    """Where an incremental run keeps its tables, what it ingested, and the partitions it wrote."""

    bronze: str
    silver: SnapshotTable
    gold: GoldTables
    metrics: DataFrame
    written: dict[str, list[str]]


def refresh_layers(
    spark: SparkSession,
    feeds: Sequence[Feed],
    root: str,
    options: IngestOptions = IngestOptions(),
    buckets: int = BUCKETS,
) -> Refreshed:
    """Bring all layers under ``root`` up to date with files that are new or changed since the last run.

    New files are appended to bronze and merged into silver; gold takes the signed rows that silver changed. Each
    layer reads only what the one before it changed. A batch that an earlier run began and did not finish is
    repeated first, with the same files and the same name, and counts once. Silver keeps trips that a changed file no
    longer holds: a delivery says what is, not what is not.
    """
    layer, ledger, merged = f"{root}/bronze/trips", f"{root}/ledger/bronze", f"{root}/ledger/silver"
    table, gold_tables = silver_table(spark, f"{root}/silver/trips"), GoldTables(spark, f"{root}/gold")
    metrics = ingest_new(spark, feeds, layer, ledger, options)
    written: dict[str, list[str]] = {}
    while batch := next_batch(spark, ledger, merged):
        number, arrived = batch
        name = f"{number:09d}"
        own = plain_path(F.col("source_file")) == F.col("path")
        delivery = read_bronze(spark, layer, bronze_schema(spark, feeds)).join(arrived, own, "left_semi")
        merge = upsert(
            table,
            delivery,
            rules=options.rules,
            buckets=buckets,
            tag=("batch", name),
            before_commit=lambda rows: gold_tables.prepare(name, rows),
        )
        for part, names in {"silver": merge.written, **gold_tables.apply(name)}.items():
            written[part] = sorted({*written.get(part, []), *names})
        finish_batch(arrived, merged, number)
    return Refreshed(layer, table, gold_tables, metrics, written)


def read_silver(spark: SparkSession, path: str, schema: T.StructType = SILVER_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
