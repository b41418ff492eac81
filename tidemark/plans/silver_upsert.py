"""Silver, kept up to date: deliveries are merged into the buckets they change.

The table is partitioned by pickup month and by a hash bucket of the trip's key; the key holds the pickup
time, so all copies of a trip lie in one bucket. A delivery is cleaned and reduced to one row per trip,
and written once. An anti-join with the buckets it falls into finds the rows the table does not have yet in
that or a newer version; buckets without such a row are left alone, the others are written anew with the
newest copy of each trip, and published in one step. Files of all other buckets are neither listed nor read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import TRIP_RULES, Rules
from tidemark.plans.silver import TRIP_KEY, clean, dedup, features
from tidemark.plans.snapshots import NULL_PARTITION, Snapshot, SnapshotTable
from tidemark.scratch import materialise

BUCKETS = 16
PARTITIONS = ("pickup_month", "key_bucket")
SIGN = "sign"


@dataclass(frozen=True)
class Merge:
    """What a delivery changed: the snapshot, partitions written, and rows gone (-1) or come (+1) as ``sign``."""

    snapshot: Snapshot | None
    written: list[str]
    changes: DataFrame


def silver_table(spark: SparkSession, root: str) -> SnapshotTable:
    return SnapshotTable(spark, root, PARTITIONS)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("key_bucket")


def upsert(
    table: SnapshotTable,
    delivery: DataFrame,
    keys: Sequence[str] = TRIP_KEY,
    rules: Rules = TRIP_RULES,
    buckets: int = BUCKETS,
    tag: tuple[str, str] | None = None,
    before_commit: Callable[[DataFrame], None] | None = None,
) -> Merge:
    """Merge bronze rows; afterwards the table equals ``silver`` over all rows ever delivered.

    ``keys`` must hold the pickup time, and with ``buckets`` must stay what they were at the first delivery. A
    delivery that is repeated changes nothing and writes nothing. ``before_commit`` is given the changes while
    nobody sees them yet, so that what follows from them can be written down first.
    """
    ready = delivery.transform(clean, rules).transform(dedup, keys).transform(features)
    ready = ready.withColumn("key_bucket", key_bucket(keys, buckets))
    base = table.current()
    prepare = before_commit or (lambda changes: None)
    if base is None:
        staged = table.stage(ready)
        changes = table.staged_rows(staged).withColumn(SIGN, F.lit(1))
        prepare(changes)
        snapshot = table.commit(changes, "replace", tag=tag, staged=staged)
        return Merge(snapshot, sorted(snapshot.folders), changes)
    fresh = materialise(ready, "delivery")
    touched = table.partition_names(fresh)
    old = table.read(base, touched)
    derived = [c for c in fresh.columns if c not in delivery.columns]  # equal where what they follow from is
    wanted = table.partition_names(_news(fresh, old, keys, derived))
    if not wanted:
        changes = fresh.limit(0).withColumn(SIGN, F.lit(1))
        prepare(changes)
        return Merge(base, [], changes)
    before = table.read(base, wanted)
    both = before.unionByName(fresh.filter(_in_partitions(wanted)), allowMissingColumns=True)
    staged = table.stage(both.transform(dedup, keys))
    after = table.staged_rows(staged)
    changes = _changes(before, after)
    prepare(changes)
    snapshot = table.commit(after, "replace", base=base, tag=tag, staged=staged)
    return Merge(snapshot, wanted, changes)


def _same_trip(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"f.{key}").eqNullSafe(F.col(f"o.{key}"))
    return condition


def _news(fresh: DataFrame, old: DataFrame, keys: Sequence[str], derived: Sequence[str]) -> DataFrame:
    """Delivered rows whose trip the table lacks, or holds in a version that is not newer for certain."""
    newer = F.col("o.ingestion_timestamp") > F.col("f.ingestion_timestamp")
    rest = [c for c in fresh.columns if c in old.columns and c not in [*keys, *derived]]
    equal = F.struct(*(F.col(f"f.{c}") for c in rest)).eqNullSafe(F.struct(*(F.col(f"o.{c}") for c in rest)))
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(f"f.{key}").isNull()
    beaten = _same_trip(keys) & (equal | (newer & ~unknown))
    return fresh.alias("f").join(old.alias("o"), beaten, "left_anti")


def _in_partitions(names: Sequence[str]) -> Column:
    """Rows of partitions named as in manifests."""
    parts = [F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit(NULL_PARTITION))) for p in PARTITIONS]
    return F.concat_ws("/", *parts).isin(list(names))


def _changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows only in one of the two, with their sign; equal rows cancel out."""
    columns = after.columns
    signed = before.withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1)), allowMissingColumns=True)
    return signed.groupBy(*columns).agg(F.sum(SIGN).cast("int").alias(SIGN)).filter(F.col(SIGN) != 0)
