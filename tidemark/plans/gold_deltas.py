"""Gold, kept up to date: signed counts and sums are added to the aggregates they change.

All three gold tables follow from additive totals: trips and miles per day and company, trips per hour
and weekday, trips per month and location. Changed rows carry a sign (rows of a changed file come once
with -1 and once with +1), one scan of them gives the deltas of all totals by grouping sets, and equal
rows cancel. Deltas are written first, under the batch's name; then each total is brought up to date in
one published step that remembers the batch. A run that is repeated takes the deltas as written and skips
what holds the batch, so it may be repeated after any failure. Only months with a delta are read and
written; a month of days and companies is one small file, which a folder for each day would not be.

Miles are summed as decimals of nine places: what is subtracted leaves nothing behind, and the order of
additions does not matter. A row whose miles are no finite number counts as a trip without miles.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.functions.lineage import plain_path
from tidemark.functions.temporal import pickup_month
from tidemark.plans.sinks import in_partitions
from tidemark.plans.snapshots import SnapshotTable
from tidemark.schema import TRIPS, TripColumns

MILES = "decimal(38,9)"
SIGN = "sign"
BATCH = "batch"
NUMBERS = ("trips", "miles", "measured")


@dataclass(frozen=True)
class Total:
    """An additive table: what it is grouped by, and which of these columns is its partition."""

    keys: tuple[str, ...]
    partition: str | None


TOTALS: Mapping[str, Total] = {
    "daily_company": Total(("pickup_month", "pickup_date", "company"), "pickup_month"),
    "hour_weekday": Total(("pickup_hour", "pickup_dayofweek"), None),
    "location_month": Total(("pickup_month", "location"), "pickup_month"),
    "source_file": Total(("source_file", "pickup_month"), None),
}


def _grouped(rows: DataFrame, c: TripColumns) -> DataFrame:
    """One scan of signed rows -> deltas of all totals, told apart by ``total``."""
    source = F.col("source_file") if "source_file" in rows.columns else F.lit(None).cast("string")
    values = rows.select(
        F.to_date(c.pickup).alias("pickup_date"),
        F.col(c.company).alias("company"),
        F.hour(c.pickup).alias("pickup_hour"),
        F.dayofweek(c.pickup).alias("pickup_dayofweek"),
        pickup_month(c.pickup).alias("pickup_month"),
        F.col(c.location).alias("location"),
        source.alias("source_file"),
        F.col(SIGN).cast("long").alias(SIGN),
        F.when(F.abs(c.miles) < 1e18, F.col(c.miles)).try_cast(MILES).alias("miles"),
    )
    columns = list(dict.fromkeys(key for total in TOTALS.values() for key in total.keys))
    sets = [[F.col(key) for key in total.keys] for total in TOTALS.values()]
    number = F.grouping_id(*columns).alias("set")
    # tasks of bounded size, however many places a file holds; most groups are whole in one task
    sums = (
        values.hint("rebalance", "pickup_month", "location")
        .groupingSets(sets, *columns)
        .agg(
            number,
            F.sum(SIGN).alias("trips"),
            F.sum(F.col("miles") * F.col(SIGN).cast("decimal(1,0)")).cast(MILES).alias("miles"),
            F.sum(F.when(F.col("miles").isNotNull(), F.col(SIGN))).alias("measured"),
        )
        .withColumns({"miles": F.coalesce("miles", F.lit(0).cast(MILES)), "measured": F.coalesce("measured", F.lit(0))})
    )
    named = F.lit(None).cast("string")
    for name, total in TOTALS.items():
        bits = sum(1 << i for i, column in enumerate(reversed(columns)) if column not in total.keys)
        named = F.when(F.col("set") == bits, name).otherwise(named)
    changed = (F.col("trips") != 0) | (F.col("miles") != 0) | (F.col("measured") != 0)
    return sums.withColumn("total", named).filter(changed).select("total", *columns, *NUMBERS)


@dataclass(frozen=True)
class GoldTables:
    """The gold tables below ``root``, and the totals they follow from."""

    spark: SparkSession
    root: str

    def total(self, name: str) -> SnapshotTable:
        partition = TOTALS[name].partition
        return SnapshotTable(self.spark, f"{self.root}/totals/{name}", (partition,) if partition else ())

    def prepare(self, batch: str, changes: DataFrame, c: TripColumns = TRIPS) -> None:
        """Write the deltas of a batch, unless they are written."""
        self._written(batch, changes, c)

    def apply(self, batch: str, changes: DataFrame | None = None, c: TripColumns = TRIPS) -> dict[str, list[str]]:
        """Add signed rows (column ``sign``) to all totals, once for each batch name; the partitions written by total.

        Without ``changes`` the batch must be prepared. Batches follow one another; a name must not come back
        after another batch.
        """
        deltas = self._written(batch, changes, c)
        return {name: self._add(name, batch, deltas) for name in TOTALS}

    def _written(self, batch: str, changes: DataFrame | None, c: TripColumns) -> DataFrame:
        """The deltas of a batch: computed and written once, the same ones whenever the batch is repeated."""
        path = f"{self.root}/deltas/{batch}"
        if not storage.exists(self.spark, f"{path}/_SUCCESS"):
            if changes is None:
                raise ValueError(f"batch {batch} is not prepared")
            _grouped(changes, c).write.mode("overwrite").partitionBy("total").parquet(path)
        columns = ", ".join(
            f"{name} {kind}"
            for name, kind in {
                "pickup_date": "date",
                "company": "string",
                "pickup_hour": "int",
                "pickup_dayofweek": "int",
                "pickup_month": "string",
                "location": "long",
                "source_file": "string",
                "trips": "long",
                "miles": MILES,
                "measured": "long",
                "total": "string",
            }.items()
        )
        return self.spark.read.schema(columns).parquet(path)

    def _add(self, name: str, batch: str, deltas: DataFrame) -> list[str]:
        total, table = TOTALS[name], self.total(name)
        base = table.current()
        if base is not None and base.tags.get(BATCH) == batch:
            return []
        own = deltas.filter(F.col("total") == name).select(*total.keys, *NUMBERS)
        touched = table.partition_names(own) if total.partition else [""]
        known = own if base is None else own.unionByName(table.read(base, touched))
        sums = known.hint("rebalance", *total.keys).groupBy(*total.keys).agg(*(F.sum(n).cast(own.schema[n].dataType).alias(n) for n in NUMBERS))
        table.commit(sums.filter("trips <> 0"), "replace", emptied=touched, base=base, tag=(BATCH, batch))
        return touched

    # --- the gold tables ---------------------------------------------------------------------

    def daily_company(self) -> DataFrame:
        """Trips, total and mean miles per day and company."""
        miles = F.when(F.col("measured") > 0, F.col("miles").cast("double"))
        return self.total("daily_company").read().select(
            "pickup_date",
            F.col("company").alias(TRIPS.company),
            "trips",
            miles.alias("total_miles"),
            (miles / F.col("measured")).alias("mean_miles"),
        )

    def hour_weekday(self) -> DataFrame:
        """Trips per hour of day and weekday (1 = Sunday)."""
        return self.total("hour_weekday").read().select("pickup_hour", "pickup_dayofweek", "trips")

    def location_month(self, n: int = 3) -> DataFrame:
        """The ``n`` busiest pickup locations of each month with their rank, from the monthly totals."""
        by_month = Window.partitionBy("pickup_month").orderBy(F.desc("trips"), F.asc("location"))
        ranked = self.total("location_month").read().withColumn("rank", F.row_number().over(by_month))
        return ranked.filter(f"rank <= {int(n)}").select("pickup_month", F.col("location").alias(TRIPS.location), "trips", "rank")

    def files(self) -> DataFrame:
        """Trips per source file and month, by which a changed file's own months are known."""
        return self.total("source_file").read().select("source_file", "pickup_month", "trips")


def file_changes(gold: GoldTables, layer: DataFrame, files: DataFrame, rows: DataFrame) -> DataFrame:
    """Signed rows that make ``rows`` the only ones of the source ``files`` (column ``path``).

    ``layer`` is the bronze table as it was counted last. The months its rows of the files lie in are known
    from the totals, so only these months are read. A file without new rows is one that was removed.
    """
    own = plain_path(F.col("source_file")) == F.col("path")
    known = gold.files().join(files, own, "left_semi").select("pickup_month").distinct()
    months = [row[0] for row in known.toLocalIterator()]
    old = layer.filter(in_partitions("pickup_month", months)).join(files, own, "left_semi")
    return signed(old, -1).unionByName(signed(rows, 1), allowMissingColumns=True)


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.withColumn(SIGN, F.lit(sign))
