"""Streams into snapshot tables: batches published in one step, folded, freed of old copies, counted by window.

Every micro-batch is one commit, which also keeps the number of the stream's last batch. A batch repeated
after a failure finds its number there and does nothing, whatever has been folded since, because Spark
numbers the batches of a stream in ascending order and repeats only the last one. Two streams may append to
one table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.temporal import event_time
from tidemark.operators.dedup import keep_first
from tidemark.plans.snapshots import ConcurrentChange, Snapshot, SnapshotTable
from tidemark.schema import TRIPS, TripColumns
from tidemark.scratch import materialise
from tidemark.streaming.jobs import stream_identity

ATTEMPTS = 5


def is_done(table: SnapshotTable, stream: str, batch_id: int) -> bool:
    """Whether the table holds this batch of the stream, by itself or folded with others."""
    last = table.tagged(stream)
    return last is not None and int(last) >= batch_id


def _run(df: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def publish(df: DataFrame, table: SnapshotTable, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch to the table, once; readers see whole batches only."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        stream = stream_identity(rows)
        if not is_done(table, stream, batch_id):
            table.commit(rows, "append", tag=(stream, str(batch_id)))

    return _run(df, checkpoint, batch)


def fold(
    table: SnapshotTable, folders: int = 1, rewrite: Callable[[DataFrame], DataFrame] | None = None
) -> Snapshot | None:
    """Write partitions of more than ``folders`` folders anew as one folder each, and publish that in one step.

    Rows stay as they are, or become ``rewrite`` of them, which must keep each row's partition. Batches that
    streams append meanwhile stay beside the folded folder. Which batches the table holds is not forgotten. The
    folders before remain for readers of older snapshots until ``vacuum``. Partitions with fewer folders
    are neither read nor written. A table without a snapshot stays as it is (``None``).
    """
    for attempt in range(ATTEMPTS):
        base = table.current()
        many = sorted(name for name, held in base.folders.items() if len(held) > folders) if base else []
        if not many:
            return base
        rows = table.read(base, many)
        try:
            return table.commit(rewrite(rows) if rewrite else rows, "fold", emptied=many, base=base)
        except ConcurrentChange:  # somebody else folded or replaced one of them
            if attempt == ATTEMPTS - 1:
                raise
    return None


def publish_once(
    df: DataFrame, table: SnapshotTable, checkpoint: str, keys: Sequence[str], order: Sequence[Column]
) -> StreamingQuery:
    """Append the first copy of each key, however far apart copies arrive; no state is kept but the table.

    Copies within a batch are reduced to the first under ``order``; an anti-join with the table's
    partitions that the batch falls into drops keys published before. Copies of a key must therefore agree
    in the partition columns, as trips delivered again do, and the work of a batch grows with these
    partitions' key columns, not with the table. NULL parts of a key equal each other. Another writer to the same
    partitions makes the batch start again from what that writer published.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        stream = stream_identity(rows)
        if is_done(table, stream, batch_id):
            return
        single = materialise(keep_first(rows, keys, order), "batch")
        touched = table.partition_names(single)
        for attempt in range(ATTEMPTS):
            base = table.current()
            fresh = single
            if base:
                held = table.read(base, touched).select(*keys).alias("held")
                same = F.lit(True)
                for key in keys:
                    same = same & F.col(f"new.{key}").eqNullSafe(F.col(f"held.{key}"))
                fresh = single.alias("new").join(held, same, "left_anti")
            try:
                table.commit(fresh, "guarded", base=base, tag=(stream, str(batch_id)))
                return
            except ConcurrentChange:
                if attempt == ATTEMPTS - 1:
                    raise

    return _run(df, checkpoint, batch)


# --- demand by window, with late rows ----------------------------------------------------------

WATERMARK = "watermark"
EPOCH = datetime(1970, 1, 1)


def _time(value: datetime) -> Column:
    return F.lit(value.isoformat(" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class WindowedDemand:
    """Trips per hour window as signed counts, and the rows that came too late for their window.

    ``counts`` (window_start, window_end, trips, late) gets one row per window and batch; ``late`` says
    that the window had been closed before the batch. ``late_rows`` gets those rows themselves.
    A window is closed once the newest pickup of earlier batches, less the delay, has passed its
    end, as with Spark's watermark; that time is kept with the commit. Rows without a pickup time are in no window.
    """

    counts: SnapshotTable
    late_rows: SnapshotTable

    @staticmethod
    def at(spark: SparkSession, root: str) -> WindowedDemand:
        return WindowedDemand(SnapshotTable(spark, f"{root}/counts"), SnapshotTable(spark, f"{root}/late"))

    def watermark(self) -> datetime | None:
        """Windows that end here or earlier are closed."""
        held = self.counts.tagged(WATERMARK)
        return None if held is None else EPOCH + timedelta(microseconds=int(held))

    def add(self, rows: DataFrame, stream: str, batch_id: int, delay: timedelta, c: TripColumns = TRIPS) -> None:
        """Count a batch; its late rows are published before its counts, so a repeated batch completes both."""
        if is_done(self.counts, stream, batch_id):
            return
        mark = self.watermark()
        hour = F.window(event_time(c.pickup), "1 hour")
        timed = rows.filter(F.col(c.pickup).isNotNull()).withColumn("hour", hour)
        end = F.col("hour.end").cast("timestamp_ntz")
        late = end <= _time(mark) if mark else F.lit(False)
        counted = materialise(
            timed.groupBy("hour")
            .agg(F.count(F.lit(1)).alias("trips"), F.max(c.pickup).cast("timestamp_ntz").alias("newest"))
            .select(
                F.col("hour.start").cast("timestamp_ntz").alias("window_start"),
                end.alias("window_end"), "trips", late.alias("late"), "newest",
            ),
            "windows",
        )
        seen = counted.agg(F.max("newest").alias("newest"), F.count_if("late").alias("late")).first()
        if seen["late"] and not is_done(self.late_rows, stream, batch_id):
            self.late_rows.commit(timed.filter(late).drop("hour"), "append", tag=(stream, str(batch_id)))
        reached = max(t for t in (mark, seen["newest"] and seen["newest"] - delay, EPOCH) if t is not None)
        passed = str((reached - EPOCH) // timedelta(microseconds=1))
        self.counts.commit(counted.drop("newest"), "append", tag=(stream, str(batch_id)), also={WATERMARK: passed})

    def run(self, df: DataFrame, checkpoint: str, delay: timedelta, c: TripColumns = TRIPS) -> StreamingQuery:
        return _run(df, checkpoint, lambda rows, n: self.add(rows, stream_identity(rows), n, delay, c))

    def windows(self, closed_only: bool = False) -> DataFrame:
        """All windows: ``trips``, and how many of them were late.

        This is the closing pass: it includes windows still open and corrects closed ones by their late rows.
        ``closed_only`` leaves the open ones out.
        """
        rows = self.counts.read()
        if closed_only:
            rows = rows.filter(F.col("window_end") <= _time(self.watermark()))
        return rows.groupBy("window_start", "window_end").agg(
            F.sum("trips").alias("trips"), F.sum(F.when(F.col("late"), F.col("trips")).otherwise(0)).alias("late_trips")
        )

    def fold(self, folders: int = 1) -> Snapshot | None:
        """Sum the counts of many batches into one row per window and lateness."""
        return fold(
            self.counts, folders, lambda r: r.groupBy("window_start", "window_end", "late").agg(F.sum("trips").alias("trips")).select(*r.columns)
        )
