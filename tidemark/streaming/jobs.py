"""Streaming ingestion, windowed demand, deduplication and partition publishing.

The file source takes files in order of modification time, ``files_per_trigger`` of them in one
micro-batch, so that a failure repeats no more than that; ``None`` takes everything available at once.
Within a batch no row is late. With several batches
the watermark follows the order of the files, so they must arrive roughly in event-time order or the
delay must cover the difference; rows behind the watermark are dropped and counted in the progress.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.temporal import event_time
from tidemark.operators.quality import TRIP_RULES, Rules
from tidemark.plans.bronze import transform
from tidemark.schema import TRIPS, TripColumns
from tidemark.sources.feeds import Feed, with_binding

FILES_PER_TRIGGER = 1_000
QUERY_ID = "sql.streaming.queryId"  # fixed value: the local property in which Spark names the running query


def read_stream(
    spark: SparkSession, feed: Feed, files_per_trigger: int | None = FILES_PER_TRIGGER, lineage: bool = True
) -> DataFrame:
    """The feed's folder (one path, may be a glob) as a stream of trips."""
    (path,) = feed.paths
    reader = spark.readStream.schema(feed.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_binding(reader.parquet(path), feed, lineage)


def bronze(df: DataFrame, rules: Rules = TRIP_RULES, ingested_at: datetime | None = None) -> DataFrame:
    """The batch transformation, unchanged."""
    return transform(df, rules, ingested_at)


def hourly_demand(df: DataFrame, delay: str, c: TripColumns = TRIPS) -> DataFrame:
    """Trips per hour window, sent once when the watermark has passed the window's end.

    A run that ends with the input leaves the windows younger than the newest row less ``delay``
    open; they are sent by a later run. A finished backfill takes its last hours from the batch table.
    """
    return (
        df.withColumn("event_time", event_time(c.pickup))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 hour"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "trips",
        )
    )


def dedup(
    df: DataFrame, keys: list[str], delay: str, two_steps: bool = False, c: TripColumns = TRIPS
) -> DataFrame:
    """The first copy of each key within the watermark delay.

    A key holding much of the stream goes to one state partition. For such streams ``two_steps``
    first reduces copies per (key, input partition), which spreads them over the cluster; only the
    survivors, at most one per key and input partition, meet in the second step. It costs a second
    stateful shuffle. Copies further apart than the delay may or may not be dropped.
    """
    timed = df.withColumn("event_time", event_time(c.pickup)).withWatermark("event_time", delay)
    if two_steps:
        spread = timed.withColumn("input_partition", F.spark_partition_id())
        timed = spread.dropDuplicatesWithinWatermark([*keys, "input_partition"]).drop("input_partition")
    return timed.dropDuplicatesWithinWatermark(keys).drop("event_time")


def run_to_files(
    df: DataFrame, target: str, checkpoint: str, partition_by: str | None = None
) -> StreamingQuery:
    """Process everything available into a Parquet table, then stop.

    Run again with the same checkpoint it takes only files that arrived since.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    query = (writer.partitionBy(partition_by) if partition_by else writer).start(target)
    query.awaitTermination()
    return query


def stream_identity(batch: DataFrame) -> str:
    """The identity of the query a micro-batch belongs to, which Spark keeps in the checkpoint."""
    stream_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
    if not stream_id:
        raise RuntimeError("the batch does not say which streaming query it belongs to")
    return stream_id


def publish_partitions(
    df: DataFrame, target: str, checkpoint: str, partition_by: str = "pickup_month"
) -> StreamingQuery:
    """Publish each micro-batch into partitions of its own: (``partition_by``, ``stream_id``, ``batch_id``).

    ``stream_id`` is the query's identity, which Spark keeps in the checkpoint. A batch repeated after
    a failure replaces exactly the partitions it wrote before; a run with another checkpoint adds its
    rows and replaces none.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"stream_id": F.lit(stream_identity(batch)), "batch_id": F.lit(batch_id).cast("long")})
        (
            rows.hint("rebalance", partition_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_by, "stream_id", "batch_id")
            .parquet(target)
        )

    query = (
        df.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
