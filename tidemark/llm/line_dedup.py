"""Line dedup over levelled sorted runs of line hashes.

A store keeps runs: tables of line hashes sorted by hash, each at a level. A batch of documents is
aggregated to one row a line and anti-joined with the runs: a line not seen before enters with the
largest document that holds it, a line seen before only adds to its document count. Batches arrive
by descending document id, so the first document recorded for a line is the one that keeps it.
When a level holds ``FAN_IN`` runs they are compacted into one sorted run of the next level.

A line's key is the line without white space (``[ \\t-\\r]``) at its ends and with A-Z in lower
case. Keys of at least ``min_length`` code points found in at least ``min_docs`` documents lose
all their lines except in the document with the largest id. Null or empty text is one empty line.
Null ids sort before all others; rows that repeat an id count as documents of their own, and all
rows with the largest id keep the line. Keys are compared by a 64-bit hash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.ranges import id_of, range_index, split_points
from tidemark.scratch import new_dir

MIN_LENGTH = 40
MIN_DOCS = 5
BATCHES = 3
FAN_IN = 2
EDGE = " \t\n\x0b\x0c\r"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN_SCHEMA = "line long, docs long, last_doc long"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(EDGE)), UPPER, SMALL)


def hash_of(line: Column) -> Column:
    return F.xxhash64(key_of(line))


def line_keys(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row for each document and long line: ``id`` and ``line``, the hash of the key."""
    long = F.filter(lines_of(F.col("text")), lambda x: F.length(F.btrim(x, F.lit(EDGE))) >= min_length)
    hashes = F.array_distinct(F.transform(long, hash_of))
    return docs.select(id_of().alias("id"), hashes.alias("lines")).select("id", F.explode("lines").alias("line"))


@dataclass
class LineRuns:
    """The runs of a store: level -> tables, newest last. Each run is sorted by line hash."""

    spark: SparkSession
    levels: dict[int, list[str]] = field(default_factory=dict)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(*paths)

    def _paths(self) -> list[str]:
        return [path for level in sorted(self.levels, reverse=True) for path in self.levels[level]]

    def _add_run(self, rows: DataFrame, level: int) -> None:
        path = new_dir(self.spark, f"line-run-{level}")
        rows.sortWithinPartitions("line").write.parquet(path)
        self.levels.setdefault(level, []).append(path)
        if len(self.levels[level]) >= FAN_IN:
            self._compact(level)

    def _compact(self, level: int) -> None:
        """Merge the runs of a level into one of the next; counts add up, the first keeper stays."""
        self._add_run(self._totals(self.levels.pop(level)), level + 1)

    def _totals(self, paths: list[str]) -> DataFrame:
        return self._read(paths).groupBy("line").agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc"))

    def add(self, keys: DataFrame) -> None:
        """Take in a batch (``id``, ``line``) whose ids are below those of the batches before it."""
        batch = keys.groupBy("line").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("last_doc"))
        if self._paths():
            known = self._read(self._paths()).filter("last_doc IS NOT NULL").select("line", F.lit(True).alias("seen"))
            fresh = F.when(F.col("seen").isNull(), F.col("last_doc")).alias("last_doc")
            batch = batch.join(known, "line", "left").select("line", "docs", fresh)
        self._add_run(batch, 0)

    def frequent(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Lines of at least ``min_docs`` documents, with the document that keeps each."""
        if not self._paths():
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self._totals(self._paths()).filter(F.col("docs") >= min_docs)


RESULT = ("n_lines", "n_dropped")


def drop_repeated_lines(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """All columns of ``docs`` with the text without its repeated lines, plus ``n_lines`` and ``n_dropped``.

    The text is scanned twice and shuffled once; between the scans only line hashes move. Other columns pass
    unseen, whatever their names; one named like a result is replaced by it.
    """
    spark = docs.sparkSession
    store, table = LineRuns(spark), new_dir(spark, "line-keys")
    points = split_points(docs, batches)
    batch = F.lit(len(points)) - range_index(points, "id")
    line_keys(docs, min_length).withColumn("batch", batch).write.partitionBy("batch").parquet(table)
    keys = spark.read.schema("id long, line long, batch int").parquet(table)
    for i in range(len(points) + 1):
        store.add(keys.filter(F.col("batch") == i).drop("batch"))
    keeper = store.frequent(min_docs).select("line", "last_doc")
    drops = keys.join(keeper, "line").filter("id < last_doc").groupBy("id").agg(F.collect_set("line").alias("dropped"))
    lines = lines_of(F.col("text"))
    kept = F.filter(
        lines,
        lambda x: (F.length(F.btrim(x, F.lit(EDGE))) < min_length) | ~F.array_contains("dropped", hash_of(x)),
    )
    own = [F.col(f"`{name}`") for name in docs.columns if name not in ("text", *RESULT)]
    packed = docs.select(F.struct(*own).alias("row"), id_of().alias("id"), "text")
    joined = packed.join(drops.withColumnRenamed("id", "dropped_id"), F.col("id") == F.col("dropped_id"), "left")
    split = joined.select("row", lines.alias("lines"), F.when(F.col("dropped").isNull(), lines).otherwise(kept).alias("kept"))
    return split.select(
        "row.*",
        F.array_join("kept", "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )
