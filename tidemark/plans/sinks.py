"""Publishing tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import storage
from tidemark.functions.lineage import plain_path
from tidemark.scratch import materialise


@dataclass(frozen=True)
class WriteOptions:
    """How a partitioned Parquet table is laid out and replaced.

    ``refresh``: ``partitions`` replaces only the partitions that receive rows, ``table``
    replaces everything. ``rebalance`` shuffles rows by partition value so that each partition
    gets few, evenly sized files; a partition value holding most of the rows is split over many
    tasks by adaptive execution. Leave it off when each input file holds few partition values:
    the write then needs no shuffle. ``coalesce_n`` is the most files that a partition gets while it holds no
    more rows than that many files may: its rows are dealt over as many tasks by their hash, so that no task
    holds more than a share of one partition at a time, however large the table is.
    """

    partition_by: str = "pickup_month"
    compression: str = "snappy"
    max_records_per_file: int = 5_000_000
    refresh: str = "partitions"
    rebalance: bool = False
    coalesce_n: int | None = None

    def __post_init__(self) -> None:
        if self.refresh not in ("partitions", "table"):
            raise ValueError(f"unknown refresh: {self.refresh}")


def write_table(
    df: DataFrame,
    path: str,
    options: WriteOptions = WriteOptions(),
    mode: str = "overwrite",
    written: Observation | None = None,
) -> None:
    """Write a partitioned Parquet table; ``mode`` is ``overwrite`` or ``append``.

    ``written`` receives the number of rows as ``n``. It is taken in the writing tasks, after any
    shuffle, where a task that is run again counts once.

    A table that is replaced as a whole is deleted only when its successor lies complete in shared
    storage: rows that cannot be read or computed fail the write and leave the old table.
    """
    laid_out = df
    if options.coalesce_n:
        share = F.pmod(F.xxhash64(*df.columns), F.lit(options.coalesce_n))
        laid_out = df.repartition(options.partition_by, share)
    if options.rebalance:
        laid_out = laid_out.hint("rebalance", options.partition_by)
    if written is not None:
        laid_out = laid_out.observe(written, F.count(F.lit(1)).alias("n"))
    dynamic = options.refresh == "partitions"
    whole = mode == "overwrite" and not dynamic
    spark = df.sparkSession
    present = table_exists(spark, path)
    if whole and present:
        laid_out = materialise(laid_out, "successor")
    known = _known_schema(spark, path) if present and not whole else None
    if present and not whole and known is None:
        known = spark.read.option("mergeSchema", True).parquet(path).schema
    (
        laid_out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .option("compression", options.compression)
        .option("maxRecordsPerFile", options.max_records_per_file)
        .partitionBy(options.partition_by)
        .parquet(path)
    )
    _remember_schema(spark, path, df.schema, known)


SCHEMA_FILE = "_table_schema.json"  # names with an underscore are no data to Spark's readers


def table_exists(spark: SparkSession, path: str) -> bool:
    """One status call on the folder; nothing in it is listed."""
    return storage.exists(spark, path)


def _remember_schema(spark: SparkSession, path: str, schema: T.StructType, known: T.StructType | None) -> None:
    """Keep the columns a table has got so far beside its data, so that no later run opens footers for them."""
    fields = {f.name: f for f in [*(known.fields if known else []), *schema.fields]}
    wanted = T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])
    if known is None or wanted != known:
        storage.replace(spark, f"{path}/{SCHEMA_FILE}", wanted.json())


def _known_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = storage.read_text(spark, f"{path}/{SCHEMA_FILE}")
    return T.StructType.fromJson(json.loads(text)) if text else None


def read_table(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """A table with the columns of all its files, whatever run wrote them; the partition column is text.

    The columns are those written down with the table; only where nothing is written down, because another
    program made the table, all footers are merged.
    """
    found = _known_schema(spark, path) or spark.read.option("mergeSchema", True).parquet(path).schema
    kinds = [T.StructField(f.name, T.StringType()) if f.name == partition_by else f for f in found.fields]
    return spark.read.schema(T.StructType(kinds)).parquet(path)


def replace_files(
    rows: DataFrame,
    files: DataFrame,
    path: str,
    options: WriteOptions = WriteOptions(),
    written: Observation | None = None,
    known_new: bool = False,
) -> None:
    """Make ``rows`` the only rows of the source ``files`` (column ``path``) in a table; other rows stay.

    Rows carry the file's URI as ``source_file``. Files the table holds no rows of are appended, with
    no shuffle. To find that out one column of the table is scanned, which ``known_new`` saves.
    Otherwise the partitions holding rows of the files are written anew from the rows of other files
    and the new ones. Every step may be repeated after a failure with the same result.
    """
    spark, by = rows.sparkSession, options.partition_by
    if known_new or not table_exists(spark, path):
        write_table(rows, path, options, "append", written)
        return
    old = read_table(spark, path, by)
    own = plain_path(F.col("source_file")) == F.col("path")
    held = [row[0] for row in old.join(files, own, "left_semi").select(by).distinct().toLocalIterator()]
    if not held:
        write_table(rows, path, options, "append", written)
        return
    fresh = materialise(rows if written is None else rows.observe(written, F.count(F.lit(1)).alias("n")), "fresh")
    kept = old.filter(in_partitions(by, held)).join(files, own, "left_anti")
    successor = materialise(
        fresh.filter(in_partitions(by, held)).unionByName(kept, allowMissingColumns=True), "successor"
    )
    left = {row[0] for row in successor.select(by).distinct().toLocalIterator()}
    write_table(successor, path, replace(options, refresh="partitions"))
    drop_partitions(spark, path, by, [value for value in held if value not in left])
    write_table(fresh.filter(~in_partitions(by, held)), path, options, "append")


def in_partitions(column: str, values: Sequence[str | None]) -> Column:
    """True for rows of these partitions, never NULL; ``None`` is the partition of NULLs."""
    named = F.coalesce(F.col(column).isin([v for v in values if v is not None]), F.lit(False))
    return named | F.col(column).isNull() if None in values else named


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str | None]) -> None:
    """Delete whole partition folders; values must need no escaping in a path, as months do not."""
    for value in values:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_csv_by(df: DataFrame, path: str, key: str, mode: str = "overwrite") -> None:
    """Write CSV with a header, one folder per ``key`` value and few files in each."""
    df.hint("rebalance", key).write.mode(mode).option("header", True).partitionBy(key).csv(path)
