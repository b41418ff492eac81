"""File catalog, tolerant reads and new-file detection."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lineage import plain_path, scanned_file
from tidemark.scratch import materialise


def catalog(
    spark: SparkSession,
    paths: str | Sequence[str],
    limit: int | None = None,
    pattern: str = "*.parquet",
) -> DataFrame:
    """Files under ``paths`` (top level only): path, bytes and modification time.

    The files are listed, not opened: the ``content`` column is never selected. ``limit`` keeps
    the first names; ``None`` or 0 keeps all.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(wanted)
        .select("path", F.col("length").alias("bytes"), "modificationTime")
    )
    return files.orderBy("path").limit(limit) if limit else files


def catalog_paths(files: DataFrame) -> list[str]:
    """Sorted file names for a reader. A listing is metadata the driver holds for any scan anyway."""
    return sorted(row.path for row in files.select("path").toLocalIterator())


def seen_files(df: DataFrame) -> DataFrame:
    """Files a scan touches with the rows it takes from each; reads Parquet footers only.

    Paths are written as in :func:`catalog`, whatever characters they hold.
    """
    return df.groupBy(plain_path(scanned_file()).alias("path")).agg(F.count(F.lit(1)).alias("rows"))


def new_files(files: DataFrame, ingested: DataFrame) -> DataFrame:
    """Catalog entries whose path is not in the ingestion log."""
    return files.join(ingested.select("path"), "path", "left_anti")


def readable_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """One row per path that holds rows Spark can open. Files are opened, no column is decoded."""
    probe = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths)
    return seen_files(probe)


def file_report(spark: SparkSession, files: DataFrame, schema: T.StructType) -> DataFrame:
    """Catalog entries with ``status`` ok / skipped, the rows each file holds, and the ``error`` of a skipped one.

    The probe of all files does not tell an unreadable file from an empty one or from a passing I/O
    error. Files it finds no rows in, expected to be few, are opened again one by one, strictly. The
    report is written once, so that all who use it see the same.
    """
    readable = readable_files(spark, catalog_paths(files), schema)
    probed = materialise(files.join(readable, "path", "left"), "probe")
    again = [(path, *_strict_rows(spark, path, schema)) for path in catalog_paths(probed.filter("rows IS NULL"))]
    second = spark.createDataFrame(again, "path string, second long, error string")
    status = F.when(F.coalesce("rows", "second").isNull(), "skipped").otherwise("ok")
    report = probed.join(second, "path", "left").withColumn("status", status)
    counted = report.withColumn("rows", F.coalesce("rows", "second", F.lit(0)))
    return materialise(counted.select(*files.columns, "rows", "status", "error"), "report")


def _strict_rows(spark: SparkSession, path: str, schema: T.StructType) -> tuple[int | None, str | None]:
    strict = spark.read.schema(schema).option("ignoreCorruptFiles", "false")
    try:
        return strict.parquet(path).count(), None
    except (PySparkException, Py4JJavaError) as failure:
        return None, str(failure).split("\n")[0]


def tolerant_read(
    spark: SparkSession, files: DataFrame, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Rows of the readable files, and the report naming the skipped ones.

    Only the footer probe tolerates errors. The data read is strict, so an I/O error while
    reading a good file is retried or fails the job and never loses rows silently.
    """
    report = file_report(spark, files, schema)
    good = catalog_paths(report.filter("status = 'ok'"))
    if not good:
        return spark.createDataFrame([], schema), report
    return spark.read.schema(schema).parquet(*good), report
