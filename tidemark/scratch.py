"""Working folders and small intermediate tables in shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a session in local mode may do without it; such a session gets a folder of its own.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        _local_dirs[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[application]


def new_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier call returned."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a table and read it back.

    The plan above starts from files that survive the loss of an executor, and Spark knows their
    size: a join broadcasts the table when it is below the session's threshold and shuffles
    otherwise.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
