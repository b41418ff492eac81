"""Make this package importable in Python workers, also where executors have no copy of the repository."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to the session's executors, once for an application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).parents[2]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted((root / "tidemark").rglob("*.py")):
            archive.write(path, path.relative_to(root).as_posix())
    handle, name = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")  # Spark serves it to the executors
    with os.fdopen(handle, "wb") as out:
        out.write(data.getvalue())
    spark.sparkContext.addPyFile(name)
    _shipped.add(application)
