"""Small files and folders of shared storage, through the file systems that Spark itself uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    """One status call; no listing of what is inside."""
    files, location = _file_system(spark, path)
    return files.exists(location)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text; False when there is one of that name already, which stays as it is."""
    files, location = _file_system(spark, path)
    try:
        stream = files.create(location, False)
    except Py4JJavaError as failure:
        if "FileAlreadyExists" in failure.java_exception.getClass().getName():
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def replace(spark: SparkSession, path: str, text: str) -> None:
    """Create a file or replace its text."""
    files, location = _file_system(spark, path)
    stream = files.create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file, None when there is none."""
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return None
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in milliseconds) of what a folder holds, sorted; empty when there is no folder."""
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(location))


def folders_at(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Paths below ``path`` of the folders ``depth`` levels down, relative to it; hidden ones are left out."""
    files, location = _file_system(spark, path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path + "/*" * depth)
    base = files.makeQualified(location).toUri().getPath().rstrip("/") + "/"
    found = [s.getPath().toUri().getPath() for s in files.globStatus(pattern) or [] if s.isDirectory()]
    inner = [p[len(base) :] for p in found]
    return sorted(p for p in inner if not any(part[0] in "_." for part in p.split("/")))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds; nothing happens when there is none."""
    files, location = _file_system(spark, path)
    files.delete(location, True)
