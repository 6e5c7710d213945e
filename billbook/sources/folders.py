"""Listing directories on the driver, one level at a time and without a job."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _open(spark, path)
    return files.exists(at)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories in `path`, in order; none where it is not there."""
    at, files = _open(spark, path)
    found = files.listStatus(at) if files.exists(at) else []
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a directory with all that is in it."""
    at, files = _open(spark, path)
    files.delete(at, True)


def _open(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
