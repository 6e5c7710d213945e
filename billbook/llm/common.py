"""What several operators share: text in ASCII lower case, written intermediate tables, clean names."""

from __future__ import annotations

import ctypes
import gc
import os
import string
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billbook.session import scratch_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers of this machine import the package from where the driver has it.

    On a cluster it comes with --py-files, and a folder that is not there does no harm.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, ROOT)))


_kept: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task: the tables of the operator it runs, one at a time."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Drops what another operator's tasks have left in this worker, and hands its memory back to the system."""
    if _kept:
        _kept.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only; every other letter stays as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table under the shared folder.

    Later jobs read the table, so a lost executor costs no recomputation of what lies before it.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, purpose: str, key: str) -> tuple[DataFrame, int]:
    """As `written`, with the rows bucketed by `key`, and the number of buckets: one for each shuffle partition.

    Rows go to their bucket's file from the task that has them. What is joined to the table by `beside` moves to
    its rows, which stay.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"billbook_{purpose}_{uuid.uuid4().hex}"
    path = scratch_dir(spark, purpose)
    df.write.option("path", path).bucketBy(buckets, key).format("parquet").saveAsTable(name)
    return spark.table(name), buckets


def beside(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """rows shuffled as a bucketed table lies, whatever number of partitions the session has now."""
    return rows.repartition(buckets, key)
