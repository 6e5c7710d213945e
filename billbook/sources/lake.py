"""Parquet zones, and the lake as tables for SQL."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billbook.config import BY_CUSTOMER, Zones, month_bounds
from billbook.plans.book import book_schema
from billbook.plans.spec import BookSpec
from billbook.schema import RAW, REJECTS, STAGE
from billbook.sources.folders import subfolders


def read_raw(spark: SparkSession, zones: Zones, table: str) -> DataFrame:
    """A raw table; run and month come from its directories."""
    return spark.read.schema(RAW[table]).parquet(zones.raw(table)).select(*RAW[table].names)


def read_rejects(spark: SparkSession, zones: Zones, table: str) -> DataFrame:
    """What no book can use, as `load_job` wrote it, with the reason: rows of a raw table, and malformed lines.

    A malformed line has its text in `LINE`, and is not in the raw table.
    """
    schema = REJECTS[table]
    return spark.read.schema(schema).parquet(zones.rejects(table)).select(*schema.names)


def raw_runs(spark: SparkSession, zones: Zones, table: str) -> list[str]:
    """Runs that have a directory in a raw table, in order of time."""
    return [d.removeprefix("dt_proc=") for d in subfolders(spark, zones.raw(table)) if d.startswith("dt_proc=")]


def in_months(df: DataFrame, first: int, last: int) -> DataFrame:
    """Months `first` to `last`, both inclusive. Prunes directories when `ref` partitions them."""
    return df.where(F.col("ref").between(first, last))


def read_look_back(
    spark: SparkSession, zones: Zones, table: str, ref_date: date | str, months: int = 12
) -> DataFrame:
    """The months a book for `ref_date` needs: `months` before it, and its own."""
    return in_months(read_raw(spark, zones, table), *month_bounds(ref_date, months))


def read_stage(
    spark: SparkSession, zones: Zones, ref: str | int, run_ts: str | None = None
) -> DataFrame:
    """One reference month of the stage; with `run_ts` only what that run wrote."""
    month = spark.read.schema(STAGE).parquet(zones.curated("stage")).where(F.col("ref") == int(ref))
    return month.where(F.col("dt_proc") == run_ts) if run_ts else month


def read_table(spark: SparkSession, zones: Zones, name: str, spec: BookSpec = BookSpec()) -> DataFrame:
    """All of a raw table, the stage or the book."""
    if name in RAW:
        return read_raw(spark, zones, name)
    return spark.read.schema(_columns(name, spec)).parquet(zones.curated(name))


def read_clustered(spark: SparkSession, zones: Zones, name: str, spec: BookSpec = BookSpec()) -> DataFrame:
    """The copy of a lake table that `sinks.clustered` made; a condition on `id_cliente` skips row groups."""
    schema = _columns(name, spec)
    return spark.read.schema(schema).parquet(zones.curated(name + BY_CUSTOMER)).select(*schema.names)


def _columns(name: str, spec: BookSpec) -> T.StructType:
    return {**RAW, "stage": STAGE}.get(name) or book_schema(spec)


def register_zones(
    spark: SparkSession,
    zones: Zones,
    database: str,
    tables: Sequence[str] = ("faturas", "pagamentos", "stage", "book"),
    spec: BookSpec = BookSpec(),
) -> list[str]:
    """Declare lake tables in the session's catalog, for SQL over the lake.

    Newly written runs and months are added to existing declarations, which are
    replaced only if the columns differ. `ref` is an int everywhere. The tables
    are external: dropping them leaves the files. Clustered copies go by their own
    names, as `faturas_por_cliente`.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{zones.root}/_catalog'")
    done = []
    for name in tables:
        path = zones.raw(name) if name in RAW else zones.curated(name)
        schema = _columns(name.removesuffix(BY_CUSTOMER), spec)
        by = ("dt_proc", "ref") if name in RAW else ("ref",)
        schema = T.StructType([f for f in schema if f.name not in by] + [schema[c] for c in by])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        full = f"{database}.{name}"
        if spark.catalog.tableExists(full) and spark.table(full).dtypes != [
            (f.name, f.dataType.simpleString()) for f in schema
        ]:
            spark.sql(f"DROP TABLE {full}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'"
        )
        spark.catalog.recoverPartitions(full)
        done.append(full)
    return done
