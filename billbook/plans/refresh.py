"""A month's book, brought up to date for the customers that a late load changes.

Everything about a customer stands in one slice, the hash of their number: a history of raw rows by run, the
stage and the book. A load that is kept in the history leaves a log of the customers and months it brings or
takes away. Refreshing a month reads from the log whom the runs given concern within its look-back, recomputes the stage and
the book of those customers, and replaces the slices they are in. The other slices are neither read nor
written, and in their own slice other customers' rows are copied.

    keep_history(...)      after each load, for both tables
    book_by_slices(...)    the month as a whole, once
    refresh_book(...)      after a late load
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billbook.config import Zones, as_date, check_run_ts, month_bounds
from billbook.operators.skew import ROWS_PER_TASK
from billbook.operators.standardize import has_keys
from billbook.plans.book import book_schema, feature_book
from billbook.plans.spec import BookSpec
from billbook.plans.stage import build_stage
from billbook.schema import INVOICE_KEYS, RAW, STAGE
from billbook.session import scratch_dir
from billbook.sources.folders import exists, remove
from billbook.sources.lake import in_months, read_raw

CUSTOMER = "id_cliente"
SLICE = "fatia"
CHANGES = "mudancas"
CHANGE = T.StructType([
    T.StructField(CUSTOMER, T.LongType()), T.StructField("ref", T.IntegerType()),
    T.StructField("tabela", T.StringType()), T.StructField("dt_proc", T.StringType()),
])


def slice_of(slices: int) -> Column:
    return F.pmod(F.hash(CUSTOMER), F.lit(slices)).alias(SLICE)


def read_sliced(spark: SparkSession, zones: Zones, name: str, schema: T.StructType, slices: int) -> DataFrame:
    """A table by slices with the columns of `schema` and `SLICE`; empty if it is not there."""
    path, full = zones.sliced(name, slices), T.StructType([*schema, T.StructField(SLICE, T.IntegerType())])
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path).select(*full.names)


def keep_history(spark: SparkSession, zones: Zones, name: str, run_ts: str, slices: int) -> None:
    """Bring run `run_ts` of the raw table `name` into the history, in place of what it had there.

    First the log gets the customers and months of the rows that come and of those that go, so that a refresh knows of both,
    also if this is broken off and repeated. Rows with a NULL key are in no book and left out.
    """
    run = read_raw(spark, zones, name).where((F.col("dt_proc") == check_run_ts(run_ts)) & has_keys(INVOICE_KEYS))
    before = read_sliced(spark, zones, name, RAW[name], slices).where(F.col("dt_proc") == run_ts)
    changes = run.select(CUSTOMER, "ref").union(before.select(CUSTOMER, "ref")).distinct()
    changes.write.mode("append").parquet(f"{zones.sliced(CHANGES, slices)}/tabela={name}/dt_proc={run_ts}")
    (
        run.drop("dt_proc").withColumn(SLICE, slice_of(slices))
        .hint("rebalance", F.col(SLICE))
        .write.mode("overwrite").partitionBy(SLICE).parquet(f"{zones.sliced(name, slices)}/dt_proc={run_ts}")
    )


def changed_customers(spark: SparkSession, zones: Zones, runs: Sequence[str], first: int, last: int, slices: int) -> DataFrame:
    """(id_cliente,): whom the runs concern in months `first` to `last`, in either table."""
    log = spark.read.schema(CHANGE).parquet(zones.sliced(CHANGES, slices))
    return in_months(log.where(F.col("dt_proc").isin(list(runs))), first, last).select(CUSTOMER).distinct()


def book_by_slices(
    spark: SparkSession,
    zones: Zones,
    ref_date: date | str,
    run_ts: str,
    slices: int,
    spec: BookSpec = BookSpec(),
    rows_per_task: int | None = ROWS_PER_TASK,
    payment_keys: Sequence[str] = INVOICE_KEYS,
) -> None:
    """Stage and book of one month from the whole history, as `book_job` makes them of the raw zone."""
    tables = [read_sliced(spark, zones, n, RAW[n], slices) for n in RAW]
    stage = _stage(tables, ref_date, run_ts, spec, rows_per_task, payment_keys)
    month = int(f"{as_date(ref_date):%Y%m}")
    _write_month(stage, zones, "stage", month, slices)
    written = read_sliced(spark, zones, "stage", STAGE, slices).where(F.col("ref") == month)
    _write_month(feature_book(written, spec, ref_date), zones, "book", month, slices)


def refresh_book(
    spark: SparkSession,
    zones: Zones,
    ref_date: date | str,
    run_ts: str,
    runs: Sequence[str],
    slices: int,
    spec: BookSpec = BookSpec(),
    rows_per_task: int | None = ROWS_PER_TASK,
    payment_keys: Sequence[str] = INVOICE_KEYS,
) -> list[int]:
    """Bring stage and book of a month up to date with `runs` of the history; returns the slices replaced.

    Afterwards both are as `book_by_slices` would make them, but that rows of customers whom no run concerns keep the
    `dt_proc` of the run that made them. Repeating it, also after it was broken off, gives the same. The month, made by
    `book_by_slices` or empty, must have been made with the same spec and keys.
    """
    month = int(f"{as_date(ref_date):%Y%m}")
    changed = changed_customers(spark, zones, runs, *month_bounds(ref_date, max(spec.windows)), slices)
    changed = _written(changed, "changed")
    # At most `slices` numbers.
    touched = sorted(r[0] for r in changed.select(slice_of(slices)).distinct().collect())
    if not touched:
        return []

    def rows_of(name: str, schema: T.StructType, how: str = "left_semi") -> DataFrame:
        """Of the slices touched the rows of changed customers, or of the others."""
        rows = read_sliced(spark, zones, name, schema, slices).where(F.col(SLICE).isin(touched))
        return rows.join(changed, CUSTOMER, how)

    def of_month(df: DataFrame) -> DataFrame:
        return df.where(F.col("ref") == month)

    stage = _stage([rows_of(n, RAW[n]) for n in RAW], ref_date, run_ts, spec, rows_per_task, payment_keys)
    others = of_month(rows_of("stage", STAGE, "left_anti"))
    _replace_slices(spark, stage, others, zones, "stage", month, touched, slices)

    book = feature_book(of_month(rows_of("stage", STAGE)), spec, ref_date)
    others = of_month(rows_of("book", book_schema(spec), "left_anti"))
    _replace_slices(spark, book, others, zones, "book", month, touched, slices)
    return touched


def _stage(
    tables: Sequence[DataFrame], ref_date: date | str, run_ts: str, spec: BookSpec,
    rows_per_task: int | None, payment_keys: Sequence[str],
) -> DataFrame:
    bounds = month_bounds(ref_date, max(spec.windows))
    invoices, payments = (in_months(t.drop(SLICE), *bounds) for t in tables)
    return build_stage(invoices, payments, ref_date, run_ts, rows_per_task=rows_per_task, payment_keys=payment_keys)


def _write_month(df: DataFrame, zones: Zones, name: str, month: int, slices: int) -> None:
    (
        df.drop("ref").withColumn(SLICE, slice_of(slices))
        .hint("rebalance", F.col(SLICE))
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy(SLICE).parquet(f"{zones.sliced(name, slices)}/ref={month}")
    )


def _replace_slices(
    spark: SparkSession, new: DataFrame, others: DataFrame, zones: Zones, name: str, month: int,
    touched: Sequence[int], slices: int,
) -> None:
    """Make `new` and `others` all that the slices touched hold in a month.

    `others` may come from these very slices: the writer replaces them when all rows are read. Slices that nothing is left
    for are not written to, and removed.
    """
    path = f"{zones.sliced(name, slices)}/ref={month}"
    filled = Observation()
    rows = new.withColumn(SLICE, slice_of(slices)).unionByName(others.select(*new.columns, SLICE)).drop("ref")
    (
        rows.hint("rebalance", F.col(SLICE))
        .observe(filled, F.collect_set(SLICE).alias("slices"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(SLICE).parquet(path)
    )
    for gone in sorted(set(touched) - set(filled.get["slices"])):
        remove(spark, f"{path}/{SLICE}={gone}")


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
