"""Month-partitioned Parquet tables and the load-audit table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from billbook.config import check_run_ts
from billbook.schema import CONTROL


def write_raw(
    df: DataFrame, path: str, mode: str = "append", derive: Callable[[DataFrame], DataFrame] | None = None
) -> int:
    """Write `df` under one directory per run and month and return the rows written.

    `append` keeps history, and replaces what a run had written to the same
    months; `overwrite` replaces the whole table. Rows are rebalanced by month
    first, which makes few files per month and, under adaptive execution, splits
    a month that is too large for one task. The count is taken in the writing
    tasks: no second scan, and a re-run task counts once. `derive` makes the rows of the table from those of `df`
    after they have moved, so that columns that follow from others, or whole rows, need not.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    counted = Observation()
    moved = df.hint("rebalance", F.col("ref"))
    (
        (derive(moved) if derive else moved)
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if mode == "append" else "static")
        .partitionBy("dt_proc", "ref")
        .parquet(path)
    )
    return counted.get["rows"]


def write_run(df: DataFrame, path: str, run_ts: str) -> int:
    """Make `df` all that run `run_ts` has in a raw table; returns the rows written.

    A run that is repeated replaces its own directory, also where it has fewer
    months than before, and no other run's.
    """
    counted = Observation()
    (
        df.drop("dt_proc")
        .hint("rebalance", F.col("ref"))
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("ref")
        .parquet(f"{path}/dt_proc={check_run_ts(run_ts)}")
    )
    return counted.get["rows"]


def write_month(df: DataFrame, path: str, ref: int | str) -> None:
    """Make `df` all of one month, also if it is empty. Files are sized by adaptive execution."""
    df.drop("ref").hint("rebalance").write.mode("overwrite").parquet(f"{path}/ref={int(ref)}")


def replace_months(df: DataFrame, path: str) -> None:
    """Replace exactly the months present in `df`; other months stay. See `write_month` for a known one."""
    (
        df.hint("rebalance", F.col("ref"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ref")
        .parquet(path)
    )


def write_months(df: DataFrame, path: str, mode: str) -> None:
    """Plain `append`, or `overwrite` of the whole table, under one directory per `ref`."""
    (
        df.hint("rebalance", F.col("ref"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy("ref")
        .parquet(path)
    )


def control_row(
    spark: SparkSession, table: str, run_ts: str, rows: int, rejected: int = 0
) -> DataFrame:
    """Audit of one load: table, run, rows, and how many of them no book can use."""
    return spark.createDataFrame([(table, check_run_ts(run_ts), rows, rejected)], CONTROL)


def write_control(row: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append an audit row; `fmt="csv"` writes it as text without a header."""
    row.write.mode("append").format(fmt).save(path)
