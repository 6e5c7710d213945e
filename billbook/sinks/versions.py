"""Latest versions of both raw tables, kept bucketed by invoice key.

Rows stand in the bucket of their key's hash, which is the bucket Spark itself reads them from, and also
names their directory. So a run replaces the directories of the buckets that it touches and no others, and a
join of the two tables, bucketed alike, finds its rows side by side without a shuffle.

A log of runs is written ahead of the rows. A run that is not in it is merged with what its buckets hold. A run that
is in it, repeated or broken off, may have replaced versions that it does not bring again: its buckets are built
anew from the raw table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billbook.config import Zones, check_run_ts
from billbook.operators import skew
from billbook.operators.dedup import dedup_latest
from billbook.operators.join import join_payments
from billbook.operators.standardize import has_keys
from billbook.plans.stage import latest_joined
from billbook.schema import INVOICE_KEYS, RAW
from billbook.sources.folders import exists, remove
from billbook.sources.lake import raw_runs, read_raw

BUCKET = "balde"
# About 200 MB of payment rows to sort at a time.
ROWS_TO_SORT = 2_000_000
LOG = "dt_proc string"


def bucket_of(buckets: int) -> Column:
    """The bucket that Spark gives a row of a table clustered by the invoice keys."""
    return F.pmod(F.hash(*INVOICE_KEYS), F.lit(buckets)).alias(BUCKET)


def versions_table(spark: SparkSession, zones: Zones, name: str, buckets: int, database: str = "default") -> str:
    """Declare the table of latest versions of the raw table `name` in the session's catalog; returns its name.

    The number of buckets is part of its path: a table with another number is another table.
    """
    full = f"{database}.ultimas_{name}_{buckets}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW[name])
    path = zones.versions(name, buckets)
    if spark.catalog.tableExists(full) and _location(spark, full) != path.removeprefix("file:"):
        spark.sql(f"DROP TABLE {full}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({columns}, {BUCKET} int) USING parquet "
        f"OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY ({BUCKET}) "
        f"CLUSTERED BY ({', '.join(INVOICE_KEYS)}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if exists(spark, path):
        spark.catalog.recoverPartitions(full)
    return full


def _location(spark: SparkSession, full: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].removeprefix("file:") if rows else ""


def update_versions(
    spark: SparkSession,
    zones: Zones,
    name: str,
    run_ts: str,
    buckets: int,
    database: str = "default",
    rows_per_task: int = skew.ROWS_PER_TASK,
) -> list[int]:
    """Bring a loaded run into the table of latest versions; returns the buckets that were replaced.

    Call it after each load, in the order of loads or not: the result is `dedup_latest` of the raw table's runs so far
    brought in. Calling it again for a run, with the same or other rows, is right too. Rows with a NULL key
    are left out.
    """
    table = versions_table(spark, zones, name, buckets, database)
    log = f"{zones.versions(name, buckets)}_cargas"
    spark.createDataFrame([], LOG).write.mode("append").parquet(log)
    known = {r[0] for r in spark.read.schema(LOG).parquet(log).distinct().collect()}
    again = check_run_ts(run_ts) in known
    spark.createDataFrame([(run_ts,)], LOG).write.mode("append").parquet(log)

    raw = read_raw(spark, zones, name).where(has_keys(INVOICE_KEYS))
    run = raw.where(F.col("dt_proc") == run_ts)
    held = spark.table(table)
    rows = run.select(bucket_of(buckets))
    if again:
        rows = rows.union(held.where(F.col("dt_proc") == run_ts).select(BUCKET))
    # At most `buckets` numbers.
    touched = sorted(r[0] for r in rows.distinct().collect())
    if not touched:
        return []
    if again:
        loaded = sorted(known & set(raw_runs(spark, zones, name)))
        source = raw.where(F.col("dt_proc").isin(loaded) & bucket_of(buckets).isin(touched))
    else:
        source = held.where(F.col(BUCKET).isin(touched)).drop(BUCKET).unionByName(run)
    latest = _placed(source, buckets, rows_per_task).withColumn(BUCKET, bucket_of(buckets))
    latest.select(*RAW[name].names, BUCKET).write.mode("overwrite").insertInto(table)
    if again:
        _empty_buckets(spark, zones, name, buckets, table, touched)
    return touched


def _placed(rows: DataFrame, buckets: int, rows_per_task: int) -> DataFrame:
    """`dedup_latest`, a bucket's keys in as many tasks, and files, as its rows need; rows of a hot key are spread.

    The number of tasks is a multiple of `buckets`, so that the hash puts each task's rows into one bucket.
    """
    keys = [F.col(k) for k in INVOICE_KEYS]
    total = rows.count()
    tasks = buckets * max(1, -(-total // (buckets * ROWS_TO_SORT)))
    if total <= rows_per_task:
        return dedup_latest(rows.repartition(tasks, *keys))
    cells = skew.plan_cells(
        skew.find_hot_keys(rows, rows_per_task=rows_per_task), None, INVOICE_KEYS, rows_per_task
    )
    # A key has more than `rows_per_task` rows, so there are few.
    hot_keys = F.broadcast(cells.select(*INVOICE_KEYS))
    cold = rows.join(hot_keys, list(INVOICE_KEYS), "left_anti").select(*rows.columns)
    hot = skew.salted(rows.join(hot_keys, list(INVOICE_KEYS), "left_semi").select(*rows.columns), cells, "left")
    spread = dedup_latest(hot, (*INVOICE_KEYS, skew.SALT)).select(*rows.columns)
    return dedup_latest(cold.repartition(tasks, *keys)).unionByName(spread)


def _empty_buckets(
    spark: SparkSession, zones: Zones, name: str, buckets: int, table: str, touched: list[int]
) -> None:
    """Remove what a rebuilt bucket held if nothing is left for it: a writer replaces only what it writes to.

    Buckets that have rows are found in the raw table, not in the one just written.
    """
    loaded = {r[0] for r in spark.read.schema(LOG).parquet(f"{zones.versions(name, buckets)}_cargas").distinct().collect()}
    raw = read_raw(spark, zones, name).where(has_keys(INVOICE_KEYS) & F.col("dt_proc").isin(sorted(loaded)))
    own = raw.select(bucket_of(buckets)).where(F.col(BUCKET).isin(touched))
    filled = {r[0] for r in own.distinct().collect()}
    for bucket in sorted(set(touched) - filled):
        remove(spark, f"{zones.versions(name, buckets)}/{BUCKET}={bucket}")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET} = {bucket})")
    spark.catalog.refreshTable(table)


def versions_joined(
    spark: SparkSession,
    zones: Zones,
    buckets: int,
    database: str = "default",
    rows_per_task: int = skew.ROWS_PER_TASK,
) -> DataFrame:
    """Latest invoices with their latest payments, as `latest_joined` of the raw tables, without a shuffle.

    A bucket is read by one task. If a key of either table has more than `rows_per_task` rows, both are read as plain
    files instead and joined by `latest_joined`, which spreads such keys.
    """
    tables = [spark.table(versions_table(spark, zones, n, buckets, database)) for n in ("faturas", "pagamentos")]
    large = [t for t in tables if t.count() > rows_per_task]
    if any(not skew.find_hot_keys(t, rows_per_task=rows_per_task).isEmpty() for t in large):
        plain = [
            spark.read.schema(t.schema).parquet(zones.versions(n, buckets)).select(*RAW[n].names)
            for t, n in zip(tables, ("faturas", "pagamentos"))
        ]
        return latest_joined(*plain, rows_per_task=rows_per_task)
    return join_payments(*tables)
