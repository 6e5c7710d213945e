"""The scheduled jobs: extract, load, book. Each is one call per run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from billbook.config import AS_WRITTEN, INTENDED, Zones, as_date
from billbook.operators.skew import ROWS_PER_TASK
from billbook.operators.standardize import STANDARDIZE, rejected_lines, rejects
from billbook.plans.book import feature_book
from billbook.plans.spec import BookSpec
from billbook.plans.stage import build_stage
from billbook.schema import INVOICE_KEYS, LINE, RAW_NAME
from billbook.sinks.lake import (
    control_row, write_control, write_month, write_months, write_raw, write_run,
)
from billbook.sources.ingestion import (
    extract_snapshot, malformed, read_ingestion, read_lines, well_formed,
)
from billbook.sources.lake import read_look_back, read_raw, read_stage


def extract_job(source: DataFrame, zones: Zones, table: str, run_ts: str) -> str:
    """Snapshot a source table into the ingestion zone."""
    return extract_snapshot(source, zones, table, run_ts)


def load_job(
    spark: SparkSession,
    zones: Zones,
    table: str,
    run_ts: str,
    snapshot_ts: str | None = None,
    mode: str = INTENDED,
    write_mode: str = "append",
    control_format: str = "parquet",
    control_table: str | None = None,
) -> int:
    """Standardise one snapshot into the raw zone and audit it; returns the rows loaded.

    Repeating a load with its `run_ts` replaces what it had loaded, and its rejects; `write_mode="overwrite"`
    replaces all of both tables. Rows without a key or month stay in the raw table, and stand with the reason
    in the rejects beside it. Malformed lines stand in the rejects only, with their text, so that the
    lines of a snapshot are the rows loaded and the lines rejected; `as_written` loads what can be read of
    them. They are counted while loading, and the snapshot is read again only if there are any.
    `control_table` names the audit table, by default after the raw table.
    """
    name = RAW_NAME[table]
    counted = None
    if mode == AS_WRITTEN:
        text = read_ingestion(spark, zones, table, snapshot_ts, permissive=True)
    else:
        counted, lines = Observation(), read_lines(spark, zones, table, snapshot_ts)
        text = well_formed(lines.observe(counted, F.count(LINE).alias("malformed")))
    typed = STANDARDIZE[table](text, run_ts, mode)
    if write_mode == "overwrite":
        rows = write_raw(typed, zones.raw(name), "overwrite")
    else:
        rows = write_run(typed, zones.raw(name), run_ts)
    loaded = read_raw(spark, zones, name).where(F.col("dt_proc") == run_ts)
    bad = rejects(loaded).withColumn(LINE, F.lit(None).cast("string"))
    if counted is not None and counted.get["malformed"]:
        bad = bad.unionByName(rejected_lines(malformed(lines), name, run_ts))
    if write_mode == "overwrite":
        rejected = write_raw(bad, zones.rejects(name), "overwrite")
    else:
        rejected = write_run(bad, zones.rejects(name), run_ts)
    audit = control_row(spark, name, run_ts, rows, rejected)
    write_control(audit, zones.control(control_table or name), control_format)
    return rows


def book_job(
    spark: SparkSession,
    zones: Zones,
    ref_date: date | str,
    run_ts: str,
    spec: BookSpec = BookSpec(),
    mode: str = INTENDED,
    rows_per_task: int | None = ROWS_PER_TASK,
    payment_keys: Sequence[str] = INVOICE_KEYS,
) -> None:
    """Stage and book of one reference month, replacing that month in both.

    `as_written` replaces the whole stage and appends to the book instead. The
    book reads the stage back from its files, so deduplication and join run
    once, and a book that fails can be repeated without them. `payment_keys`
    are those of `latest_joined`.
    """
    months, month = max(spec.windows), f"{as_date(ref_date):%Y%m}"
    invoices = read_look_back(spark, zones, "faturas", ref_date, months)
    payments = read_look_back(spark, zones, "pagamentos", ref_date, months)
    stage = build_stage(invoices, payments, ref_date, run_ts, mode, rows_per_task, payment_keys)
    literal = mode == AS_WRITTEN
    if literal:
        write_months(stage, zones.curated("stage"), "overwrite")
    else:
        write_month(stage, zones.curated("stage"), month)

    written = read_stage(spark, zones, month, run_ts)
    book = feature_book(written, spec, ref_date)
    if literal:
        write_months(book, zones.curated("book"), "append")
    else:
        write_month(book, zones.curated("book"), month)
