"""The daily load as a stream that stops when it has caught up.

Each call loads the snapshot files that arrived since the last one. The
checkpoint remembers which files were taken and the file sink commits a batch
once, so an interrupted or repeated call neither loses nor doubles rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from billbook.config import AS_WRITTEN, INTENDED, Zones
from billbook.operators.standardize import MALFORMED, STANDARDIZE, has_keys, rejected_lines, rejects
from billbook.schema import CONTROL, INGESTION, INVOICE_KEYS, LINE, RAW_NAME
from billbook.sinks.lake import write_control
from billbook.sources.folders import exists
from billbook.sources.ingestion import CSV, line_reader, newest_run, parsed_lines, well_formed
from billbook.sources.lake import raw_runs, read_raw, read_rejects


# A snapshot file stands in the directory of its run.
RUN_OF_FILE = r"_(\d{14})/[^/]+$"
RUN = "_run"


def _arrivals(spark: SparkSession, zones: Zones, table: str, mode: str, max_files: int) -> DataFrame:
    """Lines of new snapshot files with `LINE` as `read_lines` has it, and the run whose directory the file stands in."""
    if mode == AS_WRITTEN:
        schema, options = INGESTION[table], {**CSV, "enforceSchema": "false"}
    else:
        try:
            path = newest_run(spark, zones, table)
        except FileNotFoundError:
            path = None
        schema, options = line_reader(spark, path, table)
    raw = (
        spark.readStream.schema(schema)
        .options(**options, maxFilesPerTrigger=str(max_files))
        .csv(f"{zones.ingestion(table)}/*")
        .withColumn(RUN, F.regexp_extract(F.col("_metadata.file_path"), RUN_OF_FILE, 1))
    )
    return raw.withColumn(LINE, F.lit(None).cast("string")) if mode == AS_WRITTEN else parsed_lines(raw, table)


def load_arrivals(
    spark: SparkSession,
    zones: Zones,
    table: str,
    mode: str = INTENDED,
    max_files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Load new snapshot files into the raw zone; await the returned query.

    Every row is of the run whose directory its file stands in, so several
    snapshots that wait for one call stay apart. A raw table is filled either by
    this or by `load_job`: the file sink keeps its own list of committed files,
    and readers of the table follow that list. Malformed lines are left to
    `reject_arrivals`; `as_written` loads what can be read of them.
    """
    name = RAW_NAME[table]
    lines = well_formed(_arrivals(spark, zones, table, mode, max_files_per_batch))
    typed = STANDARDIZE[table](lines, F.col(RUN), mode).hint("rebalance", F.col("ref"))
    return _into(typed, zones.raw(name), zones.stream_state(name))


def reject_arrivals(
    spark: SparkSession,
    zones: Zones,
    table: str,
    mode: str = INTENDED,
    max_files_per_batch: int = 10_000,
) -> StreamingQuery:
    """What `load_job` puts into the rejects, for new snapshot files; await the returned query.

    A stream of its own, with its own record of the files that it has taken: a file sink commits exactly once,
    but only to one table. `as_written` has no malformed lines.
    """
    name = RAW_NAME[table]
    lines = _arrivals(spark, zones, table, mode, max_files_per_batch)
    rows = rejects(STANDARDIZE[table](well_formed(lines), F.col(RUN), mode)).withColumn(LINE, F.lit(None).cast("string"))
    if mode != AS_WRITTEN:
        texts = lines.where(F.col(LINE).isNotNull())
        rows = rows.unionByName(rejected_lines(texts, name, F.col(RUN)))
    return _into(rows, zones.rejects(name), zones.stream_state(f"rejeitados_{name}"))


def _into(rows: DataFrame, path: str, state: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", state)
        .partitionBy("dt_proc", "ref")
        .trigger(availableNow=True)
        .start()
    )


def audit_arrivals(spark: SparkSession, zones: Zones, table: str) -> None:
    """Audit rows of the runs that the stream has loaded and that have none yet.

    Call it when the streams have ended. Which runs are new is told by directory names and the audit table, so that only
    rows of new runs are read, however long the history. Repeating it adds nothing. Malformed
    lines count as rejected if `reject_arrivals` has run.
    """
    name = RAW_NAME[table]
    # Makes an empty table the first time.
    spark.createDataFrame([], CONTROL).write.mode("append").parquet(zones.control(name))
    known = spark.read.schema(CONTROL).parquet(zones.control(name)).select("dt_proc").distinct()
    new = sorted(set(raw_runs(spark, zones, name)) - {r[0] for r in known.collect()})
    if not new:
        return
    unusable = (~has_keys(INVOICE_KEYS) | F.col("ref").isNull()).cast("long")
    counted = read_raw(spark, zones, name).where(F.col("dt_proc").isin(new)).select(
        "dt_proc", F.lit(1).alias("rows"), unusable.alias("bad")
    )
    if exists(spark, zones.rejects(name)):
        lines = read_rejects(spark, zones, name).where(F.col("dt_proc").isin(new) & (F.col("motivo") == MALFORMED))
        counted = counted.unionByName(lines.select("dt_proc", F.lit(0).alias("rows"), F.lit(1).cast("long").alias("bad")))
    runs = counted.groupBy("dt_proc").agg(F.sum("rows").alias("qtd_registros"), F.sum("bad").alias("qtd_rejeitados"))
    write_control(runs.withColumn("tb_name", F.lit(name)).select(*CONTROL.names), zones.control(name))
