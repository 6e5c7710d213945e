"""Snapshots in the ingestion zone: one directory of headed CSV files per run."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billbook.config import Zones
from billbook.schema import INGESTION, LINE
from billbook.sources.folders import exists, subfolders

# Quotes are doubled and blanks kept, as most database extracts have it.
CSV = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def extract_snapshot(df: DataFrame, zones: Zones, table: str, run_ts: str) -> str:
    """Write a full snapshot of `df` as this run's directory and return its path.

    Every task writes its own file. A run that is repeated replaces its own
    directory; failures raise.
    """
    path = zones.ingestion_run(table, run_ts)
    (
        df.write.mode("overwrite")
        .options(**CSV, timestampFormat="yyyy-MM-dd HH:mm:ss", timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return path


def newest_run(spark: SparkSession, zones: Zones, table: str) -> str:
    """Directory of the latest run that was written to its end. Run names sort by time.

    Lists one directory level on the driver; no job is started.
    """
    for run in reversed(subfolders(spark, zones.ingestion(table))):
        if exists(spark, f"{zones.ingestion(table)}/{run}/_SUCCESS"):
            return f"{zones.ingestion(table)}/{run}"
    raise FileNotFoundError(f"no snapshot under {zones.ingestion(table)}")


def read_ingestion(
    spark: SparkSession, zones: Zones, table: str, run_ts: str | None = None, permissive: bool = False
) -> DataFrame:
    """One snapshot, every column text: the run given, or the newest.

    The schema is stated, so no pass is spent on finding it, and a header that
    disagrees with it raises. Malformed lines are left out: `read_lines` has them.
    `permissive` reads them too, surplus fields cut off and missing ones NULL.
    """
    if not permissive:
        return well_formed(read_lines(spark, zones, table, run_ts))
    path = _run_path(spark, zones, table, run_ts)
    return spark.read.schema(INGESTION[table]).options(**CSV, enforceSchema="false").csv(path)


def read_lines(spark: SparkSession, zones: Zones, table: str, run_ts: str | None = None) -> DataFrame:
    """One snapshot with a column `LINE`: the text of a malformed line, NULL for the others.

    Malformed is a line with more or fewer fields than the table has, or with a quote that is not closed on it:
    a decimal comma, a cut line, a value over two lines. What the other columns of such a line hold
    is no value of the table.
    """
    path = _run_path(spark, zones, table, run_ts)
    schema, options = line_reader(spark, path, table)
    return parsed_lines(spark.read.schema(schema).options(**options).csv(path), table)


def well_formed(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(LINE).isNull()).drop(LINE)


def malformed(lines: DataFrame) -> DataFrame:
    """(`LINE`,) of the malformed lines."""
    # Spark refuses to read nothing but the text of lines it could not parse, so a field is read with it.
    field = F.col(lines.columns[0])
    return lines.where(F.col(LINE).isNotNull()).select(F.coalesce(LINE, field).alias(LINE))


def _run_path(spark: SparkSession, zones: Zones, table: str, run_ts: str | None) -> str:
    return zones.ingestion_run(table, run_ts) if run_ts else newest_run(spark, zones, table)


def line_reader(spark: SparkSession, path: str | None, table: str) -> tuple[T.StructType, dict[str, str]]:
    """Schema and options with which a CSV reader leaves lines as they are, for `parsed_lines`.

    Quotes are ordinary characters to it, so that the fields of a line together are its text. Headers may be quoted:
    one line of the snapshot at `path` is read to see; without a path they are not.
    """
    first = spark.read.text(path).head() if path else None
    quote = '"' if first and first[0].startswith('"') else ""
    names = [f"{quote}{n}{quote}" for n in INGESTION[table].names]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, LINE]])
    return schema, {**CSV, "quote": "", "enforceSchema": "false", "columnNameOfCorruptRecord": LINE}


def parsed_lines(raw: DataFrame, table: str) -> DataFrame:
    """The columns of the table and `LINE`, from what a reader set up by `line_reader` returns; further columns stay.

    A line without quotes, as nearly all are, is parsed once, and its text is not put together.
    """
    fields, names = raw.columns[:len(INGESTION[table])], INGESTION[table].names
    plain = [F.col(f"`{f}`") for f in fields]
    whole = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in plain])
    line = F.coalesce(F.col(LINE), whole)
    quoted = reduce(or_, [F.coalesce(c.contains('"'), F.lit(False)) for c in [*plain, F.col(LINE)]])
    options = {k: v for k, v in CSV.items() if k != "header"} | {"columnNameOfCorruptRecord": LINE}
    schema = ", ".join(f"{n} string" for n in [*names, LINE])
    again = F.when(quoted, F.from_csv(line, schema, options))
    further = [F.col(c) for c in raw.columns if c not in (*fields, LINE)]
    unclosed = F.when(quoted, _unclosed(line)).otherwise(False)
    read = raw.select(*plain, F.col(LINE), *further, again.alias("_quoted"), unclosed.alias("_unclosed"))
    value = lambda column, name: F.when(F.col("_quoted").isNull(), column).otherwise(F.col("_quoted")[name])
    bad = value(F.col(LINE), LINE).isNotNull() | F.col("_unclosed")
    return read.select(
        *[value(c, n).alias(n) for c, n in zip(plain, names)], *further, F.when(bad, line).alias(LINE)
    )


def _unclosed(line: Column) -> Column:
    """An odd number of quotes: doubled ones and those around a value come in pairs."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
