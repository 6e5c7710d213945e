"""Command line for a scheduler: `spark-submit --py-files billbook.zip run_job.py <job> ...`.

Takes the wall clock here, once, and nowhere else.
"""

from __future__ import annotations

import argparse
import os
from datetime import datetime

from billbook.config import AS_WRITTEN, BY_CUSTOMER, INTENDED, Zones
from billbook.plans.jobs import book_job, extract_job, load_job
from billbook.plans.spec import BookSpec
from billbook.schema import INGESTION, INVOICE_KEYS, RAW
from billbook.session import build_session
from billbook.sinks.clustered import ROWS_PER_FILE, cluster
from billbook.sources.database import jdbc_table
from billbook.sources.folders import exists
from billbook.sources.lake import register_zones


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="billbook")
    top.add_argument("--root", required=True, help="URI of the lake")
    top.add_argument(
        "--shuffle-partitions", type=int, default=2_000,
        help="partitions a shuffle starts with; adaptive execution joins small ones",
    )
    top.add_argument("--run-ts", default=datetime.now().strftime("%Y%m%d%H%M%S"))
    jobs = top.add_subparsers(dest="job", required=True)

    extract = jobs.add_parser("extract", help="database table to ingestion zone")
    extract.add_argument("table", choices=sorted(INGESTION))
    extract.add_argument("--url", required=True)
    extract.add_argument("--schema", default="public")
    extract.add_argument("--partition-column", required=True)
    extract.add_argument("--lower", required=True)
    extract.add_argument("--upper", required=True)
    extract.add_argument("--partitions", type=int, default=64)

    load = jobs.add_parser("load", help="ingestion zone to raw zone")
    load.add_argument("table", choices=sorted(INGESTION))
    load.add_argument("--snapshot-ts", help="run to load; the newest if left out")
    load.add_argument("--write-mode", choices=("append", "overwrite"), default="append")
    load.add_argument("--control-table", help="audit table; after the raw table if left out")
    load.add_argument("--control-format", choices=("parquet", "csv"), default="parquet")
    load.add_argument("--mode", choices=(INTENDED, AS_WRITTEN), default=INTENDED)

    book = jobs.add_parser("book", help="raw zone to stage and book")
    book.add_argument("--ref-date", required=True)
    book.add_argument("--documented", action="store_true")
    book.add_argument("--by-payment", action="store_true", help="keep all payments of an invoice, not its latest")
    book.add_argument("--mode", choices=(INTENDED, AS_WRITTEN), default=INTENDED)

    clustered = jobs.add_parser("cluster", help="copy of a lake table clustered by customer, for looking customers up")
    clustered.add_argument("table", choices=sorted((*RAW, "stage", "book")))
    clustered.add_argument("--months", type=int, nargs="+", help="only these (yyyyMM); all if left out")
    clustered.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)

    sql = jobs.add_parser("sql", help="run a statement over the lake's tables")
    sql.add_argument("statement")
    sql.add_argument("--database", default="lake")
    sql.add_argument("--output", help="URI that gets the whole result")
    sql.add_argument("--output-format", choices=("parquet", "csv"), default="parquet")
    sql.add_argument("--show", type=int, metavar="N", help="print the first N rows as a preview")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if args.job == "sql" and args.output is None and args.show is None:
        parser().error("sql needs --output for the whole result, or --show for a preview")
    spark = build_session(**{
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(args.shuffle_partitions),
    })
    zones = Zones(args.root)
    if args.job == "extract":
        source = jdbc_table(
            spark, args.url, f"{args.schema}.{args.table}", args.partition_column,
            args.lower, args.upper, args.partitions,
            user=os.environ["DB_USER"], password=os.environ["DB_PASSWORD"],
        )
        print(extract_job(source, zones, args.table, args.run_ts))
    elif args.job == "load":
        rows = load_job(
            spark, zones, args.table, args.run_ts, args.snapshot_ts, args.mode,
            args.write_mode, args.control_format, args.control_table,
        )
        print(f"{args.table}: {rows} rows")
    elif args.job == "book":
        spec = BookSpec().documented() if args.documented else BookSpec()
        keys = (*INVOICE_KEYS, "id_pagamento") if args.by_payment else INVOICE_KEYS
        book_job(spark, zones, args.ref_date, args.run_ts, spec, args.mode, payment_keys=keys)
    elif args.job == "cluster":
        print(cluster(spark, zones, args.table, args.months, args.rows_per_file))
    else:
        tables = (*RAW, "stage", "book")
        copies = [n + BY_CUSTOMER for n in tables if exists(spark, zones.curated(n + BY_CUSTOMER))]
        register_zones(spark, zones, args.database, (*tables, *copies))
        spark.sql(f"USE {args.database}")
        result = spark.sql(args.statement)
        if args.output:
            result.write.format(args.output_format).option("header", "true").save(args.output)
        if args.show is not None:
            print(f"preview, {args.show} rows at most:")
            result.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
