"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1) and BENCH_CPUS the threads. Each
query runs twice into a sink that discards rows; the second run counts. `cold`
has what is timed once, with the session's start: writing the raw zone and the
stage. It is not part of the total, nor are `book_10x`, the book of ten copies
of the stage with customers of their own, and `direct_book`, the book as 665
plain conditional aggregates over the same written stage.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billbook.plans.book import feature_book, feature_book_direct, feature_book_long
from billbook.plans.spec import BookSpec
from billbook.session import build_session
from workload import billing
from workload.queries import QUERIES, written_stage

HEADLINE = (
    "raw_invoices", "raw_payments", "scan_raw_range", "latest_key", "dedup_invoices",
    "dedup_payments", "invoice_payment_join", "days_class", "days_late", "value_class",
    "pct_paid", "window_flags", "stage",
)


def seconds(make: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(shared: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": shared,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    billing.lake(spark, sf_dir)
    load = time.perf_counter() - start
    start = time.perf_counter()
    stage = written_stage(spark, sf_dir)
    write_stage = time.perf_counter() - start

    spec, ref_date = BookSpec(), billing.REF_DATE
    runs: dict[str, Callable[[], DataFrame]] = {
        name: (lambda q=QUERIES[name]: q(spark, sf_dir)) for name in HEADLINE
    }
    runs["book"] = lambda: feature_book(stage, spec, ref_date)
    runs["book_documented"] = lambda: feature_book(stage, spec.documented(), ref_date)
    runs["book_long"] = lambda: feature_book_long(stage, spec, ref_date)

    timings = {}
    for name, make in runs.items():
        seconds(make)
        timings[name] = seconds(make)
    copies = stage.crossJoin(spark.range(10).withColumnRenamed("id", "_copy"))
    many = written(copies.withColumn("id_cliente", F.expr("id_cliente + _copy * 1000000000")).drop("_copy"), shared)
    seconds(lambda: feature_book(many, spec, ref_date))
    ten_fold = seconds(lambda: feature_book(many, spec, ref_date))
    seconds(lambda: feature_book_direct(stage, spec, ref_date))
    direct = seconds(lambda: feature_book_direct(stage, spec, ref_date))

    print(json.dumps({
        "metric": "total of headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {name: round(t, 3) for name, t in timings.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
        "cold": {"load_raw_zone": round(load, 3), "write_stage": round(write_stage, 3)},
        "book_10x": round(ten_fold, 3),
        "direct_book": round(direct, 3),
    }))


def written(df: DataFrame, shared: str) -> DataFrame:
    df.write.parquet(f"{shared}/ten-stages")
    return df.sparkSession.read.parquet(f"{shared}/ten-stages")


if __name__ == "__main__":
    with tempfile.TemporaryDirectory() as folder:
        main(folder)
