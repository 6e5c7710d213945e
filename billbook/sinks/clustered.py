"""Copies of lake tables in which the rows of one customer lie together.

The lake's tables are laid out for reading whole months: a customer's rows are in every file. A clustered copy
is cut into ranges of (month, customer), each a sorted file with a Bloom filter of its customers. A search
for a customer then reads, in each month, the row groups whose range holds it, and none where the filter
says that it is not there. Pruning is Spark's own: the condition only has to reach the scan.

A copy is as old as its last `cluster`; loads do not touch it.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billbook.config import BY_CUSTOMER, Zones
from billbook.plans.spec import BookSpec
from billbook.sources.folders import remove, subfolders
from billbook.sources.lake import read_clustered, read_table

ROWS_PER_FILE = 1_000_000


def ranges(df: DataFrame, parts: int, by: str = "id_cliente") -> DataFrame:
    """`df` in `parts` sorted ranges of (month, customer).

    Rows of one customer and month are told apart by a hash of the whole row, so that a customer with more
    rows than a range should hold gets several. The hash makes a re-run task place its rows as before.
    """
    row = F.xxhash64(*df.columns)
    return df.repartitionByRange(parts, "ref", by, row).sortWithinPartitions("ref", by)


def cluster(
    spark: SparkSession,
    zones: Zones,
    name: str,
    refs: Sequence[int] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    spec: BookSpec = BookSpec(),
) -> str:
    """Make the clustered copy of a lake table anew, or of its months `refs` only; returns the copy's path.

    No file has more than `rows_per_file` rows, and each month at most two files that are not full for a
    range that ends in it. Wide rows, as the book's, go to several row groups of a file by their bytes. With
    `refs`, a month that is gone from the table is taken out of the copy as well. Rows without a month or customer are kept.
    """
    table, path = read_table(spark, zones, name, spec), zones.curated(name + BY_CUSTOMER)
    if refs is not None:
        table = table.where(F.col("ref").isin([int(r) for r in refs]))
    rows = table.count()
    (
        ranges(table, max(1, ceil(rows / rows_per_file)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if refs is None else "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .option("parquet.bloom.filter.enabled#id_cliente", "true")
        .option("parquet.bloom.filter.expected.ndv#id_cliente", rows_per_file)
        .partitionBy("ref")
        .parquet(path)
    )
    if refs is not None:
        there = {r["ref"] for r in table.select("ref").distinct().collect()}
        gone = {f"ref={int(r)}" for r in refs if int(r) not in there}
        for folder in gone.intersection(subfolders(spark, path)):
            remove(spark, f"{path}/{folder}")
    return path


def read_customers(
    spark: SparkSession, zones: Zones, name: str, customers: Sequence[int], spec: BookSpec = BookSpec()
) -> DataFrame:
    """All rows of a few customers, from the clustered copy. For many, join the table with a frame of them."""
    return read_clustered(spark, zones, name, spec).where(F.col("id_cliente").isin(list(customers)))
