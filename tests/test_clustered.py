"""Clustered copies: the same rows, and searches that read few of them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from billbook.config import BY_CUSTOMER
from billbook.schema import RAW
from billbook.sinks.clustered import cluster, ranges, read_customers
from billbook.sinks.lake import write_raw
from billbook.sources.folders import subfolders
from billbook.sources.lake import read_clustered, read_raw, register_zones

FILE = 5_000


def invoices(spark, rows, customer, month="200001"):
    """`rows` invoices; `customer` and `month` are expressions of the number `id`."""
    made = spark.range(rows).selectExpr(
        "id as id_fatura", f"cast({customer} as bigint) as id_cliente", "'20240201080000' as dt_proc",
        "date'2000-01-05' as data_emissao", "date'2000-01-15' as data_vencimento",
        "cast(id as decimal(15,2)) as valor_fatura", "cast(1 as decimal(15,2)) as valor_pagamento_minimo",
        f"cast({month} as int) as ref",
    )
    return made.select([F.col(f.name).cast(f.dataType) for f in RAW["faturas"]])


def scanned(df):
    """The rows of `df`, and how many its scan had to read."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return rows, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture
def plain_plans(spark):
    """Final plans stand in the query itself, with their metrics."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_same_rows_with_nulls_and_repeated_ones(spark, zones):
    df = invoices(spark, 3_000, "if(id % 7 = 0, null, id % 50)", "if(id % 11 = 0, null, 200001 + id % 3)")
    df = df.unionByName(df.limit(100))
    write_raw(df, zones.raw("faturas"))
    cluster(spark, zones, "faturas", rows_per_file=500)
    assert Counter(read_clustered(spark, zones, "faturas").collect()) == Counter(read_raw(spark, zones, "faturas").collect())


def test_empty_table(spark, zones):
    write_raw(invoices(spark, 10, "id").limit(0), zones.raw("faturas"))
    spark.createDataFrame([], RAW["faturas"]).write.parquet(zones.raw("faturas") + "/dt_proc=20240201080000/ref=200001")
    cluster(spark, zones, "faturas")
    assert read_clustered(spark, zones, "faturas").count() == 0


def test_search_reads_few_rows(spark, zones, plain_plans):
    write_raw(invoices(spark, 60_000, "pmod(hash(id), 600)", "200001 + id % 3"), zones.raw("faturas"))
    cluster(spark, zones, "faturas", rows_per_file=FILE)
    table, condition = read_raw(spark, zones, "faturas"), F.col("id_cliente") == 123
    expected, all_rows = scanned(table.where(condition))
    rows, read = scanned(read_customers(spark, zones, "faturas", [123]))
    assert Counter(rows) == Counter(expected) and rows
    assert all_rows > 50_000
    assert read <= 3 * 2 * FILE

    register_zones(spark, zones, "clustered_test", ("faturas" + BY_CUSTOMER,))
    rows, read = scanned(spark.sql(
        f"select * from clustered_test.faturas{BY_CUSTOMER} where id_cliente = 123 and ref = 200002"
    ))
    assert len(rows) == sum(r["ref"] == 200002 for r in expected)
    assert read <= 2 * FILE


def test_customers_who_are_not_there_cost_nothing(spark, zones, plain_plans):
    """Ids that are too many for a dictionary: only the Bloom filter can tell that odd ones are missing."""
    write_raw(invoices(spark, 400_000, "2 * id"), zones.raw("faturas"))
    cluster(spark, zones, "faturas", rows_per_file=200_000)
    read = [scanned(read_customers(spark, zones, "faturas", [odd]))[1] for odd in range(1001, 800_000, 40_000)]
    assert sum(n > 0 for n in read) <= 2
    assert scanned(read_customers(spark, zones, "faturas", [1000]))[1] > 0


def test_a_customer_of_most_rows_gets_several_ranges(spark):
    df = invoices(spark, 40_000, "if(id % 5 < 3, 7, id)")
    sizes = [r["count"] for r in ranges(df, 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8


def test_months_are_replaced_one_by_one(spark, zones):
    write_raw(invoices(spark, 900, "id % 50", "200001 + id % 3"), zones.raw("faturas"))
    path = cluster(spark, zones, "faturas", rows_per_file=100)
    write_raw(invoices(spark, 90, "id", "200002"), zones.raw("faturas"), "overwrite")
    cluster(spark, zones, "faturas", refs=[200002, 200003], rows_per_file=100)
    counts = {r["ref"]: r["count"] for r in read_clustered(spark, zones, "faturas").groupBy("ref").count().collect()}
    assert counts == {200001: 300, 200002: 90}
    assert subfolders(spark, path) == ["ref=200001", "ref=200002"]
