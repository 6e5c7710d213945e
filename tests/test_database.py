"""Equal-depth parts of a table that stands in for a database's."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billbook.sources.database import equal_depth_predicates


def _parts(df, column, partitions, other=None):
    """Rows of each part; every row of the table is in exactly one."""
    predicates = equal_depth_predicates(df, column, partitions)
    table = df if other is None else other
    flags = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    marked = table.select(column, *[f.alias(f"p{i}") for i, f in enumerate(flags)], sum(flags).alias("n"))
    assert marked.where("n <> 1").isEmpty()
    sizes = marked.agg(*[F.sum(f"p{i}").alias(f"p{i}") for i in range(len(flags))]).first()
    return dict(zip(predicates, [s or 0 for s in sizes]))


def _even(df, column, partitions):
    parts = _parts(df, column, partitions)
    mean = sum(parts.values()) / len(parts)
    top = {r[0] for r in df.groupBy(column).count().where(F.col("count") > mean).collect()}
    for predicate, rows in parts.items():
        single = df.where(predicate).select(column).distinct().limit(2).collect()
        assert rows <= 2 * mean or [r[0] for r in single][1:] == [] and single[0][0] in top
    return parts


def test_skewed_numbers(spark):
    skewed = spark.range(30_000).select(F.floor(F.pow(F.lit(1.0004), F.col("id"))).cast("long").alias("k"))
    parts = _even(skewed, "k", 10)
    assert 8 <= len(parts) <= 14


def test_hot_values_and_nulls(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 7 == 0, None).when(F.col("id") % 5 == 0, 501).otherwise(F.col("id")).cast("long").alias("k")
    )
    parts = _even(rows, "k", 8)
    assert any(rows > 13_000 for rows in parts.values()) and parts["k IS NULL"] > 0


@pytest.mark.parametrize("kind, expression", [
    ("date", "date_add(date'2020-01-01', cast(id % 900 as int))"),
    ("timestamp", "timestamp_micros(1600000000000000 + id * 1234567)"),
    ("decimal(15,2)", "cast(id * id / 100 as decimal(15,2))"),
    ("int", "cast(id % 5 as int)"),
])
def test_types(spark, kind, expression):
    df = spark.range(6_000).selectExpr(f"cast({expression} as {kind}) as k")
    assert len(_even(df, "k", 6)) >= 5


def test_a_table_that_has_grown_since(spark):
    before = spark.range(1000).select(F.col("id").alias("k"))
    after = spark.range(-500, 3000).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("k"))
    assert sum(_parts(before, "k", 4, after).values()) == 3500


def test_empty_single_and_unfit_columns(spark):
    empty = spark.createDataFrame([], "k bigint")
    assert equal_depth_predicates(empty, "k", 4) == ["k IS NOT NULL", "k IS NULL"]
    assert sum(_parts(spark.createDataFrame([(None,)] * 3, "k bigint"), "k", 2).values()) == 3
    assert sum(_parts(spark.createDataFrame([(7,)] * 9, "k bigint"), "k", 3).values()) == 9
    assert len(equal_depth_predicates(spark.range(9).withColumnRenamed("id", "k"), "k", 1)) >= 2
    with pytest.raises(TypeError):
        equal_depth_predicates(spark.range(9).selectExpr("cast(id as double) as k"), "k", 2)
    with pytest.raises(ValueError):
        equal_depth_predicates(empty, "k", 0)


def test_literals():
    from billbook.sources.database import _literal

    assert _literal(date(2024, 1, 2)) == "DATE '2024-01-02'" and _literal(Decimal("1.50")) == "1.50"
    assert _literal(datetime(2024, 1, 2, 3, 4, 5, 6)) == "TIMESTAMP '2024-01-02 03:04:05.000006'"
