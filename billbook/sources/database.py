"""Database tables as distributed snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A whole table read as `partitions` range queries on `partition_column`.

    The queries are separate statements: if the source changes meanwhile they may
    see different states of it, unlike one statement would. Extract from a
    replica that stands still, or with `partitions=1`. The column is a number,
    date or timestamp; Spark refuses text. `lower` and `upper` only set the stride; rows outside them are still read.
    Credentials and driver options go into `options` and come from the caller.
    """
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            **{"fetchsize": "10000", **options},
        )
        .load()
    )


def jdbc_parts(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], **options: str
) -> DataFrame:
    """A whole table read as one query per predicate, such as `equal_depth_predicates` gives.

    They are separate statements, as those of `jdbc_table` are.
    """
    properties = {"fetchsize": "10000", **options}
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)


# Quantiles taken for each part: heavy values are told from others by how many they span.
UNITS = 16


def equal_depth_predicates(df: DataFrame, column: str, partitions: int) -> list[str]:
    """SQL conditions on `column` that split a table into about `partitions` parts of as many rows.

    Every row meets exactly one of them, NULL too, also if the table has changed since: the outer ones are open. `df` is
    what depths are taken from: the last snapshot, or the column alone read by `jdbc_table`. It is
    summed up in one pass by mergeable quantile sketches, of which the driver gets `UNITS` numbers per
    part. A value with more rows than a part should have is a part of its own; strides of equal width, by contrast,
    have as many rows as the values happen to. The column holds whole numbers, decimals, dates or timestamps.
    """
    if partitions < 1:
        raise ValueError("a table has one part or more")
    steps = partitions * UNITS
    shares = [i / steps for i in range(1, steps)]
    found = df.agg(F.percentile_approx(column, shares, 4 * steps)).first()[0]
    out, at, weight = [], None, 0
    for start, closed, units in _pieces(found or []):
        if weight and weight + units > UNITS:
            out.append(_between(column, at, (start, closed)))
            at, weight = (start, closed), 0
        weight += units
    return [*out, _between(column, at, None), f"{column} IS NULL"]


def _pieces(quantiles: Sequence) -> list[tuple]:
    """(start, whether it belongs to the piece, units) of pieces in order; a value that spans several units is one of its own."""
    if not quantiles:
        return []
    spans: dict = {}
    for value in quantiles:
        spans[value] = spans.get(value, 0) + 1
    pieces: list[tuple] = [(None, True, 1)]
    for value, units in spans.items():
        pieces.append((value, True, units))
        if units > 1:
            pieces.append((value, False, 1))
    return pieces


def _between(column: str, start: tuple | None, end: tuple | None) -> str:
    tests = []
    if start is not None:
        tests.append(f"{column} {'>=' if start[1] else '>'} {_literal(start[0])}")
    if end is not None:
        tests.append(f"{column} {'<' if end[1] else '<='} {_literal(end[0])}")
    return " AND ".join(tests) or f"{column} IS NOT NULL"


def _literal(value: int | Decimal | date) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, (int, Decimal)):
        return str(value)
    raise TypeError(f"no depths of a {type(value).__name__}")
