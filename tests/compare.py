"""Spark rows against DuckDB rows of the same query."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql) -> list[str]:
    """Empty when columns, row count and every value agree."""
    result = con.execute(sql)
    theirs = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(theirs):
        return [f"columns {sorted(set(df.columns) ^ set(theirs))[:6]}"]
    ours, expected = _rows(df.columns, df.collect()), _rows(theirs, result.fetchall())
    if ours == expected:
        return []
    extra, missing = ours - expected, expected - ours
    return [
        f"rows {sum(ours.values())} vs {sum(expected.values())}, "
        f"{sum(extra.values())} only in Spark, {sum(missing.values())} only in DuckDB",
        *[f"spark {r[:14]}" for r in sorted(extra, key=str)[:3]],
        *[f"duck  {r[:14]}" for r in sorted(missing, key=str)[:3]],
    ]
