"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation flips signs at random and applies a fast Hadamard transform, three times
over. A rotated unit vector hashes to the signed axis nearest to it, the coordinate of
largest magnitude. Each of `tables` tables has a rotation of its own; a query probes in each
the axes nearest to it, and everything in those buckets is scored exactly on the
original vectors.

Nearness is the inner product. If lengths differ, vectors get one coordinate more, which
makes them equally long and leaves their inner products with the queries as they are.

Equal vectors are searched as one, with as many of their smallest ids as a result can
need. A bucket is searched in blocks of bounded size, members by queries, each block a
matrix product that keeps a query's best `k`; no pair of vectors becomes a row. With one
axis per table the share of the members that is scored does not depend on their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billbook.llm.common import written


@dataclass(frozen=True)
class CrossPolytope:
    """Parameters of the index; the defaults find over 0.9 of the 20 nearest of random vectors in 64 dimensions.

    `probes` is the share of the signed axes that a query probes in each table, one axis at least.
    """

    tables: int = 12
    probes: float = 0.1
    seed: int = 5
    members_per_block: int = 8_192
    queries_per_block: int = 2_048


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row; their length is a power of two."""
    n, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(n, width // (2 * step), 2, step)
        rows = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2)
        rows = rows.reshape(n, width)
        step *= 2
    return rows / np.sqrt(width)


def rotated(rows: np.ndarray, table: int, seed: int) -> np.ndarray:
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, rows.shape[1]))
    for sign in signs:
        rows = hadamard(rows * sign)
    return rows


def nearest_axes(rows: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the `count` nearest signed axes, nearest first: i for +axis i, width + i for -axis i."""
    signed = np.concatenate((rows, -rows), axis=1)
    return np.argsort(-signed, axis=1, kind="stable")[:, :count]


def _hashed_rows(vectors: np.ndarray, longest: float, equal: bool, query: bool) -> np.ndarray:
    """Unit vectors to be rotated, padded to a power of two."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    if equal or query:
        rows = vectors / length
        extra = np.zeros_like(length)
    else:
        rows = vectors / longest
        extra = np.sqrt(np.maximum(0.0, 1.0 - (length / longest) ** 2))
    if not equal:
        rows = np.concatenate((rows, extra), axis=1)
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def _valid(vector: Column) -> Column:
    """Neither NULL, empty nor zero, and all components finite."""
    infinite = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vectors(df: DataFrame) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    return df.select("vec_id", vector.alias("v")).where(F.col("vec_id").isNotNull() & _valid(F.col("v"))).distinct()


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten()).reshape(len(lists), -1).astype(np.float64)


def search(
    candidates: DataFrame, queries: DataFrame, k: int = 20, index: CrossPolytope = CrossPolytope()
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, nearest first, rank from 1.

    Both frames have (vec_id, embedding); other columns are left out. Scores are inner products in double
    precision, ties go to the smaller vec_id. A query is no candidate of its own: rows of its vec_id are
    left out. Vectors that are NULL, empty, zero or have NULL or non-finite components take no part, nor
    do rows without vec_id; repeated rows count once. Vectors have inner products with those of as many
    components only, so each number of components, of which a table has few, is searched on its own. A query
    with fewer than k found is searched again among all candidates.
    """
    rows, asked = _vectors(candidates), _vectors(queries)
    widths = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())
    if len(widths) < 2:
        return _search(rows, asked, k, index)
    return reduce(DataFrame.unionByName, [
        _search(*[df.where(F.size("v") == width) for df in (rows, asked)], k, index) for width in widths
    ])


def _search(rows: DataFrame, asked: DataFrame, k: int, index: CrossPolytope) -> DataFrame:
    """`search` among vectors of one width."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    # Of equal vectors, the k + 1 smallest ids are all that a result can show.
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    ids = rows.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= k + 1)
    members = written(ids.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "members")
    asked = written(asked, "queries")
    total, least, most = members.agg(F.count(F.lit(1)), F.min(norm), F.max(norm)).first()
    if not total:
        return _ranked(asked.sparkSession.createDataFrame([], _FOUND), k)
    space = (float(most), bool(most - least <= 1e-6 * most))
    found = written(_searched(members, asked, k, index, space, index.probes), "found")
    ranked = _ranked(found, k)
    enough = min(k, ids.select("vec_id").distinct().count() - 1)
    got = found.groupBy("query_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("n"))
    short = asked.join(got.where(F.col("n") >= enough), F.col("vec_id") == F.col("query_id"), "leftanti")
    if enough < 1 or short.isEmpty():
        return ranked
    one_table = CrossPolytope(1, 1.0, index.seed, index.members_per_block, index.queries_per_block)
    everything = _ranked(_searched(members, short, k, one_table, space, 1.0), k)
    return ranked.join(short, F.col("query_id") == short["vec_id"], "leftanti").unionByName(everything)


_FOUND = "query_id bigint, ids array<bigint>, scores array<double>"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query's distinct (score, id); lists of a query are k long at most, one per block."""
    pair = F.explode(F.arrays_zip("scores", "ids")).alias("x")
    each = found.select("query_id", pair).select("query_id", F.col("x.scores").alias("score"), F.col("x.ids").alias("vec_id"))
    best = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _placed(
    df: DataFrame, own: list[str], index: CrossPolytope, space: tuple[float, bool], probes: float, query: bool
) -> DataFrame:
    """Each row once per table and probed bucket: (bucket, *own, v)."""
    rows = df.select(*own, "v")
    longest, equal = space

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4_096):
                part = batch.slice(first, 4_096)
                units = _hashed_rows(_matrix(part.column("v")), longest, equal, query)
                wide = 2 * units.shape[1]
                for table in range(index.tables):
                    axes = nearest_axes(rotated(units, table, index.seed), max(1, ceil(probes * wide)))
                    taken = pa.array(np.repeat(np.arange(len(axes)), axes.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(axes.ravel() + table * wide, pa.int64()), *(c.take(taken) for c in part.columns)],
                        ["bucket", *part.schema.names],
                    )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"bucket bigint, {kinds}")


def _searched(
    members: DataFrame, asked: DataFrame, k: int, index: CrossPolytope, space: tuple[float, bool], probes: float
) -> DataFrame:
    """(query_id, ids, scores): each query's best in every block of its buckets."""
    placed = written(_placed(members, ["ids"], index, space, 0.0, False), "placed")
    probing = _placed(asked.withColumnRenamed("vec_id", "query_id"), ["query_id"], index, space, probes, True)
    probing = written(probing, "probing")
    # One row per bucket, and there are two per table and axis, whatever the data's size.
    blocks = lambda df, size, name: df.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name)
    )
    grid = F.broadcast(
        blocks(placed, index.members_per_block, "rows").join(
            blocks(probing, index.queries_per_block, "columns"), "bucket"
        )
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    left = placed.join(grid, "bucket").select(
        "bucket", one("v", "rows").alias("row"), every("columns").alias("column"), "ids", "v"
    )
    right = probing.join(grid, "bucket").select(
        "bucket", every("rows").alias("row"), one("query_id", "columns").alias("column"), "query_id", "v"
    )

    def best(own: pa.Table, other: pa.Table) -> pa.Table:
        if not own.num_rows or not other.num_rows:
            return pa.table({"query_id": [], "ids": [], "scores": []}, schema)
        x, q = _matrix(own.column("v")), _matrix(other.column("v"))
        owned = own.column("ids").to_pylist()
        numbers, ids, scores = [], [], []
        take = min(k + 1, len(x))
        lengths, error = np.linalg.norm(x, axis=1).max(), 4 * x.shape[1] * np.finfo(np.float64).eps
        for first in range(0, len(q), 256):
            product = q[first : first + 256] @ x.T
            border = -np.partition(-product, take - 1, axis=1)[:, take - 1]
            # All that may tie with the last: both products are off by a few units of the terms' sizes.
            slack = error * lengths * np.linalg.norm(q[first : first + 256], axis=1)
            for i in range(len(product)):
                places = np.nonzero(product[i] >= border[i] - slack[i])[0]
                values = (x[places] * q[first + i]).sum(axis=1).tolist()
                query = other.column("query_id")[first + i].as_py()
                pairs = sorted(
                    (-value, vec) for place, value in zip(places.tolist(), values, strict=True)
                    for vec in owned[place] if vec != query
                )[:k]
                numbers.append(query)
                ids.append([vec for _, vec in pairs])
                scores.append([-value for value, _ in pairs])
        return pa.table({"query_id": numbers, "ids": ids, "scores": scores}, schema)

    schema = pa.schema(
        [("query_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))]
    )
    key = ["bucket", "row", "column"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(best, _FOUND)
