"""Merkle manifest of a dataset, by slot pivot.

Rows are the leaves of one tree per group, the groups' roots the leaves of one tree above
them. A tree's nodes of one level stand at positions 0, 1, 2 ...; while several remain, every
`fanout` consecutive ones (the last run may have fewer, even one) become the SHA-256 of their
digests, side by side as lowercase hex.

Slot pivot: conditional aggregates spread the nodes below one ancestor into slot columns, one
for each place. Concatenating the columns of a run hashes the run; leaving out a node's own
column gives its siblings. One pivot has the slots of as many levels as fit into `SLOTS`
columns, so that a tree of n leaves takes log(n) / log(SLOTS) shuffles upwards, of n,
n / SLOTS, ... rows. Downwards every block of slots meets the path of its own root and hands
it on, longer by its own levels, so that paths of whole length appear with the leaves only.

Positions come from a range partitioning with a count of each partition's rows: no group,
however large, is in one task, and nothing but the height of the highest tree reaches the
driver. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billbook.llm.common import written

# Slot columns of one pivot: four levels of a binary tree.
SLOTS = 16

STEP = "array<struct<before:string,after:string>>"
ROWS_BITS = 33  # of monotonically_increasing_id, below the number of the partition


def record_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of a record: `-` for NULL, else the UTF-8 length, `:` and the value, all side by side."""

    def encoded(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def manifest(leaves: DataFrame, group: str, order: str, digest: str, carry: Sequence[str] = (), fanout: int = 2) -> DataFrame:
    """(group, order, digest, *carry, subroot, root, path) of every row of `leaves`.

    `path` lists from the leaf to the root what stands before and after the node in its run; a
    node that is alone in its run has an empty step. Groups ascend as text, NULL first and then by
    UTF-8 bytes, the rows of a group by `order`, NULL first; ties go by digest. Rows that agree in all of
    that are alike, and each of them gets a place, so repeated rows stay. An empty table gives no
    rows. Other columns are left out; `carry` are columns to keep. The digest must not be NULL.
    """
    if fanout < 2:
        raise ValueError("a run has two nodes or more")
    names = [group, order, *carry]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("row")
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree")
    rows = leaves.select(tree, F.col(order).alias("o"), F.col(digest).alias("digest"), row)
    bottom = positions(rows, ["o", "digest"], fanout, "leaves")
    lower, subroots = _rise(bottom, fanout)
    below = F.struct(F.col("tree").alias("tree"), F.col("digest").alias("subroot")).alias("row")
    top = positions(subroots.select(F.lit("").alias("tree"), "digest", below), ["row"], fanout, "subroots")
    upper, root = _rise(top, fanout)

    root = root.select("tree", "pos", F.col("digest").alias("root"), F.array().cast(STEP).alias("up"))
    tops = _descend(upper, root, top, ["root"], fanout).select("row.*", F.lit(0).cast("long").alias("pos"), "root", "up")
    found = _descend(lower, tops, bottom, ["subroot", "root"], fanout)
    return found.select(
        *[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(names)],
        F.col("digest").alias(digest), "subroot", "root", F.col("up").alias("path"),
    )


def positions(df: DataFrame, order: Sequence[str], fanout: int, purpose: str) -> DataFrame:
    """Add pos, the place of a row in its `tree`, and height, the number of levels above it, as a written table.

    Rows are sorted by range over all partitions, a tree of any size over many. The numbers within a
    partition and a table of (tree, partition, rows) together give the place. `tree` is not NULL.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written first, as finding the ranges reads everything once more. The last key cuts apart equal rows.
    keys = ["tree", *order, "_tie"]
    tied = written(df, purpose).withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
    numbered = written(ranged.withColumn("_at", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_at", ROWS_BITS).alias("_part")
    counts = numbered.groupBy("tree", part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
        _height(F.sum("_rows").over(whole), fanout).alias("height"),
    )
    found = numbered.withColumn("_part", part).join(starts, ["tree", "_part"])
    return written(found.select(*df.columns, (F.col("_at") + F.col("_offset")).alias("pos"), "height"), purpose)


def _height(leaves: Column, fanout: int) -> Column:
    """How often runs of `fanout` must be hashed until one node is left."""
    powers, n = [], 1
    while n < 2**62:
        powers.append(n)
        n *= fanout
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < leaves))


def _levels(fanout: int) -> int:
    """Levels of one pivot."""
    levels = 1
    while fanout ** (levels + 1) <= SLOTS:
        levels += 1
    return levels


Rounds = list[tuple[DataFrame, int]]


def _rise(nodes: DataFrame, fanout: int) -> tuple[Rounds, DataFrame]:
    """Blocks of slots per round, each with the number of levels below it, and (tree, pos, digest) of the roots."""
    levels = _levels(fanout)
    highest = nodes.agg(F.max("height")).first()[0] or 0
    here = nodes.select("tree", "pos", "height", F.struct("digest", "row").alias("node"))
    rounds: Rounds = []
    for done in range(0, highest, levels):
        blocks = written(_pivoted(here, fanout**levels), "slots")
        rounds.append((blocks, done))
        root = F.struct(F.col(_name(levels, 0)).alias("digest")).alias("node")
        here = _hashed(blocks, fanout, levels, done).select("tree", "pos", "height", root)
    return rounds, here.select("tree", "pos", "node.digest")


def _pivoted(nodes: DataFrame, slots: int) -> DataFrame:
    """One row per `slots` consecutive places of a tree, and one column for each."""
    columns = [f"any_value(case when pmod(pos, {slots}) = {i} then node end, true) as slot_{i}" for i in range(slots)]
    block = F.expr(f"pos div {slots}").alias("pos")
    return nodes.groupBy("tree", block).agg(F.max("height").alias("height"), *map(F.expr, columns))


# What follows writes columns as SQL text: one call to the JVM for all columns of a level.


def _name(level: int, place: int) -> str:
    return f"d{level}_{place}"


def _run(level: int, run: int, fanout: int) -> list[str]:
    return [_name(level, run * fanout + i) for i in range(fanout)]


def _joined(columns: Sequence[str]) -> str:
    return f"concat_ws('', {', '.join(columns)})" if columns else "''"


def _hashed(blocks: DataFrame, fanout: int, levels: int, done: int) -> DataFrame:
    """Add a column for each node of each level of the blocks; NULL where there is none.

    Above the height of its tree the only node is handed on as it is.
    """
    out = blocks.selectExpr("*", *[f"slot_{i}.digest as {_name(0, i)}" for i in range(fanout**levels)])
    for level in range(levels):
        runs = [_run(level, k, fanout) for k in range(fanout ** (levels - level - 1))]
        out = out.selectExpr("*", *[
            f"case when height <= {done + level} then {run[0]} "
            f"when {run[0]} is not null then sha2({_joined(run)}, 256) end as {_name(level + 1, k)}"
            for k, run in enumerate(runs)
        ])
    return out


def _children(blocks: DataFrame, carried: Sequence[str], fanout: int, levels: int, done: int) -> DataFrame:
    """From blocks with `up`, the path of their root, the nodes in their slots with theirs."""
    out = _hashed(blocks, fanout, levels, done).withColumnRenamed("up", f"p{levels}_0")
    for level in reversed(range(levels)):
        paths = []
        for k in range(fanout ** (levels - level - 1)):
            run = _run(level, k, fanout)
            for own, name in enumerate(run):
                step = f"named_struct('before', {_joined(run[:own])}, 'after', {_joined(run[own + 1:])})"
                paths.append(
                    f"case when height <= {done + level} then p{level + 1}_{k} when {name} is not null "
                    f"then concat(array({step}), p{level + 1}_{k}) end as p{level}_{k * fanout + own}"
                )
        out = out.selectExpr("*", *paths)
    slots = fanout**levels
    below = ", ".join(f"named_struct('pos', pos * {slots} + {i}, 'node', slot_{i}, 'up', p0_{i})" for i in range(slots))
    every = out.selectExpr("tree", *carried, f"explode(filter(array({below}), n -> n.node is not null)) as n")
    return every.select("tree", *carried, "n.pos", "n.node", "n.up")


def _descend(rounds: Rounds, roots: DataFrame, nodes: DataFrame, carried: Sequence[str], fanout: int) -> DataFrame:
    """(digest, row, up, *carried) of every node at the bottom; roots has tree, pos, up and `carried`."""
    if not rounds:
        return nodes.join(roots, ["tree", "pos"]).select("digest", "row", "up", *carried)
    levels = _levels(fanout)
    found = roots
    for blocks, done in reversed(rounds):
        above = found.select("tree", "pos", "up", *carried)
        found = _children(blocks.join(above, ["tree", "pos"]), carried, fanout, levels, done)
    return found.select("node.*", "up", *carried)
