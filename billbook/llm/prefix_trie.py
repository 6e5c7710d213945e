"""Prefix trie of conversations, by whole-sequence collapse.

A conversation is a sequence of turns, a node of the trie a distinct sequence of first turns. Identical
conversations become one weighted sequence with the list of those that end there. A sequence
that is a proper prefix of another is no leaf, which an anti-join against all proper prefixes tells.
What stands at a node is then summed over the prefixes of the weighted sequences.

A prefix is named by a chain of SHA-256 values: the name of the shorter prefix and the digest of the
next turn, hashed. So texts are read once and never shuffled. Chains are streamed in order through Arrow
batches, so that no conversation has to fit in memory. The ends of a sequence, which may be a third of
all conversations, are sorted by range over all tasks and joined to texts of `ENDS_OF_A_TEXT` ids; what
goes through one task, since SHA-256 takes its input in order, is a stream of these texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billbook.llm.common import importable, written

ROOT = hashlib.sha256(b"").digest()
NO_ENDS = hashlib.sha256(b"").hexdigest()

# At most so many nodes count as crowded parents, and get their children by broadcast.
CROWDED = 1000

CHAIN = "conv_id bigint, depth bigint, node binary, parent binary, words bigint, last boolean"
END_LISTS = "node binary, first bigint, ids string"
ENDS = "node binary, ends_sha256 string"

ENDS_OF_A_TEXT = 10_000


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn, words) from rows (conv_id, turn, role, text): place counts from 1, turn is a digest.

    Turns go by `turn`, NULL first; ties by role, then by the SHA-256 of the text. Equal rows all stay.
    NULL roles and texts are empty. Rows with a NULL conv_id belong to no conversation and are left out.
    Other columns are ignored.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.sha2(text, 256).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    # The role's digest has a fixed length, so that no other role and text give the same turn.
    digest = F.unhex(F.sha2(F.concat(F.sha2("role", 256), F.col("digest")), 256))
    return rows.select(
        "conv_id", F.row_number().over(order).cast("long").alias("place"), digest.alias("turn"), "words"
    )


def rebuilt(turns: DataFrame, base: Column, head: Column, longest_head: int) -> DataFrame:
    """Replace each conversation's first `head` turns by those of conversation `base`.

    `base` and `head` are expressions of conv_id; head is at most `longest_head`. A base with fewer turns
    gives all it has, one that is not there none. The result has the columns of `turns` and a row with
    place 0 and no turn for every conversation, so that those left without turns are there too; places
    ascend, but need not be consecutive.
    """
    turns = written(turns, "turns")
    plan = turns.where("place = 1").select("conv_id", base.alias("base"), head.alias("head"))
    heads = turns.where(F.col("place") <= longest_head).select(F.col("conv_id").alias("base"), "place", "turn", "words")
    taken = plan.join(heads, "base").where(F.col("place") <= F.col("head"))
    own = turns.where(F.col("place") > head)
    none = plan.selectExpr("conv_id", "0L as place", "cast(null as binary) as turn", "0L as words")
    return taken.select(*turns.columns).unionByName(own).unionByName(none)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of `turns` (conv_id, place, turn, words).

    A row without a turn adds no depth, but makes its conversation a member of the root. Columns:
    conv_id, the smallest member, a conversation that starts with the node's turns; depth;
    parent_conv_id, that of the parent, NULL at the root; n_convs, members; n_children; n_leaves,
    childless nodes in the subtree, the node included; saved_words, over the subtree the words of a
    node's last turn times its members but one; ends_sha256, SHA-256 of the conv_ids whose last turn this
    is, ascending, comma-joined. No rows give no nodes.
    """
    importable(turns.sparkSession)
    one_after_another = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    chains = written(one_after_another.mapInArrow(chained, CHAIN), "chains")

    ends = chains.where("last").select("node", "conv_id")
    weights = ends.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("conv_id").alias("conv_id"))
    proper = chains.where("not last").select("node").distinct()
    leaves = weights.join(proper, "node", "left_anti").select("node", F.lit(1).alias("leaf"))
    sequences = weights.join(leaves, "node", "left").select(
        "conv_id", "copies", F.coalesce("leaf", F.lit(0)).alias("leaf")
    )

    prefixes = written(chains.drop("last").join(sequences, "conv_id"), "prefixes")
    nodes = prefixes.groupBy("node").agg(
        F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("words").alias("words"),
        F.min("conv_id").alias("conv_id"), F.sum("copies").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
    )
    nodes = written(
        nodes.join(children_of(nodes), "node", "left").join(digests_of(ends), "node", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0))),
        "nodes",
    )
    found = with_parents(nodes.join(saved_words(prefixes, nodes), "node"))
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_words",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def digests_of(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id) of all conversations, each at its last node."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ends.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    texts = ranged.mapInArrow(end_lists, END_LISTS)
    return texts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed_ends, ENDS)


def children_of(nodes: DataFrame) -> DataFrame:
    """(node, n_children) of the nodes with children."""
    return nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))


def saved_words(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, saved_words): over the subtree, the words of a node's last turn times its members but one.

    A node's own share is put on one weighted sequence, that of its smallest member. A sum from the end of
    each sequence then holds the shares below every prefix of it, and the sums of all sequences through
    a node add up to its subtree.
    """
    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("share"))
    upwards = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    shares = prefixes.select("conv_id", "depth", "node").join(own, ["conv_id", "depth"], "left")
    below = shares.select("node", F.sum(F.coalesce("share", F.lit(0))).over(upwards).alias("below"))
    return below.groupBy("node").agg(F.sum("below").alias("saved_words"))


def with_parents(nodes: DataFrame) -> DataFrame:
    """Add parent_conv_id.

    A parent with over a thousandth of all nodes as children would send them to one task. There are at
    most `CROWDED` such parents: they are broadcast, and the others joined by a shuffle.
    """
    crowd = nodes.count() // CROWDED
    parents = nodes.where("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    crowded = parents.where(F.col("n_children") > crowd).drop("n_children")
    few = crowded.withColumnRenamed("parent_conv_id", "_crowded")
    once = written(nodes.join(F.broadcast(few), "parent", "left"), "parents")
    rest = once.where("_crowded is null").drop("_crowded")
    other = parents.where(F.col("n_children") <= crowd).drop("n_children")
    return (
        once.where("_crowded is not null").withColumnRenamed("_crowded", "parent_conv_id")
        .unionByName(rest.join(other, "parent", "left"))
    )


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (conv_id, place, turn, words) sorted by conv_id and place: every prefix, the last of each one marked."""
    names = [("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("words", pa.int64()), ("last", pa.bool_())]

    def prefixes() -> Iterator[tuple]:
        held = None
        for conv_id, _, turn, words in _rows(batches):
            if held is None or held[0] != conv_id:
                if held:
                    yield (*held, True)
                held = (conv_id, 0, ROOT, None, 0)
            if turn is not None:
                yield (*held, False)
                _, depth, node, _, _ = held
                held = (conv_id, depth + 1, hashlib.sha256(node + turn).digest(), node, words)
        if held:
            yield (*held, True)

    yield from _batched(prefixes(), pa.schema(names))


def end_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (node, conv_id) sorted by both: comma-joined conv_ids of a node, and the first of them."""

    def lists() -> Iterator[tuple]:
        at, ids = None, []
        for node, conv_id in _rows(batches):
            if ids and (node != at or len(ids) == ENDS_OF_A_TEXT):
                yield at, ids[0], ",".join(map(str, ids))
                ids = []
            at = node
            ids.append(conv_id)
        if ids:
            yield at, ids[0], ",".join(map(str, ids))

    schema = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    yield from _batched(lists(), schema, 100)


def hashed_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (node, first, ids) sorted by node and first: SHA-256 of all ids of a node, comma-joined."""

    def ends() -> Iterator[tuple]:
        at, digest = None, hashlib.sha256()
        for node, _, ids in _rows(batches):
            if node != at:
                if at is not None:
                    yield at, digest.hexdigest()
                at, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
        if at is not None:
            yield at, digest.hexdigest()

    yield from _batched(ends(), pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())]))
