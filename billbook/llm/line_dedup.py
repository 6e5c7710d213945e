"""Line deduplication by range-partitioned hashes.

Every line's key is hashed to 128 bits. The hashes are range-partitioned and sorted by (hash, document
descending, position), so that a stream over a partition meets the lines of a key one after the other, the
document that keeps its lines first. The stream says which lines go, a task turns them into one
compressed bitmap per document, and only these travel to the texts.

A frequent key is cut over as many partitions as its lines fill. A stream cannot know what came before its first
key, nor whether its last one goes on: their lines are left open, with a summary per partition. Those
are two rows at most for each partition; put together they decide the open lines.

A line's hash stands twice for 64 bits with different seeds. Two keys would have to agree in both.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from billbook.llm.common import ascii_lower, importable, written

BLANKS = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]

DROPPED, OPEN, SUMMARY = 0, 1, 2
# kind DROPPED and OPEN: a line. SUMMARY: of the first and the last key in a partition the number of documents,
# the first and the last of them; part numbers partitions.
STREAM = (
    "kind int, h1 bigint, h2 bigint, doc_id bigint, text_hash bigint, line int, part int, docs bigint, last_doc bigint"
)
MARKS = "doc_id bigint, text_hash bigint, n_dropped bigint, keep binary"


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, text_hash, line) of every line whose key has `min_chars` code points or more."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.split(text, "\n", -1)).alias("line", "content"),
    )
    keyed = lines.withColumn("key", ascii_lower(F.btrim("content", F.lit(BLANKS)))).where(F.length("key") >= min_chars)
    return keyed.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id", "text_hash", "line"
    )


def dropped_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(doc_id, text_hash, line) of the lines of `line_keys` that go: keys in `min_docs` documents, all but the last."""
    importable(lines.sparkSession)
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written first, as finding the ranges reads everything once more.
    lines = written(lines, "lines")
    order = [*HASH, F.desc_nulls_last("doc_id"), "text_hash", "line"]
    streamed = (
        lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(lambda batches: stream_lines(batches, min_docs), STREAM)
    )
    streamed = written(streamed, "streamed")
    kept = ["doc_id", "text_hash", "line"]
    opened = streamed.where(F.col("kind") == OPEN).select(*HASH, *kept)
    # Two rows at most for each partition.
    decided = F.broadcast(_decided(streamed.where(F.col("kind") == SUMMARY), min_docs))
    found = opened.join(decided, HASH).where(~F.col("doc_id").eqNullSafe(F.col("holder"))).select(*kept)
    return streamed.where(F.col("kind") == DROPPED).select(*kept).unionByName(found)


def _decided(summaries: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, holder) of the keys left open that occur in enough documents; a document cut in two counts once."""
    order = Window.partitionBy(*HASH).orderBy("part")
    ends = F.lag(F.struct("last_doc")).over(order)
    again = ends.isNotNull() & ends["last_doc"].eqNullSafe(F.col("doc_id"))
    counted = summaries.withColumn("docs", F.col("docs") - again.cast("int"))
    first = F.min_by(F.struct("doc_id"), "part")["doc_id"]
    return counted.groupBy(*HASH).agg(F.sum("docs").alias("docs"), first.alias("holder")).where(
        F.col("docs") >= min_docs
    ).drop("docs")


def stream_lines(batches: Iterable[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """The rows of `STREAM` of one sorted partition.

    A summary has hash, documents, first and last document, a document being its id and whether that is NULL.
    Held from batch to batch are the lines of the key that is last in it, and only while it is in fewer than
    `min_docs` documents. Once it is in enough, lines go out as they come.
    """
    held: _Lines | None = None
    part, started = 0, False  # started: the partition's first key is over
    opened: list | None = None  # summary of that key
    going: list | None = None  # summary of the last key, if it is in enough documents
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(5)[0].as_py()
        lines = _Lines.of(batch)
        if held is not None:
            lines, held = _Lines.joined(held, lines), None
        if not started:
            first, lines = lines.cut(*(opened[:2] if opened else lines.key(0)))
            if len(first):
                opened = first.summary(opened)
                yield first.out(OPEN)
            started = len(lines) > 0
        if going is not None:
            more, lines = lines.cut(*going[:2])
            if len(more):
                yield more.other_than(going[3]).out(DROPPED)
                going = more.summary(going)
            going = None if len(lines) else going
        if not len(lines):
            continue
        run, docs, holder = lines.runs()
        enough = docs[run] >= min_docs
        yield lines.take(enough & ~holder).out(DROPPED)
        last = lines.take(run == run[-1])
        going, held = (last.summary(None), None) if enough[-1] else (None, last)
    if held is not None:
        yield held.out(OPEN)
        going = held.summary(None)
    for summary in (opened, going):
        if summary is not None:
            yield _summary_row(summary, part)


class _Lines:
    """Columns h1, h2, doc_id (0 where NULL), whether it is NULL, text_hash, line."""

    def __init__(self, columns: list[np.ndarray]) -> None:
        self.columns = columns

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Lines:
        h1, h2, doc, text, line = (batch.column(i) for i in range(5))
        null = doc.is_null().to_numpy(zero_copy_only=False)
        doc = doc.fill_null(0).to_numpy(zero_copy_only=False)
        return cls([h1.to_numpy(), h2.to_numpy(), doc, null, text.to_numpy(), line.to_numpy()])

    @classmethod
    def joined(cls, a: _Lines, b: _Lines) -> _Lines:
        return cls([np.concatenate(x) for x in zip(a.columns, b.columns)])

    def __len__(self) -> int:
        return len(self.columns[0])

    def take(self, rows: slice | np.ndarray) -> _Lines:
        return _Lines([c[rows] for c in self.columns])

    def key(self, i: int) -> tuple:
        return self.columns[0][i], self.columns[1][i]

    def doc(self, i: int) -> tuple:
        return self.columns[2][i], self.columns[3][i]

    def cut(self, h1: int, h2: int) -> tuple[_Lines, _Lines]:
        """The lines of a key that the rows begin with, and the others."""
        others = np.flatnonzero((self.columns[0] != h1) | (self.columns[1] != h2))
        n = others[0] if len(others) else len(self)
        return self.take(slice(0, n)), self.take(slice(n, None))

    def other_than(self, doc: tuple) -> _Lines:
        return self.take((self.columns[2] != doc[0]) | (self.columns[3] != doc[1]))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per line the number of its key, per key its documents, per line whether it is in the key's first document."""
        h1, h2, doc, null, _, _ = self.columns
        new_key = np.ones(len(self), bool)
        new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_doc = new_key.copy()
        new_doc[1:] |= (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])
        run = np.cumsum(new_key) - 1
        docs = np.bincount(run, weights=new_doc).astype(np.int64)
        nth = np.cumsum(new_doc)
        return run, docs, nth == nth[new_key][run]

    def summary(self, before: list | None) -> list:
        """h1, h2, documents, first and last document of lines of one key that follow those of `before`."""
        docs = int(self.runs()[1][0])
        if before is None:
            return [*self.key(0), docs, self.doc(0), self.doc(len(self) - 1)]
        h1, h2, so_far, first, last = before
        return [h1, h2, so_far + docs - (last == self.doc(0)), first, self.doc(len(self) - 1)]

    def out(self, kind: int) -> pa.RecordBatch:
        h1, h2, doc, null, text, line = self.columns
        nothing = pa.nulls(len(self), pa.int32()), pa.nulls(len(self), pa.int64()), pa.nulls(len(self), pa.int64())
        arrays = [pa.array(np.full(len(self), kind, np.int32)), pa.array(h1), pa.array(h2), pa.array(doc, mask=null), pa.array(text), pa.array(line)]
        return pa.RecordBatch.from_arrays([*arrays, *nothing], names=_STREAM_NAMES)


_STREAM_NAMES = [c.split()[0] for c in STREAM.split(", ")]


def _summary_row(summary: list, part: int) -> pa.RecordBatch:
    h1, h2, docs, first, last = summary
    value = lambda doc: None if doc[1] else int(doc[0])
    row = [SUMMARY, int(h1), int(h2), value(first), None, None, part, docs, value(last)]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=_STREAM_NAMES)


def line_marks(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, text_hash, n_dropped, keep) of the documents that lose lines.

    A key is a line without blanks (space, \\t to \\r) at both ends, A-Z in lower case. Keys of at least
    `min_chars` code points that occur in `min_docs` documents or more lose their lines everywhere but in
    the document with the largest doc_id. NULL is the smallest doc_id; rows with the same doc_id are one
    document here. `text_hash` (XXH64 of the text, NULL as empty) tells their texts apart; equal
    rows have equal marks, and one row stands for all of them. `keep` is `packed` with one bit per line.
    """
    gone = dropped_lines(line_keys(docs, min_chars), min_docs)
    lines = gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("lines"))
    return lines.mapInArrow(_marked, MARKS)


def _marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, text, gone = batch.columns
        lines = [np.asarray(x, np.int64) for x in gone.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [doc, text, pa.array([len(x) for x in lines], pa.int64()), pa.array([packed(x) for x in lines], pa.binary())],
            names=["doc_id", "text_hash", "n_dropped", "keep"],
        )


def packed(dropped: np.ndarray) -> bytes:
    """Bits of the lines, 1 for those that stay, to the end of the byte with the last that goes, compressed."""
    bits = np.ones((int(dropped.max()) // 8 + 1) * 8 if len(dropped) else 0, np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def unpacked(keep: bytes, n_lines: int) -> np.ndarray:
    """Whether each of `n_lines` lines stays; lines past the end of the bits do."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n_lines]
    return np.concatenate([bits, np.ones(n_lines - len(bits), np.uint8)]).astype(bool)


def with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Add n_lines, n_dropped and keep (NULL if all lines stay) to every row of `docs`; other columns stay."""
    text = F.coalesce("text", F.lit(""))
    doc, found = docs.withColumn("_hash", F.xxhash64(text)).alias("d"), marks.alias("m")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d._hash") == F.col("m.text_hash"))
    lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    own = [F.col(f"d.`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped", "keep")]
    joined = doc.withColumn("_lines", lines).alias("d").join(found, same, "left")
    return joined.select(
        *own, F.col("d._lines").alias("n_lines"), F.coalesce("m.n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.col("m.keep")
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The text without the lines that go; all of it where `keep` is NULL. A NULL text is empty."""
    text = F.coalesce(text, F.lit(""))
    # Only texts that lose lines reach Python.
    return F.coalesce(_kept_lines(F.when(keep.isNotNull(), text), keep), text)


@F.pandas_udf(StringType())
def _kept_lines(texts: pd.Series, keeps: pd.Series) -> pd.Series:
    return pd.Series([None if keep is None else _without(text, keep) for text, keep in zip(texts, keeps)], dtype=object)


def _without(text: str, keep: bytes) -> str:
    lines = text.split("\n")
    return "\n".join(line for line, stays in zip(lines, unpacked(keep, len(lines))) if stays)
