"""Exact removal of repeated long strings by suffix arrays.

Bytes covered by a string of `length` bytes that also starts elsewhere, in any text, are
removed. Two windows can only be equal if they have the same anchor (see `anchors`), so
windows travel by anchor to shards, and only those whose anchor occurs twice:

1. Chunks of texts send their distinct anchors to shards, which answer which are repeated.
2. Chunks send the distinct strings around repeated anchors; a shard puts all of its
   strings, each once with its number of copies, into one text and sorts its suffixes by
   external induced sorting (see `induced`). A window is repeated if its suffix agrees with
   a neighbour in the order, or with a copy, for `length` bytes.
3. Chunks put the answers together and cut the covered bytes out.

Only blocks and answers are shuffled: the chunk table is bucketed, and answers come to their chunk.

A passage that a third of all documents share is one string per chunk. Chunks and shards
have bounded sizes, their numbers grow with the input, and a shard larger than memory is
sorted on the task's disk.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billbook.llm.anchors import runs
from billbook.llm.blocks import by_shard, pack, shard_of, smallest, unpack
from billbook.llm.common import beside, bucketed, release, written
from billbook.llm.induced import suffixes

LENGTH = 200
CHUNK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20  # of texts, for each shard
_BORDER = b"\xff"  # in no UTF-8 text
ADDED = ("n_bytes", "spans", "kept")


def chunks_of(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """The chunk table of docs, (chunk, rows, n_bytes, packed), and the number of its buckets by chunk.

    `rows` has the documents' other columns in order, `packed` their sizes and UTF-8 bytes. A longer
    text is a chunk of its own.
    """
    others = [c for c in docs.columns if c != "text" and c not in ADDED]
    row_type = T.StructType([docs.schema[c] for c in others])
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("rows", T.ArrayType(row_type)),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("packed", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        task, made = TaskContext.get().partitionId(), 0
        rows: list[pa.Array] = []
        texts: list[bytes] = []
        held = 0

        def chunk() -> pa.RecordBatch:
            nonlocal made
            made += 1
            every = pa.concat_arrays(rows)
            sizes = np.array([len(t) for t in texts], np.int64)
            packed = pack(sizes, np.frombuffer(b"".join(texts), np.uint8))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | made], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every),
                    pa.array([int(sizes.sum())], pa.int64()),
                    pa.array([packed], pa.binary()),
                ],
                ["chunk", "rows", "n_bytes", "packed"],
            )

        for batch in batches:
            struct = pa.StructArray.from_arrays([batch.column(c) for c in others], others)
            first = 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                texts.append((text or "").encode("utf-8", "surrogatepass"))
                held += len(texts[-1])
                if held >= chunk_bytes:
                    rows.append(struct[first : i + 1])
                    yield chunk()
                    rows, texts, held, first = [], [], 0, i + 1
            if first < len(struct):
                rows.append(struct[first:])
        if texts:
            yield chunk()

    picked = docs.select(*others, "text")
    return bucketed(picked.mapInArrow(run, schema), "chunks", "chunk")


class _Chunk:
    def __init__(self, packed: bytes, length: int):
        self.sizes, self.data = unpack(packed)
        self.length = length
        self.first, self.last, self.anchor = runs(self.data, np.cumsum(self.sizes), length)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.anchor, return_counts=True)

    def repeated(self, answers: dict[int, bytes], shards: int) -> np.ndarray:
        """Runs whose anchor is repeated somewhere, from the shards' answers."""
        values, _ = self.anchors()
        known = np.zeros(len(values), bool)
        for number, at in by_shard(shard_of(values, shards)):
            known[at] = np.unpackbits(unpack(answers[number])[0], count=len(at)).astype(bool)
        return np.nonzero(known[np.searchsorted(values, self.anchor)])[0]

    def strings(self, places: np.ndarray, shards: int) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
        """For each shard its distinct strings, the runs that have them, and which string each run has."""
        data, length = self.data.tobytes(), self.length
        for number, at in by_shard(shard_of(self.anchor[places], shards)):
            mine = places[at]
            numbers: dict[bytes, int] = {}
            which = [
                numbers.setdefault(data[a : b + length], len(numbers))
                for a, b in zip(self.first[mine].tolist(), self.last[mine].tolist(), strict=True)
            ]
            yield number, list(numbers), mine, np.array(which, np.int64)


def _mapped(frame: DataFrame, columns: list[str], make: Callable[..., list], schema: str) -> DataFrame:
    """make(*values of a row) gives (shard, block) pairs of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = make(*(batch.column(c)[i].as_py() for c in columns))
                number = batch.column("chunk")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(found), pa.int64()),
                        pa.array([s for s, _ in found], pa.int64()),
                        pa.array([b for _, b in found], pa.binary()),
                    ],
                    ["chunk", "shard", "block"],
                )

    return frame.select("chunk", *columns).mapInArrow(run, schema)


def _answered(blocks: DataFrame, answer: Callable[[list[bytes]], list[bytes]], name: str) -> DataFrame:
    """(chunk, shard, answer): what each shard answers to each of its blocks, as a written table."""

    def run(group: pa.Table) -> pa.Table:
        release()
        found = answer([b.as_py() for b in group.column("block")])
        return pa.table(
            {"chunk": group.column("chunk"), "shard": group.column("shard"), "answer": pa.array(found, pa.binary())}
        )

    done = blocks.groupBy("shard").applyInArrow(run, "chunk bigint, shard bigint, answer binary")
    return written(done, name)


def _collected(answers: DataFrame, name: str, buckets: int) -> DataFrame:
    own = beside(answers, "chunk", buckets)
    return own.groupBy("chunk").agg(F.collect_list(F.struct("shard", "answer")).alias(name))


def _by_number(answers: list[dict] | None) -> dict[int, bytes]:
    return {a["shard"]: a["answer"] for a in answers or ()}


def _repeated_anchors(blocks: list[bytes]) -> list[bytes]:
    parts = [unpack(b) for b in blocks]
    values, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(which, 1.0 + np.concatenate([p[1] for p in parts]), len(values))
    found = np.split(counts[which] > 1, np.cumsum([len(p[0]) for p in parts])[:-1])
    return [pack(np.packbits(f)) for f in found]


def repeated_windows(strings: list[bytes], copies: list[int], length: int) -> list[np.ndarray]:
    """For each of some distinct strings, which of its windows occur again, in itself, another or a copy."""
    text = np.frombuffer(_BORDER.join(strings) + _BORDER, np.uint8)
    again = np.zeros(len(text), bool)
    before = -1
    with tempfile.TemporaryDirectory() as folder:
        for places, common in suffixes(text, folder, length):
            same = common >= length
            again[places[same]] = True
            after = np.append(before, places[:-1])
            again[after[same]] = True
            before = int(places[-1])
    found, at = [], 0
    for string, n in zip(strings, copies, strict=True):
        windows = again[at : at + len(string) - length + 1]
        found.append(windows | (n > 1))
        at += len(string) + 1
    return found


def _repeated_strings(blocks: list[bytes], length: int) -> list[bytes]:
    numbers: dict[bytes, int] = {}
    copies: list[int] = []
    asked: list[list[int]] = []
    for block in blocks:
        sizes, many, raw = unpack(block)
        data, at = raw.tobytes(), 0
        own = []
        for size, m in zip(sizes.tolist(), many.tolist(), strict=True):
            number = numbers.setdefault(data[at : at + size], len(numbers))
            if number == len(copies):
                copies.append(0)
            copies[number] += 1 + m
            own.append(number)
            at += size
        asked.append(own)
    windows = repeated_windows(list(numbers), copies, length)
    return [pack(np.packbits(np.concatenate([windows[i] for i in own]))) for own in asked]


def _spans(again: np.ndarray, length: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the maximal runs within a text covered by the windows that start at `again`."""
    n = int(ends[-1])
    covered = np.zeros(n + 1, np.int64)
    covered[: len(again)] += again
    covered[length : length + len(again)] -= again
    inside = np.cumsum(covered)[:n] > 0
    border = np.zeros(n + 1, bool)
    border[0] = border[ends] = True
    before, after = np.append(False, inside), np.append(inside, False)
    return np.nonzero(after & (border | ~before))[0], np.nonzero(before & (border | ~after))[0]


def deduplicate(
    docs: DataFrame,
    length: int = LENGTH,
    chunk_bytes: int = CHUNK_BYTES,
    shard_bytes: int = SHARD_BYTES,
    as_text: bool = False,
) -> DataFrame:
    """docs without `text`, and n_bytes, spans (array of first byte and length) and kept (binary).

    Bytes within a span are covered by a string of `length` bytes that starts at another place too, in
    the same text or another, overlaps included; all strings are judged on the input. `kept` has the
    other bytes of the UTF-8 text. Rows stay as they are, repeated ones and NULL ids too; a repeated row
    is a copy like any other. NULL and empty texts have no bytes. Own columns of the three names give way.
    `as_text` gives `kept` as a string, without the rest of characters that were cut into. `length` is from 64, the
    bytes of an anchor, to 254, as common prefixes are bytes.
    """
    if not 64 <= length <= 254:
        raise ValueError(f"length must be from 64 to 254, not {length}")
    chunks, buckets = chunks_of(docs, chunk_bytes)
    size = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(1, ceil(size / shard_bytes))

    def anchors(packed: bytes) -> list[tuple[int, bytes]]:
        values, counts = _Chunk(packed, length).anchors()
        return [
            (number, pack(values[at], (counts[at] > 1).astype(np.uint8)))
            for number, at in by_shard(shard_of(values, shards))
        ]

    def strings(packed: bytes, answers: list[dict] | None) -> list[tuple[int, bytes]]:
        chunk = _Chunk(packed, length)
        places = chunk.repeated(_by_number(answers), shards)
        return [
            (
                number,
                pack(
                    smallest(np.array([len(s) for s in distinct], np.int64)),
                    (np.bincount(which, minlength=len(distinct)) > 1).astype(np.uint8),
                    np.frombuffer(b"".join(distinct), np.uint8),
                ),
            )
            for number, distinct, _, which in chunk.strings(places, shards)
        ]

    schema = "chunk bigint, shard bigint, block binary"
    answers = _answered(_mapped(chunks, ["packed"], anchors, schema), _repeated_anchors, "anchors")
    repeated = _collected(answers, "anchors", buckets)
    blocks = _mapped(chunks.join(repeated, "chunk", "left"), ["packed", "anchors"], strings, schema)
    windows = _collected(_answered(blocks, lambda b: _repeated_strings(b, length), "strings"), "windows", buckets)
    return _cut(chunks.join(repeated, "chunk", "left").join(windows, "chunk", "left"), length, shards, as_text)


def without_repeats(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """docs with what `deduplicate` keeps as their text; a character that was cut into is left out whole.

    All rows stay, also those with nothing left. A NULL text becomes empty.
    """
    return deduplicate(docs, length, as_text=True, **sizes).drop("n_bytes", "spans").withColumnRenamed("kept", "text")


def _cut(asked: DataFrame, length: int, shards: int, as_text: bool) -> DataFrame:
    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("length", T.LongType())])
    schema = T.StructType(
        [
            *asked.schema["rows"].dataType.elementType.fields,
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk(batch.column("packed")[i].as_py(), length)
                again = np.zeros(max(len(chunk.data) - length + 1, 0), bool)
                places = chunk.repeated(_by_number(batch.column("anchors")[i].as_py()), shards)
                answers = _by_number(batch.column("windows")[i].as_py())
                for number, distinct, mine, which in chunk.strings(places, shards):
                    sizes = np.array([len(s) - length + 1 for s in distinct], np.int64)
                    bits = np.unpackbits(unpack(answers[number])[0], count=int(sizes.sum()))
                    at = np.concatenate(([0], np.cumsum(sizes)))
                    for first, string in zip(chunk.first[mine].tolist(), which.tolist(), strict=True):
                        again[first : first + sizes[string]] = bits[at[string] : at[string + 1]]
                yield _rows(batch.column("rows")[i].values, chunk, again)

    def _rows(rows: pa.StructArray, chunk: _Chunk, again: np.ndarray) -> pa.RecordBatch:
        data = chunk.data.tobytes()
        ends = np.cumsum(chunk.sizes)
        starts, stops = _spans(again, length, ends)
        owner = np.searchsorted(ends, starts, side="right")
        cut = np.searchsorted(owner, np.arange(len(ends) + 1))
        kept, spans = [], []
        for j, (end, size) in enumerate(zip(ends.tolist(), chunk.sizes.tolist(), strict=True)):
            at, parts, own = end - size, [], []
            for a, b in zip(starts[cut[j] : cut[j + 1]].tolist(), stops[cut[j] : cut[j + 1]].tolist(), strict=True):
                parts.append(data[at:a])
                own.append({"first": a - (end - size), "length": b - a})
                at = b
            rest = b"".join([*parts, data[at:end]])
            kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
            spans.append(own)
        return pa.RecordBatch.from_arrays(
            [
                *rows.flatten(),
                pa.array(chunk.sizes, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("length", pa.int64())]))),
                pa.array(kept, pa.string() if as_text else pa.binary()),
            ],
            [*(f.name for f in rows.type), "n_bytes", "spans", "kept"],
        )

    return asked.select("rows", "packed", "anchors", "windows").mapInArrow(run, schema)
