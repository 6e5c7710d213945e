"""Bigram language model in Elias-Fano tries, built and queried shard by shard.

Texts become chunks of about CHUNK_TOKENS tokens: a sorted array of the chunk's word hashes
and one small number per token. What a chunk has to say and to ask goes out as one block for
each shard, its n-grams counted beforehand, so a word or context of a third of all tokens
is one entry per chunk.

1. Word shards add up counts and answer with the count of each word.
2. n-gram shards, by context, add up bigram counts and put them in a trie: sorted contexts,
   monotone pointers into their successors, the successors relative to their context, both
   as Elias-Fano sequences, and smoothed probabilities of 16 bits. The trie is written to a
   file of the task, mapped, and searched for every n-gram that a chunk asks for. Contexts
   with more tokens than a shard should hold are spread by their successors.
3. Each chunk puts the answers together and adds up its documents.

    p(word) = (c(word) + 1) / (N + V + 1)
    p(word | before) = (c(before, word) + MU p(word)) / (c(before) + MU)

c, N and V count training tokens; the end of a text is a token, its start only a context.
The probabilities of all words and of one unknown word add up to 1, up to the rounding of
stored ones (0.03 %). Words are told apart by 63 bits of their XXH64 and successors of one
context by 40 bits.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billbook.llm.blocks import by_shard, pack, shard_of, smallest, unpack
from billbook.llm.common import beside, bucketed, release, written
from billbook.llm.elias_fano import EliasFano

CHUNK_TOKENS = 1_000_000
SHARD_TOKENS = 2_000_000
MU = 200.0
STEPS = 5_000  # stored probabilities are 10 ** (-code / STEPS)
END, START = " end", " start"  # no words: they hold a blank
SUCCESSOR_BITS = 40


@dataclass(frozen=True)
class Totals:
    """Training tokens, distinct ones, and texts."""

    tokens: int
    distinct: int
    texts: int


def _hash(word: str | bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> 1


# Chunks


def chunks_of(docs: DataFrame, train: Column, chunk_tokens: int = CHUNK_TOKENS) -> tuple[DataFrame, int]:
    """The chunk table of docs (doc_id, text) and the number of its buckets; `train` marks the rows to learn from.

    One row per chunk: its documents in order, and as one packed value the sizes and training marks of
    the documents, the chunk's words and its tokens.
    """
    rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train"))
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(kind)),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("packed", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        task, made = TaskContext.get().partitionId(), 0
        ids: list[object] = []
        sizes: list[int] = []
        marks: list[bool] = []
        numbers: dict[bytes, int] = {}
        tokens: list[np.ndarray] = []
        held, id_type = 0, pa.null()

        def chunk() -> pa.RecordBatch:
            nonlocal made
            hashes = np.array([_hash(w) for w in numbers], np.uint64)
            order = np.argsort(hashes)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            every = rank[np.concatenate(tokens)]
            packed = pack(
                np.array(sizes, np.int64), np.array(marks, np.uint8), hashes[order], smallest(every)
            )
            made += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | made], pa.int64()),
                    pa.array([ids], pa.list_(id_type)),
                    pa.array([len(every)], pa.int64()),
                    pa.array([packed], pa.binary()),
                ],
                ["chunk", "doc_ids", "n_tokens", "packed"],
            )

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not numbers:
                    numbers = {START.encode(): 0, END.encode(): 1}
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                tokens.append(
                    np.array([numbers.setdefault(w, len(numbers)) for w in words] + [1], np.int64)
                )
                ids.append(doc_id)
                sizes.append(len(words) + 1)
                marks.append(mark)
                held += len(words) + 1
                if held >= chunk_tokens:
                    yield chunk()
                    ids, sizes, marks, numbers, tokens, held = [], [], [], {}, [], 0
        if ids:
            yield chunk()

    return bucketed(rows.mapInArrow(run, schema), "chunks", "chunk")


class _Chunk:
    """A chunk's tokens as numbers of its sorted words, and what follows from them."""

    def __init__(self, packed: bytes):
        self.sizes, marks, self.words, tokens = unpack(packed)
        self.tokens = tokens.astype(np.int64)
        self.marks = marks.astype(bool)
        self.start = int(np.searchsorted(self.words, np.uint64(_hash(START))))
        self.end = int(np.searchsorted(self.words, np.uint64(_hash(END))))
        self.learnt = np.repeat(self.marks, self.sizes)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.learnt], minlength=len(self.words))

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(context, word, training count) of distinct bigrams in order, and each token's bigram."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.concatenate(([0], np.cumsum(self.sizes)[:-1]))] = self.start
        keys, which = np.unique(before * len(self.words) + self.tokens, return_inverse=True)
        counts = np.bincount(which[self.learnt], minlength=len(keys))
        return keys // len(self.words), keys % len(self.words), counts, which

    def bigram_shards(self, contexts: np.ndarray, words: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
        own, other = self.words[contexts], self.words[words]
        return shard_of(np.where(np.isin(own, hot), own ^ (other >> np.uint64(7)), own), shards)


def _blocks(chunks: DataFrame, make) -> DataFrame:
    """(chunk, shard, block) from make(chunk) -> iterator of (shard, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(batch.column("chunk").to_pylist(), batch.column("packed"), strict=True):
                found = list(make(_Chunk(packed.as_py())))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(found), pa.int64()),
                        pa.array([s for s, _ in found], pa.int64()),
                        pa.array([b for _, b in found], pa.binary()),
                    ],
                    ["chunk", "shard", "block"],
                )

    return chunks.select("chunk", "packed").mapInArrow(run, "chunk bigint, shard bigint, block binary")


# Words

_ANSWER = "chunk bigint, shard bigint, answer binary, tokens bigint, distinct bigint, hot array<struct<id:bigint,n:bigint>>"


def word_answers(chunks: DataFrame, shards: int, hot_from: int) -> DataFrame:
    """Counts of each chunk's words over all chunks, as a written table.

    `tokens`, `distinct` and `hot`, the words with over `hot_from` tokens, stand in a row without chunk
    for each shard.
    """

    def blocks(chunk: _Chunk) -> Iterator[tuple[int, bytes]]:
        counts = chunk.word_counts()
        for number, at in by_shard(shard_of(chunk.words, shards)):
            yield number, pack(chunk.words[at], smallest(counts[at]))

    def answer(group: pa.Table) -> pa.Table:
        parts = [unpack(b.as_py()) for b in group.column("block")]
        ids, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(which, np.concatenate([p[1] for p in parts]).astype(np.float64), len(ids)).astype(np.int64)
        hot = [{"id": int(ids[i]), "n": int(counts[i])} for i in np.nonzero(counts > hot_from)[0]]
        found = np.split(counts[which], np.cumsum([len(p[0]) for p in parts])[:-1])
        n = len(parts)
        return pa.table(
            {
                "chunk": pa.array([*group.column("chunk").to_pylist(), None], pa.int64()),
                "shard": pa.array([group.column("shard")[0].as_py()] * (n + 1), pa.int64()),
                "answer": pa.array([pack(smallest(f)) for f in found] + [None], pa.binary()),
                "tokens": pa.array([None] * n + [int(counts.sum())], pa.int64()),
                "distinct": pa.array([None] * n + [int((counts > 0).sum())], pa.int64()),
                "hot": pa.array(
                    [None] * n + [hot], pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))
                ),
            }
        )

    return written(_blocks(chunks, blocks).groupBy("shard").applyInArrow(answer, _ANSWER), "words")


# Bigrams


class Trie:
    """Two levels: contexts, and each context's successors with codes of c(before, word) / (c(before) + MU)."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @classmethod
    def of(cls, contexts: np.ndarray, words: np.ndarray, counts: np.ndarray, totals: dict[int, int]) -> Trie:
        """From sorted bigrams; `totals` has c(before) of contexts that are not here as a whole."""
        seen = counts > 0
        contexts, words, counts = contexts[seen], words[seen], counts[seen]
        ids, first = np.unique(contexts, return_index=True)
        size = np.diff(np.append(first, len(contexts)))
        total = np.add.reduceat(counts, first) if len(ids) else np.zeros(0, np.int64)
        for i in np.nonzero(np.isin(ids, np.array(list(totals), np.uint64)))[0]:
            total[i] = totals[int(ids[i])]
        share = counts / (np.repeat(total, size) + MU)
        codes = np.minimum(np.rint(-np.log10(share) * STEPS) + 1, 65_535).astype(np.uint16)
        rank = np.repeat(np.arange(len(ids), dtype=np.uint64), size)
        return cls(
            EliasFano.of(ids),
            EliasFano.of(np.append(first, len(contexts))),
            EliasFano.of((rank << np.uint64(SUCCESSOR_BITS)) | words),
            codes,
        )

    def save(self, path: str) -> None:
        parts = [a for level in (self.contexts, self.pointers, self.successors) for a in level.arrays()]
        parts.append(self.codes)
        sizes = np.array([len(a) for a in parts], np.int64)
        with open(path, "wb") as out:
            out.write(sizes.tobytes())
            for a in parts:
                out.write(b"\0" * (-out.tell() % 8) + np.ascontiguousarray(a).tobytes())

    @classmethod
    def mapped(cls, path: str) -> Trie:
        raw = np.memmap(path, np.uint8, "r")
        sizes, at, parts = raw[: 13 * 8].view(np.int64).tolist(), 13 * 8, []
        for size, kind in zip(sizes, [np.int64, np.uint8, np.uint64, np.int64] * 3 + [np.uint16], strict=True):
            at += -at % 8
            width = size * np.dtype(kind).itemsize
            parts.append(raw[at : at + width].view(kind))
            at += width
        return cls(*(EliasFano.from_arrays(*parts[i : i + 4]) for i in (0, 4, 8)), parts[12])

    def codes_of(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The code of each bigram; 0 if it was not seen."""
        everything = np.zeros(len(contexts), np.int64)
        at = self.contexts.find(contexts, everything, everything + self.contexts.n)
        known = np.nonzero(at >= 0)[0]
        found = np.zeros(len(contexts), np.uint16)
        if len(known):
            rank = at[known]
            relative = (rank.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | words[known]
            place = self.successors.find(relative, self.pointers.get(rank), self.pointers.get(rank + 1))
            found[known[place >= 0]] = self.codes[place[place >= 0]]
        return found


def _successor(ids: np.ndarray) -> np.ndarray:
    return ids >> np.uint64(63 - SUCCESSOR_BITS)


def _five_bytes(ids: np.ndarray) -> np.ndarray:
    return ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].ravel()


def _from_five(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = raw.reshape(-1, 5)
    return wide.view("<u8").ravel()


def bigram_answers(chunks: DataFrame, shards: int, hot: dict[int, int]) -> DataFrame:
    """(chunk, shard, answer): codes of each chunk's bigrams, as a written table. `hot` contexts are spread."""
    spread = np.array(sorted(hot), np.uint64)

    def blocks(chunk: _Chunk) -> Iterator[tuple[int, bytes]]:
        contexts, words, counts, _ = chunk.bigrams()
        for number, at in by_shard(chunk.bigram_shards(contexts, words, spread, shards)):
            ids, size = np.unique(chunk.words[contexts[at]], return_counts=True)
            yield number, pack(
                ids, smallest(size), _five_bytes(_successor(chunk.words[words[at]])), smallest(counts[at])
            )

    def answer(group: pa.Table) -> pa.Table:
        parts = [unpack(b.as_py()) for b in group.column("block")]
        asked = [(np.repeat(p[0], p[1].astype(np.int64)), _from_five(p[2])) for p in parts]
        contexts, words = (np.concatenate([a[i] for a in asked]) for i in (0, 1))
        counts = np.concatenate([p[3].astype(np.int64) for p in parts])
        order = np.lexsort((words, contexts))
        sorted_contexts, sorted_words = contexts[order], words[order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_contexts[1:] != sorted_contexts[:-1]) | (sorted_words[1:] != sorted_words[:-1])
        first = np.nonzero(new)[0]
        trie = Trie.of(
            sorted_contexts[first], sorted_words[first], np.add.reduceat(counts[order], first), hot
        )
        with tempfile.TemporaryDirectory() as folder:
            path = os.path.join(folder, "trie")
            trie.save(path)
            del trie, order, new, first, sorted_contexts, sorted_words, contexts, words, counts, parts
            mapped = Trie.mapped(path)
            found = [mapped.codes_of(*a) for a in asked]
        return pa.table(
            {
                "chunk": group.column("chunk"),
                "shard": group.column("shard"),
                "answer": pa.array([pack(f) for f in found], pa.binary()),
            }
        )

    grouped = _blocks(chunks, blocks).groupBy("shard")
    return written(grouped.applyInArrow(answer, "chunk bigint, shard bigint, answer binary"), "bigrams")


# Scores


def _scores(
    chunk: _Chunk, counts: np.ndarray, codes: np.ndarray, totals: Totals
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known tokens, base score, score) of each document of a chunk."""
    contexts, words, _, which = chunk.bigrams()
    base = (counts + 1.0) / (totals.tokens + totals.distinct + 1.0)
    before = counts.astype(np.float64)
    before[chunk.start] = totals.texts
    share = np.where(codes > 0, 10.0 ** (-(codes.astype(np.float64) - 1) / STEPS), 0.0)
    smooth = np.log10(share + MU / (before[contexts] + MU) * base[words])
    first = np.concatenate(([0], np.cumsum(chunk.sizes)[:-1]))
    each = lambda x: np.add.reduceat(x, first)
    return (
        each((counts[chunk.tokens] > 0).astype(np.int64)),
        each(np.log10(base)[chunk.tokens]),
        each(smooth[which]),
    )


def score(
    docs: DataFrame,
    train: Column,
    chunk_tokens: int = CHUNK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row of docs (doc_id, text).

    The model learns from the rows that `train` marks; NULL marks none. Tokens are words up to ASCII
    white space, A-Z in lower case, then one end: NULL and empty texts have the end alone. All rows
    stay, with repeated or NULL doc_ids too; other columns are left out. If nothing is learnt, every
    token is the unknown word of an empty model, with probability 1.
    """
    chunks, buckets = chunks_of(docs, train, chunk_tokens)
    size = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, ceil(size / shard_tokens))
    words = word_answers(chunks, shards, shard_tokens // 4)
    summed = words.where("chunk is null").agg(F.sum("tokens"), F.sum("distinct")).first()
    # At most size / (shard_tokens // 4) words: four numbers for each shard.
    hot = {
        r["id"]: r["n"]
        for r in words.where("chunk is null").select(F.inline("hot")).collect()
    }
    start, end = _hash(START), _hash(END)
    texts = hot.pop(end, None) or _texts(chunks)
    if texts > shard_tokens // 4:
        hot[start] = texts
    totals = Totals(summed[0] or 0, summed[1] or 0, texts)
    bigrams = bigram_answers(chunks, shards, hot)
    spread = np.array(sorted(hot), np.uint64)

    every = (
        words.where("chunk is not null").select("chunk", F.struct(F.lit(0).alias("level"), "shard", "answer").alias("x"))
        .unionByName(bigrams.select("chunk", F.struct(F.lit(1).alias("level"), "shard", "answer").alias("x")))
    )
    answers = beside(every, "chunk", buckets).groupBy("chunk").agg(F.collect_list("x").alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk(batch.column("packed")[i].as_py())
                got = {(a["level"], a["shard"]): a["answer"] for a in batch.column("answers")[i].as_py()}
                counts = np.zeros(len(chunk.words), np.int64)
                for number, at in by_shard(shard_of(chunk.words, shards)):
                    counts[at] = unpack(got[0, number])[0]
                contexts, followers, _, _ = chunk.bigrams()
                codes = np.zeros(len(contexts), np.uint16)
                for number, at in by_shard(chunk.bigram_shards(contexts, followers, spread, shards)):
                    codes[at] = unpack(got[1, number])[0]
                known, base, smooth = _scores(chunk, counts, codes, totals)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[i].values,
                        pa.array(chunk.sizes, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(np.full(len(known), totals.tokens), pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array(smooth, pa.float64()),
                    ],
                    ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            *[T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")],
            *[T.StructField(n, T.DoubleType()) for n in ("base_score", "score")],
        ]
    )
    return chunks.join(answers, "chunk").select("doc_ids", "packed", "answers").mapInArrow(run, schema)


def _texts(chunks: DataFrame) -> int:
    """Number of training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [int(unpack(p.as_py())[1].sum()) for p in batch.column("packed")]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n"])

    return chunks.select("packed").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0
