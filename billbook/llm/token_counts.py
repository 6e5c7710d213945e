"""Token counts by a map-side lookup of two tiers.

The lengths, in tokens, of frequent pre-tokens are broadcast as one compact table of
bounded size. A pre-token that is not in it is looked up in its worker's cache, and
encoded by the tokenizer itself if it is not there either. The texts' pre-tokens are
never shuffled; the counting job has no exchange at all.

The frequent pre-tokens are chosen on a sample of at most about `fit_rows` documents.
They decide which tier answers, never the answer.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from billbook.llm.common import kept, release

FREQUENT = 65_536
LONGEST = 32
FIT_ROWS = 20_000
CACHED = 300_000


def _tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def _special(tokenizer: Tokenizer) -> list[str]:
    """Strings that the tokenizer cuts out of a text before its pattern sees it."""
    return [added.content for added in tokenizer.get_added_tokens_decoder().values()]


def odd_characters(tokenizer: Tokenizer, pattern: str) -> list[tuple[int, int]]:
    """Ranges of code points that the library's pattern and ours class differently (Unicode versions).

    A character's class shows in what it joins: a letter, a digit or a sign before it. Neighbouring
    code points of one class are tried together, and one by one only where the library cuts them.
    """
    ours = regex.compile(pattern).findall

    def theirs(text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def same(chars: str) -> bool:
        return all(theirs(text) == ours(text) for text in (f"a{chars}", f"1{chars}", f"!{chars}"))

    kind = regex.compile(r"(\p{L}+)|(\p{N}+)|([^\s\p{L}\p{N}]+)|\s+").finditer
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    ranges: list[tuple[int, int]] = []
    for run in kind(every):
        for c in () if same(run.group()) else map(ord, filter(lambda c: not same(c), run.group())):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1] = (ranges[-1][0], c)
            else:
                ranges.append((c, c))
    return ranges


def _finder(ranges: list[tuple[int, int]]) -> Callable[[str], object]:
    """Whether a text has a character of the ranges; texts of low code points only are soon done."""
    if not ranges:
        return lambda text: None
    low = ranges[0][0] > 0xFF
    search = re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges) + "]").search

    def found(text: str) -> object:
        if low:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return search(text)
            return None
        return search(text)

    return found


def _encoded_lengths(tokenizer: Tokenizer, pieces: list[str]) -> list[int]:
    """One by one: a batch goes to a pool of a thread per core, while a task has one core and a text few new pieces."""
    return [len(tokenizer.encode(p, add_special_tokens=False)) for p in pieces]


def frequent_pieces(
    docs: DataFrame, pattern: str, frequent: int = FREQUENT, fit_rows: int = FIT_ROWS
) -> list[str]:
    """The most frequent pre-tokens of a sample of docs, up to `frequent`, of LONGEST characters at most.

    Each task adds up its own documents, so that only sums of the bounded sample are shuffled.
    """
    rows = docs.where("text is not null").select("text")
    share = min(1.0, fit_rows / max(1, docs.count()))
    if share < 1:
        rows = rows.sample(fraction=share, seed=7)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern).findall
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(p for p in cut(text) if len(p) <= LONGEST)
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())}
        )

    sums = rows.mapInArrow(count, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    return [r["piece"] for r in sums.orderBy(F.desc("n"), "piece").limit(frequent).collect()]


class LengthTable:
    """Compact form of piece -> tokens: UTF-8 of all pieces in one string, and their two sizes.

    `odd` are ranges of characters with which a text is left to the tokenizer as a whole.
    """

    def __init__(self, pieces: list[str], lengths: list[int], odd: list[tuple[int, int]]):
        self.odd = odd
        encoded = [p.encode() for p in pieces]
        self.text = b"".join(encoded)
        self.sizes = np.array([len(p) for p in encoded], np.uint8)
        self.lengths = np.array(lengths, np.uint8)

    def unpacked(self) -> dict[str, int]:
        at, found = 0, {}
        for size, length in zip(self.sizes.tolist(), self.lengths.tolist(), strict=True):
            found[self.text[at : at + size].decode()] = length
            at += size
        return found


class _Lookup(dict):
    """Both tiers: the broadcast lengths, which stay, and up to CACHED others."""

    def __init__(self, table: LengthTable, path: str):
        super().__init__(table.unpacked())
        self.table = table
        self.fixed = len(self)
        self.tokenizer = _tokenizer(path)
        self.special = _special(self.tokenizer)
        self.odd = _finder(table.odd)

    def learn(self, pieces: set[str]) -> dict[str, int]:
        """Encodes pieces that neither tier has; returns those too long to keep."""
        new = [p for p in pieces if p not in self]
        if len(self) - self.fixed + len(new) > CACHED:
            for piece in list(islice(self, self.fixed, None)):
                del self[piece]
            new = [p for p in pieces if p not in self]
        lengths = dict(zip(new, _encoded_lengths(self.tokenizer, new), strict=True))
        self.update((p, n) for p, n in lengths.items() if len(p) <= LONGEST)
        return {p: n for p, n in lengths.items() if len(p) > LONGEST}

    def tokens(self, text: str, pieces: list[str]) -> int:
        if any(map(text.__contains__, self.special)) or self.odd(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        try:
            return sum(map(self.__getitem__, pieces))
        except KeyError:
            rest = self.learn(set(pieces))
            return sum(rest[p] if p in rest else self[p] for p in pieces)


def _lookup(table: LengthTable, path: str) -> _Lookup:
    """This worker's tiers; those of an earlier table give way."""
    lookup = kept(("token counts", path), lambda: _Lookup(table, path))
    if lookup.table is not table:
        release()
        lookup = kept(("token counts", path), lambda: _Lookup(table, path))
    return lookup


def count_tokens(
    docs: DataFrame,
    path: str,
    pattern: str,
    frequent: int = FREQUENT,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of docs (doc_id, text).

    `path` is a tokenizers file of a byte-level BPE, which every executor can open, and `pattern` cuts
    texts into the same pre-tokens as the file does. Special strings inside texts count as the library
    counts them by default. NULL and empty texts have 0. Rows with NULL or repeated doc_ids are kept as
    they are; other columns are left out; an empty table gives none.
    """
    tokenizer = _tokenizer(path)
    pieces = frequent_pieces(docs, pattern, frequent, fit_rows)
    known = [(p, n) for p, n in zip(pieces, _encoded_lengths(tokenizer, pieces), strict=True) if n < 256]
    table = docs.sparkSession.sparkContext.broadcast(
        LengthTable([p for p, _ in known], [n for _, n in known], odd_characters(tokenizer, pattern))
    )
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, cut = _lookup(table.value, path), regex.compile(pattern).findall
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                sizes.append(len(text.encode()))
                tokens.append(lookup.tokens(text, cut(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    schema = T.StructType(
        [rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )
    return rows.mapInArrow(run, schema)
