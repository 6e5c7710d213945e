"""Byte-level BPE as a finite-state transducer, and streaming decoding.

A sequence of tokens is the BPE encoding of its bytes exactly if each token is the
encoding of itself and each two neighbours are the encoding of their joined bytes: no
merge crosses the border of two final tokens, so what happens inside two neighbours does
not depend on the rest. Hence a transducer: a hypothesis is the encoding of a prefix plus
a node of the token trie for the bytes after it; a token may end where it is compatible
with the one before. Exactly one hypothesis is complete after every byte: the encoding of the prefix that
ends there. The set of hypotheses (last token, trie node) is a state of the determinised
machine, and a transition gives the last token of the prefix. When only the complete
hypothesis is left, all tokens so far are decided and emitted. Where several stay alive, as
in long runs of letters, they began within the length of the longest token, and the tokens
that the encodings up to all their beginnings share are emitted: the lookahead is about the
longest token. States and transitions are made when a text first needs them, and kept.

Texts are cut by the vocabulary's pattern first; encodings of pieces are cached per
worker. Caches are cleared when full and never change a result.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from billbook.llm.common import kept

# About 120, 60 and 60 MB; transitions are mostly one or two a state.
STATES = 220_000
TRANSITIONS = 4 * STATES
PAIRS = 400_000
PIECES = 250_000
# So many bytes beyond the longest token are read before hypotheses are compared.
LOOK = 16
_NODE = (1 << 32) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token -> rank, from lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """BPE by definition: join the neighbours of lowest rank, the first of equals, while there are any."""
    never = len(ranks) << 8
    parts = [piece[i : i + 1] for i in range(len(piece))]
    costs = [ranks.get(piece[i : i + 2], never) for i in range(len(piece) - 1)]
    while costs and (best := min(costs)) < never:
        i = costs.index(best)
        parts[i] += parts.pop(i + 1)
        del costs[i]
        if i:
            costs[i - 1] = ranks.get(parts[i - 1] + parts[i], never)
        if i < len(costs):
            costs[i] = ranks.get(parts[i] + parts[i + 1], never)
    return tuple(ranks[p] for p in parts)


class Transducer:
    """Lazily determinised encoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        # The token trie: node << 8 | byte -> node; the root is 0.
        self.child: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        inner = set()
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                inner.add(node)
                node = self.child.setdefault(node << 8 | byte, len(self.child) + 1)
            self.token_at[node] = rank
        self.leaves = set(self.token_at) - inner
        self.longest = max(map(len, ranks))
        # Nodes are numbered after their parents.
        self.depth = array("I", bytes(4 * (len(self.child) + 1)))
        for way, node in self.child.items():
            self.depth[node] = self.depth[way >> 8] + 1
        self.pairs: dict[int, bool] = {}
        # A state is its hypotheses, each as last token + 1 and trie node in one number, as bytes.
        self.number: dict[bytes, int] = {}
        self.states: list[bytes] = []
        # state << 8 | byte -> next state, token that ends here, whether it is decided, in one number.
        self.steps: dict[int, int] = {}
        self._clear()

    def _clear(self, state: int | None = None) -> int:
        """Forgets all states but the start and `state`, whose new number it returns."""
        start = array("Q", [0]).tobytes()
        keep = start if state is None else self.states[state]
        self.steps.clear()
        self.number.clear()
        self.states[:] = dict.fromkeys((start, keep))
        self.number.update((s, i) for i, s in enumerate(self.states))
        return self.number[keep]

    def _follows(self, last: int, token: int) -> bool:
        """Whether `token` may stand after `last`; -1 is the start of the piece."""
        key = (last + 1) << 32 | token
        known = self.pairs.get(key)
        if known is None:
            pair = (token,) if last < 0 else (last, token)
            known = merged(b"".join([self.bytes_of[t] for t in pair]), self.ranks) == pair
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _step(self, state: int, byte: int) -> int:
        alive, ended = array("Q"), -1
        for hypothesis in array("Q", self.states[state]):
            to = self.child.get((hypothesis & _NODE) << 8 | byte)
            if to is None:
                continue
            if to not in self.leaves:
                alive.append(hypothesis & ~_NODE | to)
            token = self.token_at.get(to)
            if token is not None and self._follows((hypothesis >> 32) - 1, token):
                ended = token
        decided = not alive
        alive.append((ended + 1) << 32)
        found = alive.tobytes()
        to = self.number.get(found)
        if to is None:
            to = self.number[found] = len(self.states)
            self.states.append(found)
        step = self.steps[state << 8 | byte] = to << 33 | ended << 1 | decided
        return step

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids: list[int] = []
        for decided in self.stream(piece):
            ids += decided
        return ids

    def stream(self, piece: Iterable[int]) -> Iterator[list[int]]:
        """Ids of one piece that is no token, given byte by byte, as soon as they are decided."""
        open_: list[int] = []  # for each byte since the last emission, the step that it made
        state, known = 0, self.steps.get
        look = first_look = self.longest + LOOK
        for byte in piece:
            step = known(state << 8 | byte)
            if step is None:
                if len(self.states) > STATES or len(self.steps) > TRANSITIONS:
                    state = self._clear(state)
                step = self._step(state, byte)
            state = step >> 33
            open_.append(step)
            if step & 1:
                yield self._emitted(open_)
                open_, look = [], first_look
            elif len(open_) >= look:
                agreed = self._agreed(state, open_)
                if agreed:
                    yield self._emitted(open_[:agreed])
                    open_ = open_[agreed:]
                look = max(first_look, len(open_) + max(LOOK, len(open_) // 2))
        if open_:
            yield self._emitted(open_)

    def _agreed(self, state: int, steps: list[int]) -> int:
        """Where the encodings up to the beginnings of all hypotheses last have a border in common."""
        ends = {len(steps) - self.depth[h & _NODE] for h in array("Q", self.states[state])}
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(last - len(self.bytes_of[steps[last - 1] >> 1 & _NODE]))
        return ends.pop()

    def _emitted(self, steps: list[int]) -> list[int]:
        """The tokens up to here, found from the last one backwards."""
        at, ids = len(steps), []
        while at:
            token = steps[at - 1] >> 1 & _NODE
            ids.append(token)
            at -= len(self.bytes_of[token])
        return ids[::-1]


# The second byte's range after each lead byte of UTF-8, and the bytes that follow a lead.
_SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


def _needed(lead: int) -> int:
    if 0xC2 <= lead <= 0xDF:
        return 1
    if 0xE0 <= lead <= 0xEF:
        return 2
    return 3 if 0xF0 <= lead <= 0xF4 else 0


def utf8_step(held: bytes, data: bytes) -> tuple[bytes, str]:
    """The incremental UTF-8 machine: its state is the incomplete sequence that it holds.

    Returns the next state and the text completed meanwhile; what cannot be continued is U+FFFD.
    """
    text: list[str] = []
    for byte in data:
        if held:
            low, high = _SECOND.get(held[0], (0x80, 0xBF)) if len(held) == 1 else (0x80, 0xBF)
            if low <= byte <= high:
                held += bytes((byte,))
                if len(held) == _needed(held[0]) + 1:
                    text.append(held.decode())
                    held = b""
                continue
            text.append("�")
            held = b""
        if byte < 0x80:
            text.append(chr(byte))
        elif _needed(byte):
            held = bytes((byte,))
        else:
            text.append("�")
    return held, "".join(text)


class _Steps(dict):
    """Token -> (next state, text) from one state of the UTF-8 machine."""

    def __init__(self, held: bytes, bytes_of: dict[int, bytes]):
        super().__init__()
        self.held, self.bytes_of = held, bytes_of

    def __missing__(self, token: int) -> tuple[bytes, str]:
        self[token] = found = utf8_step(self.held, self.bytes_of[token])
        return found


class StreamDecoder:
    """Ids in, text out as soon as its characters are complete."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.table = {b"": _Steps(b"", bytes_of)}

    def feed(self, held: bytes, ids: Iterable[int]) -> tuple[bytes, str]:
        text, table = [], self.table
        steps = table.get(held) or table.setdefault(held, _Steps(held, self.bytes_of))
        for token in ids:
            to, piece = steps[token]
            text.append(piece)
            if to != held:
                held = to
                steps = table.get(held)
                if steps is None:
                    steps = table[held] = _Steps(held, self.bytes_of)
        return held, "".join(text)

    def decode(self, ids: Iterable[int]) -> str:
        held, text = self.feed(b"", ids)
        return text + "�" * bool(held)


class _Packed(dict):
    """Piece -> its ids as little-endian 32-bit integers."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        ids = self.transducer.encode(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = packed
        return packed


def _machine(path: str) -> tuple[_Packed, StreamDecoder]:
    """This worker's transducer of a vocabulary, with its cache, and its decoder."""

    def make() -> tuple[_Packed, StreamDecoder]:
        transducer = Transducer(read_ranks(path))
        return _Packed(transducer), StreamDecoder(transducer.bytes_of)

    return kept(("bpe", path), make)


def encode(docs: DataFrame, path: str, pattern: str, keep: bool = False) -> DataFrame:
    """(doc_id, ids) for every row of docs (doc_id, text), without special tokens; `keep` keeps text too.

    `path` is a rank file that every executor can open; `ids` are bytes, four per token, little-endian.
    NULL and empty texts have no ids. Rows with NULL or repeated doc_ids are kept as they are; other
    columns are left out. A text is handled piece by piece, whatever its length.
    """
    return _coded(docs.select("doc_id", "text"), path, pattern, keep, False)


def decode(encoded: DataFrame, path: str, keep: bool = False) -> DataFrame:
    """(doc_id, ids, decoded) for every row (doc_id, ids) as `encode` gives them; NULL ids are none.

    `keep` keeps text too.
    """
    return _coded(encoded.select("doc_id", "ids", *(["text"] if keep else [])), path, None, keep, True)


def encode_and_decode(docs: DataFrame, path: str, pattern: str, keep: bool = False) -> DataFrame:
    """`decode` of `encode` in one pass, so that a task needs one Python worker and not two."""
    return _coded(docs.select("doc_id", "text"), path, pattern, keep, True)


def _coded(rows: DataFrame, path: str, pattern: str | None, keep: bool, back: bool) -> DataFrame:
    names = [c for c in rows.columns if keep or c != "text"]
    own = T.StructType([rows.schema[c] for c in names])
    new = [("ids", T.BinaryType())] * (pattern is not None) + [("decoded", T.StringType())] * back
    schema = T.StructType([*own, *(T.StructField(n, kind) for n, kind in new)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, decoder = _machine(path)
        cut = regex.compile(pattern).finditer if pattern else None
        for batch in batches:
            columns = [batch.column(n) for n in names]
            if cut:
                texts = map(pa.StringScalar.as_py, batch.column("text"))
                ids = pa.array(
                    [b"".join([packed[m.group()] for m in cut(t)]) if t else b"" for t in texts], pa.binary()
                )
                columns.append(ids)
            else:
                ids = batch.column("ids")
            if back:
                decoded = [
                    decoder.decode(np.frombuffer(i, "<u4").tolist()) if i else ""
                    for i in map(pa.BinaryScalar.as_py, ids)
                ]
                columns.append(pa.array(decoded, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)
