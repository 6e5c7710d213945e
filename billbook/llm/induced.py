"""Suffix order and common prefixes of a byte string by external induced sorting.

A suffix is S if it is smaller than the next one and L if it is larger; LMS suffixes are
the S suffixes after an L. From the LMS suffixes in order, one ascending sweep over the
first-byte buckets induces the order of the L suffixes and one descending sweep that of the
S suffixes: each suffix, when its turn comes, sends the one before it to the queue of that
one's first byte. Queues hold tuples (place, common prefix with the tuple before); together
they are the priority queue of the sweep, ordered by first byte and then by arrival. They
are written to disk beyond a limit of memory, and text and types are memory-mapped. The
common prefix of two tuples of a queue is one more than the least one between the suffixes
that sent them.

The LMS suffixes are ordered by recursion: the same two sweeps order the strings between LMS
places, equal strings get equal names, and the names make a string of a third of the size.
Names have far too many values for one queue each, so that string is ordered by doubling
prefixes over names instead of a further sweep.

Common prefixes are counted up to `depth`, and suffixes that agree that far may stand in
any order.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 18  # tuples handled at a time
MEMORY = 64 << 20  # bytes of all queues before they are written to disk
_FAR = np.uint8(255)


class _Queues:
    """One queue of tuples (place, common prefix with the tuple before) for each first byte."""

    def __init__(self, folder: str, name: str, place_type: type, memory: int):
        self.folder, self.name, self.place_type, self.memory = folder, name, place_type, memory
        self.parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(256)]
        self.starts: list[list[int]] = [[] for _ in range(256)]
        self.on_disk, self.sizes, self.held = [0] * 256, [0] * 256, 0

    def _path(self, byte: int, what: str) -> str:
        return os.path.join(self.folder, f"{self.name}-{what}-{byte}")

    def push(self, byte: int, places: np.ndarray, common: np.ndarray) -> None:
        self.starts[byte].append(self.sizes[byte])
        self.parts[byte].append((places, common))
        self.sizes[byte] += len(places)
        self.held += places.nbytes + common.nbytes
        if self.held > self.memory:
            for b in range(256):
                self._write(b)
            self.held = 0

    def _write(self, byte: int) -> None:
        if self.parts[byte]:
            with open(self._path(byte, "place"), "ab") as place, open(self._path(byte, "common"), "ab") as common:
                for p, c in self.parts[byte]:
                    place.write(p.tobytes())
                    common.write(c.tobytes())
            self.on_disk[byte] = self.sizes[byte]
            self.parts[byte], self.starts[byte] = [], []

    def read(self, byte: int, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Tuples from `first` on, up to `stop` or to where the part on disk ends."""
        n = self.on_disk[byte]
        if first < n:
            stop = min(stop, n)
            return tuple(
                np.fromfile(self._path(byte, what), kind, stop - first, offset=first * np.dtype(kind).itemsize)
                for what, kind in (("place", self.place_type), ("common", np.uint8))
            )
        i = bisect_right(self.starts[byte], first) - 1
        found = []
        while i < len(self.parts[byte]) and self.starts[byte][i] < stop:
            at = self.starts[byte][i]
            p, c = self.parts[byte][i]
            cut = slice(max(first - at, 0), stop - at)
            found.append((p[cut], c[cut]))
            i += 1
        if len(found) == 1:
            return found[0]
        return np.concatenate([p for p, _ in found]), np.concatenate([c for _, c in found])

    def forward(self, byte: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples in order, also those that arrive while they are read."""
        at = 0
        while at < self.sizes[byte]:
            block = self.read(byte, at, min(at + BLOCK, self.sizes[byte]))
            at += len(block[0])
            yield block

    def backward(self, byte: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples from the last to the first, each with the common prefix with the one after it."""
        stop, after = self.sizes[byte], np.uint8(0)
        while stop:
            first = max(0, stop - BLOCK)
            if first < self.on_disk[byte] < stop:
                first = self.on_disk[byte]
            places, common = self.read(byte, first, stop)
            yield places[::-1], np.append(common[1:], after)[::-1]
            after, stop = common[0], first

    def ends(self, byte: int) -> int:
        """The last place of a queue, or -1."""
        n = self.sizes[byte]
        return int(self.read(byte, n - 1, n)[0][0]) if n else -1


class _Sweep:
    """Sends from each block of suffixes the ones before them to their queues."""

    def __init__(self, text: np.ndarray, small: np.ndarray, queues: _Queues, descending: bool, depth: int):
        self.text, self.small, self.queues, self.descending, self.depth = text, small, queues, descending, depth
        self.least = np.zeros(256, np.uint8)  # least common prefix since each queue's last tuple
        self.empty = np.ones(256, bool)

    def send(self, places: np.ndarray, common: np.ndarray) -> None:
        """`common` has for each suffix the common prefix with the one whose turn was before."""
        if not len(places):
            return
        before = places - 1
        byte = self.text[before]  # place 0 wraps around, and is left out below
        wanted = (self.small[before] if self.descending else ~self.small[before]) & (places > 0)
        at = np.nonzero(wanted)[0]
        overall = common.min()
        if len(at):
            order = at[np.argsort(byte[at], kind="stable")]
            targets = byte[order]
            new = np.ones(len(order), bool)
            new[1:] = targets[1:] != targets[:-1]
            low = np.zeros(len(order), np.int64)
            low[1:] = order[:-1] + 1
            low[new] = 0
            least = _range_least(common, low, order)
            firsts = np.nonzero(new)[0]
            heads = targets[firsts]
            least[firsts] = np.minimum(least[firsts], self.least[heads])
            sent = np.minimum(least, self.depth - 1) + np.uint8(1)
            sent[firsts[self.empty[heads]]] = 0
            stops = np.append(firsts[1:], len(order))
            after = np.full(len(heads), _FAR)
            lasts = order[stops - 1]
            inner = lasts + 1 < len(common)
            after[inner] = _range_least(common, lasts[inner] + 1, np.full(int(inner.sum()), len(common) - 1))
            self.least = np.minimum(self.least, overall)
            self.least[heads] = after
            self.empty[heads] = False
            moved = before[order]
            for head, first, stop in zip(heads.tolist(), firsts.tolist(), stops.tolist(), strict=True):
                self.queues.push(head, moved[first:stop], sent[first:stop])
        else:
            self.least = np.minimum(self.least, overall)


def _range_least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first..last] of each pair, from a table of blocks of powers of two."""
    if not len(first):
        return np.zeros(0, np.uint8)
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    found = np.empty(len(first), np.uint8)
    table, width = values, 1
    for k in range(int(level.max()) + 1):
        own = np.nonzero(level == k)[0]
        if len(own):
            found[own] = np.minimum(table[first[own]], table[last[own] - width + 1])
        if len(table) <= width:
            break
        table = np.minimum(table[:-width], table[width:])
        width *= 2
    return found


def _types(text: np.ndarray, small: np.ndarray) -> None:
    """Fills in which suffixes are S, from the end; a suffix equal so far is as the one after it."""
    later = False
    n = len(text)
    for stop in range(n, 0, -BLOCK * 8):
        first = max(0, stop - BLOCK * 8)
        here = text[first:stop].astype(np.int16)
        following = np.append(here[1:], text[stop] if stop < n else -1)
        sign = np.sign(following - here)
        decided = np.nonzero(sign)[0]
        nearest = np.searchsorted(decided, np.arange(len(here)))
        known = nearest < len(decided)
        part = np.full(len(here), later)
        part[known] = sign[decided[nearest[known]]] > 0
        small[first:stop] = part
        later = bool(part[0])


def _lms(small: np.ndarray, place_type: type) -> np.ndarray:
    found = []
    for first in range(0, len(small), BLOCK * 8):
        here = small[first : first + BLOCK * 8]
        before = np.append(small[first - 1] if first else True, here[:-1])
        found.append(np.nonzero(here & ~before)[0].astype(place_type) + place_type(first))
    return np.concatenate(found)


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of the suffixes at a and b, up to depth; `text` has 8 bytes more at its end."""
    found = np.zeros(len(a), np.int64)
    end = len(text) - 8
    for first in range(0, len(a), BLOCK):
        x, y = a[first : first + BLOCK].astype(np.int64), b[first : first + BLOCK].astype(np.int64)
        open_, length = np.arange(len(x)), np.zeros(len(x), np.int64)
        while len(open_):
            u, v = x[open_] + length[open_], y[open_] + length[open_]
            fits = np.maximum(u, v) < end
            u, v = np.minimum(u, end), np.minimum(v, end)
            differ = _words(text, u) ^ _words(text, v)
            lowest = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, np.bitwise_count(lowest - np.uint64(1)) // 8).astype(np.int64)
            length[open_] += np.where(fits, same, 0)
            open_ = open_[fits & (same == 8) & (length[open_] < depth)]
        found[first : first + BLOCK] = np.minimum(length, np.minimum(end - np.maximum(x, y), depth))
    return found


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    return text[at[:, None] + np.arange(8)].view(np.uint64).ravel()


def _ordered_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, correct for depth names."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    rank = _group_starts(names[order], order)
    width = 1
    while width < depth:
        ranked = rank[order]
        tied = np.zeros(n, bool)
        same = ranked[1:] == ranked[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        places = np.nonzero(tied)[0]
        if not len(places):
            break
        own = order[places]
        next_ = np.where(own + width < n, rank[np.minimum(own + width, n - 1)] + 1, 0)
        key = rank[own] * (n + 1) + next_
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        order[places] = own
        # A group's members keep its places; a new subgroup starts where the key changes.
        fresh = np.ones(len(own), bool)
        fresh[1:] = key[1:] != key[:-1]
        rank[own] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))]
        width *= 2
    return order


def _group_starts(sorted_values: np.ndarray, order: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(order), bool)
    fresh[1:] = sorted_values[1:] != sorted_values[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    return rank


def _sweep_up(text, small, seeds, seeds_common, queues, depth) -> None:
    """Queues of L suffixes in order, from LMS suffixes in order (or by first byte only)."""
    sweep = _Sweep(text, small, queues, False, depth)
    n = len(small)
    sweep.send(np.array([n], queues.place_type), np.zeros(1, np.uint8))
    first_bytes = text[seeds]
    borders = np.searchsorted(first_bytes, np.arange(257))
    for byte in range(256):
        for places, common in queues.forward(byte):
            sweep.send(places, common)
        first, stop = borders[byte], borders[byte + 1]
        last = queues.ends(byte)
        for at in range(first, stop, BLOCK):
            common = seeds_common[at : min(at + BLOCK, stop)].copy()
            if at == first:
                common[0] = _one_common(text, last, int(seeds[at]), n, depth)
            sweep.send(seeds[at : min(at + BLOCK, stop)], common)


def _one_common(text: np.ndarray, a: int, b: int, n: int, depth: int) -> int:
    if a < 0 or b < 0:
        return 0
    x, y = text[a : min(a + depth, n)], text[b : min(b + depth, n)]
    size = min(len(x), len(y))
    differ = np.nonzero(x[:size] != y[:size])[0]
    return int(differ[0]) if len(differ) else size


def _sweep_down(text, small, large, queues, depth) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes from the last to the first, in blocks with the common prefix with the one after each.

    `large` are the L queues, `queues` receive the S suffixes.
    """
    sweep = _Sweep(text, small, queues, True, depth)
    n = len(small)
    for byte in range(255, -1, -1):
        for places, common in queues.forward(byte):
            sweep.send(places, common)
            yield places, common
        lowest, joint = queues.ends(byte), True
        for places, common in large.backward(byte):
            if joint:
                common = common.copy()
                common[0] = _one_common(text, int(places[0]), lowest, n, depth)
                joint = False
            sweep.send(places, common)
            yield places, common


def suffixes(
    text: np.ndarray, folder: str, depth: int = 200, memory: int = MEMORY
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffixes of a byte string from the last to the first, in blocks (places, common prefixes).

    A common prefix is that with the suffix that was given before, which is the next larger one. `folder`
    is the task's own; what is written there is the caller's to remove. An empty string gives nothing.
    `depth` is 254 at most.
    """
    n = len(text)
    if n == 0:
        return
    place_type = np.int32 if n < 2**31 - 16 else np.int64
    path = os.path.join(folder, "text")
    with open(path, "wb") as out:
        for first in range(0, n, 1 << 24):
            out.write(np.asarray(text[first : first + (1 << 24)], np.uint8).tobytes())
        out.write(b"\0" * 8)
    # Plain views of the maps: indexing them is faster, and pages still come from the files.
    mapped = np.asarray(np.memmap(path, np.uint8, "r"))
    small = np.asarray(np.memmap(os.path.join(folder, "small"), bool, "w+", shape=(n,)))
    _types(mapped[:n], small)
    lms = _lms(small, place_type)
    seeds = lms[np.argsort(mapped[lms], kind="stable")]
    common = np.zeros(len(seeds), np.uint8)
    if len(lms) > 1:
        # First induction: the order of the strings between LMS places, and their names.
        up = _Queues(folder, "string-l", place_type, memory)
        _sweep_up(mapped, small, seeds, common, up, depth)
        down = _Queues(folder, "string-s", place_type, memory)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        found = [p[is_lms[p]] for p, _ in _sweep_down(mapped, small, up, down, depth)]
        strings = np.concatenate(found)[::-1]
        del up, down, found, is_lms
        size = np.append(np.diff(lms), n - lms[-1]) + 1
        number = np.searchsorted(lms, strings)
        same = _same_strings(mapped, strings, size[number])
        names = np.empty(len(lms), np.int64)
        names[number] = np.cumsum(np.append(True, ~same)) - 1
        if same.any():
            seeds = lms[_ordered_names(names, depth // 2 + 2)]
        else:
            seeds = strings
        common[1:] = _common(mapped, seeds[1:], seeds[:-1], depth).astype(np.uint8)
    up = _Queues(folder, "l", place_type, memory)
    _sweep_up(mapped, small, seeds, common, up, depth)
    down = _Queues(folder, "s", place_type, memory)
    yield from _sweep_down(mapped, small, up, down, depth)


def _same_strings(text: np.ndarray, strings: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether each string between LMS places equals the one before it."""
    limit = int(size.max())
    possible = np.nonzero(size[1:] == size[:-1])[0]
    same = np.zeros(len(strings) - 1, bool)
    same[possible] = _common(text, strings[1:][possible], strings[:-1][possible], limit) >= np.minimum(
        size[1:][possible], len(text) - 8 - np.maximum(strings[1:], strings[:-1])[possible]
    )
    return same
