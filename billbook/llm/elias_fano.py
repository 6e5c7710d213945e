"""Elias-Fano sequences as flat byte arrays: monotone numbers, readable from a memory-mapped file.

Each of n sorted numbers is cut into low bits, which are stored packed, and a high part,
stored in unary: the i-th number sets bit (high part + i). A directory of set bits makes
`select` fast; all operations work on arrays of queries.
"""

from __future__ import annotations

import numpy as np


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, words: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.words, self.ones = n, low_bits, low, words, ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """Of sorted numbers below 2**63; equal ones may repeat."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        words = np.zeros((int(high[-1]) if n else 0) // 64 + 2, np.uint64)
        np.bitwise_or.at(words, high >> 6, np.uint64(1) << (high & 63).astype(np.uint64))
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
        low = np.zeros((n * low_bits + 7) // 8 + 9, np.uint8)
        step = 8 << 13  # numbers at a time; their bits fill whole bytes
        for first in range(0, n if low_bits else 0, step):
            part = values[first : first + step]
            bits = (part[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
            at = first * low_bits // 8
            low[at : at + len(packed)] = packed
        return cls(n, low_bits, low, words, ones)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.words, self.ones]

    @classmethod
    def from_arrays(cls, head: np.ndarray, low: np.ndarray, words: np.ndarray, ones: np.ndarray) -> EliasFano:
        return cls(int(head[0]), int(head[1]), low, words, ones)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.int64) * self.low_bits
        found = np.zeros(len(i), np.uint64)
        for k in range(8):
            found |= self.low[(bit >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
        shift = (bit & 7).astype(np.uint64)
        found >>= shift
        if self.low_bits > 57:
            found |= np.where(
                shift > 0,
                self.low[(bit >> 3) + 8].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, np.uint64(1))),
                np.uint64(0),
            )
        return found & np.uint64((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th bit, from 0, that is set or, without `ones`, unset."""
        before = self.ones if ones else np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.minimum(np.searchsorted(before, k, side="right") - 1, len(self.words) - 1)
        rest = (k - before[word]).astype(np.int64)
        bits = self.words[word] if ones else ~self.words[word]
        place = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            half = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            right = rest >= half
            rest -= np.where(right, half, 0)
            place += np.where(right, width, 0)
            bits = np.where(right, bits >> np.uint64(width), bits)
        return word * 64 + place

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        high = (self._select(np.asarray(i, np.int64), True) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def find(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Where each value stands among the numbers of [first, last), or -1: search for its successor."""
        values = np.asarray(values, np.uint64)
        found = np.full(len(values), -1, np.int64)
        if not self.n:
            return found
        high = np.minimum(values >> np.uint64(self.low_bits), np.uint64(len(self.words) * 64)).astype(np.int64)
        zeros = len(self.words) * 64 - int(self.ones[-1])
        # Numbers of a high part stand between the zero before it and its own.
        at = np.where(high > 0, self._select(np.clip(high - 1, 0, zeros - 1), False) - high + 1, 0)
        end = self._select(np.clip(high, 0, zeros - 1), False) - high
        at, end = np.maximum(at, first), np.minimum(end, last)
        wanted = values & np.uint64((1 << self.low_bits) - 1)
        asked = np.nonzero((at < end) & (high < zeros))[0]
        at, stop, wanted = at[asked], end[asked], wanted[asked]
        end = stop.copy()
        while True:
            # Binary search for the first low part that is not smaller: a high part may hold very many.
            open_ = np.nonzero(at < stop)[0]
            if not len(open_):
                break
            middle = (at[open_] + stop[open_]) // 2
            smaller = self._low(middle) < wanted[open_]
            at[open_] = np.where(smaller, middle + 1, at[open_])
            stop[open_] = np.where(smaller, stop[open_], middle)
        inside = np.nonzero(at < end)[0]
        hit = inside[self._low(at[inside]) == wanted[inside]]
        found[asked[hit]] = at[hit]
        return found
