"""Content-defined anchors: where texts may share a long string, whatever surrounds it.

A window of `length` bytes has as its anchor the leftmost of its `GRAM`-byte strings with the
smallest hash. The anchor depends on the window's bytes only, so equal windows have equal
anchors at equal places, and windows whose anchors occur once anywhere need no comparison.
Neighbouring windows mostly share an anchor and form a run.
"""

from __future__ import annotations

import numpy as np

GRAM = 64
_SEGMENT = 1 << 19  # window starts handled at a time
_BASE = 0x5851F42D4C957F2D
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if n not in _powers:
        _powers.clear()
        base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        tables = []
        for b in (base, inverse):
            table = np.full(n, b, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[n] = (tables[0], tables[1])
    return _powers[n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed rolling hash of the `gram` bytes from every place."""
    power, inverse = _power_tables(_SEGMENT * 2)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    found = (sums[gram:] - sums[:-gram]) * inverse[: len(data) - gram + 1]
    found ^= found >> np.uint64(32)
    found *= np.uint64(0x9FB21C651E98DF25)
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(32)
    return found


def runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first start, last start, anchor hash) of the runs of windows that lie inside one text.

    `data` holds texts one after the other, and `ends` where each of them ends.
    """
    span = length - gram + 1  # strings in a window
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    anchor, value = np.empty(n, np.int64), np.empty(n, np.uint64)
    place_bits = np.uint64((_SEGMENT * 2).bit_length())
    place_mask = (np.uint64(1) << place_bits) - np.uint64(1)
    for first in range(0, n, _SEGMENT):
        count = min(_SEGMENT, n - first)
        hashes = gram_hashes(data[first : first + count + length - 1], gram)
        least = (hashes & ~place_mask) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:count], least[span - width : span - width + count])
        place = (least & place_mask).astype(np.int64)
        anchor[first : first + count] = place + first
        value[first : first + count] = hashes[place]
    inside = np.ones(n, bool)
    for end in np.asarray(ends)[:-1]:
        inside[max(0, end - length + 1) : end] = False
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first = np.nonzero(new & inside)[0]
    stop = np.ones(n, bool)
    stop[:-1] = new[1:] | ~inside[1:]
    last = np.nonzero(stop & inside)[0]
    return first, last, value[first]
