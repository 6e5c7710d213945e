"""Blocks of numbers: what a chunk of texts and a shard of keys tell each other in one row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of any types, compressed; `unpack` has them back."""
    head = ";".join(f"{a.dtype.str},{a.size}" for a in arrays).encode()
    raw = len(head).to_bytes(4, "little") + head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(block: bytes) -> list[np.ndarray]:
    raw = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), "zstd", asbytes=True)
    size = int.from_bytes(raw[:4], "little")
    at, arrays = 4 + size, []
    for kind, n in (part.split(",") for part in raw[4 : 4 + size].decode().split(";")):
        arrays.append(np.frombuffer(raw, kind, int(n), at))
        at += arrays[-1].nbytes
    return arrays


def shard_of(ids: np.ndarray, shards: int) -> np.ndarray:
    mixed = ids * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def smallest(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shards with the places of their entries, in order."""
    if not len(shard):
        return
    order = np.argsort(shard, kind="stable")
    numbers, first = np.unique(shard[order], return_index=True)
    yield from zip(numbers.tolist(), np.split(order, first[1:]), strict=True)
