"""Vectorised word handling over Arrow batches, shared by the operators on texts.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``. A null text counts as empty. Texts
are cut into blocks of whole texts, so a task holds a bounded number of bytes beside the
batch it got from Spark (one text that is longer than a block is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)


def u64(x: int) -> np.uint64:
    return np.uint64(x & 0xFFFFFFFFFFFFFFFF)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; one to one."""
    h = (h ^ (h >> u64(32))) * u64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> u64(32))) * u64(0xD6E8FEB86659FD93)
    return h ^ (h >> u64(32))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its beginning and the hash of what follows."""
    return mix(left * u64(0x9FB21C651E98DF25) + right)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        steps = np.full(size, u64(base))
        steps[0] = 1
        have = np.cumprod(steps)
        if size > 8 * BLOCK_BYTES:  # one very long text does not keep its table
            return have[:n]
        _powers[base] = have
    return have[:n]


@lru_cache(maxsize=4)
def byte_values(seed: int) -> np.ndarray:
    """A random odd value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) + u64(seed * 1_000_003)) | u64(1)


def prefix_hashes(data: np.ndarray, seed: int = 0) -> np.ndarray:
    """Polynomial hashes of all prefixes, modulo 2**64; one longer than the data."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(byte_values(seed)[data] * powers(BASE, len(data)), out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range; equal bytes give equal hashes, whatever the place."""
    return (prefix[end] - prefix[start]) * powers(UNBASE, len(prefix))[start]


@dataclass
class Block:
    """Some whole texts: their rows in the batch, bytes one after the other, and offsets."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each run of bytes outside ``space``, and offsets into these by text."""
        n = len(self.data)
        inside = ~space[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        outside = ~inside
        start, end = inside.copy(), inside.copy()
        start[1:] &= outside[:-1] | edge[1:n]
        end[:-1] &= outside[1:] | edge[1:n]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def per_text(self, at: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """Sums by text of what lies at the byte places ``at`` (ascending)."""
        text = np.searchsorted(self.offsets, at, side="right") - 1
        return np.bincount(text, weights, minlength=len(self))


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column in order, about ``size`` bytes at a time."""
    data, offsets = as_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield Block(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def word_hashes(block: Block, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, lower-cased in A-Z if asked."""
    data = LOWER[block.data] if lower else block.data
    return mix(range_hashes(prefix_hashes(data), starts, ends) + (ends - starts).astype(np.uint64))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.diff(np.append(first, len(values)))
