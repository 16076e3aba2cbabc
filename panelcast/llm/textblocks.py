"""Vectorised words and hashes over the UTF-8 bytes of Arrow text columns.

Used inside Spark tasks only. A batch is cut into blocks of a few megabytes (a
longer document is a block of its own), so working memory follows the block, not
the batch. Words are maximal runs without the bytes 0x20 and 0x09-0x0D; these
never occur inside a multi-byte character, so bytes can be scanned directly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
CONTINUATION = np.zeros(256, bool)
CONTINUATION[0x80:0xC0] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


class Block:
    """A run of documents: their rows in the batch, bytes and byte offsets."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.n = len(offsets) - 1

    def words(self, separators: np.ndarray = SEPARATORS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (exclusive) and document (in the block) of every word."""
        inside = ~separators[self.data]
        edges = self.offsets[:-1][self.offsets[:-1] < self.offsets[-1]]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[edges] = inside[edges]
        starts = np.flatnonzero(opens)
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        last = self.offsets[1:][self.offsets[1:] > 0] - 1
        closes[last] = inside[last]
        ends = np.flatnonzero(closes) + 1
        docs = np.searchsorted(self.offsets, starts, side="right") - 1
        return starts, ends, docs


def binary(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK_BYTES) -> Iterator[Block]:
    data, offsets = binary(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield Block(i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


# --- hashes -----------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _family(seed: int) -> tuple[np.ndarray, int, int]:
    """Random value per byte, an odd base and its inverse modulo 2^64."""
    rng = np.random.Generator(np.random.PCG64(seed))
    table = rng.integers(0, 2**64, 256, np.uint64, endpoint=False)
    base = int(rng.integers(0, 2**62)) * 4 + 3
    return table, base, pow(base, -1, 2**64)


@lru_cache(maxsize=16)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64, from a table grown in doublings."""
    return _powers(base, 1 << max(16, (max(n, 1) - 1).bit_length()))[:n]


# Ranges are hashed a piece at a time: tables and working arrays follow the piece, not the text.
PIECE = 1 << 16


def _pieces(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring ranges (both ends ascending) that span ``PIECE`` items together, or one
    longer range alone."""
    i, n = 0, len(starts)
    while i < n:
        j = max(int(np.searchsorted(ends, starts[i] + PIECE, side="right")), i + 1)
        yield i, j
        i = j


def _long_hash(values, length: int, base: int) -> int:
    """Polynomial of one long range modulo 2^64, piece by piece."""
    total, shift, step = 0, 1, pow(base, PIECE, 2**64)
    for at in range(0, length, PIECE):
        part = values(at, min(at + PIECE, length))
        total += shift * int((part * powers(base, len(part))).sum(dtype=np.uint64))
        shift = shift * step % 2**64
    return total % 2**64


def _range_hashes(values, starts: np.ndarray, ends: np.ndarray, base: int, inverse: int) -> np.ndarray:
    """Mixed polynomial of ``values(a, b)`` over each range; both ends ascending."""
    raw = np.zeros(len(starts), np.uint64)
    for i, j in _pieces(starts, ends):
        a, b = int(starts[i]), int(ends[j - 1])
        if b - a > PIECE:
            raw[i] = _long_hash(lambda x, y, a=a: values(a + x, a + y), b - a, base)
            continue
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(values(a, b) * powers(base, b - a), out=sums[1:])
        raw[i:j] = (sums[ends[i:j] - a] - sums[starts[i:j] - a]) * powers(inverse, b - a + 1)[starts[i:j] - a]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of each byte range (ranges in order), from prefix sums of a polynomial."""
    table, base, inverse = _family(seed)
    return _range_hashes(lambda a, b: table[data[a:b]], starts, ends, base, inverse)


def run_hashes(items: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 2) -> np.ndarray:
    """64-bit hash of items[start:end] for each range (ranges in order); the items are hashes."""
    _, base, inverse = _family(seed)
    return _range_hashes(lambda a, b: items[a:b], starts, ends, base, inverse)


def window_starts(docs: np.ndarray, width: int) -> np.ndarray:
    """Positions where ``width`` consecutive items belong to one document."""
    if len(docs) < width:
        return np.zeros(0, np.int64)
    return np.flatnonzero(docs[width - 1:] == docs[:len(docs) - width + 1])


def bounds(docs: np.ndarray, n: int) -> np.ndarray:
    """Offsets of the items of documents 0 ... n-1 (``docs`` ascending)."""
    return np.searchsorted(docs, np.arange(n + 1))


def flat(values: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenates values[offsets[w]:offsets[w+1]] for each w; also returns the lengths."""
    lengths = offsets[which + 1] - offsets[which]
    total = int(lengths.sum())
    shift = np.repeat(offsets[which] - (np.cumsum(lengths) - lengths), lengths)
    return values[shift + np.arange(total)], lengths
