"""Count-min sketch over 64-bit hashes, merged from partition sketches.

The sketch has ``DEPTH`` rows of 2^bits cells and answers "seen twice or more?".
It may overestimate (two keys share a cell), never underestimate. Cells saturate
at two, so a merged row is one bit per cell. A task's partition sketch is sparse:
the sorted cells it has touched, twice where it counted two or more, as byte-wide
gaps; it is cut by range of cells (shards), and shards merge in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import mix

DEPTH, SHARD_BITS = 2, 22
FLUSH_KEYS = 4_000_000


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    mixed = keys if row == 0 else mix(keys + np.uint64(row) * np.uint64(0x9E3779B97F4A7C15))
    return (mixed >> np.uint64(64 - bits)).astype(np.uint32)


def gaps(sorted_cells: np.ndarray) -> bytes:
    """Ascending numbers as bytes: 255 adds and goes on, less than 255 adds and ends one."""
    if not len(sorted_cells):
        return b""
    step = np.diff(sorted_cells.astype(np.int64), prepend=0)
    more = step // 255
    out = np.full(int(more.sum()) + len(step), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = step % 255
    return out.tobytes()


def ungaps(data: bytes | memoryview) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def twice_at_most(values: np.ndarray) -> np.ndarray:
    """Sorted values, each at most two times."""
    v = np.sort(values)
    keep = np.ones(len(v), bool)
    keep[2:] = v[2:] != v[:-2]
    return v[keep]


class Sketch:
    """The merged sketch: per row, one bit per cell for a count of two or more.

    It travels as compressed shards (the bitmaps are mostly empty): the driver never
    unpacks them, and a worker does so once, at first use, giving up each shard as it
    goes into its bitmap."""

    def __init__(self, bits: int, shard_bits: int, shards: dict[int, bytes]):
        self.bits, self.shard_bits, self.shards, self.bitmaps = bits, shard_bits, shards, None

    def __getstate__(self):
        if self.bitmaps is not None:
            raise ValueError("an unpacked sketch has no shards left to send")
        return self.__dict__

    @property
    def rows(self) -> list[np.ndarray]:
        if self.bitmaps is None:
            n, width = 1 << (self.bits - self.shard_bits), max(1, (1 << self.shard_bits) // 8)
            self.bitmaps = [np.zeros(n * width, np.uint8) for _ in range(DEPTH)]
            while self.shards:
                shard, data = self.shards.popitem()
                row, k = divmod(shard, n)
                self.bitmaps[row][k * width:(k + 1) * width] = np.frombuffer(zlib.decompress(data), np.uint8)
        return self.bitmaps

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for row, bitmap in enumerate(self.rows):
            at = np.flatnonzero(out) if row else slice(None)
            c = cells(keys[at], row, self.bits)
            out[at] = (bitmap[c >> np.uint32(3)] >> (c & np.uint32(7)).astype(np.uint8)) & 1
        return out


def build(rows: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> Sketch:
    """Sketch of all keys that ``keys_of`` finds in the batches of ``rows``. What the
    driver collects is the merged sketch: at most DEPTH * 2^bits bits, compressed."""
    shard_bits = min(SHARD_BITS, bits)
    n_shards = 1 << (bits - shard_bits)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            keys = np.concatenate(held)
            for row in range(DEPTH):
                own = twice_at_most(cells(keys, row, bits))
                at = np.searchsorted(own, np.arange(n_shards + 1, dtype=np.int64) << shard_bits)
                low = own & np.uint32((1 << shard_bits) - 1)
                data = [gaps(low[a:b]) for a, b in zip(at[:-1], at[1:])]
                some = [k for k, d in enumerate(data) if d]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row * n_shards + k for k in some], pa.int32()), pa.array([data[k] for k in some], pa.binary())],
                    ["shard", "cells"])

        for batch in batches:
            for keys in keys_of(batch):
                if len(keys):
                    held.append(keys)
                    size += len(keys)
                if size >= FLUSH_KEYS:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    def merge(key, table):
        seen, again = np.zeros(1 << shard_bits, bool), np.zeros(1 << shard_bits, bool)
        for cell in table.column("cells"):
            c = ungaps(cell.as_buffer())
            again[c[1:][c[1:] == c[:-1]]] = True
            again[c[seen[c]]] = True
            seen[c] = True
        data = zlib.compress(np.packbits(again, bitorder="little").tobytes(), 1)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([data], pa.binary())})

    merged = (rows.mapInArrow(partial, "shard int, cells binary").groupBy("shard")
              .applyInArrow(merge, "shard int, bits binary"))
    return Sketch(bits, shard_bits, {r.shard: bytes(r.bits) for r in merged.collect()})
