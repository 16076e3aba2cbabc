"""Packed numpy columns in binary cells, for shuffles of many small numbers.

A row of a Spark shuffle costs tens of bytes; hashes of every window of a corpus
are sent as arrays instead, one cell per task and bucket. A pack is the item
counts and type codes followed by the raw arrays."""

from __future__ import annotations

import struct

import numpy as np

_CODES = {"u1": 1, "u2": 2, "u4": 3, "u8": 4, "i4": 5, "i8": 6}
_TYPES = {v: np.dtype("<" + k) for k, v in _CODES.items()}


def pack(*arrays: np.ndarray) -> bytes:
    head = struct.pack("<B", len(arrays)) + b"".join(
        struct.pack("<BQ", _CODES[a.dtype.str[1:]], len(a)) for a in arrays)
    return head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(cell: bytes | memoryview) -> list[np.ndarray]:
    (n,), at = struct.unpack_from("<B", cell), 1
    heads = [struct.unpack_from("<BQ", cell, at + 9 * k) for k in range(n)]
    at += 9 * n
    out = []
    for code, length in heads:
        kind = _TYPES[code]
        out.append(np.frombuffer(cell, kind, length, at))
        at += length * kind.itemsize
    return out


def by_bucket(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by bucket and the offsets of the buckets 0 ... n-1."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))
