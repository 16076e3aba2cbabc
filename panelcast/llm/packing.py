"""Operator 6: bounded-space online best-fit packing of token sequences.

Documents become token pieces (only a document longer than the capacity is cut).
What is packed are narrow rows (id, piece, length): tokens are not shuffled.
Pieces are dealt by hash over tasks of about ``task_tokens`` tokens each, in hash
order, and every task packs its pieces online: a piece goes into the open bin
with the least sufficient free space, found in a bitset with one bit per amount
of free space; if none fits, a new bin opens, and beyond ``open_bins`` the
fullest open bin closes first. Memory per task is the open bins. The order is a
function of the rows, so a task run again after an executor is lost gives the
same bins.

Edge cases: a null or empty text is the end id alone (length 1); rows repeated
under one id are packed each; a null id is packed like any other; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, narrow, scalar, ship_package

CAPACITY, OPEN_BINS, TASK_TOKENS = 4096, 1024, 24_000_000
PIECES = "id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids; ``ids`` are little-endian uint32."""
    ship_package(docs.sparkSession)
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .textblocks import blocks
        from .tokens import encode_block, huggingface

        table, end = huggingface(tokenizer), np.array([end_id], np.uint32)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                ids, off = encode_block(block, table)
                rows = []
                for i in range(block.n):
                    own = np.concatenate([ids[off[i]:off[i + 1]], end]).astype("<u4")
                    for k, start in enumerate(range(0, len(own), capacity)):
                        part = own[start:start + capacity]
                        rows.append((doc_ids[block.first + i], k, start, len(part), part.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return narrow(docs, id_col, text_col).mapInArrow(encode, PIECES)


class BestFit:
    """Open bins by free space: ``free_bits`` has bit f set where ``by_free[f]`` is not empty."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.free_bits, self.by_free, self.n_open, self.n_bins = 0, {}, 0, 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        bin_ = stack.pop()
        if not stack:
            self.free_bits ^= 1 << free
        self.n_open -= 1
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of the next piece."""
        fitting = self.free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.n_open >= self.limit:  # the fullest closes
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            free, bin_ = self.capacity, self.n_bins
            self.n_bins += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(bin_)
            self.free_bits |= 1 << left
            self.n_open += 1
        return bin_, self.capacity - free


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         task_tokens: int = TASK_TOKENS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``id, piece, length`` (1 to capacity)."""
    total = scalar(pieces.agg(F.coalesce(F.sum("length"), F.lit(0))))
    order = F.xxhash64(*pieces.columns)
    dealt = (pieces.withColumn("__order", order)
             .repartition(max(1, math.ceil(total / task_tokens)), "__order")
             .sortWithinPartitions("__order", "id", "piece").drop("__order"))

    def best_fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 36
        for batch in batches:
            put = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield (batch.append_column("sequence_id", pa.array([base + b for b, _ in put], pa.int64()))
                   .append_column("offset", pa.array([o for _, o in put], pa.int64())))

    fields = ", ".join(f"{name} {kind}" for name, kind in pieces.dtypes)
    return dealt.mapInArrow(best_fit, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
                   open_bins: int = OPEN_BINS, task_tokens: int = TASK_TOKENS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packing plan: ``id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col)
    lean = cut_lineage(pieces.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return pack(lean, capacity, open_bins, task_tokens)


def sequences(pieces: DataFrame, plan: DataFrame) -> DataFrame:
    """``sequence_id, ids, lengths``: the packed sequences themselves (capacity bounds
    each group). ``pieces`` has ids; both come from the same documents, ids unique."""
    placed = pieces.select("id", "piece", "ids").join(
        plan.select("id", "piece", "sequence_id", "offset", "length"), ["id", "piece"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> a || p.ids)").alias("ids"),
        F.col("parts.length").alias("lengths"))
