"""Operator 9: substring dedup behind a count-min prefilter.

A window is ``width`` consecutive words of one document. A word goes if it is
covered by a window whose word sequence also starts earlier (smaller id, or the
same document and an earlier start); windows are judged on the input.

1. Partition sketches of all window hashes merge into one count-min sketch. It
   overestimates, so a window estimated to occur once occurs once: none is lost.
   The sketch has about three cells per window, up to ``max_bits`` (64 MB a row);
   a larger corpus fills it and lets more windows through, at the same result.
2. The second pass takes only windows estimated repeated. Inside a task, equal
   windows meet first: the earliest goes on, the others are repeats already. So a
   passage held by a third of all documents is one entry per task, not a hot key.
   Entries carry 96 hash bits from two independent word hashes, and are dealt by
   hash in packed arrays; each bucket groups them exactly.
3. Repeats come back per document as ranges of words, and texts join them by id.

Edge cases: a null text has no words; a document shorter than the window keeps all
its words; a null id counts as smaller than any other; rows repeated under one id
with one text are one document, with different texts they are ordered by a text
hash; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blobs, sketch
from .common import cut_lineage, ship_package
from .line_dedup import keyed
from .textblocks import blocks, run_hashes, window_starts, word_hashes

WIDTH, MAX_BITS, BYTES_PER_WORD, WINDOWS_PER_TASK = 20, 29, 6, 1_000_000
# Several buckets a task, so that dealing them by hash leaves no task with many times the mean.
BUCKETS_PER_TASK = 4
FLUSH_ENTRIES, BATCH_BYTES = 750_000, 2 << 20
CLEANED = "id long, text string, n_words long, n_removed long"


def block_windows(block, words, width: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document in the block and starting word in the document of every window."""
    starts, ends, docs = words
    at = window_starts(docs, width)
    hashes = run_hashes(word_hashes(block.data, starts, ends, seed), at, at + width, seed + 1)
    first = np.searchsorted(docs, np.arange(block.n))
    return hashes, docs[at], at - first[docs[at]]


def second_hashes(block, words, width: int, hit: np.ndarray) -> np.ndarray:
    """32 bits of an independent hash of the windows ``hit`` (numbers, ascending); only the
    words these windows hold are hashed."""
    starts, ends, docs = words
    at = window_starts(docs, width)[hit]
    edge = np.zeros(len(docs) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    held = np.flatnonzero(np.cumsum(edge[:-1]))
    new = np.searchsorted(held, at)  # a window's words stay neighbours
    hashes = word_hashes(block.data, starts[held], ends[held], 11)
    return (run_hashes(hashes, new, new + width, 12) >> np.uint64(32)).astype(np.uint32)


def ranges(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged word ranges [from, to) covered by windows at ``starts`` (ascending)."""
    if not len(starts):
        return starts, starts
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > starts[:-1] + width]))
    last = np.concatenate([new[1:] - 1, [len(starts) - 1]])
    return starts[new], starts[last] + width


class _Entries:
    """Windows of a task that may repeat, until they are sent."""

    def __init__(self):
        self.parts, self.docs, self.size = [], [], 0

    def add(self, doc_keys: np.ndarray, h1, h2, doc, pos) -> None:
        self.parts.append((h1, h2, (doc + len(self.docs)).astype(np.int32), pos.astype(np.int32)))
        self.docs += doc_keys.tolist()
        self.size += len(h1)

    def arrays(self):
        h1, h2, doc, pos = (np.concatenate(x) for x in zip(*self.parts))
        return h1, h2, doc, pos, np.array(self.docs, np.int64).reshape(-1, 2)


def later_ones(h1, h2, key, body, pos) -> tuple[np.ndarray, np.ndarray]:
    """Order by (hash, place), and in that order which entries are repeats: equal to
    the one before them and not the very same place."""
    order = np.lexsort((pos, body, key, h2, h1))
    a, b = order[:-1], order[1:]
    same = (h1[a] == h1[b]) & (h2[a] == h2[b])
    place = (key[a] == key[b]) & (body[a] == body[b]) & (pos[a] == pos[b])
    # A copy of the first place (a repeated row) is no repeat, however often it comes.
    head = np.concatenate([[True], ~same]) if len(order) else np.zeros(0, bool)
    group = np.cumsum(head) - 1
    moved = np.concatenate([[False], same & ~place]) if len(order) else head
    before = np.cumsum(moved)
    return order, before - before[np.flatnonzero(head)][group] > 0


def _send(bucket: np.ndarray, n: int, kind: int, columns: list[np.ndarray], doc: np.ndarray,
          docs: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Cells per bucket: the documents used, the entries' document numbers, the columns."""
    order, at = blobs.by_bucket(bucket, n)
    for k in np.flatnonzero(at[1:] > at[:-1]):
        own = order[at[k]:at[k + 1]]
        used, number = np.unique(doc[own], return_inverse=True)
        number = number.astype(np.uint16 if len(used) <= 0xFFFF else np.uint32)
        yield int(k), kind, blobs.pack(docs[used, 0].copy(), docs[used, 1].copy(), number, *[c[own] for c in columns])


def _cells(rows: Iterable[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of bounded bytes, each sent before more are made."""
    held, size = [], 0

    def batch():
        b, k, c = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int32()), pa.array(c, pa.binary())],
                                          ["bucket", "kind", "cell"])

    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= BATCH_BYTES or len(held) >= 4096:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _doc_bucket(docs: np.ndarray, n: int) -> np.ndarray:
    from .textblocks import mix
    return (mix(docs[:, 0].view(np.uint64) ^ mix(docs[:, 1].view(np.uint64))) % np.uint64(n)).astype(np.int64)


def repeated_ranges(docs: DataFrame, width: int, counting: sketch.Sketch, tasks: int) -> DataFrame:
    """``key, body, starts, ends`` (word ranges to remove) of documents that have any."""
    spark, n_buckets = docs.sparkSession, tasks * BUCKETS_PER_TASK
    shared = spark.sparkContext.broadcast(counting)
    cell = "bucket int, kind int, cell binary"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Entries()

        def out():
            h1, h2, doc, pos, own = found.arrays()
            order, late = later_ones(h1, h2, own[doc, 0], own[doc, 1], pos)
            again, first = order[late], order[~late]
            del order, late
            if len(again):
                to = _doc_bucket(own, n_buckets)
                yield from _cells(_send(to[doc[again]], n_buckets, 1, [pos[again].astype(np.uint32)], doc[again], own))
            bucket = (h1[first] >> np.uint64(32)).astype(np.int64) * n_buckets >> 32
            yield from _cells(_send(bucket, n_buckets, 0, [h1[first], h2[first], pos[first].astype(np.uint32)],
                                    doc[first], own))

        for batch in batches:
            keys = np.stack([batch.column("key").to_numpy(), batch.column("body").to_numpy()], 1)
            for block in blocks(batch.column("text")):
                words = block.words()
                h1, doc, pos = block_windows(block, words, width)
                hit = np.flatnonzero(shared.value.repeated(h1))
                if len(hit):
                    h2 = second_hashes(block, words, width, hit)
                    used, number = np.unique(doc[hit], return_inverse=True)
                    found.add(keys[block.first + used], h1[hit], h2, number, pos[hit])
                if found.size >= FLUSH_ENTRIES:
                    yield from out()
                    found = _Entries()
        if found.size:
            yield from out()

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for k, kind, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if kind:
                    yield from _cells([(k, 1, c.as_buffer().to_pybytes())])
                else:
                    parts.append(blobs.unpack(c.as_buffer().to_pybytes()))
        if parts:
            key, body = (np.concatenate([p[i][p[2]] for p in parts]) for i in (0, 1))
            h1, h2, pos = (np.concatenate([p[i] for p in parts]) for i in (3, 4, 5))
            order, late = later_ones(h1, h2, key, body, pos)
            again = order[late]
            own, doc = np.unique(np.stack([key[again], body[again]], 1), axis=0, return_inverse=True)
            if len(again):
                yield from _cells(_send(_doc_bucket(own, n_buckets)[doc.ravel()], n_buckets, 1, [pos[again]],
                                        doc.ravel(), own))

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [blobs.unpack(c.as_buffer().to_pybytes()) for batch in batches for c in batch.column("cell")]
        if not parts:
            return
        key, body = (np.concatenate([p[i][p[2]] for p in parts]) for i in (0, 1))
        pos = np.concatenate([p[3] for p in parts]).astype(np.int64)
        order = np.lexsort((pos, body, key))
        key, body, pos = key[order], body[order], pos[order]
        at = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (body[1:] != body[:-1]), [True]]))
        rows = [(int(key[a]), int(body[a]), *ranges(pos[a:b], width)) for a, b in zip(at[:-1], at[1:])]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for i in range(0, len(rows), 5000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows[i:i + 5000]), kinds)], ["key", "body", "starts", "ends"])

    entries = docs.mapInArrow(find, cell).repartition(tasks, "bucket")
    late = entries.mapInArrow(group, cell).repartition(tasks, "bucket")
    return late.mapInArrow(per_document, "key long, body long, starts array<long>, ends array<long>")


def window_estimate(docs: DataFrame) -> int:
    """About as many words as the texts hold, from their bytes; it sizes the sketch and
    the buckets and has no part in the result."""
    return int(docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // BYTES_PER_WORD


def substring_dedup(docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id, text, n_words, n_removed`` for every row: the words that stay, one blank between."""
    spark = docs.sparkSession
    ship_package(spark)
    base = keyed(docs, id_col, text_col)
    n = window_estimate(base)
    bits = min(max_bits, max(10, (3 * n - 1).bit_length()))

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for block in blocks(batch.column("text")):
            yield block_windows(block, block.words(), width)[0]

    counting = sketch.build(base.select("text"), keys_of, bits)
    tasks = max(16, -(-n // WINDOWS_PER_TASK))
    gone = cut_lineage(repeated_ranges(base.select("text", "key", "body"), width, counting, tasks))
    joined = base.join(gone.hint("merge"), ["key", "body"], "left").select("id", "text", "starts", "ends")
    names = [c.split()[0] for c in CLEANED.split(", ")]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, count, removed = [], [], []
            for t, a, b in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = t.as_buffer().to_pybytes().split()
                count.append(len(words))
                for s, e in zip(reversed(a or []), reversed(b or [])):
                    del words[s:e]
                removed.append(count[-1] - len(words))
                out.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()).cast(pa.string()), pa.array(count, pa.int64()),
                 pa.array(removed, pa.int64())], names)

    return joined.mapInArrow(clean, CLEANED)
