"""Operator 1: line dedup by winnowing over line hashes.

A document is its sequence of lines that hold a word (split at line feeds). Of
every window of ``run`` consecutive lines the smallest line hash (the rightmost
of equal ones) is selected as a fingerprint, so any repeated run of ``run`` lines
is sure to contain a common fingerprint.

1. One pass over the texts writes, per window, its selected fingerprint and the
   128-bit hash of the whole run around it.
2. Fingerprints selected at two or more positions are counted out (map-side
   combine); windows of the others can't repeat and go no further.
3. Around each remaining fingerprint the match is extended to both sides: all
   windows that selected it are grouped by their run's hash, and of each group the
   first position (smallest id, then place) stays. The others are repeated runs;
   neighbouring and overlapping ones merge into one longer run.
4. Lines in a repeated run are deleted. Lines without a word stay.

The result is exact: a line goes if and only if some run of ``run`` lines around
it also starts earlier, in a document with a smaller id or earlier in its own.
With ``long_words`` (20 in the registered query) two kinds of windows are added and go
the same way: from each line the shortest run of fewer lines with that many words (one
long line, two middling ones), and the whole of a document with fewer than ``run`` lines.
So what is guaranteed to go depends on content: any later run of three lines or of
twenty words, and every later copy of a document as a whole. No line stays for it that
would go without.
A frequent line costs one row per task in step 2 and 3 (map-side combine); the
joins are with tables written before, which the adaptive planner splits if hot.
These tables grow with the corpus, so they are merged, not broadcast, at any size.

Edge cases: a null text is empty, with no line; a document with fewer than ``run``
lines loses none unless ``long_words`` is given; a null id counts as smaller than any other; rows repeated under
one id with one text are one document (neither makes the other a repeat), and
with different texts they are ordered by a hash of the text; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, narrow, ship_package

RUN_LINES, LONG_WORDS = 3, 20
BLANK = b" \t\n\v\f\r"
WINDOWS = "fingerprint long, leads boolean, key long, body long, place long, run_a long, run_b long"
CLEANED = "id long, text string, n_lines long, n_removed long"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text, key, body``: key is the id with null as the smallest, body a text hash."""
    return narrow(docs, id_col, text_col).select(
        "id", "text", F.coalesce("id", F.lit(-2**63)).alias("key"), F.xxhash64("text").alias("body"))


def _pair(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def spans(lines: list[bytes], run: int, long_words: int | None = None) -> list[tuple[int, int]]:
    """First line and line after the last of each window, of at most ``run`` lines."""
    n = len(lines)
    out = [(k, k + run) for k in range(n - run + 1)]
    if long_words is not None:
        sizes = [len(x.split()) for x in lines]
        for first in range(n):
            words = 0
            for end in range(first + 1, min(first + run, n + 1)):
                words += sizes[end - 1]
                if words >= long_words:
                    out.append((first, end))
                    break
        if 0 < n < run and (0, n) not in out:
            out.append((0, n))
    return out


def document_windows(text: bytes, run: int, long_words: int | None = None) -> Iterator[tuple[int, bool, int, int, int]]:
    """Per window: its fingerprint, whether it is the first to select that position, its
    place (``run`` times its first line, plus its lines less one), and the two halves of
    its run's hash."""
    lines = [x for x in text.split(b"\n") if x.strip(BLANK)]
    digests = [hashlib.blake2b(x, digest_size=16).digest() for x in lines]
    values = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
    selected: set[int] = set()
    for first, end in spans(lines, run, long_words):
        window = values[first:end]
        at = end - 1 - window[::-1].index(min(window))
        yield (values[at], at not in selected, run * first + end - first - 1,
               *_pair(hashlib.blake2b(b"".join(digests[first:end]), digest_size=16).digest()))
        selected.add(at)


def line_windows(docs: DataFrame, run: int, long_words: int | None = None) -> DataFrame:
    ship_package(docs.sparkSession)
    names = [c.split()[0] for c in WINDOWS.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, key, body in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows += [(f, leads, key, body, place, a, b)
                         for f, leads, place, a, b in document_windows(text.as_buffer().to_pybytes(), run, long_words)]
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select("text", "key", "body").mapInArrow(scan, WINDOWS)


def repeated_runs(docs: DataFrame, run: int = RUN_LINES, long_words: int | None = None) -> DataFrame:
    """``key, body, places``: the places of runs that are repeats of an earlier one."""
    windows = cut_lineage(line_windows(docs, run, long_words))
    again = cut_lineage(windows.filter("leads").groupBy("fingerprint").count()
                        .filter("count > 1").select("fingerprint"))
    met = windows.join(again.hint("merge"), "fingerprint", "left_semi")
    place = F.struct("key", "body", "place")
    first = cut_lineage(met.groupBy("run_a", "run_b").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                        .filter("first != last").drop("last"))
    return (met.join(first.hint("merge"), ["run_a", "run_b"]).filter(place != F.col("first"))
            .groupBy("key", "body").agg(F.collect_set("place").alias("places")))


def drop_lines(text: bytes, places: list[int], run: int) -> tuple[bytes, int, int]:
    """The text without the lines of the runs; its lines with a word, and those removed."""
    gone = {k for p in places for k in range(p // run, p // run + p % run + 1)}
    kept, n = [], 0
    for line in text.split(b"\n"):
        if line.strip(BLANK):
            if n not in gone:
                kept.append(line)
            n += 1
        else:
            kept.append(line)
    return b"\n".join(kept), n, len(gone)


def line_dedup(docs: DataFrame, run: int = RUN_LINES, id_col: str = "doc_id", text_col: str = "text",
               long_words: int | None = None) -> DataFrame:
    """``id, text, n_lines, n_removed`` for every row: the text that stays."""
    base = keyed(docs, id_col, text_col)
    repeats = cut_lineage(repeated_runs(base, run, long_words)).hint("merge")
    joined = base.join(repeats, ["key", "body"], "left").select("id", "text", "places")
    names = [c.split()[0] for c in CLEANED.split(", ")]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [drop_lines(t.as_buffer().to_pybytes(), p or [], run)
                   for t, p in zip(batch.column(1), batch.column(2).to_pylist())]
            text, n, gone = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(text, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
                 pa.array(gone, pa.int64())], names)

    return joined.mapInArrow(clean, CLEANED)
