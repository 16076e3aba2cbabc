"""Operator 4: quality rules by tokeniser fertility.

A public vocabulary with byte fallback is run over the words of every whole text.
Its fit is measured by characters per token, the share of tokens that are single
bytes, the entropy of the token distribution in bits, and symbols per token; a
document is rejected where a measure leaves the band of its script. Base rules (too few words, too many words
in repeated three-word windows) come first. One pass, no shuffle: everything is
computed per document with numpy over the bytes of a batch, words are encoded
once per distinct word, and a long document is a block of its own.

Edge cases: a null or blank text has no words, fails the base rules and has null
fertility measures; rows repeated under one id are judged each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import narrow, ship_package
from .textblocks import CONTINUATION, SEPARATORS, Block, blocks, bounds, run_hashes, window_starts, word_hashes

# Fixed value: the characters counted as symbols.
SYMBOLS = b"[#*$%&|<>]"[1:-1]
SCRIPTS = ("latin", "greek", "cyrillic", "hebrew_arabic", "indic", "cjk", "hangul", "symbols", "other")


@dataclass(frozen=True)
class Band:
    """What a document of a script may measure (``entropy`` in bits per token)."""

    chars_per_token: tuple[float, float]
    byte_share: float
    entropy: tuple[float, float]
    symbols_per_token: float = 0.1


# Bands per script: a vocabulary trained mostly on Latin text spells other scripts in
# shorter tokens and more bytes, so their bands are wider. They bound what 50 or more
# words of running text measure in each script, not a quantile of some corpus.
BANDS: dict[str, Band] = {
    "latin": Band((1.4, 8.0), 0.10, (3.5, 13.0)),
    "greek": Band((0.8, 5.0), 0.30, (3.0, 13.0)),
    "cyrillic": Band((1.1, 6.0), 0.20, (3.0, 13.0)),
    "hebrew_arabic": Band((0.7, 5.0), 0.30, (3.0, 13.0)),
    "indic": Band((0.3, 5.0), 0.90, (2.5, 13.0)),
    "cjk": Band((0.3, 3.0), 0.90, (2.5, 13.0)),
    "hangul": Band((0.3, 3.0), 0.90, (2.5, 13.0)),
    "symbols": Band((1.0, 8.0), 0.50, (3.0, 13.0)),
    "other": Band((0.3, 8.0), 0.95, (2.5, 13.0)),
}
MIN_WORDS, REPEAT_PERCENT = 50, 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _script_of_lead() -> np.ndarray:
    """Script by the first byte of a character; -1 for what says nothing."""
    out = np.full(256, -1, np.int8)
    for script, leads in (("latin", [*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]),
                          ("greek", [0xCE, 0xCF]), ("cyrillic", range(0xD0, 0xD4)),
                          ("hebrew_arabic", range(0xD6, 0xDC)), ("indic", [0xE0]),
                          ("cjk", range(0xE3, 0xEA)), ("hangul", range(0xEA, 0xEE)), ("symbols", [0xE2]), ("other", [0xE1, 0xF0])):
        out[list(leads)] = SCRIPTS.index(script)
    return out


_LEAD = _script_of_lead()
STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "script string, n_tokens long, byte_share double, token_entropy double")


def _per_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated_words(words: np.ndarray, docs: np.ndarray, n_docs: int, width: int = 3) -> np.ndarray:
    """Words in windows that are found twice or more in their document, by document."""
    at = window_starts(docs, width)
    hashes, own = run_hashes(words, at, at + width), docs[at]
    off = bounds(own, n_docs)
    covered = np.zeros(len(words), bool)
    for a, b in zip(off[:-1], off[1:]):
        if b - a > 1:
            order = np.argsort(hashes[a:b])
            run = hashes[a:b][order]
            same = run[1:] == run[:-1]
            if same.any():
                twice = np.zeros(b - a, bool)
                twice[1:] |= same
                twice[:-1] |= same
                hit = at[a:b][order[twice]]
                for k in range(width):
                    covered[hit + k] = True
    return np.bincount(docs[covered], minlength=n_docs)


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _entropy(ids: np.ndarray) -> float:
    if not len(ids):
        return np.nan
    run = np.sort(ids)
    counts = np.diff(np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1], [True]])))
    n = len(ids)
    return float(np.log2(n) - (counts * np.log2(counts)).sum() / n)


def block_stats(block: Block, vocabulary: str) -> dict[str, np.ndarray]:
    from .textblocks import flat
    from .tokens import byte_tokens, sentencepiece

    table, is_byte = sentencepiece(vocabulary), byte_tokens(vocabulary)
    starts, ends, docs = block.words()
    n, data = block.n, block.data
    inside = ~SEPARATORS[data]
    text = np.ascontiguousarray(data[inside])
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(text)]).dictionary_encode()
    which = table.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    ids, lengths = flat(table.ids, table.offsets, which)
    word_off = bounds(docs, n)
    token_at = np.concatenate([[0], np.cumsum(lengths)])
    token_off = token_at[word_off]
    n_tokens = np.diff(token_off)
    bytes_seen = np.concatenate([[0], np.cumsum(is_byte[ids])])
    byte_share = (bytes_seen[token_off[1:]] - bytes_seen[token_off[:-1]]) / np.maximum(n_tokens, 1)
    entropy = np.array([_entropy(ids[a:b]) for a, b in zip(token_off[:-1], token_off[1:])])
    lead = _LEAD[data]
    seen = np.flatnonzero(lead >= 0)
    owner = np.searchsorted(block.offsets, seen, side="right") - 1
    by_script = np.bincount(owner * len(SCRIPTS) + lead[seen], minlength=n * len(SCRIPTS)).reshape(n, -1)
    script = np.where(by_script.sum(1) > 0, by_script.argmax(1), len(SCRIPTS) - 1)
    view = data.tobytes()
    off = block.offsets
    return {
        "n_words": np.diff(word_off),
        "word_chars": _per_doc(inside & ~CONTINUATION[data], off),
        "n_symbols": _per_doc(_SYMBOL[data], off),
        "n_dup_lines": np.array([duplicate_lines(view[a:b]) for a, b in zip(off[:-1], off[1:])], np.int64),
        "n_repeat_words": repeated_words(word_hashes(data, starts, ends), docs, n),
        "script": np.array(SCRIPTS)[script], "n_tokens": n_tokens,
        "byte_share": byte_share, "token_entropy": entropy,
    }


def with_stats(docs: DataFrame, vocabulary: str, text_col: str = "text", name: str = "__stats") -> DataFrame:
    """All columns of ``docs`` and a struct ``name`` of counts and measures (``STATS``)."""
    ship_package(docs.sparkSession)
    fields = [c.split()[0] for c in STATS.split(", ")]
    text_of = docs.columns.index(text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(text_of)):
                got = block_stats(block, vocabulary)
                stats = pa.StructArray.from_arrays([pa.array(got[c], from_pandas=True) for c in fields], fields)
                rows = batch.slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays([*rows.columns, stats], [*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StructType.fromDDL(STATS))])
    return docs.mapInArrow(measure, schema)


def document_stats(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the counts and fertility measures of every document."""
    return with_stats(narrow(docs, id_col, text_col), vocabulary).select("id", "__stats.*")


def verdict(stats: str = "", bands: dict[str, Band] = BANDS, min_words: int = MIN_WORDS,
            repeat_percent: int = REPEAT_PERCENT) -> dict[str, Column]:
    """``base_failed``, ``chars_per_token`` and ``kept`` over columns with prefix ``stats``."""
    c = lambda name: F.col(stats + name)
    base = (c("n_words") < min_words) | (100 * c("n_repeat_words") > repeat_percent * c("n_words"))
    chars = F.when(c("n_tokens") > 0, c("word_chars") / c("n_tokens"))
    inside = F.lit(False)
    for script, b in bands.items():
        fits = (chars.between(*b.chars_per_token) & (c("byte_share") <= b.byte_share)
                & c("token_entropy").between(*b.entropy) & (c("n_symbols") <= b.symbols_per_token * c("n_tokens")))
        inside = inside | ((c("script") == script) & F.coalesce(fits, F.lit(False)))
    return {"base_failed": base, "chars_per_token": chars, "kept": ~base & inside}


def quality(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """The measures and the verdict for every row of ``docs``."""
    return document_stats(docs, vocabulary, id_col, text_col).withColumns(verdict(**rules))


def good_documents(docs: DataFrame, vocabulary: str, text_col: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    judged = with_stats(docs, vocabulary, text_col)
    return judged.filter(verdict("__stats.", **rules)["kept"]).drop("__stats")
