"""Operator 10: language identification with bit-sliced Bloom filters of n-grams.

Learning. Character n-grams (with word edges) of all training texts are counted
per language in Spark, pre-aggregated per task. An n-gram belongs to a language
if it makes up at least ``min_share`` of that language's n-grams. Shares sum to
one, so a language has at most ``1 / min_share`` n-grams whatever the size of the
corpus; only this model reaches the driver and is broadcast. Every label that the
training texts bear is learned, so the model grows with the number of labels.

Filter. One table of m slots holds a bit mask of languages per slot (a Bloom
filter per language, sliced by bit), in as many 64-bit words as the labels need.
An n-gram is set in k slots; the AND of its slots returns *all* languages of a
word that contain it in one look-up.

Deciding. A text's n-grams are looked up, languages are counted by bit
(popcount), and each count c of n is corrected for the false positives of that
language's slice (rate p = fill^k): (c - n p) / (1 - p). The largest corrected
count wins; the score is its share of n, cut to 0..1. Ties go to the smaller
language name; a text with letters but no known n-gram gets the language with
the most training n-grams, with score 0.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and so
is everything if nothing was learned; rows with a null or empty label or no
letters teach nothing; rows repeated under one id are judged each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, ship_package
from .textblocks import mix

GRAM, MIN_SHARE, HASHES, SLOTS_PER_GRAM = 4, 1e-5, 3, 8
WORD_BITS = 64
SLICE_CHARS = 1 << 20
FLUSH = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str], n: int = GRAM) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice of texts: the first text, the 64-bit grams and their text (in the slice).

    Text is lower-cased, every run of other characters than letters is one blank,
    and a blank stands at both ends, so a gram never spans two texts."""
    def slice_grams(part: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(f" {t}\x00" for t in part).lower()
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = codes == 0
        owner = np.cumsum(ends) - ends
        is_letter = _letters()[codes]
        keep = is_letter | ends
        keep[:-1] |= is_letter[1:]  # of other characters, the last before a letter
        symbols, owner = np.where(is_letter, codes, 32)[keep].astype(np.uint64), owner[keep]
        if len(symbols) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        code = symbols[:len(symbols) - n + 1].copy()
        for k in range(1, n):
            code = code * _BASE + symbols[k:len(symbols) - n + 1 + k]
        own = owner[:len(code)]
        good = owner[n - 1:] == own
        return code[good], own[good]

    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= SLICE_CHARS or i + 1 == len(texts):
            code, own = slice_grams([t.replace("\x00", " ") for t in texts[start:i + 1]])
            yield start, code, own
            start, size = i + 1, 0


def _texts(column: pa.Array) -> list[str]:
    return column.fill_null("").to_pylist()


def gram_counts(training: DataFrame, n: int = GRAM) -> DataFrame:
    """``lang, gram, n`` over all of ``training`` (``lang, text``)."""
    ship_package(training.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def merged(parts):
            g, c = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(g)
            g, c = g[order], c[order]
            at = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
            return g[at], np.add.reduceat(c, at) if len(at) else c

        def out():
            for lang, parts in held.items():
                g, c = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g.view(np.int64)), pa.array(c)],
                                                 ["lang", "gram", "n"])

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = _texts(batch.column(1))
            for lang in dict.fromkeys(langs):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                for _, code, _ in grams(own, n):
                    g, c = np.unique(code, return_counts=True)
                    held.setdefault(lang, []).append((g, c.astype(np.int64)))
                    size += len(g)
                if len(held.get(lang, ())) > 8:
                    before = sum(len(p[0]) for p in held[lang])
                    held[lang] = [merged(held[lang])]
                    size -= before - len(held[lang][0][0])
            if size > FLUSH:
                yield from out()
                held, size = {}, 0
        yield from out()

    raw = training.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return raw.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """The bit-sliced table: ``slots`` has a language mask per slot, of one or more words."""

    def __init__(self, languages: list[str], lang_of: np.ndarray, gram_of: np.ndarray, n: int,
                 prior: str | None = None, hashes: int = HASHES, slots_per_gram: int = SLOTS_PER_GRAM):
        self.languages, self.n, self.prior, self.hashes = languages, n, prior, hashes
        most = max([1, *np.bincount(lang_of, minlength=1)])
        self.bits = max(10, int(most * slots_per_gram - 1).bit_length())
        self.slots = np.zeros((1 << self.bits, max(1, -(-len(languages) // WORD_BITS))), np.uint64)
        word, bit = lang_of // WORD_BITS, np.uint64(1) << (lang_of % WORD_BITS).astype(np.uint64)
        for slot in self._slots(gram_of):
            np.bitwise_or.at(self.slots, (slot, word), bit)
        fill = np.array([np.count_nonzero(self.slots[:, b // WORD_BITS] & (np.uint64(1) << np.uint64(b % WORD_BITS)))
                         for b in range(len(languages))])
        self.false_rate = (fill / len(self.slots)) ** hashes

    def _slots(self, code: np.ndarray) -> Iterator[np.ndarray]:
        h = mix(code)
        for _ in range(self.hashes):
            yield (h >> np.uint64(64 - self.bits)).astype(np.int64)
            h = mix(h + np.uint64(0x9E3779B97F4A7C15))

    def masks(self, code: np.ndarray, word: int = 0) -> np.ndarray:
        """All languages of the word containing each n-gram, as bits."""
        column, out = self.slots[:, word], None
        for slot in self._slots(code):
            out = column[slot] if out is None else out & column[slot]
        return out

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        total = np.zeros(len(texts), np.int64)
        for start, code, own in grams(texts, self.n):
            if not len(own):
                continue
            held = np.bincount(own)
            n_texts = len(held)
            total[start:start + n_texts] = held
            at = np.concatenate([[0], np.cumsum(held)])
            counts = np.empty((len(self.languages), n_texts))
            for b in range(len(self.languages)):
                if b % WORD_BITS == 0:
                    mask = self.masks(code, b // WORD_BITS)
                seen = np.concatenate([[0], np.cumsum((mask >> np.uint64(b % WORD_BITS)) & np.uint64(1), dtype=np.int64)])
                counts[b] = seen[at[1:]] - seen[at[:-1]]
            p = self.false_rate[:, None]
            corrected = (counts - held * p) / np.maximum(1 - p, 1e-9)
            best = corrected.argmax(0)
            share = np.clip(corrected[best, np.arange(n_texts)] / np.maximum(held, 1), 0, 1)
            for i in np.flatnonzero(share):
                names[start + i], scores[start + i] = self.languages[best[i]], share[i]
        for i in np.flatnonzero(scores == 0):
            if any(map(str.isalpha, texts[i])):
                names[i] = self.prior
        return names, scores


def learn(training: DataFrame, n: int = GRAM, min_share: float = MIN_SHARE) -> Filters:
    """Filters of all labels from ``lang, text`` rows. What is collected is at most
    ``1 / min_share`` n-grams a label."""
    good = training.filter("lang is not null and lang != '' and text is not null")
    counts = cut_lineage(gram_counts(good, n))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").filter(F.col("n") >= F.col("total") * min_share).select("lang", "gram")
    got = kept.toArrow()
    languages = sorted(set(got["lang"].to_pylist()))
    where = pc.index_in(got["lang"].combine_chunks(), pa.array(languages, pa.string())).to_numpy(zero_copy_only=False)
    prior = totals.orderBy(F.desc("total"), "lang").head()
    return Filters(languages, where.astype(np.int64), got["gram"].to_numpy().view(np.uint64), n,
                   prior["lang"] if prior else None)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` for every row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(filters)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.decide(_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)],
                                             ["id", "lang_pred", "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(predict, "id long, lang_pred string, score double")


def fold(doc_id: Column, folds: int = 4) -> Column:
    """Remainder of the CRC-32 of the id as text; a null id is text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % folds
