"""Operator 11: ranked lexical search over frequency-ordered document tries.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased. ``N`` documents hold a term, ``L`` terms stand in all of them, ``n`` in one;
a term in ``df`` documents weighs ``w = floor(1000 ln((2N+2)/(2df+1)))``; a document's
``m`` is ``75 + (25 n N) div L`` and its score the sum over an item's terms, repeats
included, of ``w * ((10^9 tf) div (1000 tf + 12 m))``.

Items are answered in blocks of bounded vocabulary, each against all documents:

1. One pass over the texts writes every document's vector restricted to the block's
   vocabulary, with ``n``. Hashes find the terms, their bytes decide.
2. ``N``, ``L`` and ``df`` are counted from these vectors (one row per task and term).
3. A task orders each vector by falling ``df`` and sorts the vectors, so that equal
   beginnings become shared paths of a trie (FP-tree). Every node keeps, for each term
   in its subtree, the largest tf, and the smallest m. Both bound the score of every
   document below it, because a term's part grows with tf and falls with m.
4. Per item the tries are searched depth first, the child with the highest bound
   first; a subtree is left out only if its bound is below the score of the worst
   document held, so equal scores are seen. Runs of small neighbouring subtrees are
   leaves, whose documents are scored exactly.
5. Each trie gives its best rows per item; two grouped steps (salted, then whole)
   keep the best of all.

Edge cases: a null or blank text has no term and is neither counted nor found; an item
without terms, or whose terms no document holds, gives no row; an item repeated under
one id is answered once per row's distinct text (rows of one id and text are one item;
different texts under one id are ranked separately and then only the best of each
document is kept); a null document id sorts last among equal scores; rows repeated under
one id are separate documents; empty tables give an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import blobs
from .common import cut_lineage, narrow, ship_package
from .textblocks import LOWER_ASCII, Block, blocks, word_hashes

TOP = 20
BLOCK_ITEMS, BLOCK_TERMS = 1000, 50_000
LEAF_DOCS, TREE_POSTINGS = 64, 1_500_000
SALTS = 64
NO_TERM = np.ones(256, bool)
NO_TERM[0x30:0x3A] = NO_TERM[0x41:0x5B] = NO_TERM[0x61:0x7B] = NO_TERM[0x80:] = False


# --- terms -----------------------------------------------------------------------

def lowered(block: Block) -> np.ndarray:
    return LOWER_ASCII[block.data]


def terms_of(text: str | None) -> list[bytes]:
    """Terms of one short text (an item), in order."""
    out = []
    for block in blocks(pa.array([text], pa.string())):
        data = lowered(block).tobytes()
        starts, ends, _ = block.words(NO_TERM)
        out += [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    return out


class Vocabulary:
    """The distinct terms of a block of items, found by hash and confirmed by bytes."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms])
        starts = ends - [len(t) for t in terms]
        self.seed = 1
        while True:  # a seed under which no two terms share a hash
            hashes = word_hashes(data, starts, ends, self.seed)
            if len(np.unique(hashes)) == len(terms):
                break
            self.seed += 2
        order = np.argsort(hashes)
        self.data, self.hashes = data, hashes[order]
        self.starts, self.lengths, self.ids = starts[order], (ends - starts)[order], order

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words are terms (positions), and their numbers."""
        hashes = word_hashes(data, starts, ends, self.seed)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        hit = np.flatnonzero((self.hashes[at] == hashes) & (self.lengths[at] == ends - starts))
        at, sure = at[hit], np.ones(len(hit), bool)
        for size in np.unique(self.lengths[at]):
            own = np.flatnonzero(self.lengths[at] == size)
            step = np.arange(size)
            sure[own] = (data[starts[hit[own], None] + step] == self.data[self.starts[at[own], None] + step]).all(1)
        return hit[sure], self.ids[at[sure]]


def restricted(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``id, n, cell``: number of terms of each document that has any, and its vector
    restricted to ``terms`` (numbers ascending, tf)."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(terms))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                starts, ends, doc = block.words(NO_TERM)
                if not len(starts):
                    continue
                sizes = np.bincount(doc, minlength=block.n)
                hit, number = shared.value.find(lowered(block), starts, ends)
                cells, tf = np.unique(doc[hit] * len(terms) + number, return_counts=True)
                owner, number = np.divmod(cells, len(terms))
                at = np.searchsorted(owner, np.arange(block.n + 1))
                some = np.flatnonzero(sizes)
                packed = [blobs.pack(number[at[d]:at[d + 1]].astype(np.uint32), tf[at[d]:at[d + 1]].astype(np.uint32))
                          for d in some]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(block.first + some)), pa.array(sizes[some], pa.int64()),
                     pa.array(packed, pa.binary())], ["id", "n", "cell"])

    return docs.select("id", "text").mapInArrow(vectors, "id long, n long, cell binary")


def statistics(vectors: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and df of every term: at most ``n_terms + 2`` rows reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = words = 0
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            docs += batch.num_rows
            words += int(batch.column(1).to_numpy().sum())
            numbers = [blobs.unpack(c.as_buffer())[0] for c in batch.column(2)]
            df += np.bincount(np.concatenate(numbers), minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *some], pa.int64()), pa.array([docs, words, *df[some]], pa.int64())], ["what", "count"])

    rows = dict(vectors.mapInArrow(count, "what long, count long").groupBy("what").agg(F.sum("count")).collect())
    df = np.zeros(n_terms, np.int64)
    for what, number in rows.items():
        if what >= 0:
            df[what] = number
    return rows.get(-1, 0), rows.get(-2, 0), df


# --- the trie --------------------------------------------------------------------

def parts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score; 0 where tf is 0. Rises with tf, falls with m."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


class _Maxima:
    """Sparse rows (term, value), looked up by row and term together."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, width: int):
        self.keys, self.values, self.width = keys, values, width

    def at(self, rows: np.ndarray, terms: np.ndarray) -> np.ndarray:
        want = rows[:, None] * self.width + terms
        place = np.searchsorted(self.keys, want)
        place[place == len(self.keys)] = 0
        return np.where(self.keys[place] == want, self.values[place], 0)


class DocumentTrie:
    """FP-tree of a bounded set of documents. Their vectors come as flat arrays: per
    posting the document, the term's rank by falling frequency, and tf."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, doc: np.ndarray, rank: np.ndarray, tf: np.ndarray,
                 width: int, leaf: int = LEAF_DOCS):
        self.width, n = max(width, 1), len(ids)
        order = np.lexsort((rank, doc))
        doc, rank, tf = doc[order], rank[order], tf[order]
        at = np.searchsorted(doc, np.arange(n + 1))
        big = rank.astype(">u4").tobytes()
        path = [big[4 * a:4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        place = sorted(range(n), key=path.__getitem__)
        self.path = [path[d] for d in place]
        self.ids, self.m = ids[place], m[place]
        new = np.empty(n, np.int64)
        new[place] = np.arange(n)
        keys = new[doc] * self.width + rank
        order = np.argsort(keys)
        self.postings = _Maxima(keys[order], tf[order], self.width)
        self.first, self.last, self.children = [], [], []
        self._grow(leaf)
        self._summarise()

    def _node(self, a: int, b: int) -> int:
        self.first.append(a)
        self.last.append(b)
        self.children.append([])
        return len(self.first) - 1

    def _grow(self, leaf: int) -> None:
        """Nodes of the sorted documents, parents before children. A node's documents [a, b)
        agree in their first ``depth`` terms; neighbouring children that together hold few
        documents share one leaf."""
        todo = [(self._node(0, len(self.path)), 0)]
        while todo:
            node, depth = todo.pop()
            a, b = self.first[node], self.last[node]
            if b - a <= leaf or self.path[a] == self.path[b - 1]:
                continue
            while self.path[a][:4 * depth + 4] == self.path[b - 1][:4 * depth + 4]:
                depth += 1  # a single path: sorted neighbours agree if the ends do
            cuts, at = [a], a
            while at < b:
                start, at = at, self._end(at, b, depth)
                if start > cuts[-1] and at - cuts[-1] > leaf:
                    cuts.append(start)
            for x, y in zip(cuts, [*cuts[1:], b]):
                child = self._node(x, y)
                self.children[node].append(child)
                todo.append((child, depth))

    def _end(self, a: int, b: int, depth: int) -> int:
        """End of the run of documents that share the term of ``a`` at this depth."""
        head, lo, hi = self.path[a][4 * depth:4 * depth + 4], a, b
        while lo < hi:
            mid = (lo + hi) // 2
            if self.path[mid][4 * depth:4 * depth + 4] == head:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def _summarise(self) -> None:
        """Per node the largest tf of every term below it and the smallest m."""
        n = len(self.first)
        self.least_m = np.array([self.m[a:b].min(initial=np.iinfo(np.int64).max) for a, b in zip(self.first, self.last)])
        own: list = [None] * n
        edge = np.searchsorted(self.postings.keys, np.array([*self.first, *self.last]) * self.width)
        for node in reversed(range(n)):  # children have higher numbers
            if self.children[node]:
                terms, tf = (np.concatenate(x) for x in zip(*(own[c] for c in self.children[node])))
            else:
                cut = slice(edge[node], edge[n + node])
                terms, tf = self.postings.keys[cut] % self.width, self.postings.values[cut]
            order = np.argsort(terms, kind="stable")
            found, start = np.unique(terms[order], return_index=True)
            own[node] = found, (np.maximum.reduceat(tf[order], start) if len(found) else tf[:0])
        keys = np.concatenate([t + k * self.width for k, (t, _) in enumerate(own)])
        self.maxima = _Maxima(keys, np.concatenate([v for _, v in own]), self.width)

    def bounds(self, nodes: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return parts(weight, self.maxima.at(nodes, terms), self.least_m[nodes][:, None]).sum(1)

    def search(self, terms: np.ndarray, weight: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best documents, equal scores by ascending id; the weight of
        a repeated term counts its repeats."""
        ids, scores, floor = self.ids[:0], np.zeros(0, np.int64), 1
        if not len(self.postings.keys) or not len(terms):
            return ids, scores
        stack = [(np.iinfo(np.int64).max, 0)]
        while stack:
            bound, node = stack.pop()
            if bound < floor:
                continue
            if self.children[node]:
                below = np.array(self.children[node])
                bound = self.bounds(below, terms, weight)
                go = np.flatnonzero(bound >= floor)
                go = go[np.argsort(bound[go], kind="stable")]  # the highest comes last, so it is next
                stack += zip(bound[go].tolist(), below[go].tolist())
                continue
            docs = np.arange(self.first[node], self.last[node])
            score = parts(weight, self.postings.at(docs, terms), self.m[docs][:, None]).sum(1)
            good = score >= floor
            if good.any():
                ids = np.concatenate([ids, self.ids[docs[good]]])
                scores = np.concatenate([scores, score[good]])
                keep = np.lexsort((ids, -scores))[:top]
                ids, scores = ids[keep], scores[keep]
                if len(ids) == top:
                    floor = int(scores[-1])
        return ids, scores


# --- the search ------------------------------------------------------------------

NULL_ID = np.iinfo(np.int64).max  # a null id sorts last


def find_best(vectors: DataFrame, items: list[dict[int, int]], weight: np.ndarray, rank: np.ndarray,
              n_docs: int, n_words: int, top: int) -> DataFrame:
    """``item, id, score``: the best documents of every trie; ``items`` count each term."""
    wanted = [(np.array([rank[t] for t in item], np.int64), np.array([weight[t] * c for t, c in item.items()], np.int64))
              for item in items]
    shared = vectors.sparkSession.sparkContext.broadcast((wanted, rank))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, rank = shared.value
        held, size = [], 0

        def out():
            ids = np.concatenate([h[0] for h in held])
            n = np.concatenate([h[1] for h in held])
            number = np.concatenate([h[3] for h in held])
            tf = np.concatenate([h[4] for h in held]).astype(np.int64)
            doc = np.repeat(np.arange(len(ids)), np.concatenate([h[2] for h in held]))
            trie = DocumentTrie(ids, 75 + 25 * n * n_docs // n_words, doc, rank[number], tf, len(rank))
            for k, (terms, weights) in enumerate(wanted):
                found, scores = trie.search(terms, weights, top)
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), k), pa.int32()), pa.array(found, pa.int64(), mask=found == NULL_ID),
                         pa.array(scores, pa.int64())], ["item", "id", "score"])

        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                piece = batch.slice(start, 2000)
                cells = [blobs.unpack(c.as_buffer()) for c in piece.column(2)]
                some = np.array([len(c[0]) > 0 for c in cells])
                if not some.any():
                    continue
                ids = piece.column(0).fill_null(NULL_ID).to_numpy()[some]
                lengths = np.array([len(c[0]) for c in cells])[some]
                held.append((ids, piece.column(1).to_numpy()[some], lengths,
                             np.concatenate([c[0] for c in cells]), np.concatenate([c[1] for c in cells])))
                size += int(lengths.sum())
                if size >= TREE_POSTINGS:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    return vectors.mapInArrow(search, "item int, id long, score long")


def best_rows(rows: DataFrame, group: str, top: int) -> DataFrame:
    """The ``top`` rows of each group with their rank; first within salted parts, so that
    no task meets more than a fraction of what all tries gave for one item."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("id", "score"), F.lit(SALTS))
    part = Window.partitionBy(group, "salt").orderBy(*order)
    first = (rows.withColumn("salt", salt).withColumn("place", F.row_number().over(part))
             .where(F.col("place") <= top).drop("place", "salt"))
    whole = Window.partitionBy(group).orderBy(*order)
    return first.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with terms, in blocks of bounded size and vocabulary; only one block is
    on the driver at a time."""
    block, seen = [], set()
    rows = narrow(items, item_col, text_col).distinct().orderBy("id", "text")
    for row in rows.toLocalIterator():
        terms = terms_of(row.text)
        if not terms:
            continue
        if block and (len(block) >= BLOCK_ITEMS or len(seen | set(terms)) > BLOCK_TERMS):
            yield block
            block, seen = [], set()
        block.append((row.id, terms))
        seen |= set(terms)
    if block:
        yield block


RESULT = "item_id long, rank int, id long, score long"


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, id, score``: the best documents of every item."""
    spark = docs.sparkSession
    ship_package(spark)
    base = narrow(docs, id_col, text_col)
    out = []
    for block in item_blocks(items, item_col, item_text_col):
        terms = sorted({t for _, own in block for t in own})
        number = {t: k for k, t in enumerate(terms)}
        vectors = cut_lineage(restricted(base, terms))
        n_docs, n_words, df = statistics(vectors, len(terms))
        if not n_docs:
            continue
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        rank = np.empty(len(terms), np.int64)
        rank[np.lexsort((np.arange(len(terms)), -df))] = np.arange(len(terms))
        counted = []
        for _, own in block:
            counts: dict[int, int] = {}
            for t in own:
                counts[number[t]] = counts.get(number[t], 0) + 1
            counted.append(counts)
        found = find_best(vectors, counted, weight, rank, n_docs, n_words, top)
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], "item int, item_id long")
        out.append(best_rows(found, "item", top).join(F.broadcast(names), "item")  # at most BLOCK_ITEMS rows
                   .select("item_id", "rank", "id", "score"))
    if not out:
        return spark.createDataFrame([], RESULT)
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
