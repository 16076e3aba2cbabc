"""Operator 2: n-gram Jaccard join by set relations.

A document's set holds the 64-bit hashes of its distinct five-word shingles (A-Z
lower-cased). Two documents link when ``100 * |x & y| >= percent * |x | y|``. All
sets are joined; candidates are found by prefix filter in the order (number of
documents holding the shingle, hash), which loses no link.

1. ``sets``: size and 128-bit hash of every document's set. Equal sets are one
   class from here on. The same pass reports shingles that are frequent inside a
   task; those frequent overall (at most 2048 per mean set size, a few MB) are
   broadcast and never dealt by hash, so no bucket has a hot key.
2. Shingles are dealt by hash in packed arrays and counted; those held by two or
   more sets return to their set. A set needs ``percent`` of its shingles repeated
   to have any partner, so most sets end here, without a candidate pair.
3. Sets that share a prefix shingle are connected (each to the first holder of the
   shingle, never all pairs), and the connected blocks hold every possible link.
4. Inside a block, sets are joined in order of size with an inverted index from
   prefix shingles to *pivots*. A set that links to a pivot is filed under it, not
   indexed as a list entry of its own: index lists hold one entry per group of
   similar sets and skip the rest as a block. The answers of the
   grouped sets derive from the pivot's: Jaccard distance is a metric, so a set at
   distance d of a pivot can link only to members at distance of at least d - 1/4
   from it; all others are decided without looking at them.
5. Blocks larger than ``block_shingles`` are dealt into groups, and every pair of
   groups meets in a task of bounded size; links of those are joined again.

Edge cases: a null or blank text has an empty set, is linked with nothing and is
its own component; a text of one to four words is one shingle; a null id is never
the smallest of a component unless all its ids are null; rows repeated under one
id are one component; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blobs
from .common import cut_lineage, narrow, scalar, ship_package
from .components import components
from .exact_dedup import without
from .textblocks import LOWER_ASCII, blocks, mix, run_hashes, word_hashes

SHINGLE, PERCENT = 5, 75
UNIT_SHINGLES, TASK_SHINGLES, BLOCK_SHINGLES = 2_000_000, 1_000_000, 4_000_000
# Several buckets a task, so that dealing them by hash leaves no task with many times the mean.
BUCKETS_PER_TASK = 4
HOT_SHARE = 1024
LOW48 = np.uint64((1 << 48) - 1)
SETS = "kind int, id long, body long, n long, k1 long, k2 long"
CELLS = "bucket int, kind int, unit long, cell binary"
CANDIDATES = "node long, n long, k1 long, k2 long, held long, prefix array<long>, tokens binary"


def _one_per_run(values: np.ndarray) -> np.ndarray:
    v = np.sort(values)
    return v[np.concatenate([[True], v[1:] != v[:-1]])] if len(v) else v


def block_shingles(block, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the documents of a block, one after another (ascending
    inside a document), and offsets by document."""
    data = LOWER_ASCII[block.data]
    starts, ends, docs = block.words()
    words = word_hashes(data, starts, ends)
    off = np.searchsorted(docs, np.arange(block.n + 1))
    first = off[docs]
    at = np.arange(len(words))
    last = off[docs + 1] if len(docs) else at
    whole = (at == first) & (last - first < width)
    use = whole | (at + width <= last)
    at = at[use]
    hashes = run_hashes(words, at, np.minimum(at + width, last[use]))
    own = np.searchsorted(docs[use], np.arange(block.n + 1))
    parts = [_one_per_run(hashes[a:b]) for a, b in zip(own[:-1], own[1:])]
    return (np.concatenate(parts) if parts else hashes), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def set_keys(hashes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over the members of each set."""
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(salt)), dtype=np.uint64)])
        out.append((sums[off[1:]] - sums[off[:-1]]).view(np.int64))
    return out[0], out[1]


def document_sets(docs: DataFrame, unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """Rows of kind 0: a document's ``id, n, k1, k2``; of kind 1: a shingle (as id) that
    is frequent inside a task, and how often it was seen there (as n)."""
    names = [c.split()[0] for c in SETS.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n_docs = [], 0, 0

        def frequent():
            values = np.sort(np.concatenate(held))
            at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
            count = np.diff(at)
            hot = count >= max(2, n_docs / HOT_SHARE)
            # Inside a small unit everything is frequent; a shingle seen in few documents never is.
            hot &= count >= 16
            n = int(hot.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(n, np.int32)), pa.array(values[at[:-1]][hot].view(np.int64)),
                 pa.array(np.zeros(n, np.int64)), pa.array(count[hot]),
                 pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n, np.int64))], names)

        for batch in batches:
            for block in blocks(batch.column("text")):
                hashes, off = block_shingles(block)
                k1, k2 = set_keys(hashes, off)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(block.n, np.int32)), batch.column("id").slice(block.first, block.n),
                     batch.column("body").slice(block.first, block.n), pa.array(np.diff(off)), pa.array(k1), pa.array(k2)], names)
                held.append(hashes)
                size, n_docs = size + len(hashes), n_docs + block.n
                if size >= unit_shingles:
                    yield frequent()
                    held, size, n_docs = [], 0, 0
        if size:
            yield frequent()

    return docs.select("id", "text", F.xxhash64("text").alias("body")).mapInArrow(scan, SETS)


def deal_shingles(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], n_buckets: int,
                  unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """Cells of kind 0: shingles of a bucket with their set's number in the unit; of
    kind 1: repeated shingles on their way back (here the frequent ones); of kind 2:
    the sets of a unit. A unit is a part of a scan task, the same if it runs again."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    names = [c.split()[0] for c in CELLS.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_ids, hot_n = shared.value
        unit = TaskContext.get().partitionId() << 12
        held, seen = [], {}
        size = 0

        def out():
            hashes, lengths, k1, k2 = (np.concatenate(x) for x in zip(*held))
            number = np.repeat(np.arange(len(lengths), dtype=np.uint32), lengths)
            rows = [(unit % n_buckets, 2, blobs.pack(lengths.astype(np.int64), k1, k2))]
            if len(hot_ids):
                at = np.minimum(np.searchsorted(hot_ids, hashes), len(hot_ids) - 1)
                is_hot = hot_ids[at] == hashes
                rows.append((unit % n_buckets, 1, blobs.pack(number[is_hot], hashes[is_hot], hot_n[at[is_hot]])))
                hashes, number = hashes[~is_hot], number[~is_hot]
            bucket = ((hashes >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
            order, off = blobs.by_bucket(bucket, n_buckets)
            small = number.astype(np.uint16) if len(lengths) <= 0x10000 else number
            low = hashes & LOW48
            for k in np.flatnonzero(off[1:] > off[:-1]):
                own = order[off[k]:off[k + 1]]
                rows.append((int(k), 0, blobs.pack(small[own], (low[own] & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                                                   (low[own] >> np.uint64(32)).astype(np.uint16))))
            for i in range(0, len(rows), 256):
                b, kind, c = zip(*rows[i:i + 256])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b, pa.int32()), pa.array(kind, pa.int32()), pa.array([unit] * len(b), pa.int64()),
                     pa.array(c, pa.binary())], names)

        for batch in batches:
            for block in blocks(batch.column("text")):
                hashes, off = block_shingles(block)
                k1, k2 = set_keys(hashes, off)
                new = np.zeros(block.n, bool)
                for i, key in enumerate(zip(k1.tolist(), k2.tolist())):
                    if off[i + 1] > off[i] and key not in seen:  # equal sets of a unit go once
                        new[i] = seen[key] = True
                lengths = np.diff(off)
                held.append((hashes[np.repeat(new, lengths)], lengths[new], k1[new], k2[new]))
                size += len(held[-1][0])
                if size >= unit_shingles:
                    yield from out()
                    held, seen, size, unit = [], {}, 0, unit + 1
        if size:
            yield from out()

    return docs.select("text").mapInArrow(scan, CELLS)


def count_shingles(cells: DataFrame, n_buckets: int) -> DataFrame:
    """Per bucket: shingles held by two or more sets return to their unit (kind 1) with
    the number of holders; cells of other kinds pass."""
    names = [c.split()[0] for c in CELLS.split(", ")]

    def cell(rows):
        b, kind, unit, c = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(kind, pa.int32()),
                                           pa.array(unit, pa.int64()), pa.array(c, pa.binary())], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, numbers, units, owners = [], [], [], []
        for batch in batches:
            for b, kind, unit, c in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                if kind:
                    yield cell([(b, kind, unit, c.as_buffer().to_pybytes())])
                    continue
                number, low, high = blobs.unpack(c.as_buffer().to_pybytes())
                # A bucket is a range of the upper half of the hash: its upper 16 bits, or as many
                # as it fixes, complete the 48 that were sent.
                top = np.uint64((b << 16) // n_buckets << 48)
                hashes.append(low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32) | top)
                numbers.append(number.astype(np.uint32))
                owners.append(np.full(len(number), len(units), np.int32))
                units.append(unit)
        if not units:
            return
        h = np.concatenate(hashes)
        hashes.clear()
        order = np.argsort(h)
        h = h[order]
        same = h[1:] == h[:-1]
        again = np.zeros(len(h), bool)
        again[1:] |= same
        again[:-1] |= same
        at = np.flatnonzero(np.concatenate([[True], ~same]))
        holders = np.repeat(np.diff(np.concatenate([at, [len(h)]])), np.diff(np.concatenate([at, [len(h)]])))
        h, order, holders = h[again], order[again], holders[again].astype(np.uint32)
        number, owner = np.concatenate(numbers)[order], np.concatenate(owners)[order]
        by, off = blobs.by_bucket(owner, len(units))
        merged: dict[int, list] = {}
        for k in np.flatnonzero(off[1:] > off[:-1]):
            own = by[off[k]:off[k + 1]]
            merged.setdefault(units[k], []).append((number[own], h[own], holders[own]))
        for unit, parts in merged.items():
            yield cell([(0, 1, unit, blobs.pack(*(np.concatenate(x) for x in zip(*parts))))])

    return cells.mapInArrow(count, CELLS)


def candidate_sets(cells: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Sets with enough repeated shingles to have a partner (columns of ``CANDIDATES``):
    ``tokens`` are the repeated ones in global order, ``prefix`` those to be indexed."""
    names = [c.split()[0] for c in CANDIDATES.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.binary()]

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: dict[int, list] = {}
        for batch in batches:
            for kind, unit, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                units.setdefault(unit, [[], []])[kind - 1].append(blobs.unpack(c.as_buffer().to_pybytes()))
        for unit, (parts, (head,)) in units.items():
            if not parts:
                continue
            n, k1, k2 = head
            number, h, holders = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((h, holders, number))
            number, h = number[order], h[order]
            off = np.searchsorted(number, np.arange(len(n) + 1))
            rows = []
            for i in np.flatnonzero(100 * np.diff(off) >= percent * n):
                size, own = int(n[i]), h[off[i]:off[i + 1]]
                need = -(-percent * size // 100)
                first = len(own) - need + 1  # the prefix less the shingles that no one else holds
                rows.append((unit << 22 | int(i), size, int(k1[i]), int(k2[i]), len(own), own[:first].view(np.int64), own.tobytes()))
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return cells.mapInArrow(collect, CANDIDATES)


class BlockJoin:
    """Joins the sets of a block; ``roots`` gives a component per set (its first set)."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.far = percent, 1 - percent / 100
        self.compared = 0

    def overlap(self, x: np.ndarray, y: np.ndarray) -> int:
        self.compared += 1
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        return int((y[at] == x).sum()) if len(y) else 0

    def linked(self, o: int, n: int, m: int) -> bool:
        return 100 * o >= self.percent * (n + m - o)

    def roots(self, sizes: list[int], prefixes: list[np.ndarray], sets: list[np.ndarray]) -> list[int]:
        """``sets`` are the repeated shingles, ascending."""
        parent = list(range(len(sizes)))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        def union(i: int, j: int) -> None:
            i, j = find(i), find(j)
            if i != j:
                parent[max(i, j)] = min(i, j)

        pivots_of: dict[int, set[int]] = {}       # prefix shingle -> pivots with it in their group
        members: dict[int, list[tuple[float, int]]] = {}  # pivot -> (distance, set), itself first
        radius: dict[int, float] = {}
        for x in sorted(range(len(sizes)), key=lambda i: (sizes[i], i)):
            prefix, n, home, best = prefixes[x].tolist(), sizes[x], None, 0.0
            for p in dict.fromkeys(p for t in prefix for p in pivots_of.get(t, ())):
                if find(p) == find(x):
                    continue  # the whole group is connected already
                if 1 - min(n, sizes[p]) / max(n, sizes[p]) - radius[p] > self.far + 1e-9:
                    continue  # too different in size for the pivot and all of its group
                o = self.overlap(sets[x], sets[p])
                d = 1 - o / (n + sizes[p] - o)
                if self.linked(o, n, sizes[p]):
                    union(x, p)
                    if home is None:
                        home, best = p, d
                elif d - radius[p] <= self.far + 1e-9:
                    for dm, m in members[p]:
                        if d - dm <= self.far + 1e-9 and find(m) != find(x) and self.linked(
                                self.overlap(sets[x], sets[m]), n, sizes[m]):
                            union(x, m)
                            break
            if home is None:
                home = x
                members[x], radius[x] = [], 0.0
            members[home].append((best, x))
            radius[home] = max(radius[home], best)
            for t in prefix:
                pivots_of.setdefault(t, set()).add(home)
        return [find(i) for i in range(len(sizes))]


def join_blocks(placed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``node, root`` inside each ``job`` of ``placed`` (candidates with ``job``)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows):
            sets, nodes = {}, []
            for node, n, k1, k2, prefix, tokens in rows:
                nodes.append((node, k1, k2))
                if (k1, k2) not in sets:  # equal sets are one
                    sets[k1, k2] = (len(sets), node, n, np.array(prefix, np.int64), np.sort(np.frombuffer(tokens, np.uint64)))
            order = list(sets.values())
            roots = BlockJoin(percent).roots([s[2] for s in order], [s[3] for s in order], [s[4] for s in order])
            out = [(node, order[roots[sets[k1, k2][0]]][1]) for node, k1, k2 in nodes]
            a, b = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["node", "root"])

        now, rows = None, []
        for batch in batches:  # rows come sorted by job
            columns = [batch.column(c).to_pylist() for c in ("job", "node", "n", "k1", "k2", "prefix", "tokens")]
            for job, *row in zip(*columns):
                if job != now and rows:
                    yield done(rows)
                    rows = []
                now = job
                rows.append(row)
        if rows:
            yield done(rows)

    return placed.sortWithinPartitions("job", "n", "node").mapInArrow(work, "node long, root long")


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A forest that connects what the edges (a, b) connect: at most one edge a node."""
    nodes, ends = np.unique(np.stack([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(*ends.reshape(2, -1).tolist()):
        i, j = find(i), find(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
    root = np.array([find(i) for i in range(len(nodes))], np.int64)
    moved = root != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[root[moved]]]) if len(nodes) else np.zeros((2, 0), np.int64)


def star_edges(candidates: DataFrame) -> DataFrame:
    """``a, b``: edges that connect every candidate with the first holder of each of its
    prefix shingles. Holders inside a task meet there, so a frequent shingle leaves a
    task as one entry; entries are dealt by shingle in packed arrays, and a task gives
    a spanning forest of its edges."""
    entries = scalar(candidates.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))))
    n_buckets = int(max(16, -(-entries // TASK_SHINGLES)))

    def firsts(token, node):
        order = np.lexsort((node, token))
        token, node = token[order], node[order]
        at = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        first = np.repeat(node[at], np.diff(np.concatenate([at, [len(token)]])))
        late = first != node
        return token[at], node[at], spanning(node[late], first[late])

    def cells(rows):
        b, kind, c = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(b, pa.int32()), pa.array(kind, pa.int32()), pa.array(c, pa.binary())], ["bucket", "kind", "cell"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, nodes, size = [], [], 0

        def out():
            token, node, edges = firsts(np.concatenate(tokens), np.concatenate(nodes))
            bucket = (mix(token.view(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
            order, off = blobs.by_bucket(bucket, n_buckets)
            rows = [(int(k), 0, blobs.pack(token[order[off[k]:off[k + 1]]], node[order[off[k]:off[k + 1]]]))
                    for k in np.flatnonzero(off[1:] > off[:-1])]
            for i in range(0, edges.shape[1], 100_000):
                part = edges[:, i:i + 100_000]
                rows.append((int(part[0, 0] % n_buckets), 1, blobs.pack(part[0].copy(), part[1].copy())))
            for i in range(0, len(rows), 256):
                yield cells(rows[i:i + 256])

        for batch in batches:
            prefix = batch.column("prefix")
            tokens.append(prefix.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            nodes.append(np.repeat(batch.column("node").to_numpy(), prefix.value_lengths().to_numpy(zero_copy_only=False)))
            size += len(tokens[-1])
            if size >= UNIT_SHINGLES:
                yield from out()
                tokens, nodes, size = [], [], 0
        if size:
            yield from out()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for kind, c in zip(batch.column("kind").to_pylist(), batch.column("cell")):
                a, b = blobs.unpack(c.as_buffer().to_pybytes())
                if kind:
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                else:
                    parts.append((a, b))
        if parts:
            _, _, edges = firsts(*(np.concatenate(x) for x in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(edges[0].copy()), pa.array(edges[1].copy())], ["a", "b"])

    dealt = candidates.select("node", "prefix").mapInArrow(deal, "bucket int, kind int, cell binary")
    return dealt.repartition(n_buckets, "bucket").mapInArrow(join, "a long, b long")


def similar_sets(candidates: DataFrame, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES,
                 tasks: int = 16) -> DataFrame:
    """``k1, k2, root``: the component of every candidate set that shares a prefix shingle."""
    connected = components(star_edges(candidates)).withColumnRenamed("root", "block")
    # Of equal sets in several units one goes on.
    one = candidates.groupBy("k1", "k2").agg(F.min("node").alias("node")).select("node")
    blocks_ = cut_lineage(connected.join(one, "node"))
    size = cut_lineage(candidates.select("node", "held").join(blocks_, "node")
                       .groupBy("block").agg(F.sum("held").alias("shingles")))
    parts = F.ceil(2 * F.col("shingles") / block_shingles).cast("int")
    large = size.filter(F.col("shingles") > block_shingles).select("block", parts.alias("parts"))
    # A job is a whole block, or a pair of the groups that a large block is dealt into.
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = (blocks_.join(large, "block", "left")
              .withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", part)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("node", "parts", F.struct(
                  "block", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")).alias("job")))
    columns = ["job", "node", "n", "k1", "k2", "prefix", "tokens"]

    def joined(jobs: DataFrame) -> DataFrame:
        # Jobs grow with the corpus: merged, not broadcast, at any size.
        return join_blocks(candidates.join(jobs.hint("merge"), "node").select(*columns).repartition(tasks, "job"), percent)

    placed = cut_lineage(placed)
    done = joined(placed.filter("parts = 1"))
    met = cut_lineage(joined(placed.filter("parts > 1")))
    again = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return candidates.select("node", "k1", "k2").join(done.union(again), "node").select("k1", "k2", "root")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
                       unit_shingles: int = UNIT_SHINGLES, task_shingles: int = TASK_SHINGLES,
                       block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``id, body, n_shingles, component_id`` for every row of ``docs`` (body: a text hash)."""
    if not 50 <= percent <= 100:
        raise ValueError("percent is 50 to 100")
    ship_package(docs.sparkSession)
    base = narrow(docs, id_col, text_col)
    scanned = cut_lineage(document_sets(base, unit_shingles))
    sets = scanned.filter("kind = 0").select("id", "body", "n", "k1", "k2")
    n_docs, total = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).head()
    hot = (scanned.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n"))
           .filter(F.col("n") >= n_docs / (2 * HOT_SHARE)).orderBy("id").toArrow())
    ids = hot["id"].to_numpy().view(np.uint64)
    order = np.argsort(ids)
    # Frequent shingles come after all others in the global order.
    counts = (np.uint32(1 << 31) + hot["n"].to_numpy().clip(0, (1 << 31) - 1).astype(np.uint32))[order]
    tasks = int(max(16, -(-total // task_shingles)))
    n_buckets = tasks * BUCKETS_PER_TASK
    cells = deal_shingles(base, (ids[order], counts), n_buckets, unit_shingles)
    back = count_shingles(cells.repartition(tasks, "bucket"), n_buckets).repartition(tasks, "unit")
    candidates = cut_lineage(candidate_sets(back, percent))
    found = similar_sets(candidates, percent, block_shingles, tasks)
    roots = cut_lineage(found.groupBy("k1", "k2").agg(F.min("root").alias("root")))
    labelled = sets.join(roots, ["k1", "k2"], "left")
    alone = F.col("root").isNull()
    # A component is a root, else a class of equal sets, else (no shingles) the row's id.
    labelled = labelled.select(
        "id", "body", "n", F.when(F.col("n") == 0, 0).when(alone, 1).otherwise(2).alias("c0"),
        F.when(F.col("n") == 0, 0).otherwise(F.coalesce("root", "k1")).alias("c1"),
        F.when(F.col("n") == 0, F.coalesce("id", F.lit(0))).when(alone, F.col("k2")).otherwise(0).alias("c2"))
    labelled = cut_lineage(labelled)
    key = F.struct("c0", "c1", "c2")
    low = cut_lineage(labelled.groupBy(key.alias("c")).agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("m"))
                      .filter("m > 1").drop("m"))
    return (labelled.withColumn("c", key).join(low, "c", "left")
            .select("id", "body", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component_id", "id")).alias("component_id")))


def near_dedup(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component that
    with the smallest id. Rows without an id can't be addressed and stay."""
    found = jaccard_components(docs, percent, id_col, text_col)
    gone = found.filter(F.col("id") != F.col("component_id")).select("id", F.col("body").alias("key"))
    return without(docs, gone, id_col, text_col, F.xxhash64)
