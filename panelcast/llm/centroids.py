"""Operator 13: k-means with a vantage-point tree over the centroids.

Vectors become integers (floor of ``scale`` times each component) once and are
written packed. Each round builds a vantage-point tree over the centroids on the
driver (k points, a parameter) and broadcasts it. Tasks search it for blocks of
vectors: every vector keeps a lower bound for each open node and always enters its
nearest one (best first); a node is closed only when its bound lies strictly beyond
the best distance found, so ties are seen, and a margin covers the rounding of the
square roots. Distances to centroids are exact integers; the smaller number wins a
tie. A task gives one row per (centroid, component) with its sums, so no
centroid is a hot key whatever its share of the vectors.

Edge cases: vectors that are null, have another number of components, or hold a null
or non-finite component are not kept; nor are those with a scaled component beyond
2^27, whose distances need not fit a long. Fewer kept vectors than ``k`` give as many
centroids; none give an empty result. Equal vectors may start as several centroids:
the smaller number takes all, the others stay where they are. A null id sorts last
among the starting points; rows repeated under one id count as often as they stand
(and, by hash, their vectors' order, may all start as centroids). Other columns are
ignored. A sum beyond a long is raised by Spark, not wrapped, in ANSI mode.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, ship_package

K, ROUNDS, DIM, SCALE, SEED = 40, 5, 64, 256, 2
LIMIT, LEAF, BLOCK = 1 << 27, 4, 8192
EXACT_DOUBLE = 1 << 52


# --- vectors as integers ---------------------------------------------------------

def integers(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are kept, and their integers (int32)."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null becomes NaN
    rows = np.flatnonzero(lengths == dim)
    starts = (np.cumsum(lengths) - lengths)[rows]
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(values[starts[:, None] + np.arange(dim)] * scale)
        good = (np.abs(x) <= LIMIT).all(axis=1)  # false for NaN and infinities
    return rows[good], x[good].astype(np.int32)


def scaled(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """``id, v``: kept vectors, ``v`` the little-endian 32-bit integers."""
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = integers(batch.column(1), dim, scale)
            cells = pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), cells], ["id", "v"])

    narrow = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                            F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return narrow.mapInArrow(convert, "id long, v binary")


def matrix(cells: pa.Array, dim: int) -> np.ndarray:
    """The packed vectors of a batch as rows."""
    cells = cells.cast(pa.large_binary())
    offsets = np.frombuffer(cells.buffers()[1], np.int64)[cells.offset:cells.offset + len(cells) + 1]
    data = cells.buffers()[2]
    if not len(cells) or data is None:
        return np.zeros((0, dim), np.int64)
    return np.frombuffer(data, "<i4")[offsets[0] // 4:offsets[-1] // 4].reshape(-1, dim).astype(np.int64)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every row of ``c``."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if x.shape[1] * 4 * top * top < EXACT_DOUBLE:  # all sums are integers a double holds
        x, c = x.astype(np.float64), c.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (c * c).sum(1) - 2.0 * (x @ c.T)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


# --- the tree --------------------------------------------------------------------

class VantageTree:
    """Nodes in arrays. An inner node holds a vantage centroid and two children with
    the smallest and largest distance of their members from it; a leaf a few centroids."""

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = centroids
        self.members, self.children, self.spans = [], [], []
        if len(centroids):
            self._grow(np.arange(len(centroids)), leaf)

    def __len__(self) -> int:
        return len(self.members)

    def _grow(self, own: np.ndarray, leaf: int) -> int:
        node = len(self.members)
        self.members.append(own)
        self.children.append(())
        self.spans.append(())
        if len(own) <= leaf:
            return node
        # The point farthest from the middle of its group tells the others best apart.
        points = self.centroids[own]
        spread = ((points - points.mean(0)) ** 2).sum(1)
        v = int(np.argmax(spread))
        rest = np.delete(own, v)
        d = np.sqrt(distances(self.centroids[own[v]][None], self.centroids[rest])[0])
        order = np.argsort(d, kind="stable")
        half = len(order) // 2
        parts = [order[:half], order[half:]]
        self.members[node] = own[v:v + 1]
        self.children[node] = tuple(self._grow(rest[p], leaf) for p in parts)
        self.spans[node] = tuple((float(d[p].min()), float(d[p].max())) for p in parts)
        return node

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of every row."""
        n = len(x)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, -1, np.int64)
        open_ = np.full((n, len(self)), np.inf)
        open_[:, 0] = 0.0
        active = np.arange(n)
        while len(active):
            node = np.argmin(open_[active], axis=1)
            bound = open_[active, node]
            radius = np.sqrt(best[active].astype(np.float64))
            go = bound <= radius * (1 + 1e-9) + 1e-6  # inclusive: a tie beyond may have a smaller number
            active, node, bound = active[go], node[go], bound[go]
            open_[active, node] = np.inf
            for k in np.unique(node):
                rows, low = active[node == k], bound[node == k]
                own = self.members[k]
                d = distances(x[rows], self.centroids[own])
                for c in np.argsort(own):
                    better = (d[:, c] < best[rows]) | ((d[:, c] == best[rows]) & (own[c] < number[rows]))
                    best[rows] = np.where(better, d[:, c], best[rows])
                    number[rows] = np.where(better, own[c], number[rows])
                if self.children[k]:
                    away = np.sqrt(d[:, 0].astype(np.float64))
                    for child, (lo, hi) in zip(self.children[k], self.spans[k]):
                        open_[rows, child] = np.maximum(low, np.maximum(lo - away, away - hi))
        return number, best


# --- rounds ----------------------------------------------------------------------

def starting_points(packed: DataFrame, k: int, dim: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of ``seed:id``, in hash order."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = packed.withColumn("h", place).orderBy(F.col("h").asc_nulls_last(), "id", "v").limit(k).collect()
    return np.array([np.frombuffer(r.v, "<i4") for r in rows], np.int64).reshape(-1, dim)


def _assigned(packed: DataFrame, centroids: np.ndarray, dim: int):
    shared = packed.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def search(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        x = matrix(batch.column(1), dim)
        for i in range(0, len(x), BLOCK):
            at = slice(i, min(i + BLOCK, len(x)))
            yield at, x[at], *shared.value.nearest(x[at])

    return search


def moved(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dim = centroids.shape
    search = _assigned(packed, centroids, dim)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, x, number, _ in search(batch):
                order = np.argsort(number, kind="stable")
                found, first = np.unique(number[order], return_index=True)
                total[found] += np.add.reduceat(x[order], first, axis=0) if len(found) else 0
                count += np.bincount(number, minlength=k)
        some = np.flatnonzero(count)
        cell = (some[:, None] * dim + np.arange(dim)).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell, pa.int64()), pa.array(total[some].ravel(), pa.int64()),
             pa.array(np.repeat(count[some], dim), pa.int64())], ["cell", "s", "n"])

    out = centroids.copy()
    cells = packed.mapInArrow(sums, "cell long, s long, n long").groupBy("cell").agg(F.sum("s"), F.sum("n"))
    for cell, s, n in cells.collect():  # at most k * dim rows
        out[cell // dim, cell % dim] = s // n  # Python's // rounds down
    return out


def cluster_vectors(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
                    seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid`` per kept vector."""
    spark = vectors.sparkSession
    ship_package(spark)
    packed = cut_lineage(scaled(vectors, id_col, vector_col, dim, scale))
    centroids = starting_points(packed, k, dim, seed)
    for _ in range(rounds if len(centroids) else 0):
        after = moved(packed, centroids)
        if np.array_equal(after, centroids):
            break  # every further round is the same
        centroids = after
    search = _assigned(packed, centroids, dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, number, best in search(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at.start, at.stop - at.start), pa.array(number, pa.int32()),
                     pa.array(best, pa.int64())], ["id", "cluster", "distance"])

    out = cut_lineage(packed.mapInArrow(assign, "id long, cluster int, distance long"))
    found = out.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # at most k rows
    total = sum(r.s for r in found)
    facts = [(r.cluster, r.s, total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest(), c)
             for r in found for c in [centroids[r.cluster].tolist()]]
    per_cluster = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, "
                                               "centroid_sha256 string, centroid array<long>")
    return out.join(F.broadcast(per_cluster), "cluster").select(  # k rows
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")
