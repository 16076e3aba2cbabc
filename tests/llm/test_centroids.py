"""Centroid clustering against a plain k-means on Python integers, and the tree alone."""
import hashlib
import math
import random

import numpy as np
import pytest

from panelcast.llm.centroids import VantageTree, cluster_vectors, distances

SCHEMA = "vec_id long, embedding array<double>, cluster string, id int, v string"


def brute(rows, k, rounds, dim):
    kept = []
    for i, v in rows:
        if v is None or len(v) != dim or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(x * 256) for x in v]
        if all(abs(c) <= 1 << 27 for c in x):
            kept.append((i, x))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[0] or 0,
                                        np.array(r[1], "<i4").tobytes()))
    centroids = [x for _, x in order[:k]]

    def assign():
        out = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [x for (_, x), (n, _) in zip(kept, found) if n == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    found = assign()
    total, per = sum(d for _, d in found), {}
    for c, d in found:
        per[c] = per.get(c, 0) + d
    return sorted(((i, c, d, per[c], total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for (i, _), (c, d) in zip(kept, found)), key=repr)


def run(spark, rows, k, rounds, dim):
    df = spark.createDataFrame([(i, v, "x", 7, "y") for i, v in rows], SCHEMA).repartition(3)
    out = cluster_vectors(df, k=k, rounds=rounds, dim=dim)
    return sorted((tuple(r)[:6] for r in out.collect()), key=repr)


def vectors(n, dim, seed, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("n,k,dim", [(300, 17, 8), (50, 40, 3), (5, 9, 4)])
def test_equals_plain_kmeans(spark, n, k, dim):
    rows = vectors(n, dim, n)
    assert run(spark, rows, k, 3, dim) == brute(rows, k, 3, dim)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [*vectors(20, 3, 1), (100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0]), (104, [nan, 0.0, 0.0]),
            (105, [inf, 0.0, 0.0]), (106, [1e300, 0.0, 0.0]), (107, [-0.001, -1 / 256, 0.0]), (108, [5e5, -5e5, 5e5]),
            (109, [1.0] * 4), (None, [0.5, 0.5, 0.5]), (-3, [0.0, 0.0, 0.0]), (110, [0.25, 0.5, 0.75]),
            (110, [0.25, 0.5, 0.75]), (111, [0.25, 0.5, 0.75])]
    got = run(spark, rows, 30, 4, 3)
    assert got == brute(rows, 30, 4, 3)
    assert {100, 101, 102, 103, 104, 105, 106, 109}.isdisjoint(r[0] for r in got)
    assert run(spark, [], 5, 2, 3) == []


def test_ties_go_to_the_smaller_number_and_hot_points(spark):
    # A grid has many equal distances; a third of all rows are one point.
    grid = [(i, [float(i % 5), float(i // 5 % 5)]) for i in range(100)] + [(200 + i, [2.0, 2.0]) for i in range(50)]
    assert run(spark, grid, 12, 4, 2) == brute(grid, 12, 4, 2)


@pytest.mark.parametrize("top", [4, 1000, 1 << 27])
def test_tree_finds_the_nearest(top):
    rng = np.random.default_rng(top)
    for k, dim in ((1, 2), (5, 2), (40, 3), (64, 16)):
        c = rng.integers(-top, top + 1, (k, dim))
        x = np.concatenate([rng.integers(-top, top + 1, (200, dim)), c])
        d = np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)
        assert (distances(x, c) == d).all()
        number, best = VantageTree(c).nearest(x)
        assert (number == d.argmin(1)).all() and (best == d.min(1)).all()
