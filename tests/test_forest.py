"""The forest: node tables against MLlib, scale, weights, and a forest per series to compare with."""
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelcast.functions.numeric import round2
from panelcast.operators.models import forest, trees

QS = [f"{y}Q{q}" for y in range(2013, 2020) for q in (1, 2, 3, 4)]
SCHEMA = "origin string, quarter string, series string, x double, z double, rev double"
ORIGIN = "2018Q1"


def scaled_panel(n, kind="smooth", noise=0.3, seed=5):
    """Series of sizes 1 to 10^6 with one kind of response to their own x and z."""
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(n):
        size = 10 ** (6 * s / max(n - 1, 1))
        for q in QS:
            x, z = float(rng.uniform(0, size)), float(rng.normal() * 3)
            y = 10 + (4 * x / size + 2 * np.tanh(z / 3) if kind == "smooth" else 4 * (x > 0.5 * size) + 2 * (z > 0))
            rows.append((ORIGIN, q, f"EU{s % 7}-D{s}", x, z, float(round(size * (y + noise * rng.normal()), 2))))
    return rows


def grow(x, y, rows, rng):
    """A full regression tree on the given rows, as nested tuples."""
    if len(rows) < 2 or np.ptp(y[rows]) == 0:
        return float(y[rows].mean())
    best = None
    for f in range(x.shape[1]):
        order = rows[np.argsort(x[rows, f], kind="stable")]
        v, t = x[order, f], y[order]
        k = np.flatnonzero(v[1:] > v[:-1]) + 1
        if len(k):
            left, total = np.cumsum(t)[k - 1], t.sum()
            gain = left**2 / k + (total - left) ** 2 / (len(t) - k)
            at = int(np.argmax(gain))
            if best is None or gain[at] > best[0]:
                best = gain[at], f, (v[k[at] - 1] + v[k[at]]) / 2
    if best is None:
        return float(y[rows].mean())
    _, f, cut = best
    return f, cut, grow(x, y, rows[x[rows, f] <= cut], rng), grow(x, y, rows[x[rows, f] > cut], rng)


def follow(tree, row):
    while isinstance(tree, tuple):
        f, cut, left, right = tree
        tree = left if row[f] <= cut else right
    return tree


def per_series_errors(rows, n_trees, seed=42):
    """Mean relative error of each series under a bagged forest of its own."""
    rng, out = np.random.default_rng(seed), {}
    for s in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == s]
        train = np.array([r[3:] for r in own if r[1] < ORIGIN])
        later = [r for r in own if r[1] >= ORIGIN]
        grown = [grow(train[:, :2], train[:, 2], rng.integers(0, len(train), len(train)), rng) for _ in range(n_trees)]
        out[s] = np.mean([abs(np.mean([follow(t, r[3:5]) for t in grown]) - r[5]) / r[5] for r in later])
    return out


def pooled_errors(spark, rows, n_trees, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    out = forest.forest_forecast(df.where("quarter < origin"), df.where("quarter >= origin").drop("rev"), "rev", ["x", "z"],
                                 [ORIGIN], num_trees=n_trees, **how)
    truth, errors = {(r[2], r[1]): r[5] for r in rows}, {}
    for r in out.collect():
        errors.setdefault(r.series, []).append(abs(r.rev - truth[r.series, r.quarter]) / truth[r.series, r.quarter])
    return {s: np.mean(e) for s, e in errors.items()}


@pytest.mark.parametrize("kind,noise", [("smooth", 0.3), ("smooth", 1.0), ("step", 1.0)])
def test_no_worse_than_a_forest_per_series(spark, kind, noise):
    rows = scaled_panel(60, kind, noise)
    pooled, own = pooled_errors(spark, rows, 20), per_series_errors(rows, 20)
    assert set(pooled) == set(own)
    assert np.mean(list(pooled.values())) <= np.mean(list(own.values()))
    small = sorted(own, key=lambda s: int(s.split("D")[1]))[:20]  # the smallest series are served as well
    assert np.mean([pooled[s] for s in small]) <= 1.05 * np.mean([own[s] for s in small])


def test_forecasts_follow_the_scale_of_a_series(spark):
    """All values of one series times 10^6: the relative errors of all series stay (up to cuts
    that tie)."""
    rows = [r for r in scaled_panel(4) if r[2] != "EU3-D3"]
    big = [(*r[:3], r[3] * 1e6, r[4] * 1e6, r[5] * 1e6) if r[2] == "EU1-D1" else r for r in rows]
    a, b = pooled_errors(spark, rows, 5), pooled_errors(spark, big, 5)
    assert all(abs(a[s] - b[s]) < 0.02 for s in a)


def test_size_of_the_learner_follows_the_longest_series():
    assert forest.learner_size(28) == (58, 10)
    assert forest.learner_size(1) == (32, 2) and forest.learner_size(0) == (32, 1)
    assert forest.learner_size(560) == (2 * 560 + 2, 20) and forest.learner_size(10**6)[1] == 30


def test_untrained_series_and_weights(spark):
    rows = scaled_panel(4)
    df = spark.createDataFrame(rows, SCHEMA)
    train, horizon = df.where("quarter < origin and series != 'EU1-D1'"), df.where("quarter >= origin").drop("rev")
    got = forest.forest_forecast(train, horizon, "rev", ["x", "z"], [ORIGIN], num_trees=3, recency=True).collect()
    assert len(got) == 4 * 8 and all((r.rev == 0) == (r.series == "EU1-D1") for r in got)
    plain = forest.forest_forecast(train.drop("origin"), horizon, "rev", ["x", "z"], [ORIGIN], num_trees=3).collect()
    assert sorted(got) != sorted(plain)  # older rows weigh less


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rf"))
    df = spark.createDataFrame(scaled_panel(5), SCHEMA)
    train, horizon = df.where("quarter < origin"), df.where("quarter >= origin").drop("rev")
    forest.forest_forecast(train, horizon, "rev", ["x", "z"], [ORIGIN], num_trees=7, artefacts=path)
    return path, horizon


def test_node_tables_score_like_mllib(spark, saved):
    path, horizon = saved
    enc, model = forest.load_forest(spark, path, "rev", ORIGIN)
    nodes = spark.read.parquet(f"{path}/rev/{ORIGIN}/nodes")
    assert nodes.count() == model.totalNumNodes
    n_trees, depth = trees.tree_shape(nodes)
    assert n_trees == 7 and depth == max(t.depth for t in model.trees)
    rows = forest.ranked(horizon, enc, ["x", "z"])
    names, keys = forest.rank_names(["x", "z"]), ["quarter", "series"]
    got = {(r.quarter, r.series): r.score for r in trees.score_nodes(rows, nodes, keys, names, n_trees, depth).collect()}
    want = model.transform(VectorAssembler(inputCols=names, outputCol="_x").transform(rows)).select(*keys, "_pred").collect()
    assert len(got) == len(want) == 40
    assert all(abs(got[r.quarter, r.series] - r._pred) <= 1e-12 * abs(r._pred) for r in want)
    scored = {(r.quarter, r.series): r.rev for r in forest.score_forest(horizon, enc, model, "rev", ["x", "z"]).collect()}
    table = trees.score_nodes(rows, nodes, keys, names, n_trees, depth).join(enc, "series").select(
        *keys, round2(F.col("score") * F.col("_scale")).alias("rev"))
    assert {(r.quarter, r.series): r.rev for r in table.collect()} == scored


def test_null_features_unknown_nodes_and_leaves_at_the_root(spark):
    nodes = spark.createDataFrame([(0, 0, 1, 0.0, 1, 2, 9.0), (0, 1, None, None, None, None, 1.0), (0, 2, None, None, None, None, 2.0),
                                   (1, 0, None, None, None, None, 5.0)], trees.NODES)
    rows = spark.createDataFrame([(1, 1.0, None), (2, 1.0, 0.5), (3, None, -1.0)], "id int, a double, b double")
    assert trees.tree_shape(nodes) == (2, 1)
    got = {r.id: r.score for r in trees.score_nodes(rows, nodes, ["id"], ["a", "b"], 2, 1).collect()}
    assert got == {1: 3.0, 2: 3.5, 3: 3.0}
    assert trees.score_nodes(rows.limit(0), nodes, ["id"], ["a", "b"], 2, 1).count() == 0


def test_reruns_agree_whatever_the_partitions(spark):
    df = spark.createDataFrame(scaled_panel(30), SCHEMA)
    train, horizon = df.where("quarter < origin"), df.where("quarter >= origin").drop("rev")
    runs = [sorted(forest.forest_forecast(train.repartition(k), horizon, "rev", ["x", "z"], [ORIGIN], num_trees=4).collect())
            for k in (1, 5, 11)]
    assert runs[0] == runs[1] == runs[2]
