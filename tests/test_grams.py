"""Packed Gram fits: origins from sums per quarter, stacks, blocks of penalties, weights."""
import time
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelcast.operators import features as feat
from panelcast.operators.models import grams, ridge
from panelcast.operators.models.trend import fit as trend_fit
from panelcast.plans import backtest as bt
from panelcast.plans import families as fam
from panelcast.plans.params import RunParams
from panelcast.plans.queries import PARAMS, _inputs

SF = "/root/testdata/sf0.001"
QS = [f"{y}Q{q}" for y in range(2010, 2020) for q in (1, 2, 3, 4)]
SCHEMA = "quarter string, series string, x double, z double, rev double"
ORIGINS = ["2014Q1", "2013Q1", "2016Q3", "2030Q1", "2009Q4"]  # unsorted, one after all, one before


def panel(spark, n=7, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(q, f"A-{s}", float(rng.normal()), float(rng.normal()), float(10 * s + rng.normal() + 0.3 * i))
            for s in range(n) for i, q in enumerate(QS) if rng.random() > 0.1]
    return spark.createDataFrame([*rows, ("2011Q1", "A-null", None, 1.0, 2.0), ("2011Q1", None, 1.0, 1.0, 2.0)], SCHEMA)


def one_by_one(df, origin, penalty, weights=None):
    out = {}
    for s, own in df.toPandas().dropna(subset=["x", "z", "rev"]).groupby("series", dropna=False):
        own = own[own.quarter < origin].sort_values("quarter")
        if len(own):
            z = np.column_stack([np.ones(len(own)), own[["x", "z", "rev"]]])
            w = np.ones(len(own)) if weights is None else np.array([weights[q] for q in own.quarter])
            out[s if isinstance(s, str) else None] = ridge.solve_gram((z * w[:, None]).T @ z, penalty)
    return out


@pytest.mark.parametrize("penalty", [0.5, (0.1, 2.0)])
def test_every_origin_equals_its_own_fit(spark, penalty):
    df = panel(spark)
    got = {}
    for r in grams.fit(df, ["series"], ["x", "z"], "rev", penalty, ORIGINS).collect():
        got.setdefault(r.origin, {})[r.series] = r.beta
    assert "2009Q4" not in got
    for o in ORIGINS[:-1]:
        want = one_by_one(df, o, penalty)
        assert set(got[o]) == set(want)
        assert all(np.allclose(got[o][s], want[s], atol=1e-9) for s in want)


def test_recency_weights_follow_the_tiers(spark):
    df = panel(spark).where("series is not null")
    weights = {(r.origin, r.quarter): r.weight for r in feat.recency_weights(df.dropna(), ["2014Q1", "2016Q3"]).collect()}
    got = {(r.origin, r.series): r.beta for r in
           grams.fit(df, ["series"], ["x", "z"], "rev", 0.5, ["2014Q1", "2016Q3"], recency=True).collect()}
    for o in ("2014Q1", "2016Q3"):
        want = one_by_one(df, o, 0.5, {q: w for (p, q), w in weights.items() if p == o})
        assert all(np.allclose(got[o, s], want[s], atol=1e-9) for s in want)
    assert len(set(weights.values())) == 5


def test_a_new_origin_needs_only_the_new_quarters(spark):
    df = panel(spark)
    old = grams.fit(df, ["series"], ["x", "z"], "rev", 0.5, ["2014Q1"], with_gram=True)
    # Every older row is gone, and a series begins after the old origin.
    late = spark.createDataFrame([("2014Q3", "B-9", 1.0, 2.0, 3.0), ("2014Q4", "B-9", 2.0, 1.0, 4.0)], SCHEMA)
    rows = df.where("quarter >= '2014Q1'").unionByName(late)
    got = {r.series: r.beta for r in
           grams.advance(old, rows, ["series"], ["x", "z"], "rev", 0.5, "2014Q1", "2016Q3").collect()}
    want = one_by_one(df.unionByName(late), "2016Q3", 0.5)
    assert set(got) == set(want) - {None} | ({None} & set(got))
    assert all(np.allclose(got[s], want[s], atol=1e-8) for s in want if s)


def test_groups_cross_batches():
    keys = [0] * 5 + [1] + [2] * 40 + [3] * 3 + [4, 5, 6, 7]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i:i + 3], "v": list(range(i, min(i + 3, len(keys))))})
               for i in range(0, len(keys), 3)]
    for rows in (1, 4, 7, 100):
        seen = []
        for table, starts in grams.whole_groups(iter(batches), ["k"], rows):
            edges = [*starts.tolist(), table.num_rows]
            for a, b in pairwise(edges):
                assert len(set(table["k"][a:b].to_pylist())) == 1
                seen.append((table["k"][a].as_py(), table["v"][a:b].to_pylist()))
        assert [k for k, _ in seen] == list(range(8)) and sum((v for _, v in seen), []) == list(range(len(keys)))
    assert list(grams.whole_groups(iter([]), ["k"], 5)) == []


def test_stacked_solves_equal_single_ones():
    rng = np.random.default_rng(4)
    stack = []
    for n in (0, 1, 3, 40):
        z = np.column_stack([np.ones(n), rng.normal(size=(n, 4)), np.full(n, 3.0), rng.normal(size=n)])
        stack.append(z.T @ z)
    beta = grams.solve_grams(np.stack(stack), 0.7)
    assert np.isnan(beta[0]).all() and (beta[1:, 5] == 0).all()
    for g, b in zip(stack[1:], beta[1:]):
        assert np.allclose(b, ridge.solve_gram(g, 0.7))


def test_a_broken_trend_is_recovered(spark):
    """Slope 5 until 2014Q1, then -3: hinges find it, and the plain line does not."""
    rows, change = [], QS.index("2014Q1")
    for s in range(3):
        for i, q in enumerate(QS):
            y = 100.0 + 5.0 * i - 8.0 * max(0, i - change) + (4.0, -2.0, 1.0, -3.0)[i % 4]
            rows.append(("2018Q1", q, f"A-{s}", 0.0, y))
    df = spark.createDataFrame(rows, "origin string, quarter string, series string, x double, rev double")
    train, horizon = df.where("quarter < origin").drop("origin"), df.where("quarter >= origin").drop("rev")
    truth = {(r.series, r.quarter): r.rev for r in df.collect()}
    terms = ridge.AdditiveTerms(changes=tuple(f"{y}Q1" for y in range(2011, 2020)), fourier=2, trend_penalty=1e-6,
                                change_penalty=1e-5, season_penalty=1e-6)

    def error(terms):
        out = ridge.additive_forecast(train, horizon, "rev", ["x"], penalty=1e-6, origins=["2018Q1"], terms=terms)
        return max(abs(r.rev - truth[r.series, r.quarter]) for r in out.collect())

    assert error(terms) < 1.0 < 20 < error(None)


def test_trend_sums_of_all_origins_equal_copies_per_origin(spark):
    train = bt.training(_inputs(spark, SF), PARAMS)
    copies = trend_fit(feat.training_sets(train, PARAMS.origins))
    prefix = trend_fit(train, origins=PARAMS.origins)
    for a, b in zip(copies, prefix):
        assert sorted(a.select(*sorted(a.columns)).collect(), key=repr) == \
            sorted(b.select(*sorted(a.columns)).collect(), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_copy_per_origin_before_the_fits(spark):
    """M9: training rows are not exploded by origin below the window sums or the solver."""
    train = bt.training(_inputs(spark, SF), PARAMS)
    rows, feats = ridge.additive_design(train.dropna(), feat.REV_FEATURES)
    plan = plan_of(ridge.fit(rows, ["series"], feats, "rev", origins=PARAMS.origins))
    assert "Generate" not in plan and "MapInArrow" in plan
    for part in trend_fit(train, origins=PARAMS.origins):
        plan = plan_of(part)
        assert plan.index("Generate") < plan.index("Window")  # the explode is above the running sums
        assert "Generate" not in plan[plan.index("Window"):plan.index("Window") + 400].split("\n", 1)[0]


def test_groups_are_dealt_to_all_tasks(spark):
    """Small groups are not coalesced into one task."""
    train = bt.training(_inputs(spark, SF), PARAMS)
    dealt = grams.deal(train.select("series", "quarter"), ["series"])
    used = dealt.select(F.spark_partition_id().alias("p"), "series").distinct().groupBy("series").count().collect()
    assert all(r["count"] == 1 for r in used)
    parts = dealt.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= min(grams.partitions(spark), len(used)) // 2


def test_planning_time_is_bounded(spark):
    """Scoring starts from written coefficients, so the optimiser sees no fit behind them."""
    inp = _inputs(spark, SF)
    for family, p in ((ridge.ADDITIVE, RunParams(worldwide_features=("pipeline", "brent", "wti"))),
                      (ridge.AR_DIRECT, PARAMS)):
        train, stage2 = bt.training(inp, p), bt.stage2_frames(inp, p)
        t0 = time.perf_counter()
        out = fam._stage(family, train, stage2, "cm", feat.REV_FEATURES, p, fam.AR_LAGGED)
        out._jdf.queryExecution().executedPlan()
        assert time.perf_counter() - t0 < 60
