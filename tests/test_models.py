import numpy as np

from panelcast.operators.models import ridge
from panelcast.operators.models.forest import forest_forecast
from panelcast.operators.models.trend import TREND, TREND_SEASONAL, trend_forecast

QS = [f"{y}Q{q}" for y in range(2015, 2021) for q in (1, 2, 3, 4)]
SEASON = {1: 5.0, 2: -3.0, 3: 0.0, 4: -2.0}


def _two_step(ts, ys, qoys, t_new, q_new):
    """Numpy version of M10: OLS line, then mean residual per quarter-of-year."""
    b, a = np.polyfit(ts, ys, 1)
    res = {k: np.mean([y - (a + b * t) for t, y, q in zip(ts, ys, qoys) if q == k])
           for k in set(qoys)}
    return a + b * t_new + res.get(q_new, 0.0), a + b * t_new


def test_trend_forecaster_matches_two_step_fit(spark):
    rows = []
    for i, q in enumerate(QS):
        rev = 1000.0 + 10.0 * i + SEASON[int(q[-1])]
        rows.append(("O", q, "S", rev, 40.0 + 0.5 * i))   # margin: a pure line
    train = spark.createDataFrame(rows[:-4], "origin string, quarter string, series string, "
                                             "rev double, cm double")
    horizon = spark.createDataFrame([("O", q, "S") for q in QS[-4:]],
                                    "origin string, quarter string, series string")
    got = {(r.model, r.quarter): r for r in trend_forecast(train, horizon).collect()}
    ts = list(range(len(QS) - 4))
    ys = [r[3] for r in rows[:-4]]
    qoys = [int(q[-1]) for q in QS[:-4]]
    for i, q in enumerate(QS[-4:], start=len(QS) - 4):
        seasonal, line = _two_step(ts, ys, qoys, i, int(q[-1]))
        assert abs(got[(TREND_SEASONAL, q)].rev - seasonal) < 0.006
        assert abs(got[(TREND, q)].rev - line) < 0.006
        # a noise-free line is recovered exactly by both variants
        assert abs(got[(TREND, q)].cm - (40.0 + 0.5 * i)) < 0.006
        assert abs(got[(TREND_SEASONAL, q)].cm - (40.0 + 0.5 * i)) < 0.006


def test_trend_single_point_and_missing_history(spark):
    train = spark.createDataFrame([("O", "2020Q1", "S", 7.0, None)],
                                  "origin string, quarter string, series string, rev double, "
                                  "cm double")
    horizon = spark.createDataFrame([("O", "2020Q2", "S"), ("O", "2020Q2", "NEW")],
                                    "origin string, quarter string, series string")
    got = {(r.series, r.model): r for r in trend_forecast(train, horizon).collect()}
    assert got[("S", TREND)].rev == 7.0 and got[("S", TREND)].cm is None
    assert got[("NEW", TREND_SEASONAL)].rev is None


def test_solve_gram_recovers_coefficients():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = 3.0 + x @ np.array([2.0, -1.0, 0.5])
    z = np.column_stack([np.ones(200), x, y])
    beta = ridge.solve_gram(z.T @ z, penalty=1e-9)
    assert np.allclose(beta, [3.0, 2.0, -1.0, 0.5], atol=1e-6)
    # a constant feature gets a zero coefficient instead of a singular solve
    z2 = np.column_stack([np.ones(200), x, np.full(200, 7.0), y])
    assert ridge.solve_gram(z2.T @ z2, penalty=1e-9)[4] == 0.0


def test_additive_ridge_distributed_fit(spark):
    rng = np.random.default_rng(1)
    rows, hz = [], []
    for s, (a, b) in {"S1": (50.0, 2.0), "S2": (-20.0, 0.5)}.items():
        for i, q in enumerate(QS):
            x = float(rng.normal())
            y = a + b * x + 3.0 * i + SEASON[int(q[-1])]
            (hz if i >= len(QS) - 2 else rows).append(("O", q, s, x, y))
    schema = "origin string, quarter string, series string, x double, rev double"
    train, horizon = spark.createDataFrame(rows, schema), spark.createDataFrame(hz, schema)
    got = {(r.series, r.quarter): r.rev for r in
           ridge.additive_forecast(train, horizon.drop("rev"), "rev", ["x"],
                                   penalty=1e-9).collect()}
    for o, q, s, x, y in hz:
        assert abs(got[(s, q)] - y) < 0.02


def test_ar_direct_on_ar1_series(spark):
    ys = [100.0]
    for _ in range(len(QS) - 1):
        ys.append(0.5 * ys[-1] + 20.0)   # converges to 40
    rows = [("2020Q1", q, "S", 0.0, y) for q, y in zip(QS, ys)]
    schema = "origin string, quarter string, series string, x double, rev double"
    train = spark.createDataFrame(rows[:-4], schema)
    horizon = spark.createDataFrame(rows[-4:], schema).drop("rev")
    got = {r.quarter: r.rev for r in
           ridge.ar_direct_forecast(train, horizon, "rev", ["x"], penalty=1e-6).collect()}
    for (o, q, s, x, y) in rows[-4:]:
        assert abs(got[q] - y) < 0.05


def test_forest_rows(spark):
    rows = [("O", q, s, float(i % 5), 100.0 + i + (10 if s == "B" else 0))
            for s in ("A", "B") for i, q in enumerate(QS)]
    schema = "origin string, quarter string, series string, x double, rev double"
    train = spark.createDataFrame(rows[:20] + rows[24:44], schema)
    horizon = spark.createDataFrame(rows[20:24] + rows[44:48], schema).drop("rev")
    out = forest_forecast(train, horizon, "rev", ["x"], ["O"], num_trees=5)
    got = out.collect()
    assert len(got) == 8 and all(r.rev is not None for r in got)


def test_saved_coefficients_score_like_the_fit(spark, scratch):
    from panelcast.sources import store
    rows = [("2020Q1", q, s, float(i % 3), 10.0 + i * (2 if s == "A" else 1))
            for s in ("A", "B") for i, q in enumerate(QS)]
    schema = "origin string, quarter string, series string, x double, rev double"
    train = spark.createDataFrame([r for r in rows if r[1] < "2020Q1"], schema)
    horizon = spark.createDataFrame([r for r in rows if r[1] >= "2020Q1"], schema).drop("rev")
    path = f"{scratch}/coef"
    direct = ridge.additive_forecast(train, horizon, "rev", ["x"], artefacts=path)
    want = sorted(direct.collect())
    loaded = store.load_coefficients(spark, path, ridge.ADDITIVE, "rev", "2020Q1")
    again = sorted(ridge.additive_score(horizon, loaded, "rev", ["x"]).collect())
    assert want == again and len(want) == 8
    ar = ridge.ar_direct_forecast(train, horizon, "rev", ["x"], artefacts=f"{scratch}/ar")
    assert ar.count() == 8
    steps = {r.h for r in store.load_coefficients(spark, f"{scratch}/ar", ridge.AR_DIRECT,
                                                  "rev").collect()}
    assert steps == {1, 2, 3, 4}


def _panel(n_series=3, seed=0, quarters=QS):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(n_series):
        for i, q in enumerate(quarters):
            x = float(rng.normal())
            rows.append(("2019Q1", q, f"EU{s // 5}-D{s % 5}", x, 50.0 + 10 * s + 2.0 * x + i + SEASON[int(q[-1])]))
    return rows


PANEL_SCHEMA = "origin string, quarter string, series string, x double, rev double"


def test_reloaded_models_forecast_like_fresh_ones(spark, scratch):
    from panelcast.operators.models import forest
    from panelcast.sources import store
    rows = _panel()
    train = spark.createDataFrame([r for r in rows if r[1] < "2019Q1"], PANEL_SCHEMA)
    horizon = spark.createDataFrame([r for r in rows if r[1] >= "2019Q1"][:24], PANEL_SCHEMA).drop("rev")
    fresh = sorted(forest_forecast(train, horizon, "rev", ["x"], ["2019Q1"], num_trees=3,
                                   artefacts=f"{scratch}/rf").collect())
    enc, model = forest.load_forest(spark, f"{scratch}/rf", "rev", "2019Q1")
    assert model.getNumTrees == 3
    assert fresh == sorted(forest.score_forest(horizon, enc, model, "rev", ["x"]).collect())
    fresh = sorted(ridge.ar_direct_forecast(train, horizon, "rev", ["x"], artefacts=f"{scratch}/ar").collect())
    coefs = store.load_coefficients(spark, f"{scratch}/ar", ridge.AR_DIRECT, "rev", "2019Q1")
    assert fresh == sorted(ridge.ar_score(train, horizon, coefs, "rev", ["x"]).collect())


def test_forest_learns_a_function_and_no_later_row(spark):
    rows = _panel(4)
    train = spark.createDataFrame([r for r in rows if r[1] < "2019Q1"], PANEL_SCHEMA)
    horizon = spark.createDataFrame([r for r in rows if "2019Q1" <= r[1] < "2020Q1"], PANEL_SCHEMA)
    got = {(r.series, r.quarter): r.rev for r in
           forest_forecast(train, horizon.drop("rev"), "rev", ["x"], ["2019Q1"], num_trees=20).collect()}
    truth = {(r.series, r.quarter): r.rev for r in horizon.collect()}
    assert np.mean([abs(got[k] - truth[k]) for k in truth]) < 12
    # the same columns whatever the number of series, and no label is collected
    from panelcast.operators.models import forest
    many = spark.createDataFrame(_panel(600, quarters=QS[:3]), PANEL_SCHEMA)
    assert forest.design(many, forest.target_means(many, "rev")).columns == \
        forest.design(train, forest.target_means(train, "rev")).columns


def test_forecasts_scale_with_the_currency(spark):
    """All money times 1e6 gives forecasts times 1e6; trend and season stay live."""
    rows = [(*r[:3], 1e3 * r[3], r[4]) for r in _panel(2)]
    big = [(*r[:3], 1e6 * r[3], 1e6 * r[4]) for r in rows]
    for forecast in (ridge.additive_forecast, ridge.ar_direct_forecast):
        out = []
        for data in (rows, big):
            train = spark.createDataFrame([r for r in data if r[1] < "2019Q1"], PANEL_SCHEMA)
            horizon = spark.createDataFrame([r for r in data if "2019Q1" <= r[1] < "2020Q1"], PANEL_SCHEMA)
            out.append({(r.series, r.quarter): r.rev for r in forecast(train, horizon.drop("rev"), "rev", ["x"]).collect()})
        assert len(out[0]) == 8
        assert all(abs(out[1][k] / 1e6 - out[0][k]) < 0.006 for k in out[0])
    beta = ridge.solve_gram(_gram([[i, (i % 4) / 3, 1e9 * np.sin(i), 5.0 * i + (i % 4)] for i in range(24)]), 1e-6)
    assert beta[1] != 0 and beta[2] != 0


def _gram(rows):
    z = np.column_stack([np.ones(len(rows)), np.array(rows)])
    return z.T @ z


def test_step_is_the_distance_from_the_origin(spark):
    """A missing first horizon row doesn't shift the others, the horizon may be longer
    than four quarters, and a series without a model forecasts 0."""
    rows = _panel(2)
    train = spark.createDataFrame([r for r in rows if r[1] < "2019Q1"], PANEL_SCHEMA)
    horizon = [r for r in rows if "2019Q1" <= r[1] < "2020Q3"] + [("2019Q1", "2019Q1", "NEW-X", 1.0, 0.0)]
    run = lambda data: {(r.series, r.quarter): r.rev for r in ridge.ar_direct_forecast(
        train, spark.createDataFrame(data, PANEL_SCHEMA).drop("rev"), "rev", ["x"], steps=6).collect()}
    whole, gap = run(horizon), run([r for r in horizon if r[1] != "2019Q1"])
    assert all(v is not None for v in whole.values()) and whole[("NEW-X", "2019Q1")] == 0.0
    assert all(whole[k] == v for k, v in gap.items()) and len(gap) == 10


def test_lagged_regressors_read_nothing_after_the_origin(spark):
    rows = [(*r, float(i % 7)) for i, r in enumerate(_panel(2))]
    schema = PANEL_SCHEMA + ", z double"
    train = spark.createDataFrame([r for r in rows if r[1] < "2019Q1"], schema)
    later = [r for r in rows if "2019Q1" <= r[1] < "2020Q1"]
    run = lambda data: sorted(ridge.ar_direct_forecast(
        train, spark.createDataFrame(data, schema), "rev", ["x"], lagged=["z"]).collect())
    assert run(later) == run([(*r[:4], r[4] + 1e5, r[5] + 1e5) for r in later])
    samples, feats = ridge.ar_samples(train, "rev", ["x"], ["z"])
    by = {(r.series, r.quarter): r for r in train.collect()}
    for r in samples.where("h = 2").collect():
        if r.quarter >= "2017Q1":
            i = QS.index(r.quarter)
            assert [r[f"z_ar{k}"] for k in range(4)] == [by[r.series, QS[i - 2 - k]].z for k in range(4)]
            assert [r[f"rev_ar{k}"] for k in range(4)] == [by[r.series, QS[i - 2 - k]].rev for k in range(4)]
    assert feats == [f"rev_ar{k}" for k in range(4)] + [f"z_ar{k}" for k in range(4)] + ["x"]


def test_null_regressors_score_as_zero(spark):
    """A NULL horizon regressor counts as 0 in every family."""
    rows = _panel(2)
    train = spark.createDataFrame([r for r in rows if r[1] < "2019Q1"], PANEL_SCHEMA)
    later = [r for r in rows if "2019Q1" <= r[1] < "2020Q1"]
    null = spark.createDataFrame([(*r[:3], None, r[4]) for r in later], PANEL_SCHEMA).drop("rev")
    zero = spark.createDataFrame([(*r[:3], 0.0, r[4]) for r in later], PANEL_SCHEMA).drop("rev")
    for f in (ridge.additive_forecast, ridge.ar_direct_forecast,
              lambda *a: forest_forecast(*a, ["2019Q1"], num_trees=3)):
        assert sorted(f(train, null, "rev", ["x"]).collect()) == sorted(f(train, zero, "rev", ["x"]).collect())


def test_two_regressor_lists(spark):
    """M7: Worldwide series use their own list; the lists may be equal or overlap."""
    rng = np.random.default_rng(2)
    rows = []
    for s in ("Worldwide-X", "EU-X"):
        for i, q in enumerate(QS):
            a, b = float(rng.normal()), float(rng.normal())
            rows.append(("2021Q1", q, s, a, b, 5.0 + 3.0 * a + 2.0 * b))
    schema = "origin string, quarter string, series string, a double, b double, rev double"
    train = spark.createDataFrame(rows, schema)

    def coefs(regressors, worldwide):
        _, feats = ridge.additive_design(train, regressors, worldwide)
        return {r.series: dict(zip(feats, r.beta[1:])) for r in ridge.additive_fit(
            train, "rev", regressors, penalty=1e-9, worldwide=worldwide).collect()}

    plain, equal = coefs(["a", "b"], None), coefs(["a", "b"], ["a", "b"])
    assert plain == equal and abs(equal["EU-X"]["a"] - 3.0) < 1e-3
    over = coefs(["a", "b"], ["b"])
    assert over["Worldwide-X"]["a"] == 0.0 and abs(over["Worldwide-X"]["b"] - 2.0) < 1.5
    assert over["EU-X"] == plain["EU-X"]
    apart = coefs(["a"], ["b"])
    assert apart["EU-X"]["b"] == 0.0 and apart["Worldwide-X"]["a"] == 0.0
    assert abs(apart["EU-X"]["a"] - 3.0) < 1.5 and abs(apart["Worldwide-X"]["b"] - 2.0) < 1.5
    out = ridge.ar_direct_forecast(train, train.drop("rev"), "rev", ["a"], worldwide=["b"])
    assert out.count() == len(rows)


def test_normal_equations_notice_a_wrong_coefficient(spark):
    train = spark.createDataFrame(_panel(3), PANEL_SCHEMA)
    rows, feats = ridge.additive_design(train, ["x"])
    keys = ["origin", "series"]
    coefs = ridge.fit(rows, keys, feats, "rev")
    assert all(r.solved and r.n_rows == len(QS) and r.n_live == 5
               for r in ridge.normal_equations(rows, coefs, keys, feats, "rev").collect())
    from pyspark.sql import functions as F
    wrong = coefs.withColumn("beta", F.transform("beta", lambda b, i: F.when(i == 5, b * 1.01).otherwise(b)))
    assert not any(r.solved for r in ridge.normal_equations(rows, wrong, keys, feats, "rev").collect())
