from panelcast.operators.scoring import ground_truth, refresh_rows, score, score_forecasts
from panelcast.operators.selection import best_model, model_errors, winners

FC_SCHEMA = "origin string, quarter string, series string, cm double, rev double, model string"
TRUTH = [("2021Q1", "S", 10.0, 100.0), ("2021Q2", "S", 0.0, 110.0),
         ("2021Q3", "S", 12.0, 120.0), ("2021Q4", "S", 13.0, 130.0)]
REFRESHES = ["2021Q1", "2021Q2", "2021Q3"]


def forecasts():
    rows = []
    for o in REFRESHES:
        for q in ("2021Q1", "2021Q2", "2021Q3", "2021Q4", "2022Q1"):
            if q >= o:
                for m, bias in (("M1", 1.1), ("M2", 0.9)):
                    rows.append((o, q, "S", 11.0 * bias, 105.0 * bias, m))
    return rows


def sequential_reference(fc_rows, truth_rows):
    """The reference's loop: each refresh carries the newest snapshot's rows
    before the refresh quarter, appends its forecasts and re-scores."""
    truth = {(q, s): (cm, rev) for q, s, cm, rev in truth_rows}
    store = []
    for r in REFRESHES:
        latest = [x for x in store if x[-1] == max((y[-1] for y in store), default=None)]
        hist = [x[:5] for x in latest if x[0] < r]
        new = [(q, s, cm, rev, m) for o, q, s, cm, rev, m in fc_rows if o == r]
        for q, s, cm, rev, m in set(hist + new):
            acm, arev = truth.get((q, s), (None, None)) if q < r else (None, None)
            store.append((q, s, cm, rev, m, acm, arev, r))
    return store


def test_snapshots_match_sequential_refreshes(spark):
    fc = spark.createDataFrame(forecasts(), FC_SCHEMA)
    truth = spark.createDataFrame(TRUTH, "quarter string, series string, cm double, rev double")
    got = score_forecasts(fc, ground_truth(truth), REFRESHES)
    want = sequential_reference(forecasts(), TRUTH)
    got_rows = sorted(((r.quarter, r.series, round(r.cm, 2), round(r.rev, 2), r.model,
                       r.actual_contribution_margin, r.actual_revenue, r.refresh_date)
                       for r in got.collect()), key=repr)
    want_rows = sorted(((q, s, round(cm, 2), round(rev, 2), m, acm, arev, rf)
                        for q, s, cm, rev, m, acm, arev, rf in want), key=repr)
    assert got_rows == want_rows
    # one row per (quarter, series, model) in every snapshot
    keys = [(r.refresh_date, r.quarter, r.series, r.model) for r in got.collect()]
    assert len(keys) == len(set(keys))


def test_errors_labels_and_zero_actual(spark):
    fc = spark.createDataFrame(forecasts(), FC_SCHEMA)
    truth = spark.createDataFrame(TRUTH, "quarter string, series string, cm double, rev double")
    snap = {(r.refresh_date, r.quarter, r.model): r
            for r in score_forecasts(fc, ground_truth(truth), REFRESHES).collect()}
    r = snap[("2021Q3", "2021Q1", "M1")]
    assert r.revenue_error == 16.0   # rint((115.5 - 100) / 100 * 100)
    assert r.YM == "Jan'21" and r.level == "S"
    assert snap[("2021Q3", "2021Q2", "M1")].contribution_margin_error is None  # zero actual
    assert snap[("2021Q3", "2021Q3", "M1")].actual_revenue is None  # not yet known


def test_best_model_ties_go_to_first_name(spark):
    snap = spark.createDataFrame([
        ("2021Q1", "S", 10.0, 100.0, "B", 10.0, 100.0, 5.0, -5.0, "Jan'21", "2021Q2", "S"),
        ("2021Q1", "S", 10.0, 100.0, "A", 10.0, 100.0, -5.0, 5.0, "Jan'21", "2021Q2", "S"),
        ("2021Q1", "S", 10.0, 100.0, "C", 10.0, 100.0, 1.0, 9.0, "Jan'21", "2021Q2", "S"),
        ("2021Q2", "S", 11.0, 101.0, "A", None, None, None, None, "Apr'21", "2021Q2", "S"),
        ("2021Q2", "S", 12.0, 102.0, "C", None, None, None, None, "Apr'21", "2021Q2", "S"),
        ("2021Q1", "T", 9.0, 90.0, "A", None, None, None, None, "Jan'21", "2021Q2", "T"),
    ], "quarter string, series string, cm double, rev double, model string, "
       "actual_contribution_margin double, actual_revenue double, "
       "contribution_margin_error double, revenue_error double, YM string, "
       "refresh_date string, level string")
    w = {r.series: r for r in winners(model_errors(snap)).collect()}
    assert w["S"].rev_Model == "A"    # |5| ties A and B -> A
    assert w["S"].cm_Model == "C"
    assert "T" not in w               # no errors -> no winner -> absent
    best = {r.quarter: r for r in best_model(snap).collect()}
    assert best["2021Q2"].rev == 101.0 and best["2021Q2"].cm == 12.0
    fixed = {r.quarter: r for r in best_model(snap, rows_from="C").collect()}
    assert fixed["2021Q1"].rev_Model == "A" and fixed["2021Q1"].rev == 100.0


def test_history_rows_are_carried(spark):
    fc = spark.createDataFrame(forecasts(), FC_SCHEMA).where("origin = '2021Q2'")
    hist = spark.createDataFrame([("2020Q4", "S", 1.0, 2.0, "OLD")],
                                 "quarter string, series string, cm double, rev double, "
                                 "model string")
    rows = refresh_rows(fc, ["2021Q2"], hist)
    assert rows.where("model = 'OLD'").count() == 1
    truth = spark.createDataFrame(TRUTH, "quarter string, series string, cm double, rev double")
    assert score(rows, ground_truth(truth)).count() == rows.count()


def test_forecasts_of_other_origins_are_ignored(spark):
    fc = spark.createDataFrame(forecasts() + [("2020Q4", "2021Q1", "S", 1.0, 1.0, "M1")],
                               FC_SCHEMA)
    rows = refresh_rows(fc, REFRESHES)
    assert rows.where("cm = 1.0").count() == 0
    clean = refresh_rows(spark.createDataFrame(forecasts(), FC_SCHEMA), REFRESHES)
    assert rows.count() == clean.count()
