from panelcast.operators import features as feat

from fixtures import two_series_panel


def by_key(df):
    return {(r.quarter, r.series): r for r in df.collect()}


def test_training_frame_row_based_lags_and_filters(spark):
    panel, oil = two_series_panel(spark)
    tr = feat.training_frame(panel, oil, "2021-01-01", 4, "2021-06-01")
    got = by_key(tr)
    # end = quarter of as_of + 12 months = 2022Q2 (exclusive)
    assert max(q for q, _ in got) == "2022Q1"
    # B misses 2021Q3: lag 1 at 2021Q4 is the previous *row* (2021Q2)
    b = got[("2021Q4", "B-N/A")]
    assert b.rig_ex_lag1 == 301.0 and b.rig_ex_lag2 == 300.0 and b.rig_ex_lag3 is None
    assert b.rig_ex_lead1 == 304.0
    assert got[("2021Q1", "A-D1")].rev_lag1 is None
    assert set(tr.columns) == set(feat.BASE_COLUMNS) | set(feat.feature_names())
    assert len(feat.feature_names()) == 28


def test_lead_is_inverse_of_lag(spark):
    panel, oil = two_series_panel(spark)
    tr = feat.training_frame(panel, oil, "2020-01-01", 4, "2021-06-01")
    rows = sorted(tr.collect(), key=lambda r: (r.series, r.quarter))
    for a, b in zip(rows, rows[1:]):
        if a.series == b.series:
            assert a.pipeline_lead1 == b.pipeline and b.pipeline_lag1 == a.pipeline
            assert b.rev_lag1 == a.rev


def test_rounding_to_cents_half_even(spark):
    panel, oil = two_series_panel(spark)
    panel = panel.withColumn("weighted_fcst", panel.weighted_fcst * 0 + 0.575)
    tr = feat.training_frame(panel, oil, "2021-01-01", 4, "2021-06-01")
    assert {r.pipeline for r in tr.collect()} == {0.57}


def test_inference_frame_masks_actuals_before_lags(spark):
    panel, oil = two_series_panel(spark)
    masked = by_key(feat.inference_frame(panel, oil, "2022-01-01", 2))
    raw = by_key(feat.inference_frame(panel, oil, "2022-01-01", 2, mask_actuals=False))
    assert sorted(q for q, _ in masked) == ["2022Q1", "2022Q1", "2022Q2", "2022Q2"]
    m, r = masked[("2022Q2", "A-D1")], raw[("2022Q2", "A-D1")]
    assert (m.rev, m.cm, m.rev_lag1) == (0.0, 0.0, 0.0)  # blanked, then zero-filled
    assert r.rev_lag1 == 54.0 and m.rev_lag2 == r.rev_lag2 == 53.0
    # no feature at or after the origin reads a target at or after it
    for (q, _), row in masked.items():
        assert row.rev_lag1 == 0.0 or q == "2022Q1"


def test_many_origins_equal_single_origin_runs(spark):
    panel, oil = two_series_panel(spark)
    windows = [feat.OriginWindow.build(p, 2) for p in ("2021-10-01", "2022-01-01")]
    multi = feat.inference_frames(panel, oil, windows)
    for w, pickup in zip(windows, ("2021-10-01", "2022-01-01")):
        one = feat.inference_frame(panel, oil, pickup, 2)
        part = multi.where(multi.origin == w.origin).drop("origin")
        assert sorted(part.collect()) == sorted(one.collect())


def test_stage2_window_keeps_true_origin():
    w = feat.OriginWindow.stage2("2022-02-01", 4)
    assert (w.origin, w.mask_from, w.buffer_start, w.start, w.end, w.buffer_end) == \
        ("2022Q1", "2022Q1", "2020Q1", "2020Q4", "2022Q4", "2023Q4")
    s1 = feat.OriginWindow.build("2022-02-01", 4)
    assert (s1.buffer_start, s1.start, s1.end, s1.buffer_end) == \
        ("2021Q1", "2021Q4", "2022Q4", "2023Q4")


def test_recency_weights(spark):
    from fixtures import PANEL_SCHEMA
    qs = [f"{y}Q{q}" for y in (2020, 2021, 2022) for q in (1, 2, 3, 4)]
    panel = spark.createDataFrame([(q, "A-D1", 1.0 + i, 2.0, 3.0, 4.0, 5.0 + i)
                                   for i, q in enumerate(qs)], PANEL_SCHEMA)
    oil = spark.createDataFrame([(q, 1.0, 2.0) for q in qs],
                                "quarter string, brent double, wti double")
    tr = feat.training_frame(panel, oil, "2020-01-01", 4, "2022-06-01")
    w = {r.quarter: r for r in feat.recency_weights(tr, ["2022Q2"]).collect()}
    # complete rows only: three lags and two leads exist from 2020Q4 to 2022Q2
    assert sorted(w) == ["2020Q4", "2021Q1", "2021Q2", "2021Q3", "2021Q4", "2022Q1"]
    assert (w["2022Q1"].days_elapsed, w["2022Q1"].weight) == (0, 1.0)
    assert (w["2021Q4"].days_elapsed, w["2021Q4"].weight) == (92, 0.9)
    assert w["2021Q1"].weight == 0.7 and w["2020Q4"].weight == 0.7
    lit = {r.quarter: r for r in
           feat.recency_weights(tr, ["2022Q2"], true_dates=False).collect()}
    # literal reading: 2021Q3 -> 2021-03-01, 2021Q4 -> 2021-04-01, 2022Q1 -> 2022-01-01
    assert lit["2021Q4"].days_elapsed - lit["2022Q1"].days_elapsed == 275
    assert lit["2021Q3"].days_elapsed - lit["2021Q4"].days_elapsed == 31
