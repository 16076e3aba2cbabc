from panelcast.operators import panel as P

from fixtures import frames


def rows(df, *cols):
    return {tuple(r[c] for c in cols): r for r in df.collect()}


def test_weighted_quarterly_worldwide_includes_eliminations(spark):
    w, _, _ = frames(spark)
    got = rows(P.weighted_quarterly(w), "quarter", "basin", "division")
    assert got[("2021Q1", "B1", "D1")].weighted_fcst == 0.15
    assert got[("2021Q1", "ELIM", "D1")].weighted_fcst == -0.03
    assert abs(got[("2021Q1", "Worldwide", "D1")].weighted_fcst - 0.12) < 1e-12
    assert got[("2021Q1", "B1", "N/A")].weighted_fcst == 0.575
    # a group whose measures are all NULL sums to 0 (pandas), not NULL
    assert got[("2021Q2", "B1", "D1")].weighted_fcst == 0.0
    # NULL group keys are dropped, not kept as a NULL group
    assert all(k[1] is not None for k in got)


def test_rig_quarterly_is_sum_of_basin_means(spark):
    _, r, _ = frames(spark)
    got = rows(P.rig_quarterly(r), "quarter", "basin")
    aml = got[("2021Q1", "B1")]
    assert (aml.rig_ex_china, aml.rig_all) == (15.0, 30.0)
    elim = got[("2021Q1", "ELIM")]
    assert elim.has_ex is None or elim.has_ex is False
    ww = got[("2021Q1", "Worldwide")]
    assert (ww.rig_ex_china, ww.rig_all) == (15.0, 35.0)


def test_assemble_panel_join_order(spark):
    w, r, a = frames(spark)
    panel = P.assemble_panel(w, r, a)
    got = rows(panel, "quarter", "basin", "division")
    # ELIM has no EXCL rig count: its covariate row is dropped by the inner join,
    # but its actuals survive the full outer join with NULL covariates
    elim = got[("2021Q1", "ELIM", "D1")]
    assert elim.weighted_fcst is None and elim.rev == -10.0
    # actuals without any pipeline row survive
    assert got[("2021Q1", "BRZ", "OTH")].rev == 5.0
    # zero margin actual is kept as 0, not NULL
    assert got[("2021Q2", "B1", "D1")].cm == 0.0
    ww = got[("2021Q1", "Worldwide", "D1")]
    assert ww.rev == 90.0  # includes the eliminations basin
    keyed = rows(P.keyed_panel(panel, eliminations="ELIM"), "quarter", "series")
    assert ("2021Q1", "ELIM-D1") not in keyed
    assert ("2021Q1", "B1-N/A") in keyed
    assert keyed[("2021Q1", "Worldwide-D1")].rev == 90.0


def test_restrict_series(spark):
    w, r, a = frames(spark)
    keyed = P.keyed_panel(P.assemble_panel(w, r, a), eliminations="ELIM")
    got = {x.series for x in P.restrict_series(keyed, ["B1-D1"]).collect()}
    assert got == {"B1-D1"}
