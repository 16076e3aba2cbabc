"""Property checks on the real driver tables and on generated values."""
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.functions.numeric import pct_error, round2
from panelcast.plans import backtest as bt
from panelcast.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_worldwide_is_sum_of_basins(spark):
    inp = bt.PanelInputs(Tables(spark, SF))
    from panelcast.operators.panel import weighted_quarterly
    q = weighted_quarterly(inp.weighted)
    world = q.where(F.col("basin") == "Worldwide").select(
        "quarter", "division", F.col("weighted_fcst").alias("w"))
    basins = (q.where(F.col("basin") != "Worldwide").groupBy("quarter", "division")
              .agg(F.sum("weighted_fcst").alias("s")))
    rows = world.join(basins, ["quarter", "division"], "full").collect()
    assert rows and all(r.w is not None and r.s is not None and abs(r.w - r.s) < 1e-6
                        for r in rows)


def test_panel_is_unique_per_quarter_and_series(spark):
    inp = bt.PanelInputs(Tables(spark, SF))
    keyed = inp.keyed
    assert keyed.count() == keyed.select("quarter", "series").distinct().count()
    assert keyed.where(F.col("basin") == "AFRICA").count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-1e7, max_value=1e7, allow_nan=False), min_size=50,
                max_size=200))
def test_round2_matches_numpy(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(round2("x")).collect()]
    assert got == [float(np.round(x, 2)) for x in xs]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(1, 1e6), st.floats(1, 1e6)), min_size=20, max_size=80))
def test_pct_error_matches_reference_formula(spark, pairs):
    df = spark.createDataFrame(pairs, "p double, a double")
    got = [r[0] for r in df.select(pct_error("p", "a")).collect()]
    want = [float(np.round(np.round((p - a) / a, 2) * 100, 2)) for p, a in pairs]
    assert got == want
