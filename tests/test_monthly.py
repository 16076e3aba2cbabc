"""The four monthly tables written out and read back give the same panel and run."""
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from panelcast.plans import backtest as bt
from panelcast.plans.params import RunParams
from panelcast.plans.walk_forward import run_walk_forward
from panelcast.sources import monthly
from panelcast.sources.tables import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return bt.PanelInputs(Tables(spark, SF), checkpoint=True)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_same_panel_from_extracts(spark, star, tmp_path, fmt):
    monthly.write_monthly(monthly.Extracts(star.weighted, star.rig, star.actuals, star.oil), str(tmp_path), fmt)
    again = bt.PanelInputs(monthly=monthly.read_monthly(spark, str(tmp_path), fmt))
    columns = star.panel.columns
    assert sorted(again.panel.select(columns).collect(), key=repr) == sorted(star.panel.collect(), key=repr)
    prices = lambda inp: {(r.quarter, k): r[k] for r in inp.oil_q.collect() for k in ("brent", "wti")}
    assert prices(again) == pytest.approx(prices(star))


def test_run_from_extracts(spark, star, tmp_path):
    one = replace(RunParams(), n_origins=1)
    extracts = monthly.Extracts(star.weighted, star.rig, star.actuals, star.oil)
    a, _ = run_walk_forward(spark, SF, one, families=())
    b, _ = run_walk_forward(spark, None, one, families=(), monthly=extracts)
    assert sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr) != []
    with pytest.raises(ValueError):
        bt.PanelInputs()


def test_source_names_scenarios_and_nan(spark):
    rig = spark.createDataFrame(
        [("2020-01-15", "B1", float("nan"), "RIG COUNT"), ("2020-02", "B1", 4.0, "RIG COUNT WITHOUT CHINA")],
        "MONTH string, `BASIN (CODE)` string, TOTAL double, SCENARIO string")
    got = monthly.shaped(rig, "rig", {"year_month": "MONTH", "basin": "BASIN (CODE)", "rig_total": "TOTAL",
                                      "scenario": "SCENARIO"}).collect()
    assert [(r.year_month, r.basin, r.rig_total, r.scenario, r.environment) for r in got] == [
        ("2020-01", "B1", None, "ALL", None), ("2020-02", "B1", 4.0, "EXCL", None)]
    text = spark.createDataFrame([("2020-01", "B1", "N/A", "NaN"), ("2020-01", "B1", "D1", " 2.5 ")],
                                 "year_month string, basin string, division string, weighted_fcst string")
    out = monthly.shaped(text, "weighted").collect()
    assert [r.division for r in out] == ["N/A", "D1"]
    assert [None if r.weighted_fcst is None else float(r.weighted_fcst) for r in out] == [None, 2.5]
    assert monthly.shaped(text.withColumn("x", F.lit(1)), "weighted").columns == list(monthly.COLUMNS["weighted"])
