from dataclasses import replace

import pytest

from panelcast.plans.params import RunParams
from panelcast.plans.walk_forward import run_walk_forward
from panelcast.sources import runs, store

SF = "/root/testdata/sf0.001"


def test_walk_forward_store_is_idempotent_and_carries_history(spark, scratch):
    first = replace(RunParams(), n_origins=2)
    snaps, best = run_walk_forward(spark, SF, first, scratch, families=())
    n1 = store.read_snapshots(spark, f"{scratch}/snapshots").count()
    assert n1 == snaps.count() > 0 and best.count() > 0
    run_walk_forward(spark, SF, first, scratch, families=())          # rerun: no duplicates
    assert store.read_snapshots(spark, f"{scratch}/snapshots").count() == n1
    # a later run starts from the newest stored snapshot (history before its origin)
    later = replace(RunParams(), first_pickup="2000-08-01", n_origins=2)
    snaps2, _ = run_walk_forward(spark, SF, later, scratch, families=())
    carried = snaps2.where("refresh_date = '2000Q3' AND quarter < '2000Q3'")
    assert carried.count() > 0
    all_rows = store.read_snapshots(spark, f"{scratch}/snapshots")
    assert {r.refresh_date for r in all_rows.select("refresh_date").distinct().collect()} == \
        {"2000Q1", "2000Q2", "2000Q3", "2000Q4"}
    keys = all_rows.select("refresh_date", "quarter", "series", "model")
    assert keys.count() == keys.distinct().count()


def test_command_line_run(spark, scratch, capsys):
    from panelcast.plans.walk_forward import main
    main(["--tables", SF, "--store", scratch, "--origins", "1", "--trend-only"])
    out = capsys.readouterr().out
    assert "snapshot rows:" in out and "best-model rows:" in out
    assert store.read_snapshots(spark, f"{scratch}/snapshots").count() > 0


def test_models_exports_and_rerun_with_fewer_families(spark, scratch):
    """A stored run leaves its models and exports, and a rerun with fewer families
    leaves none of the dropped family's rows."""
    from pathlib import Path

    from panelcast.operators.models import ridge
    one = replace(RunParams(), n_origins=1, model_series=("Worldwide-BUILDING", "Worldwide-MACHINERY"))
    snaps, _ = run_walk_forward(spark, SF, one, scratch, families=(ridge.ADDITIVE, ridge.AR_DIRECT),
                                exports=f"{scratch}/csv")
    assert {r.model for r in snaps.select("model").distinct().collect()} >= {ridge.ADDITIVE, ridge.AR_DIRECT}
    assert {r.series for r in snaps.select("series").distinct().collect()} == set(one.model_series)
    for family, steps in ((ridge.ADDITIVE, {None}), (ridge.AR_DIRECT, {1, 2, 3, 4})):
        at = runs.models_path(spark, scratch, one.origins[0])
        coefs = store.load_coefficients(spark, f"{at}/coefficients", family, "cm")
        assert {r.h for r in coefs.collect()} == steps
    assert {p.name for p in Path(f"{scratch}/csv").iterdir()} == {
        "training", "ground_truth", "inference", "margin_inference", "forecasts", "best"}
    margin = spark.read.option("header", True).csv(f"{scratch}/csv/margin_inference")
    assert {ridge.ADDITIVE, ridge.AR_DIRECT} <= {r.model for r in margin.select("model").distinct().collect()}
    assert {"rev", "rev_lag1", "pipeline"} <= set(margin.columns)
    best = spark.read.option("header", True).csv(f"{scratch}/csv/best")
    assert best.count() == store.read_best(spark, f"{scratch}/best").count()
    truth = spark.read.option("header", True).csv(f"{scratch}/csv/ground_truth")
    assert truth.count() > 0 and "actual_revenue" in truth.columns
    again, _ = run_walk_forward(spark, SF, one, scratch, families=(ridge.ADDITIVE,), with_trend=False)
    assert {r.model for r in again.select("model").distinct().collect()} == {ridge.ADDITIVE}


def test_a_run_lost_before_its_publication_leaves_the_old_state(spark, scratch, monkeypatch):
    one = replace(RunParams(), n_origins=1)
    run_walk_forward(spark, SF, one, scratch, families=())
    state = lambda: (sorted(store.read_snapshots(spark, f"{scratch}/snapshots").collect(), key=repr),
                     sorted(store.read_best(spark, f"{scratch}/best").collect(), key=repr), runs.manifest(spark, scratch))
    before, stage = state(), runs.stage

    def lost(df, store_dir, table, run):
        if table == "best":  # after the snapshots were written
            raise RuntimeError("lost")
        stage(df, store_dir, table, run)

    monkeypatch.setattr(runs, "stage", lost)
    other = replace(one, lookback_months=6, model_series=("Worldwide-BUILDING",))
    with pytest.raises(RuntimeError, match="lost"):
        run_walk_forward(spark, SF, other, scratch, families=())
    assert state() == before
    monkeypatch.setattr(runs, "stage", stage)
    run_walk_forward(spark, SF, other, scratch, families=())
    after = state()
    assert after[2] != before[2] and {r.series for r in after[0]} == {"Worldwide-BUILDING"}
