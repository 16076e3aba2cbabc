"""End-to-end walk-forward run: the reference's driver, as one Spark job.

The reference runs its whole program once per forecast origin, each run
reading the previous snapshot back from the database. Here every origin is
computed in one job and the snapshot recursion is unrolled (see
``operators/scoring.py``); only the history *before the first origin* is
read from an existing store. Snapshots, best-model rows and models are staged under the
run's id and published together (:mod:`..sources.runs`): a run that is lost leaves the
former state, and rerunning origins replaces them as a whole. Forecasts are scored from
the stored models, and intermediates are deleted at the end; ``exports`` also writes the
stage outputs as CSV.

    python -m panelcast.plans.walk_forward --tables /data/sf1 --store /data/store
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.models.forest import FOREST
from ..operators.scoring import ground_truth, score_forecasts
from ..operators.selection import best_model
from ..operators.stage2 import margin_inference
from ..session import cut_lineage, scratch_run, set_defaults
from ..sources import runs, store
from ..sources.monthly import Extracts
from ..sources.tables import Tables
from . import backtest as bt
from .families import FAMILIES, all_forecasts
from .params import RunParams


def run_walk_forward(spark: SparkSession, tables_dir: str | None, params: RunParams = RunParams(),
                     store_dir: str | None = None, families=FAMILIES, with_trend: bool = True,
                     monthly: Extracts | None = None, exports: str | None = None
                     ) -> tuple[DataFrame, DataFrame]:
    """Forecast, score and select for every origin; optionally append to a store.

    Inputs are the star schema in ``tables_dir`` or the ``monthly`` extracts.
    Returns ``(snapshots, best)`` of this run's origins: read from the store if there
    is one, else materialised in the checkpoint folder.
    """
    if store_dir is None:
        return _run(spark, tables_dir, params, None, None, families, with_trend, monthly, exports)
    run = runs.new_run()
    with scratch_run(spark):
        snaps, best = _run(spark, tables_dir, params, store_dir, run, families, with_trend, monthly, exports)
        runs.stage(snaps.select(*store.SNAPSHOT_SCHEMA.names), store_dir, "snapshots", run)
        runs.stage(best.select(*store.BEST_SCHEMA.names), store_dir, "best", run)
        runs.publish(spark, store_dir, run, params.origins)
    return (store.read_snapshots(spark, f"{store_dir}/snapshots", params.origins),
            store.read_best(spark, f"{store_dir}/best", params.origins))


def _run(spark, tables_dir, params, store_dir, run, families, with_trend, monthly, exports):
    tables = None if tables_dir is None else Tables(spark, tables_dir)
    inp = bt.PanelInputs(tables, checkpoint=True, monthly=monthly)
    models = None if store_dir is None else f"{store_dir}/models/run={run}"
    forecasts = cut_lineage(all_forecasts(inp, params, families, with_trend, models))
    history = None
    if store_dir is not None:
        history = store.history_before(spark, f"{store_dir}/snapshots", params.origins[0])
    truth = ground_truth(bt.training(inp, params))
    snaps = cut_lineage(score_forecasts(forecasts, truth, params.origins, history))
    best = cut_lineage(best_model(snaps, params.lookback_months, params.series))
    if exports is not None:  # K4: the stage outputs of the run
        for name, df, sort_by in (("training", bt.training(inp, params), ["series", "quarter"]),
                                  ("ground_truth", truth, ["series", "quarter"]),
                                  ("inference", bt.stage1_frames(inp, params), ["origin", "series", "quarter"]),
                                  ("margin_inference", _margin_frames(inp, params, forecasts),
                                   ["model", "origin", "series", "quarter"]),
                                  ("best", best, ["refresh_date", "series", "quarter"]),
                                  ("forecasts", forecasts, ["origin", "series", "quarter", "model"])):
            store.export_csv(df, f"{exports}/{name}", sort_by)
    return snaps, best


def _margin_frames(inp: bt.PanelInputs, params: RunParams, forecasts: DataFrame) -> DataFrame:
    """The stage-2 frames of every family: margin inference fed with its own revenue forecast."""
    stage2, out = bt.stage2_frames(inp, params), None
    for label in sorted(r.model for r in forecasts.select("model").distinct().collect()):
        rev = forecasts.where(F.col("model") == label).select("origin", "quarter", "series", "rev")
        how = "inner" if label == FOREST else "right"
        part = margin_inference(stage2, rev, how).withColumn("model", F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--tables", required=True, help="folder with the parquet tables")
    ap.add_argument("--store", help="snapshot store folder (appended idempotently)")
    ap.add_argument("--first-pickup", default=RunParams.first_pickup)
    ap.add_argument("--origins", type=int, default=RunParams.n_origins)
    ap.add_argument("--as-of", default=RunParams.as_of)
    ap.add_argument("--export", help="folder for the stage outputs as CSV")
    ap.add_argument("--trend-only", action="store_true",
                    help="only the SQL-checkable trend family (fast)")
    a = ap.parse_args(argv)
    spark = set_defaults(SparkSession.builder)
    params = replace(RunParams(), first_pickup=a.first_pickup, n_origins=a.origins,
                     as_of=a.as_of)
    snaps, best = run_walk_forward(spark, a.tables, params, a.store,
                                   families=() if a.trend_only else FAMILIES, exports=a.export)
    print(f"snapshot rows: {snaps.count()}, best-model rows: {best.count()}")


if __name__ == "__main__":
    main()
