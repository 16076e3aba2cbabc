"""Registered queries: one callable per operator group of SURVEY 2.13.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables. Shared intermediates (panel, frames, forecasts) are written to the
checkpoint folder when a query first needs them, so calling a query runs them; what
is returned is the last, lazy step. Column names and types match the DuckDB oracle in
:mod:`panelcast.plans.oracle` (STRING / BIGINT / DOUBLE only; floating
means rounded to cents like the panel itself, F5).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_numeric, to_double
from ..operators import features as feat
from ..operators.models.trend import TREND, TREND_SEASONAL
from ..operators.panel import WORLDWIDE, actuals_quarterly, rig_quarterly, weighted_quarterly
from ..operators.scoring import ground_truth
from ..operators.selection import (earliest_snapshot, inspect_models, latest_snapshot,
                                   model_errors, winners)
from ..sources import business as biz
from ..session import cut_lineage
from ..sources.bucketed import bucketed
from ..sources.tables import Tables
from . import backtest as bt
from .params import RunParams

PARAMS = RunParams()
# The divisions of the driver tables (c_mktsegment), used to
# list the Worldwide series for the series-membership query.
DIVISIONS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
WORLDWIDE_SERIES = tuple(f"{WORLDWIDE}-{d}" for d in DIVISIONS)
TWO_SERIES = (f"{WORLDWIDE}-BUILDING", "ASIA-MACHINERY")


_INPUTS: dict[tuple, bt.PanelInputs] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Length and modification time of the files of the tables the panel reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for f in path.getFileSystem(conf).listStatus(path):
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def _inputs(spark: SparkSession, sf_dir: str) -> bt.PanelInputs:
    """Panel inputs of a table folder, checkpointed once per application and state of
    its files: queries share one panel, and changed files get a new one."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    if key not in _INPUTS:
        for old in [k for k in _INPUTS if k[0] != key[0] or k[1] == sf_dir]:
            del _INPUTS[old]
        _INPUTS[key] = bt.PanelInputs(Tables(spark, sf_dir), checkpoint=True)
    return _INPUTS[key]


def weighted_fcst_monthly(spark, sf_dir):
    """S1 alone: its own pass, with the order date range in the scan."""
    fact = biz.sales_fact(Tables(spark, sf_dir), orders_from=biz.WEIGHTED_FROM)
    return to_double(biz.weighted_monthly(fact))


def actuals_bucketed(spark, sf_dir):
    """S3 over orders and lineitem bucketed by order key: the lines are not exchanged."""
    with bucketed(Tables(spark, sf_dir)) as t:
        fact = cut_lineage(biz.sales_fact(t))
    return actuals_quarterly(biz.actuals_monthly(fact))


def quarterly_with_worldwide(spark, sf_dir):
    return weighted_quarterly(_inputs(spark, sf_dir).weighted)


def rig_mean_worldwide(spark, sf_dir):
    rig = rig_quarterly(_inputs(spark, sf_dir).rig)
    return round_numeric(rig.select("quarter", "basin", "rig_ex_china", "rig_all"))


def actuals_by_scenario(spark, sf_dir):
    return actuals_quarterly(_inputs(spark, sf_dir).actuals)


def oil_quarterly(spark, sf_dir):
    return round_numeric(_inputs(spark, sf_dir).oil_q)


def assemble_panel(spark, sf_dir):
    return round_numeric(_inputs(spark, sf_dir).keyed)


def training_frame(spark, sf_dir):
    return bt.training(_inputs(spark, sf_dir), PARAMS)


def worldwide_training_frame(spark, sf_dir):
    return bt.training(_inputs(spark, sf_dir), replace(PARAMS, series=WORLDWIDE_SERIES))


def inference_frame(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return feat.inference_frame(inp.keyed, inp.oil_q, PARAMS.pickups[0], PARAMS.interval)


def inference_frame_unmasked(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return feat.inference_frame(inp.keyed, inp.oil_q, PARAMS.pickups[0], PARAMS.interval,
                                mask_actuals=False)


def walk_forward_frames(spark, sf_dir):
    return bt.stage1_frames(_inputs(spark, sf_dir), PARAMS)


def _recency(spark, sf_dir, true_dates):
    train = bt.training(_inputs(spark, sf_dir), PARAMS)
    out = feat.recency_weights(train, PARAMS.origins, true_dates)
    return out.withColumn("days_elapsed", F.col("days_elapsed").cast("bigint"))


def recency_weights(spark, sf_dir):
    return _recency(spark, sf_dir, True)


def recency_weights_literal(spark, sf_dir):
    return _recency(spark, sf_dir, False)


def trend_seasonal_forecast(spark, sf_dir):
    return bt.trend_forecasts(_inputs(spark, sf_dir), PARAMS)


def margin_inference_inner(spark, sf_dir):
    return bt.margin_frames(_inputs(spark, sf_dir), PARAMS, "inner")


def margin_inference_right(spark, sf_dir):
    return bt.margin_frames(_inputs(spark, sf_dir), PARAMS, "right")


def ground_truth_q(spark, sf_dir):
    train = bt.training(_inputs(spark, sf_dir), PARAMS)
    return ground_truth(train, PARAMS.origins[0])


def score_forecasts(spark, sf_dir):
    return bt.snapshots(_inputs(spark, sf_dir), PARAMS)


def latest_snapshot_q(spark, sf_dir):
    return latest_snapshot(bt.snapshots(_inputs(spark, sf_dir), PARAMS))


def earliest_snapshot_q(spark, sf_dir):
    return earliest_snapshot(bt.snapshots(_inputs(spark, sf_dir), PARAMS))


def model_errors_q(spark, sf_dir):
    return model_errors(bt.snapshots(_inputs(spark, sf_dir), PARAMS), PARAMS.lookback_months)


def model_errors_short_window(spark, sf_dir):
    """P16 variant: evaluation window of four months before the refresh."""
    return model_errors(bt.snapshots(_inputs(spark, sf_dir), PARAMS), 4)


def winning_models(spark, sf_dir):
    """A9 + J10: best revenue model and best margin model per series and refresh."""
    snap = bt.snapshots(_inputs(spark, sf_dir), PARAMS)
    return winners(model_errors(snap, PARAMS.lookback_months))


def best_model(spark, sf_dir):
    return bt.best_models(_inputs(spark, sf_dir), PARAMS)


def best_model_fixed_family(spark, sf_dir):
    return bt.best_models(_inputs(spark, sf_dir), PARAMS, rows_from=TREND)


def additive_frame(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    out = bt.additive_frame(bt.training(inp, PARAMS), inp.oil_q)
    return round_numeric(out.withColumnsRenamed({"oil_brent": "brent", "oil_wti": "wti"}))


def combine_stage_forecasts(spark, sf_dir):
    """J9 over two different forecasts: margin of the line, revenue of the seasonal model."""
    fc = bt.trend_forecasts(_inputs(spark, sf_dir), PARAMS)
    return bt.combine_stage_forecasts(fc.where(F.col("model") == TREND_SEASONAL),
                                      fc.where(F.col("model") == TREND))


def listed_trend_forecast(spark, sf_dir):
    """P14 on the model side: models fitted for the listed (Worldwide) series only."""
    return bt.trend_forecasts(_inputs(spark, sf_dir), replace(PARAMS, model_series=WORLDWIDE_SERIES))


def two_series_forecast(spark, sf_dir):
    """Features for all series, models for two."""
    return bt.trend_forecasts(_inputs(spark, sf_dir), replace(PARAMS, model_series=TWO_SERIES))


def inspect_models_q(spark, sf_dir):
    """P20: one series under two model labels."""
    return inspect_models(bt.snapshots(_inputs(spark, sf_dir), PARAMS), TWO_SERIES[0],
                          [TREND, TREND_SEASONAL])


SQL_CHECKED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "weighted_fcst_monthly": weighted_fcst_monthly,
    "quarterly_with_worldwide": quarterly_with_worldwide,
    "rig_mean_worldwide": rig_mean_worldwide,
    "actuals_by_scenario": actuals_by_scenario,
    "actuals_bucketed": actuals_bucketed,
    "oil_quarterly": oil_quarterly,
    "assemble_panel": assemble_panel,
    "training_frame": training_frame,
    "worldwide_training_frame": worldwide_training_frame,
    "inference_frame": inference_frame,
    "inference_frame_unmasked": inference_frame_unmasked,
    "walk_forward_frames": walk_forward_frames,
    "recency_weights": recency_weights,
    "recency_weights_literal": recency_weights_literal,
    "trend_seasonal_forecast": trend_seasonal_forecast,
    "listed_trend_forecast": listed_trend_forecast,
    "margin_inference_inner": margin_inference_inner,
    "margin_inference_right": margin_inference_right,
    "ground_truth": ground_truth_q,
    "score_forecasts": score_forecasts,
    "latest_snapshot": latest_snapshot_q,
    "earliest_snapshot": earliest_snapshot_q,
    "model_errors": model_errors_q,
    "model_errors_short_window": model_errors_short_window,
    "winning_models": winning_models,
    "best_model": best_model,
    "best_model_fixed_family": best_model_fixed_family,
    "additive_frame": additive_frame,
    "combine_stage_forecasts": combine_stage_forecasts,
    "two_series_forecast": two_series_forecast,
    "inspect_models": inspect_models_q,
}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from .model_queries import MODEL_QUERIES
    return SQL_CHECKED | MODEL_QUERIES
