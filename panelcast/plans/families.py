"""Two-stage forecasts of the feature-based model families (M1-M8) for every
origin of a walk-forward run, and the full backtest over all families.

Stage 1 forecasts revenue on the stage-1 frames. Stage 2 rebuilds the
revenue lags from those predictions (C5 for the forest, C6 for the ridge
families, as in the reference) and forecasts margin with revenue and
revenue lags as features; the margin models are trained on actual revenue
(trap 22). The two stages are then joined (J9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators.models import ridge
from ..operators.models.forest import FOREST, forest_forecast
from ..operators.panel import restrict_series
from ..operators.stage2 import margin_inference
from ..session import cut_lineage
from . import backtest as bt
from .params import RunParams

FAMILIES = (FOREST, ridge.ADDITIVE, ridge.AR_DIRECT)
# Fixed value: the lagged regressors of the autoregressive margin model.
AR_LAGGED = ["rev", "rev_lag1", "rev_lag2", "rev_lag3"]


def _stage(family: str, train: DataFrame, frames: DataFrame, target: str, features,
           p: RunParams, lagged=(), artefacts: str | None = None) -> DataFrame:
    if family == FOREST:
        to = artefacts and f"{artefacts}/forest"
        return forest_forecast(train, frames, target, features, p.origins,
                               max_depth=p.forest_depth, artefacts=to, recency=p.recency)
    to = artefacts and f"{artefacts}/coefficients"
    if family == ridge.ADDITIVE:
        return ridge.additive_forecast(train, frames, target, features, worldwide=p.worldwide_features, artefacts=to,
                                       origins=p.origins, terms=p.additive, recency=p.recency)
    if family == ridge.AR_DIRECT:
        return ridge.ar_direct_forecast(train, frames, target, features, steps=p.interval,
                                        worldwide=p.worldwide_features, lagged=lagged, artefacts=to,
                                        origins=p.origins, recency=p.recency)
    raise ValueError(family)


def two_stage(inp: bt.PanelInputs, p: RunParams, family: str, artefacts: str | None = None
              ) -> DataFrame:
    """Revenue then margin forecasts of one family: (origin, quarter, series,
    rev, cm, model). The revenue forecast and the stage-2 frames are
    materialised (they feed the margin fit, the scoring and the final join)."""
    return inp.kept(("two_stage", p, family), lambda: _two_stage(inp, p, family, artefacts))


def _two_stage(inp: bt.PanelInputs, p: RunParams, family: str, artefacts: str | None) -> DataFrame:
    models = lambda df: restrict_series(df, p.model_series)  # noqa: E731  before any fit
    train, stage1, stage2 = (models(df) for df in (bt.training(inp, p), bt.stage1_frames(inp, p),
                                                   bt.stage2_frames(inp, p)))
    keep = cut_lineage if inp.checkpoint else (lambda d: d)
    lagged = AR_LAGGED if family == ridge.AR_DIRECT else ()
    cm_features = feat.REV_FEATURES if lagged else feat.CM_FEATURES
    rev = keep(_stage(family, train, stage1, "rev", feat.REV_FEATURES, p, artefacts=artefacts))
    how = "inner" if family == FOREST else "right"
    frames2 = keep(margin_inference(stage2, rev, how))
    cm = _stage(family, train, frames2, "cm", cm_features, p, lagged, artefacts)
    return bt.combine_stage_forecasts(rev, cm).withColumn("model", F.lit(family))


def all_forecasts(inp: bt.PanelInputs, p: RunParams, families=FAMILIES,
                  with_trend: bool = True, artefacts: str | None = None) -> DataFrame:
    out = bt.trend_forecasts(inp, p) if with_trend else None
    for fam in families:
        f = two_stage(inp, p, fam, artefacts).select("origin", "quarter", "series", "rev", "cm", "model")
        out = f if out is None else out.unionByName(f)
    return out
