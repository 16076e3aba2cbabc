"""Margin-stage inference frames (C5, C6): W4, N3, N4, J5, J6, U2, P15.

The second stage forecasts margin from revenue, so its revenue lags must
be rebuilt from the first stage's *predicted* revenue where the history
ends: per (origin, series) the actual revenue before the origin is unioned
with the predicted revenue from the origin on, lagged again, and those
lags replace the frame's own (zero-filled, hence NULLed again) lags.

C5 (``how='inner'``) keeps frame rows that have a prediction; C6
(``how='right'``) keeps every frame row and then drops any row with a NULL.
Both run for all origins at once; the window is partitioned by
(origin, series).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numeric import complete_cases, round_numeric, zero_to_null
from .features import TARGET_LAGS, rev_lag_names


def margin_inference(frame: DataFrame, rev_forecast: DataFrame, how: str = "inner") -> DataFrame:
    """``frame``: stage-2 inference frames keyed by (origin, quarter, series);
    ``rev_forecast``: (origin, quarter, series, rev) predicted for quarters
    at or after the origin. Returns the frame with predicted ``rev`` and
    forecast-extended revenue lags.
    """
    if how not in ("inner", "right"):
        raise ValueError(how)
    keys = ["origin", "quarter", "series"]
    own = zero_to_null(frame, rev_lag_names()).drop("rev")                       # N3
    history = frame.where(F.col("quarter") < F.col("origin")).select(*keys, "rev")  # P10
    chained = rev_forecast.select(*keys, "rev").unionByName(history)           # U2
    w = Window.partitionBy("origin", "series").orderBy("quarter")
    extended = (chained
                .withColumns({f"rev_lag{k}_new": F.lag("rev", k).over(w) for k in TARGET_LAGS})
                .where(F.col("quarter") >= F.col("origin")))                   # W4 + P15
    joined = extended.join(own, keys, how)                                      # J5 / J6
    joined = joined.withColumns({f"rev_lag{k}": F.coalesce(f"rev_lag{k}_new", f"rev_lag{k}")
                                 for k in TARGET_LAGS})                        # N4
    joined = joined.drop(*[f"rev_lag{k}_new" for k in TARGET_LAGS])
    out = joined.select(*keys, "rev", *[c for c in own.columns if c not in keys])
    if how == "right":
        out = complete_cases(out)                                               # N5
    return round_numeric(out)
