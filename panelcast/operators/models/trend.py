"""Trend + quarter-of-year forecaster expressed as grouped sums.

Per (origin, series): least-squares line of the target on the quarter
index, plus the mean detrended residual of each quarter-of-year (0 where
that quarter-of-year has no history).

The fit needs only five sums per (origin, series, quarter-of-year):
``n, sum t, sum t^2, sum y, sum t*y``. They are computed *exactly* (integers
and DECIMAL cents). For a walk-forward run they are running sums over the quarters
of a series, kept once; an origin takes the last one before it, so no training row
is copied per origin and a further origin adds one row per (series, quarter-of-year).
The line and the seasonal means follow from a fixed sequence of double operations:

    b = (n*Sty - St*Sy) / (n*Stt - St^2)     (0 if the denominator is 0)
    a = (Sy - b*St) / n
    s_k = (Sy_k - n_k*a - b*St_k) / n_k

so the result does not depend on partitioning or summation order (a float
``regr_slope`` does, and near a rounding tie that flips the cents).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ...functions.calendar import quarter_index, quarter_number
from ...functions.numeric import round2

# Model labels of the two variants.
TREND = "TREND"
TREND_SEASONAL = "TREND_SEASONAL"

CENTS = "decimal(22,2)"


def _sums(targets: Sequence[str]) -> dict[str, F.Column]:
    out = {}
    for y in targets:
        seen = F.col(y).isNotNull()
        out |= {f"{y}_n": F.count(y),
                f"{y}_st": F.sum(F.when(seen, F.col("t"))),
                f"{y}_stt": F.sum(F.when(seen, F.col("t") * F.col("t"))),
                f"{y}_sy": F.sum(y),
                f"{y}_sty": F.sum(F.col("t") * F.col(y))}
    return out


def _rows(train: DataFrame, targets: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return train.select(*keys, "quarter", quarter_index("quarter").alias("t"), quarter_number("quarter").alias("qoy"),
                        *[F.col(y).cast(CENTS).alias(y) for y in targets])


def season_sums(train: DataFrame, targets: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Exact sums per (keys, qoy) for every target (NULL targets skipped)."""
    return _rows(train, targets, keys).groupBy(*keys, "qoy").agg(*[c.alias(k) for k, c in _sums(targets).items()])


def running_sums(train: DataFrame, targets: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The same sums up to and including every quarter, and the next quarter of the same
    quarter-of-year: ``keys, qoy, quarter, next, ...``. One row per training row; stored, they
    serve every later origin."""
    rows = _rows(train, targets, keys).repartition(*keys)  # the one exchange of the fit
    w = Window.partitionBy(*keys, "qoy").orderBy("quarter")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(*keys, "qoy", "quarter", F.lead("quarter").over(w).alias("next"),
                       *[c.over(upto).alias(k) for k, c in _sums(targets).items()])


def origin_sums(running: DataFrame, origins: Sequence[str]) -> DataFrame:
    """``origin, keys, qoy, ...``: for each origin the last running sums before it."""
    here = F.filter(F.array(*[F.lit(o) for o in origins]), lambda o: (o > F.col("quarter")) & (
        F.col("next").isNull() | (o <= F.col("next"))))
    return running.withColumn("origin", F.explode(here)).drop("quarter", "next")


def _d(c: str) -> F.Column:
    return F.col(c).cast("double")


def fit(train: DataFrame, targets: Sequence[str] = ("rev", "cm"), keys: Sequence[str] = ("origin", "series"),
        origins: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Line ``(keys, {y}_a, {y}_b)`` and seasonal means ``(keys, qoy, {y}_s)``. With
    ``origins`` the training rows come without one."""
    keys = list(keys)
    if origins is None:
        per_q = season_sums(train, targets, keys)
    else:
        per_q = origin_sums(running_sums(train, targets, [k for k in keys if k != "origin"]), origins)
    totals = per_q.groupBy(*keys).agg(*[F.sum(f"{y}_{s}").alias(f"{y}_{s}") for y in targets
                                        for s in ("n", "st", "stt", "sy", "sty")])
    line_cols = []
    for y in targets:
        n, st, stt, sy, sty = (_d(f"{y}_{s}") for s in ("n", "st", "stt", "sy", "sty"))
        den = n * stt - st * st
        b = F.when(den != 0, F.try_divide(n * sty - st * sy, den)).when(n > 0, F.lit(0.0))
        a = F.try_divide(sy - b * st, n)
        line_cols += [b.alias(f"{y}_b"), a.alias(f"{y}_a")]
    line = totals.select(*keys, *line_cols)
    season_cols = []
    for y in targets:
        n_k, st_k, sy_k = (_d(f"{y}_{s}") for s in ("n", "st", "sy"))
        s_k = F.try_divide(sy_k - n_k * F.col(f"{y}_a") - F.col(f"{y}_b") * st_k, n_k)
        season_cols.append(s_k.alias(f"{y}_s"))
    season = per_q.join(line, keys).select(*keys, "qoy", *season_cols)
    return line, season


def trend_forecast(train: DataFrame, horizon: DataFrame, targets: Sequence[str] = ("rev", "cm"),
                   seasonal_variants: Sequence[bool] = (True, False),
                   keys: Sequence[str] = ("origin", "series"), origins: Sequence[str] | None = None) -> DataFrame:
    """Score the horizon rows ``(keys, quarter)`` of every origin.

    One fit serves both variants: ``TREND`` uses the line only,
    ``TREND_SEASONAL`` adds the quarter-of-year mean. Output:
    ``(keys, quarter, <targets>, model)``; series without history get NULL.
    """
    keys = list(keys)
    line, season = fit(train, targets, keys, origins)
    h = (horizon.select(*keys, "quarter").distinct()
         .withColumns({"t": quarter_index("quarter"), "qoy": quarter_number("quarter")})
         .join(line, keys, "left")
         .join(season, keys + ["qoy"], "left"))
    out = None
    for seasonal in seasonal_variants:
        cols = []
        for y in targets:
            yhat = F.col(f"{y}_a") + F.col(f"{y}_b") * F.col("t")
            if seasonal:
                yhat = yhat + F.coalesce(F.col(f"{y}_s"), F.lit(0.0))
            cols.append(round2(yhat).alias(y))
        part = h.select(*keys, "quarter", *cols,
                        F.lit(TREND_SEASONAL if seasonal else TREND).alias("model"))
        out = part if out is None else out.unionByName(part)
    return out
