"""Feature frames: lag/lead features (W1-W3, W6), training frame (C3),
inference frames for one or many forecast origins (C4, M9) and recency
weights (W5).

Lags are *row based* within a series ordered by quarter (a missing quarter
does not create a NULL row). All 28 lag/lead columns share one window spec,
so Catalyst plans a single Window operator behind a single exchange.

Features are computed on the whole panel and the date filters applied after
the window (SURVEY 2.12-21): Spark does not push a filter on a non-partition
column below a window, so the edge values stay those of the reference.

Many origins in one job: instead of looping over forecast origins, the
panel is replicated once per origin with ``explode`` (no join, no shuffle)
and the window is partitioned by (origin, series). The replication factor
is the number of origins, a run parameter (4 in the reference).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.calendar import (add_months, literal_quarter_date, quarter_of, quarter_start,
                                  to_date)
from ..functions.numeric import complete_cases, fill_zero, round_numeric
from .panel import restrict_series

# Panel measure -> feature name.
RENAMES = {"weighted_fcst": "pipeline", "rig_ex_china": "rig_ex", "rig_all": "rig_all"}
# Feature prefix -> source column of the lagged/lead covariates.
COVARIATES = {"rig_ex": "rig_ex", "rig_all": "rig_all", "pipeline": "pipeline", "wti": "wti",
              "brent": "brent"}
LAGS = (1, 2, 3)
LEADS = (1, 2)
TARGET_LAGS = (1, 2, 3)
BASE_COLUMNS = ("quarter", "series", "pipeline", "rig_ex", "rig_all", "cm", "rev", "brent",
                "wti")


def rev_lag_names() -> list[str]:
    return [f"rev_lag{k}" for k in TARGET_LAGS]


def feature_names() -> list[str]:
    """The 28 lag/lead columns in a fixed order."""
    names = []
    for p in COVARIATES:
        names += [f"{p}_lag{k}" for k in LAGS] + [f"{p}_lead{k}" for k in LEADS]
    return names + rev_lag_names()


# The reference's model feature lists, in our column names.
REV_FEATURES = ["pipeline", "rig_ex", "brent", "wti",
                "rig_ex_lag1", "rig_ex_lag2", "rig_ex_lag3", "rig_ex_lead1", "rig_ex_lead2",
                "pipeline_lag1", "pipeline_lag2", "pipeline_lag3", "pipeline_lead1", "pipeline_lead2",
                "wti_lag1", "wti_lag2", "wti_lag3", "wti_lead1", "wti_lead2",
                "brent_lag1", "brent_lag2", "brent_lag3", "brent_lead1", "brent_lead2"]
CM_FEATURES = ["rev"] + REV_FEATURES + ["rev_lag1", "rev_lag2", "rev_lag3"]


def base_frame(keyed_panel: DataFrame, oil_q: DataFrame) -> DataFrame:
    """J1 + P5 + P6 + F5: keyed panel x quarterly oil (inner on quarter),
    renamed, division dropped, every measure rounded to cents.

    The oil table has one row per quarter, so the planner broadcasts it.
    """
    joined = keyed_panel.join(oil_q, "quarter", "inner")
    cols = [F.col(c).alias(RENAMES.get(c, c)) for c in
            ("quarter", "series", "weighted_fcst", "rig_ex_china", "rig_all", "cm", "rev",
             "brent", "wti")]
    return round_numeric(joined.select(*cols))


def lag_features(df: DataFrame, partition: Sequence[str] = ("series",),
                 oil_leads: bool = True) -> DataFrame:
    """Lags 1-3 and leads 1-2 of five covariates, lags 1-3 of revenue."""
    w = Window.partitionBy(*partition).orderBy("quarter")
    cols: dict[str, Column] = {}
    for prefix, src in COVARIATES.items():
        for k in LAGS:
            cols[f"{prefix}_lag{k}"] = F.lag(src, k).over(w)
        for k in LEADS:
            lead = F.lead(src, k).over(w)
            if not oil_leads and prefix in ("wti", "brent"):
                lead = F.lit(None).cast("double")
            cols[f"{prefix}_lead{k}"] = lead
    for k in TARGET_LAGS:
        cols[f"rev_lag{k}"] = F.lag("rev", k).over(w)
    return df.withColumns(cols)


def training_frame(keyed_panel: DataFrame, oil_q: DataFrame, start_date, interval: int,
                   as_of, series: Sequence[str] | None = None,
                   oil_leads: bool = True) -> DataFrame:
    """Features for every listed series, ``start <= quarter < end``, rev > 0.

    ``end`` is the quarter of ``as_of + 3*interval`` months (the reference
    uses today's date; ``as_of`` makes runs reproducible).
    """
    start_q = quarter_of(start_date)
    end_q = quarter_of(add_months(as_of, 3 * interval))
    frame = lag_features(restrict_series(base_frame(keyed_panel, oil_q), series),
                         oil_leads=oil_leads)
    return (frame.where((F.col("quarter") >= start_q) & (F.col("quarter") < end_q)
                        & (F.col("rev") > 0))
            .select(*BASE_COLUMNS, *feature_names()))


@dataclass(frozen=True)
class OriginWindow:
    """Quarter bounds of one forecast origin (C4 bounds, trap 19 widening)."""

    origin: str          # forecast start quarter
    mask_from: str       # actuals blanked from this quarter on
    buffer_start: str    # exclusive
    start: str           # exclusive
    end: str             # inclusive
    buffer_end: str      # exclusive

    @classmethod
    def build(cls, pickup, interval: int, mask_from=None) -> OriginWindow:
        p = to_date(pickup)
        return cls(origin=quarter_of(p),
                   mask_from=quarter_of(mask_from if mask_from is not None else p),
                   buffer_start=quarter_of(add_months(p, -12)),
                   start=quarter_of(add_months(p, -3)),
                   end=quarter_of(add_months(p, 3 * interval - 3)),
                   buffer_end=quarter_of(add_months(p, 3 * interval + 9)))

    @classmethod
    def stage2(cls, pickup, interval: int) -> OriginWindow:
        """Margin frame: window moved back a year and widened by four quarters,
        actuals still blanked from the true origin on."""
        from dataclasses import replace
        w = cls.build(add_months(pickup, -12), interval + 4, mask_from=pickup)
        return replace(w, origin=quarter_of(pickup))


def _origins_array(windows: Sequence[OriginWindow]) -> Column:
    return F.array(*[F.struct(*[F.lit(getattr(w, f)).alias(f) for f in
                                ("origin", "mask_from", "buffer_start", "start", "end",
                                 "buffer_end")])
                     for w in windows])


def inference_frames(keyed_panel: DataFrame, oil_q: DataFrame,
                     windows: Sequence[OriginWindow], series: Sequence[str] | None = None,
                     mask_actuals: bool = True, oil_leads: bool = True) -> DataFrame:
    """C4 for many origins in one job; output keyed by (origin, quarter, series).

    Per origin: actuals (cm, rev) are blanked from ``mask_from`` on *before*
    the lags when ``mask_actuals`` (so no revenue lag reads a post-origin
    actual; ``False`` reproduces the reference, whose blanking is a no-op),
    features computed, rows kept in ``buffer`` and ``start < quarter <= end``,
    then NULL -> 0 on every measure (N1).
    """
    base = restrict_series(base_frame(keyed_panel, oil_q), series)
    rep = (base.withColumn("_o", F.explode(_origins_array(windows)))
           .withColumn("origin", F.col("_o.origin")))
    if mask_actuals:
        visible = F.col("quarter") < F.col("_o.mask_from")
        rep = rep.withColumns({"cm": F.when(visible, F.col("cm")),
                               "rev": F.when(visible, F.col("rev"))})
    frame = lag_features(rep, partition=("origin", "series"), oil_leads=oil_leads)
    q = F.col("quarter")
    frame = frame.where((q > F.col("_o.buffer_start")) & (q < F.col("_o.buffer_end"))
                        & (q > F.col("_o.start")) & (q <= F.col("_o.end")))
    return fill_zero(frame.select("origin", *BASE_COLUMNS, *feature_names()))


def inference_frame(keyed_panel: DataFrame, oil_q: DataFrame, pickup, interval: int,
                    series: Sequence[str] | None = None, mask_actuals: bool = True,
                    mask_from=None, oil_leads: bool = True) -> DataFrame:
    """C4 for a single origin (reference signature)."""
    w = OriginWindow.build(pickup, interval, mask_from)
    return inference_frames(keyed_panel, oil_q, [w], series, mask_actuals,
                            oil_leads).drop("origin")


def training_sets(train: DataFrame, origins: Sequence[str]) -> DataFrame:
    """Training rows of every origin: ``quarter < origin`` (P10), one job."""
    return (train.withColumn("origin", F.explode(F.array(*[F.lit(o) for o in origins])))
            .where(F.col("quarter") < F.col("origin")))


# Weight by age in days (upper bound, exclusive), and of anything older.
RECENCY_TIERS = ((90, 1.0), (270, 0.9), (360, 0.8), (540, 0.7))
OLDEST_WEIGHT = 0.5


def recency_weighted(train: DataFrame, origins: Sequence[str], true_dates: bool = True) -> DataFrame:
    """The complete training rows of every origin with ``days_elapsed`` and ``weight``.

    The newest date is a scalar subquery per origin, neither a global window (which
    would pull every row into one task) nor a join on the origin (whose few values would).
    """
    to_date_ = quarter_start if true_dates else literal_quarter_date
    complete = complete_cases(train).withColumn("d", to_date_("quarter"))
    newest = F.coalesce(*[  # one scalar per origin: no join on a key of few values
        F.when(F.col("origin") == o,
               complete.where(F.col("quarter") < o).select(F.max("d")).scalar()) for o in origins])
    days = F.datediff(newest, F.col("d"))
    (first, top), *later = RECENCY_TIERS
    weight = F.when(days < first, top)
    for bound, w in later:
        weight = weight.when(days < bound, w)
    return training_sets(complete, origins).withColumns(
        {"days_elapsed": days, "weight": weight.otherwise(OLDEST_WEIGHT)}).drop("d")


def recency_weights(train: DataFrame, origins: Sequence[str], true_dates: bool = True
                    ) -> DataFrame:
    """W5 + F11: age of each complete training row relative to the newest row
    (over all series) before the origin, and its weight tier.

    ``true_dates=False`` reads ``YYYYQn`` as year and month n, as the
    reference does (F12).
    """
    return recency_weighted(train, origins, true_dates).select(
        "origin", "quarter", "series", "days_elapsed", "weight")


def pickup_dates(first_pickup, count: int, step_months: int = 3) -> list[_dt.date]:
    """M9: walk-forward pickup dates, ``step_months`` apart."""
    return [add_months(first_pickup, step_months * k) for k in range(count)]
