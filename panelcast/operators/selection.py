"""Best model per series (C9, C10): P16, F7, A8, N6, A9, P17, J8, J10.

All refreshes are handled at once: every key carries ``refresh_date``.
The winners table has one row per (series, refresh), so the joins of the
snapshot with it are planned as broadcast joins when it is small and as
shuffle joins otherwise; no driver loop over series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import quarter_number, quarter_year
from .panel import restrict_series

BEST_COLUMNS = ("quarter", "series", "rev", "actual_revenue", "revenue_error", "YM",
                "refresh_date", "level", "rev_Model", "cm", "actual_contribution_margin",
                "contribution_margin_error", "cm_Model")


def _month_index(label) -> F.Column:
    return quarter_year(label) * 12 + (quarter_number(label) - 1) * 3


def evaluation_rows(snapshot: DataFrame, lookback_months: int = 12) -> DataFrame:
    """Rows of each refresh r with ``quarter(r - lookback) < quarter < r``."""
    cutoff_q = F.floor((_month_index("refresh_date") - lookback_months) / 3)
    q_idx = F.floor(_month_index("quarter") / 3)
    return snapshot.where((q_idx > cutoff_q) & (F.col("quarter") < F.col("refresh_date")))


def model_errors(snapshot: DataFrame, lookback_months: int = 12) -> DataFrame:
    """F7 + A8 + N6: mean absolute % errors per (series, model, refresh)."""
    return (evaluation_rows(snapshot, lookback_months)
            .groupBy("series", "model", "refresh_date")
            .agg(F.avg(F.abs("revenue_error")).alias("abs_rev_error"),
                 F.avg(F.abs("contribution_margin_error")).alias("abs_cm_error"))
            .dropna(subset=["abs_rev_error", "abs_cm_error"]))


def winners(errors: DataFrame) -> DataFrame:
    """A9 + J10: arg-min model per series for revenue and, independently, margin.

    Ties go to the alphabetically first model (the reference's grouped
    index is sorted): minimise the struct (error, model).
    """
    return (errors.groupBy("series", "refresh_date")
            .agg(F.min_by("model", F.struct("abs_rev_error", "model")).alias("rev_Model"),
                 F.min_by("model", F.struct("abs_cm_error", "model")).alias("cm_Model")))


def best_model(snapshot: DataFrame, lookback_months: int = 12,
               series: Sequence[str] | None = None, rows_from: str | None = None) -> DataFrame:
    """C9 (``rows_from=None``) / C10 (rows always from one family, label of the winner).

    Output: every snapshot row of the winning model (all quarters of the
    refresh, P17) with revenue columns, left-joined (J8) with the margin
    columns of the margin winner. Series without a winner are absent.
    """
    snap = restrict_series(snapshot, series)
    win = winners(model_errors(snap, lookback_months))
    keys = ["series", "refresh_date"]

    def rows_of(label: str, cols: Sequence[str]) -> DataFrame:
        w = win.select(*keys, label)
        if rows_from is None:
            picked = snap.join(w.withColumn("model", F.col(label)), keys + ["model"])
        else:
            picked = snap.where(F.col("model") == rows_from).join(w, keys)
        return picked.select(*cols, label).dropDuplicates()

    rev = rows_of("rev_Model", ["quarter", "series", "rev", "actual_revenue", "revenue_error",
                                "YM", "refresh_date", "level"])
    cm = rows_of("cm_Model", ["quarter", "series", "refresh_date", "cm",
                              "actual_contribution_margin", "contribution_margin_error"])
    return rev.join(cm, ["quarter", "series", "refresh_date"], "left").select(*BEST_COLUMNS)


def inspect_models(snapshot: DataFrame, series: str, models: Sequence[str]) -> DataFrame:
    """P20: the rows of one series for a few model labels, side by side."""
    return snapshot.where((F.col("series") == series) & F.col("model").isin(list(models)))


def latest_snapshot(store: DataFrame) -> DataFrame:
    """S5 + A10: rows of the newest refresh (a scalar subquery, not a join on one value)."""
    return store.where(F.col("refresh_date") == store.select(F.max("refresh_date")).scalar())


def earliest_snapshot(store: DataFrame) -> DataFrame:
    """Rows of the oldest refresh."""
    return store.where(F.col("refresh_date") == store.select(F.min("refresh_date")).scalar())
