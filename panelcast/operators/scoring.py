"""Ground truth (C7) and forecast scoring into refresh snapshots.

A snapshot for refresh r holds the new forecasts made at r plus the rows
carried from the previous snapshot with ``quarter < r`` (SURVEY 2.12-13),
each re-scored against the actuals known at r. Unrolled over a
walk-forward run with ascending refreshes r_0 < ... < r_n and an empty
store, the rows carried into r_k are exactly the forecasts made at r_j
(j < k) for quarters before r_{j+1}. That lets every refresh be built in
one job: a forecast row is emitted once for its own refresh and, if it is
for a quarter before the next refresh, once per later refresh via
``explode`` (bounded by the number of refreshes, no join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_label
from ..functions.numeric import pct_error, round_numeric

FORECAST_COLUMNS = ("quarter", "series", "cm", "rev", "model")
SNAPSHOT_COLUMNS = ("quarter", "series", "cm", "rev", "model", "actual_contribution_margin",
                    "actual_revenue", "contribution_margin_error", "revenue_error", "YM",
                    "refresh_date", "level")


def ground_truth(train: DataFrame, origin: str | None = None) -> DataFrame:
    """Distinct complete (quarter, series, cm, rev) before the origin."""
    rows = train if origin is None else train.where(F.col("quarter") < origin)
    return (rows.select("quarter", "series", F.col("cm").alias("actual_contribution_margin"),
                        F.col("rev").alias("actual_revenue"))
            .distinct().dropna())


def refresh_rows(forecasts: DataFrame, refreshes: Sequence[str],
                 history: DataFrame | None = None) -> DataFrame:
    """Rows of every refresh snapshot before scoring.

    ``forecasts``: (origin, quarter, series, cm, rev, model), origin being
    one of ``refreshes``. ``history``: optional rows of an existing store
    snapshot (quarter, series, cm, rev, model) taken before ``refreshes[0]``.
    """
    refreshes = sorted(refreshes)
    arr = F.array(*[F.lit(r) for r in refreshes])
    n = len(refreshes)
    pos = F.array_position(arr, F.col("origin")).cast("int")  # 1-based
    nxt = F.element_at(arr, pos + 1) if n > 1 else F.lit(None).cast("string")
    # forecasts of an origin outside ``refreshes`` belong to no snapshot of this run
    base = forecasts.select("origin", *FORECAST_COLUMNS).where(pos > 0)
    own = base.withColumn("refresh_date", F.col("origin"))
    carried = (base.where((pos < n) & (F.col("quarter") < nxt))
               .withColumn("refresh_date", F.explode(F.slice(arr, pos + 1, F.lit(n) - pos))))
    rows = own.unionByName(carried).drop("origin")
    if history is not None:
        old = (history.select(*FORECAST_COLUMNS).where(F.col("quarter") < refreshes[0])
               .withColumn("refresh_date", F.explode(arr)))
        rows = old.unionByName(rows)
    return rows


def score(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """Attach actuals known at the refresh, errors, labels; dedupe.

    ``truth`` is the ground truth of the whole training frame; an actual is
    visible at refresh r only for quarters before r (P10).
    """
    visible = F.col("quarter") < F.col("refresh_date")
    scored = (rows.join(truth, ["quarter", "series"], "left")
              .withColumns({
                  "actual_contribution_margin":
                      F.when(visible, F.col("actual_contribution_margin")),
                  "actual_revenue": F.when(visible, F.col("actual_revenue"))}))
    scored = scored.withColumns({
        "contribution_margin_error": pct_error("cm", "actual_contribution_margin"),
        "revenue_error": pct_error("rev", "actual_revenue"),
        "YM": month_label("quarter"),
        "refresh_date": F.replace(F.col("refresh_date"), F.lit(" "), F.lit("")),
        "level": F.col("series"),
    })
    return round_numeric(scored.select(*SNAPSHOT_COLUMNS)).dropDuplicates()


def score_forecasts(forecasts: DataFrame, truth: DataFrame, refreshes: Sequence[str],
                    history: DataFrame | None = None) -> DataFrame:
    """Every refresh snapshot of a walk-forward run, in one job."""
    return score(refresh_rows(forecasts, refreshes, history), truth)
