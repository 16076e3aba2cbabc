"""Composite plans: panel inputs, walk-forward backtest (M9), scoring and
selection, all origins in one job.

``PanelInputs`` is the only part that reads tables: the star schema, or the four
monthly extracts of :mod:`panelcast.sources.monthly`. With
``checkpoint=True`` every small intermediate that several branches read is
written once to the session's shared checkpoint folder (``kept``): the
sales fact (the one pass over lineitem and orders), the keyed panel, the
quarterly oil prices, the training frame, the stage-1 and stage-2 frames of
all origins, the forecasts and the snapshots. Later branches then read a
few thousand rows instead of re-running the plan that produced them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators.models.trend import trend_forecast
from ..operators.panel import assemble_panel, keyed_panel, oil_quarterly, restrict_series
from ..operators.scoring import ground_truth, score_forecasts  # noqa: F401 (re-export)
from ..operators.selection import best_model
from ..operators.stage2 import margin_inference
from ..session import cut_lineage
from ..sources import business as biz
from ..sources.monthly import Extracts
from ..sources.tables import Tables
from .params import RunParams


class PanelInputs:
    """Extracts, panel and quarterly oil prices, built from the driver tables or from
    given monthly extracts (``monthly``)."""

    def __init__(self, tables: Tables | None = None, checkpoint: bool = False,
                 monthly: Extracts | None = None):
        if (tables is None) == (monthly is None):
            raise ValueError("give tables or monthly extracts")
        self.tables = tables
        self.monthly = monthly
        self.checkpoint = checkpoint
        self._kept: dict[tuple, DataFrame] = {}

    def kept(self, key: tuple, make) -> DataFrame:
        """``make()`` once per key; materialised when checkpointing is on.

        Used for the small intermediates that several branches read (the
        training frame, per-origin frames, forecasts, snapshots), so one run
        computes each of them once.
        """
        if key not in self._kept:
            df = make()
            self._kept[key] = cut_lineage(df) if self.checkpoint else df
        return self._kept[key]

    @cached_property
    def fact(self) -> DataFrame:
        """The one pass over lineitem and orders; both the weighted forecast
        and the actuals read it, so it is materialised once when checkpointing."""
        fact = biz.sales_fact(self.tables)
        return cut_lineage(fact) if self.checkpoint else fact

    @cached_property
    def cells(self) -> DataFrame:
        """The other pass over orders: rig counts and oil prices read it."""
        cells = biz.order_cells(self.tables)
        return cut_lineage(cells) if self.checkpoint else cells

    @cached_property
    def weighted(self) -> DataFrame:
        return self.monthly.weighted if self.monthly else biz.weighted_monthly(self.fact)

    @cached_property
    def actuals(self) -> DataFrame:
        return self.monthly.actuals if self.monthly else biz.actuals_monthly(self.fact)

    @cached_property
    def rig(self) -> DataFrame:
        return self.monthly.rig if self.monthly else biz.rig_counts(self.cells)

    @cached_property
    def oil(self) -> DataFrame:
        return self.monthly.oil if self.monthly else biz.oil_prices(self.cells)

    @cached_property
    def panel(self) -> DataFrame:
        return assemble_panel(self.weighted, self.rig, self.actuals)

    @cached_property
    def keyed(self) -> DataFrame:
        out = self.monthly.eliminations if self.monthly else biz.ELIMINATIONS_BASIN
        keyed = keyed_panel(self.panel, out)
        return cut_lineage(keyed) if self.checkpoint else keyed

    @cached_property
    def oil_q(self) -> DataFrame:
        oil_q = oil_quarterly(self.oil)
        return cut_lineage(oil_q) if self.checkpoint else oil_q


def training(inp: PanelInputs, p: RunParams) -> DataFrame:
    return inp.kept(("training", p), lambda: feat.training_frame(
        inp.keyed, inp.oil_q, p.start_date, p.interval, p.as_of, p.series, p.oil_leads))


def training_sets(inp: PanelInputs, p: RunParams) -> DataFrame:
    """Training rows of every origin (quarter < origin), one copy per origin. The fits
    don't use it: they take the training frame once and sum per quarter (M9)."""
    return feat.training_sets(training(inp, p), p.origins)


def stage1_frames(inp: PanelInputs, p: RunParams) -> DataFrame:
    return inp.kept(("stage1", p), lambda: feat.inference_frames(
        inp.keyed, inp.oil_q, p.windows, p.series, p.mask_actuals, p.oil_leads))


def stage2_frames(inp: PanelInputs, p: RunParams) -> DataFrame:
    return inp.kept(("stage2", p), lambda: feat.inference_frames(
        inp.keyed, inp.oil_q, p.stage2_windows, p.series, p.mask_actuals, p.oil_leads))


def trend_forecasts(inp: PanelInputs, p: RunParams, seasonal_variants=(True, False)
                    ) -> DataFrame:
    """M10 forecasts of revenue and margin for every origin: (origin, quarter,
    series, rev, cm, model)."""
    variants = tuple(seasonal_variants)
    return inp.kept(("trend", p, variants), lambda: trend_forecast(
        restrict_series(training(inp, p), p.model_series),
        restrict_series(stage1_frames(inp, p), p.model_series).select("origin", "quarter", "series"),
        seasonal_variants=variants, origins=p.origins))


def margin_frames(inp: PanelInputs, p: RunParams, how: str = "inner") -> DataFrame:
    """C5/C6 fed with the seasonal-trend revenue forecast of every origin."""
    rev = trend_forecasts(inp, p, seasonal_variants=(True,)).select(
        "origin", "quarter", "series", "rev")
    return margin_inference(stage2_frames(inp, p), rev, how)


def snapshots(inp: PanelInputs, p: RunParams, forecasts: DataFrame | None = None
              ) -> DataFrame:
    """C8 for every refresh of the walk-forward run."""
    if forecasts is None:
        return inp.kept(("snapshots", p), lambda: snapshots(inp, p, trend_forecasts(inp, p)))
    return score_forecasts(forecasts, ground_truth(training(inp, p)), p.origins)


def best_models(inp: PanelInputs, p: RunParams, rows_from: str | None = None,
                forecasts: DataFrame | None = None) -> DataFrame:
    """C9/C10 for every refresh. The snapshot feeds three branches (errors,
    revenue rows, margin rows), so it is checkpointed once when the inputs are."""
    snap = snapshots(inp, p, forecasts)
    if forecasts is not None and inp.checkpoint:
        snap = cut_lineage(snap)
    return best_model(snap, p.lookback_months, p.series, rows_from)


def combine_stage_forecasts(rev_forecast: DataFrame, cm_forecast: DataFrame) -> DataFrame:
    """Margin forecast x distinct revenue forecast, inner on (origin, quarter, series)."""
    keys = ["origin", "quarter", "series"]
    return (cm_forecast.select(*keys, "cm")
            .join(rev_forecast.select(*keys, "rev").dropDuplicates(), keys, "inner"))


def additive_frame(train: DataFrame, oil_q: DataFrame) -> DataFrame:
    """Distinct (quarter, series, measures) left-joined to quarterly oil."""
    return (train.select("quarter", "series", "pipeline", "rig_ex", "rig_all", "cm", "rev")
            .dropDuplicates()
            .join(oil_q.select("quarter", F.col("brent").alias("oil_brent"),
                               F.col("wti").alias("oil_wti")), "quarter", "left"))
