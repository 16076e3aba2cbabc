"""Quarterly panel assembly (C1), oil by quarter (C2), keyed panel.

Rules kept from the reference (SURVEY 2.12):

* rows whose group keys are NULL are dropped before any grouping (pandas
  drops NULL groups, Spark keeps them);
* a group that exists but whose measures are all NULL sums to 0, a group
  that does not exist yields no row (no zero-filled phantom rows);
* the Worldwide total is built *before* eliminations are excluded, so it
  includes the eliminations basin;
* pipeline x rig counts is an inner join, actuals are then full-outer
  joined, so actuals without a pipeline row survive with NULL covariates.

Everything here works on month x basin x division aggregates, whose size
does not grow with the fact tables; the shuffles are on a few thousand rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_key_to_date, quarter_label
from ..sources import business as biz

# Fixed value: label of the all-basin total.
WORLDWIDE = "Worldwide"

PANEL_COLUMNS = ("quarter", "basin", "division", "weighted_fcst", "rig_ex_china", "rig_all",
                 "cm", "rev")


def _quarter(df: DataFrame) -> DataFrame:
    """``yyyy-MM`` month key -> ``YYYYQn`` quarter label."""
    return df.withColumn("quarter", quarter_label(month_key_to_date("year_month")))


def _present_sum(value, flag) -> F.Column:
    """Sum that is 0 for an all-NULL group and NULL only for an absent one."""
    return F.when(F.max(flag), F.coalesce(F.sum(value), F.lit(0)))


def _worldwide_basin() -> F.Column:
    return F.when(F.grouping("basin") == 1, F.lit(WORLDWIDE)).otherwise(F.col("basin"))


def weighted_quarterly(weighted: DataFrame) -> DataFrame:
    """A2 + A3 + U1 + P7: quarterly weighted forecast with Worldwide rows, / 1000.

    One GROUPING SETS aggregate replaces sum-by-basin, sum-by-division and
    the union of the two.
    """
    src = _quarter(weighted).where(
        F.col("basin").isNotNull() & F.col("division").isNotNull() & F.col("quarter").isNotNull())
    agg = (src.groupingSets([["quarter", "division", "basin"], ["quarter", "division"]],
                            "quarter", "division", "basin")
           .agg(F.coalesce(F.sum("weighted_fcst"), F.lit(0)).alias("weighted_fcst"),
                _worldwide_basin().alias("basin_label")))
    return agg.select("quarter", F.col("basin_label").alias("basin"), "division",
                      (F.col("weighted_fcst").cast("double") / 1000).alias("weighted_fcst"))


def rig_quarterly(rig: DataFrame, excl_scenario: str = biz.RIG_EXCL,
                  all_scenario: str = biz.RIG_ALL) -> DataFrame:
    """A4 + A5 + P2: quarterly mean rig total per basin and scenario, plus Worldwide.

    Worldwide is the *sum of the basin means* (two different aggregates).
    Both levels come from one GROUPING SETS pass over the basin means: the
    (quarter, basin) set holds one row per group and keeps the mean as is
    (NULL stays NULL), the (quarter) set sums the basins that have the
    scenario (0 if all their means are NULL). No self-union, so the rig
    extract is scanned once. Presence flags let the inner join of J2 drop
    (quarter, basin) cells that miss either scenario.
    """
    src = _quarter(rig).where(F.col("basin").isNotNull() & F.col("quarter").isNotNull()
                              & F.col("scenario").isNotNull())
    is_ex = F.col("scenario") == excl_scenario
    is_all = F.col("scenario") == all_scenario
    basin = (src.groupBy("quarter", "basin")
             .agg(F.avg(F.when(is_ex, F.col("rig_total"))).alias("rig_ex_china"),
                  F.max(is_ex).alias("has_ex"),
                  F.avg(F.when(is_all, F.col("rig_total"))).alias("rig_all"),
                  F.max(is_all).alias("has_all")))
    world = F.grouping("basin") == 1

    def level(value: str, flag: str) -> F.Column:
        total = _present_sum(F.when(F.col(flag), F.col(value)), flag)
        return F.when(world, total).otherwise(F.max(value))

    agg = (basin.groupingSets([["quarter", "basin"], ["quarter"]], "quarter", "basin")
           .agg(level("rig_ex_china", "has_ex").alias("rig_ex_china"),
                F.max("has_ex").alias("has_ex"),
                level("rig_all", "has_all").alias("rig_all"),
                F.max("has_all").alias("has_all"),
                _worldwide_basin().alias("basin_label")))
    return agg.select("quarter", F.col("basin_label").alias("basin"), "rig_ex_china",
                      "has_ex", "rig_all", "has_all")


def actuals_quarterly(actuals: DataFrame, cm_scenario: str = biz.ACTUALS_CM,
                      rev_scenario: str = biz.ACTUALS_REV) -> DataFrame:
    """A6 + P2 + A3: quarterly margin and revenue per cell, plus Worldwide rows."""
    src = _quarter(actuals).where(F.col("basin").isNotNull() & F.col("division").isNotNull()
                                  & F.col("quarter").isNotNull() & F.col("scenario").isNotNull())
    is_cm = F.col("scenario") == cm_scenario
    is_rev = F.col("scenario") == rev_scenario
    agg = (src.groupingSets([["quarter", "division", "basin"], ["quarter", "division"]],
                            "quarter", "division", "basin")
           .agg(_present_sum(F.when(is_cm, F.col("total")), is_cm).alias("cm"),
                _present_sum(F.when(is_rev, F.col("total")), is_rev).alias("rev"),
                _worldwide_basin().alias("basin_label")))
    return agg.where(F.col("cm").isNotNull() | F.col("rev").isNotNull()).select(
        "quarter", F.col("basin_label").alias("basin"), "division",
        F.col("cm").cast("double").alias("cm"), F.col("rev").cast("double").alias("rev"))


def assemble_panel(weighted: DataFrame, rig: DataFrame, actuals: DataFrame) -> DataFrame:
    """One row per (quarter, basin, division) with all measures.

    J2: weighted forecast x rig counts (both scenarios present), inner on
    (quarter, basin). J3: full outer with actuals on (quarter, basin,
    division); the USING join coalesces the keys.
    """
    rig_q = (rig_quarterly(rig).where(F.col("has_ex") & F.col("has_all"))
             .select("quarter", "basin", "rig_ex_china", "rig_all"))
    covariates = weighted_quarterly(weighted).join(rig_q, ["quarter", "basin"], "inner")
    return (covariates.join(actuals_quarterly(actuals), ["quarter", "basin", "division"], "full")
            .select(*PANEL_COLUMNS))


def oil_quarterly(oil: DataFrame) -> DataFrame:
    """Quarterly mean of the monthly Brent and WTI prices."""
    return (_quarter(oil).where(F.col("quarter").isNotNull())
            .groupBy("quarter")
            .agg(F.avg("brent").alias("brent"), F.avg("wti").alias("wti")))


def keyed_panel(panel: DataFrame, eliminations: str = biz.ELIMINATIONS_BASIN) -> DataFrame:
    """P3 + P4: drop the eliminations basin (after Worldwide was summed) and
    add the composite series key ``basin-division`` (NULL if either is NULL).
    """
    keep = F.col("basin").isNull() | (F.col("basin") != eliminations)
    return (panel.where(keep)
            .withColumn("series", F.concat(F.col("basin"), F.lit("-"), F.col("division"))))


def restrict_series(df: DataFrame, series: Sequence[str] | None) -> DataFrame:
    """Keep only the listed series. ``None`` keeps all.

    The list is a driver-side parameter, so its size is known: ``isin``
    becomes an InSet filter evaluated in the scan's codegen stage, no join.
    """
    if series is None:
        return df
    return df.where(F.col("series").isin(list(series)))
