"""Registered queries of the fitted model families.

What SQL can express has an oracle: the designs, the samples of the autoregression,
scoring with given coefficients or a given tree table, whether fitted coefficients
satisfy the ridge normal equations, and the whole two-stage ridge forecasts, whose
systems the oracle solves itself (ridge_oracle.py). Forecasts of MLlib forests are
compared by row count here and by value in tests/test_models.py.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as feat
from ..functions.numeric import round2
from ..operators.models import forest, ridge, trees
from ..operators.models.forest import FOREST
from ..operators.scoring import score_forecasts
from ..operators.selection import best_model
from ..session import cut_lineage
from . import backtest as bt
from . import families as fam
from .queries import PARAMS, _inputs

# Fixed values of the checks: coefficients given to the scoring queries, and a short
# regressor list for Worldwide series (M7).
FIXED_BETA = [10.0, 0.5, 1.0, 2.0, 3.0] + [0.001] * len(feat.REV_FEATURES)
FIXED_AR = 0.25
SHORT_LIST = ("pipeline", "brent", "wti")
CHANGING = ridge.AdditiveTerms(changes=("1997Q1", "1998Q1", "1999Q1", "2000Q1"), fourier=2, trend_penalty=0.1,
                               change_penalty=3.0, season_penalty=0.5, regressor_penalty=1.0)


def additive_ridge_forecast(spark, sf_dir):
    return fam.two_stage(_inputs(spark, sf_dir), PARAMS, ridge.ADDITIVE)


def additive_two_lists(spark, sf_dir):
    """M7: Worldwide series fitted with their own regressor list."""
    p = replace(PARAMS, worldwide_features=SHORT_LIST)
    return fam.two_stage(_inputs(spark, sf_dir), p, ridge.ADDITIVE)


def additive_changes_forecast(spark, sf_dir):
    """M3 with trend changes at fixed quarters, a Fourier season and a penalty per block."""
    return fam.two_stage(_inputs(spark, sf_dir), replace(PARAMS, additive=CHANGING), ridge.ADDITIVE)


def additive_recency_forecast(spark, sf_dir):
    """M3 with rows weighted by their age."""
    return fam.two_stage(_inputs(spark, sf_dir), replace(PARAMS, recency=True), ridge.ADDITIVE)


def ar_direct_forecast(spark, sf_dir):
    return fam.two_stage(_inputs(spark, sf_dir), PARAMS, ridge.AR_DIRECT)


def forest_forecast(spark, sf_dir):
    return fam.two_stage(_inputs(spark, sf_dir), PARAMS, FOREST)


def two_stage_forecast(spark, sf_dir):
    return fam.all_forecasts(_inputs(spark, sf_dir), PARAMS, with_trend=False)


def _backtest_best(spark, sf_dir, families) -> DataFrame:
    inp = _inputs(spark, sf_dir)
    forecasts = cut_lineage(fam.all_forecasts(inp, PARAMS, families))
    snap = cut_lineage(score_forecasts(forecasts, bt.ground_truth(bt.training(inp, PARAMS)),
                                       PARAMS.origins))
    return best_model(snap, PARAMS.lookback_months, PARAMS.series)


def full_backtest_best(spark, sf_dir):
    """Every family, every origin: snapshots and the best model per series."""
    return _backtest_best(spark, sf_dir, fam.FAMILIES)


def ridge_backtest_best(spark, sf_dir):
    """The same over the trend and ridge families, whose forecasts SQL can compute."""
    return _backtest_best(spark, sf_dir, (ridge.ADDITIVE, ridge.AR_DIRECT))


# --- parts with an oracle -----------------------------------------------------

def _train(spark, sf_dir) -> DataFrame:
    return bt.training_sets(_inputs(spark, sf_dir), PARAMS)


def additive_design(spark, sf_dir):
    """M3 + M7: the rows the margin model is fitted on, with the two regressor lists."""
    rows, feats = ridge.additive_design(_train(spark, sf_dir).dropna(), feat.CM_FEATURES, SHORT_LIST)
    return rows.select("origin", "quarter", "series", *[F.col(c).alias(c.lstrip("_")) for c in feats], "cm")


def ar_samples(spark, sf_dir):
    """M5: the samples of the margin autoregression, lags by step."""
    rows, feats = ridge.ar_samples(_train(spark, sf_dir), "cm", [], fam.AR_LAGGED, steps=PARAMS.interval)
    return rows.select("origin", "quarter", "series", F.col("h").cast("long").alias("h"), *feats, "cm")


def additive_normal_equations(spark, sf_dir):
    """M3: the fitted coefficients of every series solve their ridge system."""
    rows, feats = ridge.additive_design(_train(spark, sf_dir).dropna(), feat.REV_FEATURES)
    keys = ["origin", "series"]
    coefs = cut_lineage(ridge.fit(rows, keys, feats, "rev"))
    return ridge.normal_equations(rows, coefs, keys, feats, "rev")


def additive_changes_design(spark, sf_dir):
    """M3: the training rows with trend changes and Fourier terms."""
    rows, feats = ridge.additive_design(bt.training(_inputs(spark, sf_dir), PARAMS).dropna(), ["pipeline"], None, CHANGING)
    return rows.select("quarter", "series", *[F.col(c).alias(c.lstrip("_")) for c in feats], "rev")


def additive_block_equations(spark, sf_dir):
    """M3 with changes: the coefficients of all origins, fitted in one pass over the training
    rows, solve the systems with a penalty per block."""
    train = bt.training(_inputs(spark, sf_dir), PARAMS).dropna()
    rows, feats = ridge.additive_design(train, feat.REV_FEATURES, None, CHANGING)
    penalties = CHANGING.penalties(len(feat.REV_FEATURES))
    coefs = cut_lineage(ridge.fit(rows, ["series"], feats, "rev", penalties, PARAMS.origins))
    return ridge.normal_equations(feat.training_sets(rows, PARAMS.origins), coefs, ["origin", "series"], feats, "rev", penalties)


def additive_recency_equations(spark, sf_dir):
    """M3 with rows weighted by age (W5): the same for the weighted systems."""
    train = bt.training(_inputs(spark, sf_dir), PARAMS)
    rows, feats = ridge.additive_design(train.dropna(), feat.REV_FEATURES)
    coefs = cut_lineage(ridge.fit(rows, ["series"], feats, "rev", origins=PARAMS.origins, recency=True))
    weighted, _ = ridge.additive_design(feat.recency_weighted(train, PARAMS.origins), feat.REV_FEATURES)
    return ridge.normal_equations(weighted, coefs, ["origin", "series"], feats, "rev", weight="weight")


def ar_normal_equations(spark, sf_dir):
    """M5: the same for every series and step of the autoregression."""
    rows, feats = ridge.ar_samples(_train(spark, sf_dir), "rev", feat.REV_FEATURES, steps=PARAMS.interval)
    keys = ["origin", "series", "h"]
    coefs = cut_lineage(ridge.fit(rows, keys, feats, "rev"))
    out = ridge.normal_equations(rows, coefs, keys, feats, "rev")
    return out.withColumn("h", F.col("h").cast("long"))


def _fixed(frames: DataFrame, beta: list[float]) -> DataFrame:
    """The same coefficients for every Worldwide series; others have no model."""
    return (frames.where(F.col("series").startswith("Worldwide-")).select("origin", "series").distinct()
            .withColumn("beta", F.array(*[F.lit(b) for b in beta])))


def additive_fixed_scores(spark, sf_dir):
    """M4: scoring with given coefficients; series without a model forecast 0."""
    frames = bt.stage1_frames(_inputs(spark, sf_dir), PARAMS)
    return ridge.additive_score(frames, _fixed(frames, FIXED_BETA), "rev", feat.REV_FEATURES)


def ar_fixed_scores(spark, sf_dir):
    """M6: scoring with given coefficients by step from the last values before the origin."""
    inp = _inputs(spark, sf_dir)
    frames = bt.stage1_frames(inp, PARAMS)
    steps = F.explode(F.sequence(F.lit(1), F.lit(PARAMS.interval)))
    coefs = (_fixed(frames, [FIXED_AR] * ridge.AR_LAGS)
             .withColumn("h", steps)
             .withColumn("beta", F.concat(F.array(F.col("h").cast("double")), "beta")))
    return ridge.ar_score(bt.training_sets(inp, PARAMS), frames, coefs, "rev", [])


def forest_design(spark, sf_dir):
    """M1: the forest's training rows of every origin with the means that encode a series."""
    train = _train(spark, sf_dir).dropna()
    parts = [forest.design(t, forest.target_means(t, "rev"))
             for t in (train.where(F.col("origin") == o) for o in PARAMS.origins)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("origin", "quarter", "series", *[F.col(c).alias(c.lstrip("_")) for c in forest.MEANS], "rev")


def forest_ranked_design(spark, sf_dir):
    """M1: the forest's features and target in the terms of each series."""
    train = _train(spark, sf_dir).dropna()
    cols = ["pipeline", "wti", "rig_ex_lag1"]
    parts = [forest.ranked(t, forest.encoding(t, "rev", cols), cols)
             for t in (train.where(F.col("origin") == o) for o in PARAMS.origins)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("origin", "quarter", "series", *[F.col(c).alias(c.lstrip("_")) for c in forest.rank_names(cols)],
                      (F.col("rev") / F.col("_scale")).alias("ratio"))


# A given forest (tree, node, feature, threshold, left, right, value) on FIXED_FEATURES.
FIXED_FEATURES = ("pipeline", "rig_ex", "wti", "brent_lag1")
FIXED_NODES = [
    (0, 0, 0, 2500.0, 1, 2, 1.0), (0, 1, 1, 40.5, 3, 4, 2.0), (0, 2, 2, 150000.0, 5, 6, 3.0),
    (0, 3, None, None, None, None, 10.5), (0, 4, None, None, None, None, 20.25), (0, 5, None, None, None, None, 30.125),
    (0, 6, 3, 151000.0, 7, 8, 4.0), (0, 7, None, None, None, None, 40.0), (0, 8, None, None, None, None, 50.0),
    (1, 0, None, None, None, None, 7.0),
    (2, 0, 3, 149000.0, 1, 2, 5.0), (2, 1, None, None, None, None, -8.0), (2, 2, 0, 9000.0, 3, 4, 6.0),
    (2, 3, None, None, None, None, 60.75), (2, 4, None, None, None, None, 70.5),
]


def forest_fixed_scores(spark, sf_dir):
    """M2: scoring a given forest, kept as a table of nodes, by one join per level."""
    frames = bt.stage1_frames(_inputs(spark, sf_dir), PARAMS)
    nodes = spark.createDataFrame(FIXED_NODES, trees.NODES)
    out = trees.score_nodes(frames, nodes, ["origin", "quarter", "series"], FIXED_FEATURES, 3, 3)
    return out.select("origin", "quarter", "series", round2("score").alias("rev"))


MODEL_QUERIES = {
    "additive_ridge_forecast": additive_ridge_forecast,
    "additive_two_lists": additive_two_lists,
    "additive_changes_forecast": additive_changes_forecast,
    "additive_recency_forecast": additive_recency_forecast,
    "ar_direct_forecast": ar_direct_forecast,
    "forest_forecast": forest_forecast,
    "two_stage_forecast": two_stage_forecast,
    "full_backtest_best": full_backtest_best,
    "ridge_backtest_best": ridge_backtest_best,
    "additive_design": additive_design,
    "ar_samples": ar_samples,
    "additive_normal_equations": additive_normal_equations,
    "additive_changes_design": additive_changes_design,
    "additive_block_equations": additive_block_equations,
    "additive_recency_equations": additive_recency_equations,
    "ar_normal_equations": ar_normal_equations,
    "additive_fixed_scores": additive_fixed_scores,
    "ar_fixed_scores": ar_fixed_scores,
    "forest_design": forest_design,
    "forest_ranked_design": forest_ranked_design,
    "forest_fixed_scores": forest_fixed_scores,
}
