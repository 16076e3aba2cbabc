"""M1/M2: random-forest regression with MLlib, pooled over series and free of scale.

The reference fits one 100-tree forest per series in a driver loop. Here one forest is
fitted per (target, origin) on the rows of *all* series, in terms that mean the same in
every series:

* the target is its ratio to the series' own mean size (mean absolute target), so a
  split that serves a series of 10 serves one of 10^7 as well;
* a feature enters twice: as its rank among the series' own training values (the share
  below it, ties half), and as its ratio to their mean size;
* a series also enters by the ratio of its mean to those of its basin and division.

Ranks of a series with n training quarters have 2n+1 levels, so ``maxBins`` and the depth
follow from the longest series of the run (bounded by the calendar), not from the number
of series: no series has fewer thresholds inside its own range than a fit of its own
would have. The columns are the same for 25 series and for a million, and no label list is
collected; the sorted training values of a series are one row of a table, joined by
series. Pooling is a semantic change (trees share strength across series), chosen because
a per-series loop of MLlib fits does not scale; the learner itself is distributed. Origins
are fitted in parallel driver threads (their number is a run parameter), each on its own
rows only, so no origin sees later actuals. Rows may weigh less with age (W5,
MLlib's ``weightCol``). A series without training rows forecasts 0, as in the other families.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.numeric import round2
from ...session import cut_lineage
from ..features import recency_weighted, training_sets
from .grams import partitions
from .trees import node_table

FOREST = "FOREST"
NUM_TREES = 100
SEED = 42
ROWS_PER_TASK = 5000
MLLIB_BINS, MLLIB_DEPTH = 32, 30  # MLlib's default number of bins and its deepest tree
# Tree nodes split per pass over the data: a larger budget means fewer passes
# (levels of all trees are grouped), and cached node ids spare re-walking the
# trees each pass. 1 GiB per executor is a modest share on a cluster node.
MAX_MEMORY_MB = 1024
MEANS = ["_series_mean", "_basin_mean", "_division_mean"]
SHARES = ["_basin_share", "_division_share"]


def _parts(df: DataFrame) -> DataFrame:
    """Basin and division of ``basin-division`` (the division follows the last dash)."""
    return df.withColumns({"_basin": F.regexp_replace("series", "-[^-]*$", ""),
                           "_division": F.regexp_extract("series", "([^-]*)$", 1)})


def target_means(train: DataFrame, target: str, keys: Sequence[str] = ("series",)) -> DataFrame:
    """``keys, _series_mean, _basin_mean, _division_mean`` over the training rows (exact:
    cents are summed as integers). Keys are the series, and the origin where rows have one."""
    keys, over = list(keys), [k for k in keys if k != "series"]
    cents = F.round(F.col(target) * 100).cast("decimal(38,0)")
    sums = _parts(train.groupBy(*keys).agg(F.sum(cents).alias("s"), F.count(target).alias("n")))
    mean = lambda s, n: (s.cast("double") / n / 100)
    out = sums.select(*keys, "_basin", "_division", mean(F.col("s"), F.col("n")).alias("_series_mean"))
    for key in ("_basin", "_division"):
        group = sums.groupBy(*over, key).agg(mean(F.sum("s"), F.sum("n")).alias(f"{key}_mean"))
        out = out.join(group, [*over, key])
    return out.select(*keys, *MEANS)


def design(rows: DataFrame, means: DataFrame) -> DataFrame:
    """Rows with the three means; series that were not trained get those of no series (0)."""
    return rows.join(means, "series", "left").fillna(0.0, subset=MEANS)


def encoding(train: DataFrame, target: str, features: Sequence[str], keys: Sequence[str] = ("series",)) -> DataFrame:
    """What a series is: its means, ``_scale`` (mean absolute target; 1 where that is 0),
    and of each feature ``_values``, the sorted training values (bounded by the calendar), and
    ``_sizes``, their mean absolute value (1 where that is 0)."""
    values = F.array(*[F.array_sort(F.collect_list(F.col(c).cast("double"))) for c in features])
    size = lambda c: F.sum(F.abs(F.col(c)).cast("decimal(28,6)")).cast("double") / F.count(c)  # noqa: E731  exact
    whole = lambda x: F.when(x > 0, x).otherwise(1.0)
    own = train.groupBy(*keys).agg(whole(size(target)).alias("_scale"), values.alias("_values"),
                                      F.array(*[whole(size(c)) for c in features]).alias("_sizes"))
    return target_means(train, target, keys).join(own, list(keys))


def rank_names(features: Sequence[str]) -> list[str]:
    return [f"_r_{c}" for c in features] + [f"_m_{c}" for c in features] + SHARES


def ranked(rows: DataFrame, enc: DataFrame, features: Sequence[str], keys: Sequence[str] = ("series",)) -> DataFrame:
    """Rows with the ranks and ratios of their features inside the series and the series'
    shares; rows of series that are not encoded have no scale, middling ranks and ratios 0."""
    joined = rows.join(enc, list(keys), "left")

    def rank(k: int, c: str) -> F.Column:
        values, x = F.element_at("_values", k + 1), F.col(c).cast("double")
        below, upto = (F.size(F.filter(values, test)) for test in (lambda v: v < x, lambda v: v <= x))
        return F.coalesce(F.try_divide((below + upto).cast("double"), 2.0 * F.size(values)), F.lit(0.5))

    share = {"_basin_share": "_basin_mean", "_division_share": "_division_mean"}
    return joined.withColumns(
        {f"_r_{c}": rank(k, c) for k, c in enumerate(features)}
        | {f"_m_{c}": F.coalesce(F.col(c).cast("double") / F.element_at("_sizes", k + 1), F.lit(0.0))
           for k, c in enumerate(features)}
        | {n: F.coalesce(F.try_divide(F.col("_series_mean"), F.col(m)), F.lit(0.0)) for n, m in share.items()}).drop("_values", "_sizes")


def _assembler(features: Sequence[str], invalid: str) -> VectorAssembler:
    return VectorAssembler(inputCols=rank_names(features), outputCol="_x", handleInvalid=invalid)


def _predicted(rows: DataFrame, model, target: str, features: Sequence[str]) -> DataFrame:
    pred = F.coalesce(round2(F.col("_pred") * F.col("_scale")), F.lit(0.0))
    return model.transform(_assembler(features, "error").transform(rows)).select(
        "origin", "quarter", "series", pred.alias(target))


def score_forest(horizon: DataFrame, enc: DataFrame, model, target: str,
                 features: Sequence[str]) -> DataFrame:
    """M2: score with a fitted or loaded model; NULL features count as 0."""
    return _predicted(ranked(horizon.fillna(0.0, subset=list(features)), enc, features), model, target, features)


def learner_size(longest: int) -> tuple[int, int]:
    """``maxBins`` and depth from the rows of the longest series: a threshold between any two
    of its ranks, and twice the depth of a balanced tree that tells all its rows apart."""
    return max(MLLIB_BINS, 2 * longest + 2), min(MLLIB_DEPTH, max(1, 2 * math.ceil(math.log2(longest + 1))))


def load_forest(spark: SparkSession, path: str, target: str, origin: str):
    """``(encoding, model)`` of one target and origin."""
    at = f"{path}/{target}/{origin}"
    return spark.read.parquet(f"{at}/encoding"), RandomForestRegressionModel.load(f"{at}/model")


def forest_forecast(train_sets: DataFrame, horizon: DataFrame, target: str,
                    features: Sequence[str], origins: Sequence[str],
                    num_trees: int = NUM_TREES, seed: int = SEED, max_depth: int | None = None,
                    parallelism: int = 4, artefacts: str | None = None, recency: bool = False) -> DataFrame:
    """Fit on complete training rows of each origin (``quarter < origin``),
    score that origin's horizon rows. Returns ``(origin, quarter, series, target)``.
    ``max_depth`` overrides the depth that follows from the rows.

    The encoding, the training rows and the horizon in its terms are written once for all
    origins; only the learner runs per origin."""
    complete = train_sets.dropna()
    if recency:
        complete = recency_weighted(complete.drop("origin").distinct(), origins)
    elif "origin" not in complete.columns:
        complete = training_sets(complete, origins)
    keys, weight = ["origin", "series"], ["weight"] if recency else []
    enc = cut_lineage(encoding(complete, target, features, keys))
    ratio = (F.col(target) / F.col("_scale")).alias("_y")
    rows = cut_lineage(ranked(complete, enc, features, keys).select(*keys, "quarter", *rank_names(features), ratio, *weight))
    later = ranked(horizon.fillna(0.0, subset=list(features)), enc, features, keys)
    later = cut_lineage(later.select("origin", "quarter", "series", *rank_names(features), "_scale"))
    sizes = complete.groupBy(*keys).count().groupBy("origin").agg(F.max("count").alias("longest"), F.sum("count").alias("n"))
    sizes = {r.origin: r for r in sizes.collect()}  # one row per origin

    def one(o: str) -> DataFrame:
        bins, depth = learner_size(sizes[o].longest if o in sizes else 1)
        # The learner samples by partition and place in it: both are fixed by the rows' keys.
        n = max(1, min(partitions(rows.sparkSession), sizes[o].n // ROWS_PER_TASK if o in sizes else 1))
        dealt = rows.where(F.col("origin") == o).repartition(n, "series").sortWithinPartitions("series", "quarter")
        own = _assembler(features, "skip").transform(dealt).select("_x", "_y", *weight)
        own = own.persist(StorageLevel.MEMORY_AND_DISK)  # read by every pass of the learner
        rf = RandomForestRegressor(featuresCol="_x", labelCol="_y", predictionCol="_pred",
                                   numTrees=num_trees, seed=seed, maxDepth=max_depth or depth, maxBins=bins,
                                   featureSubsetStrategy="all", maxMemoryInMB=MAX_MEMORY_MB,
                                   cacheNodeIds=True, **({"weightCol": "weight"} if recency else {}))
        try:
            model = rf.fit(own)
        finally:
            own.unpersist()
        if artefacts is not None:  # K5: one pooled model per (target, origin), with its encoding and node table
            to = f"{artefacts}/{target}/{o}"
            model.write().overwrite().save(f"{to}/model")
            enc.where(F.col("origin") == o).drop("origin").write.mode("overwrite").parquet(f"{to}/encoding")
            node_table(enc.sparkSession, f"{to}/model").write.mode("overwrite").parquet(f"{to}/nodes")
        return _predicted(later.where(F.col("origin") == o), model, target, features)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(origins)))) as pool:
        parts = list(pool.map(one, origins))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
