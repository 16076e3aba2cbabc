"""Per-series ridge regressions, all groups and origins at once (M3-M7).

The reference fits one additive trend/seasonality/regressor model and one
autoregressive multi-step model per series, in a driver loop. Here every
(origin, series[, step]) is fitted in one job (:mod:`.grams`): rows move once by series,
their Grams are summed per quarter, each origin takes the quarters before it, and a
task solves its groups as one stack. Scoring joins the coefficient arrays back and
takes a dot product with ``aggregate(zip_with(x, beta))``, JVM-side.

With about 20 quarters per series and 24-28 regressors there are more features than
rows, so the ridge penalty is mandatory, not a tuning nicety. The additive model may
have trend changes (hinges) and yearly Fourier terms, each block with its own penalty
(:class:`AdditiveTerms`), and rows may weigh less with age (W5). ``gram`` is the
long-form Gram in SQL terms; the normal equations are checked with it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ...functions.calendar import quarter_index, quarter_number
from ...functions.numeric import round2
from ...session import cut_lineage
from .grams import LIVE_SHARE, fit as fit_groups, index_of, solve_grams

ADDITIVE = "ADDITIVE"
AR_DIRECT = "AR_DIRECT"

DEFAULT_PENALTY = 1.0
AR_LAGS = 4
AR_STEPS = 4  # default of a direct call; a run takes its own horizon (RunParams.interval)


def gram(rows: DataFrame, keys: Sequence[str], features: Sequence[str], target: str,
         weight: str | None = None) -> DataFrame:
    """Long-form upper-triangular Gram ``(keys, i, j, g)`` of ``[1, x, y]``.

    Two nested ``posexplode`` plus ``i <= j`` stay inside whole-stage codegen;
    building only the upper triangle in one array with ``transform`` measured
    4-5x slower (higher-order functions are interpreted).
    """
    keys = list(keys)
    z = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in features],
                F.col(target).cast("double"))
    w = F.lit(1.0) if weight is None else F.col(weight)
    return (rows.select(*keys, z.alias("z"), w.alias("w"))
            .select(*keys, "z", "w", F.posexplode("z").alias("i", "zi"))
            .select(*keys, "i", (F.col("w") * F.col("zi")).alias("zi"), F.posexplode("z").alias("j", "zj"))
            .where(F.col("i") <= F.col("j"))
            .groupBy(*keys, "i", "j")
            .agg(F.sum(F.col("zi") * F.col("zj")).alias("g")))


def solve_gram(g: np.ndarray, penalty: float | Sequence[float]) -> np.ndarray | None:
    """Ridge coefficients ``[intercept, beta...]`` from one augmented Gram of ``[1, x, y]``."""
    return solve_grams(g[None], np.asarray(penalty, np.float64))[0] if g[0, 0] > 0 else None


def fit(rows: DataFrame, keys: Sequence[str], features: Sequence[str], target: str,
        penalty: float | Sequence[float] = DEFAULT_PENALTY, origins: Sequence[str] | None = None,
        recency: bool = False) -> DataFrame:
    """Coefficients ``([origin,] keys, beta array<double>)`` for complete training rows; with
    ``origins`` the rows have no origin and every origin is fitted on the quarters before it."""
    return fit_groups(rows, keys, features, target, penalty, origins, recency)


def normal_equations(rows: DataFrame, coefs: DataFrame, keys: Sequence[str], features: Sequence[str],
                     target: str, penalty: float | Sequence[float] = DEFAULT_PENALTY, tolerance: float = 1e-6,
                     weight: str | None = None) -> DataFrame:
    """``(keys, n_rows, n_live, solved)``: whether the coefficients of each group satisfy
    the ridge normal equations, from the Gram sums in SQL (:func:`gram`).

    For a live feature j: ``sum_i S_ij b_i + penalty_j * S_jj * b_j = S_jy`` with centred
    (weighted) second moments S; for others ``b_j = 0``.
    """
    keys, m = list(keys), len(features)
    complete = rows.dropna(subset=[*features, target])
    long = gram(complete, keys, features, target, weight)
    counts = complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    penalties = F.array(*[F.lit(float(p)) for p in np.broadcast_to(penalty, (m,))])
    one = long.where("i = 0 and j = 0").select(*keys, F.col("g").alias("n"))
    mean = long.where("i = 0").select(*keys, F.col("j").alias("k"), F.col("g").alias("s"))
    full = long.unionByName(long.where("i < j").select(
        *keys, F.col("j").alias("i"), F.col("i").alias("j"), "g")).where("i >= 1 and j >= 1")
    mi = mean.select(*keys, F.col("k").alias("i"), F.col("s").alias("si"))
    mj = mean.select(*keys, F.col("k").alias("j"), F.col("s").alias("sj"))
    s = (full.join(one, keys).join(mi, keys + ["i"]).join(mj, keys + ["j"])
         .withColumn("c", F.col("g") / F.col("n") - F.col("si") / F.col("n") * F.col("sj") / F.col("n")))
    diag = s.where(F.col("i") == F.col("j")).where(F.col("i") <= m).select(
        *keys, F.col("i").alias("d"), F.col("c").alias("var"), (F.col("g") / F.col("n")).alias("square"))
    live = diag.withColumn("live", F.col("var") > LIVE_SHARE * F.col("square"))
    b = coefs.select(*keys, F.posexplode("beta").alias("k", "b")).where("k >= 1")
    lhs = (s.where(f"i <= {m} and j <= {m}").join(b.withColumnRenamed("k", "i"), keys + ["i"])
           .groupBy(*keys, "j").agg(F.sum(F.col("c") * F.col("b")).alias("lhs"),
                                    F.sum(F.abs(F.col("c") * F.col("b"))).alias("scale")))
    rhs = s.where(f"j = {m + 1} and i <= {m}").select(*keys, F.col("i").alias("j"), F.col("c").alias("rhs"))
    var_y = s.where(f"i = {m + 1} and j = {m + 1}").select(*keys, F.col("c").alias("var_y"))
    joined = (lhs.join(rhs, keys + ["j"]).join(live.withColumnRenamed("d", "j"), keys + ["j"])
              .join(b.withColumnRenamed("k", "j"), keys + ["j"]).join(var_y, keys))
    off = F.col("lhs") + F.element_at(penalties, F.col("j")) * F.col("var") * F.col("b") - F.col("rhs")
    allowed = tolerance * (F.col("scale") + F.abs("rhs") + F.sqrt(F.abs(F.col("var") * F.col("var_y"))))
    holds = F.when(F.col("live"), F.abs(off) <= allowed).otherwise(F.col("b") == 0)
    return (joined.groupBy(*keys).agg(F.count_if("live").alias("n_live"), F.bool_and(holds).alias("solved"))
            .join(counts, keys).select(*keys, "n_rows", "n_live", "solved"))


def dot(features: Sequence[str], beta: str = "beta") -> F.Column:
    """``beta[0] + sum beta[i] x_i``; NULL features count as 0."""
    x = F.array(F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0))
                              for c in features])
    return F.aggregate(F.zip_with(x, F.col(beta), lambda a, b: a * b), F.lit(0.0),
                       lambda acc, v: acc + v)


# --- M3/M4: additive trend + quarter-of-year + regressors -----------------------

@dataclass(frozen=True)
class AdditiveTerms:
    """The terms of the additive model besides its regressors.

    The season is three dummies, or with ``fourier`` the yearly sine and cosine terms up to
    that order (on quarters all orders above 2 repeat these). ``changes`` are quarters at
    which the slope may change: hinges ``max(0, t - t_c)`` at fixed quarters of the calendar,
    so that a training row is the same for every origin; a hinge after the last training
    quarter is constant there and gets no coefficient. Each block has its own penalty: strong
    on changes, so that only needed ones remain.
    """

    changes: tuple[str, ...] = ()
    fourier: int = 0
    trend_penalty: float = DEFAULT_PENALTY
    change_penalty: float = DEFAULT_PENALTY
    season_penalty: float = DEFAULT_PENALTY
    regressor_penalty: float = DEFAULT_PENALTY

    def columns(self) -> dict[str, F.Column]:
        t, q = quarter_index("quarter"), quarter_number("quarter")
        out = {"_t": t.cast("double")}
        out |= {f"_h{c}": F.greatest(t - index_of(c), F.lit(0)).cast("double") for c in self.changes}
        if not self.fourier:
            return out | {f"_q{k}": (q == k).cast("double") for k in (2, 3, 4)}
        for k in range(1, min(self.fourier, 2) + 1):
            # Sine and cosine of k quarters of a turn, exactly.
            turn = F.pmod((q - 1) * k, F.lit(4)) + 1
            if k == 1:
                out["_s1"] = F.element_at(F.array(*[F.lit(v) for v in (0.0, 1.0, 0.0, -1.0)]), turn)
            out[f"_c{k}"] = F.element_at(F.array(*[F.lit(v) for v in (1.0, 0.0, -1.0, 0.0)]), turn)
        return out

    def penalties(self, n_regressors: int) -> list[float]:
        """One penalty per feature: the terms, then the regressors."""
        block = {"_t": self.trend_penalty, "_h": self.change_penalty}
        terms = [block.get(c[:2], self.season_penalty) for c in self.columns()]
        return terms + [self.regressor_penalty] * n_regressors


PLAIN = AdditiveTerms()
ADDITIVE_TERMS = ["_t", "_q2", "_q3", "_q4"]


def regressor_lists(regressors: Sequence[str], worldwide: Sequence[str] | None
                    ) -> tuple[list[str], dict[str, F.Column]]:
    """M7: series of the Worldwide basin use the list ``worldwide``, all others
    ``regressors``; the lists may be equal, overlap or be disjoint. Returns their
    union and, for each regressor not in both, its column with 0 where the series'
    own list lacks it (its coefficient is then 0)."""
    if worldwide is None:
        return list(regressors), {}
    union = list(dict.fromkeys([*regressors, *worldwide]))
    world = F.col("series").startswith("Worldwide-")
    out = {}
    for c in union:
        if c in worldwide and c not in regressors:
            out[c] = F.when(world, F.col(c)).otherwise(F.lit(0.0))
        elif c not in worldwide:
            out[c] = F.when(world, F.lit(0.0)).otherwise(F.col(c))
    return union, out


def additive_design(rows: DataFrame, regressors: Sequence[str], worldwide: Sequence[str] | None = None,
                    terms: AdditiveTerms = PLAIN) -> tuple[DataFrame, list[str]]:
    """Rows with the additive terms and the regressors of each series' list; the features."""
    union, masks = regressor_lists(regressors, worldwide)
    columns = terms.columns()
    out = rows.withColumns(columns)
    return (out.withColumns(masks) if masks else out), [*columns, *union]


def additive_fit(train: DataFrame, target: str, regressors: Sequence[str],
                 keys: Sequence[str] = ("origin", "series"), penalty: float = DEFAULT_PENALTY,
                 worldwide: Sequence[str] | None = None, origins: Sequence[str] | None = None,
                 terms: AdditiveTerms | None = None, recency: bool = False) -> DataFrame:
    """M3: coefficients ``(keys, beta)`` from complete training rows; with ``origins`` the
    rows come without one and ``keys`` need not name it."""
    rows, feats = additive_design(train.dropna(), regressors, worldwide, terms or PLAIN)
    n_terms = len((terms or PLAIN).columns())
    penalties = terms.penalties(len(feats) - n_terms) if terms is not None else penalty
    keys = [k for k in keys if k != "origin" or origins is None]
    return fit(rows, keys, feats, target, penalties, origins, recency)


def additive_score(horizon: DataFrame, coefs: DataFrame, target: str,
                   regressors: Sequence[str], keys: Sequence[str] = ("origin", "series"),
                   worldwide: Sequence[str] | None = None, terms: AdditiveTerms | None = None) -> DataFrame:
    """M4: score horizon rows with (fitted or loaded) coefficients.

    Horizon regressors are zero-filled; series without a model forecast 0.
    Returns ``(keys, quarter, target)``.
    """
    keys = list(keys)
    hz, feats = additive_design(horizon, regressors, worldwide, terms or PLAIN)
    pred = F.coalesce(round2(dot(feats)), F.lit(0.0))
    return hz.join(coefs.select(*keys, "beta"), keys, "left").select(*keys, "quarter",
                                                                     pred.alias(target))


def additive_forecast(train: DataFrame, horizon: DataFrame, target: str,
                      regressors: Sequence[str], keys: Sequence[str] = ("origin", "series"),
                      penalty: float = DEFAULT_PENALTY,
                      worldwide: Sequence[str] | None = None,
                      artefacts: str | None = None, origins: Sequence[str] | None = None,
                      terms: AdditiveTerms | None = None, recency: bool = False) -> DataFrame:
    """M3 + M4: fit on complete training rows, score the horizon rows.

    With ``artefacts`` the coefficients are written to that coefficient table (K5),
    keyed by family, target, origin and series, and read back for scoring.
    """
    coefs = additive_fit(train, target, regressors, keys, penalty, worldwide, origins, terms, recency)
    coefs = _stored(coefs, artefacts, ADDITIVE, target) if artefacts is not None else cut_lineage(coefs)
    return additive_score(horizon, coefs, target, regressors, keys, worldwide, terms)


def _stored(coefs: DataFrame, path: str, family: str, target: str) -> DataFrame:
    from ...sources.store import load_coefficients, save_coefficients
    save_coefficients(coefs, path, family, target)
    return load_coefficients(coefs.sparkSession, path, family, target)


# --- M5/M6: direct multi-step autoregression ----------------------------------

def _lag_names(columns: Sequence[str], lags: int) -> list[str]:
    return [f"{c}_ar{k}" for c in columns for k in range(lags)]


def ar_samples(train: DataFrame, target: str, regressors: Sequence[str], lagged: Sequence[str] = (),
               keys: Sequence[str] = ("origin", "series"), lags: int = AR_LAGS, steps: int = AR_STEPS,
               worldwide: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """M5: one sample per training row and step h, and the features.

    The target and the lagged regressors enter at lags ``h .. h+lags-1`` (row-based
    within the series), the known-future regressors at the row itself.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("quarter")
    union, masks = regressor_lists(regressors, worldwide)
    complete = train.dropna()  # complete cases in every column
    complete = complete.withColumns(masks) if masks else complete
    series = [target, *lagged]
    arrays = {f"_lags_{c}": F.array(*[F.lag(c, k).over(w) for k in range(1, steps + lags)])
              for c in series}
    samples = (complete.withColumns(arrays)
               .withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(steps))))
               .withColumns({f"{c}_ar{k}": F.element_at(f"_lags_{c}", F.col("h") + k)
                             for c in series for k in range(lags)}))
    names = _lag_names(series, lags)
    feats = names + union
    return samples.select(*keys, "quarter", "h", *feats, target), feats


def last_values(train: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("origin", "series"),
                lags: int = AR_LAGS, origins: Sequence[str] | None = None) -> DataFrame:
    """The last ``lags`` known values of each column before the origin, newest first.
    Rows with an origin are all before it; without one, each of ``origins`` takes the last
    row before it, and only these are repeated."""
    keys = [k for k in keys if k != "origin" or origins is None]
    w = Window.partitionBy(*keys).orderBy("quarter")
    last = F.struct(*[F.array(F.col(c), *[F.lag(c, k).over(w) for k in range(1, lags)]).alias(f"_last_{c}")
                      for c in columns])
    rows = train.dropna().select(*keys, "quarter", last.alias("_last"))
    if origins is None:
        return rows.groupBy(*keys).agg(F.max_by("_last", "quarter").alias("_last")).select(*keys, "_last.*")
    found = rows.groupBy(*keys).agg(F.array(*[
        F.struct(F.lit(o).alias("origin"),
                 F.max_by("_last", F.when(F.col("quarter") < o, F.col("quarter"))).alias("_last"))
        for o in origins]).alias("_o"))
    return (found.select(*keys, F.explode("_o").alias("_o")).where("_o._last is not null")
            .select("_o.origin", *keys, "_o._last.*"))


def ar_score(train: DataFrame, horizon: DataFrame, coefs: DataFrame, target: str,
             regressors: Sequence[str], lagged: Sequence[str] = (),
             keys: Sequence[str] = ("origin", "series"), lags: int = AR_LAGS,
             worldwide: Sequence[str] | None = None, origins: Sequence[str] | None = None) -> DataFrame:
    """M6: score horizon rows with (fitted or loaded) coefficients ``(keys, h, beta)``.

    The step of a row is its distance in quarters from the origin (the origin's own
    quarter is step 1), so a missing row does not shift the others. Rows of series
    without a model, or without the step, forecast 0.
    """
    keys, series = list(keys), [target, *lagged]
    union, masks = regressor_lists(regressors, worldwide)
    hz = horizon.withColumns(masks) if masks else horizon
    step = (quarter_index("quarter") - quarter_index("origin") + 1).cast("int")
    hz = (hz.withColumn("h", step).join(last_values(train, series, keys, lags, origins), keys, "left")
          .withColumns({f"{c}_ar{k}": F.element_at(f"_last_{c}", k + 1)
                        for c in series for k in range(lags)}))
    pred = F.coalesce(round2(dot(_lag_names(series, lags) + union)), F.lit(0.0))
    return (hz.join(coefs.select(*keys, "h", "beta"), keys + ["h"], "left")
            .select(*keys, "quarter", pred.alias(target)))


def ar_direct_forecast(train: DataFrame, horizon: DataFrame, target: str,
                       regressors: Sequence[str], keys: Sequence[str] = ("origin", "series"),
                       lags: int = AR_LAGS, steps: int = AR_STEPS,
                       penalty: float = DEFAULT_PENALTY, artefacts: str | None = None,
                       worldwide: Sequence[str] | None = None,
                       lagged: Sequence[str] = (), origins: Sequence[str] | None = None,
                       recency: bool = False) -> DataFrame:
    """M5 + M6: one ridge per (keys, step h), scored from the origin. With ``origins`` the
    training rows come without one: lags only look back, so a sample is the same for every
    origin after it."""
    own = [k for k in keys if k != "origin" or origins is None]
    samples, feats = ar_samples(train, target, regressors, lagged, own, lags, steps, worldwide)
    coefs = fit(samples, [*own, "h"], feats, target, penalty, origins, recency)
    coefs = _stored(coefs, artefacts, AR_DIRECT, target) if artefacts is not None else cut_lineage(coefs)
    return ar_score(train, horizon, coefs, target, regressors, lagged, keys, lags, worldwide, origins)
