"""DuckDB SQL of the fitted ridge forecasts: the whole two-stage run, solved in SQL.

The ridge systems are built as Gram sums over cross joined column numbers and solved by
Gauss-Jordan elimination, one step per level of a recursive CTE, for all groups at once.
Written from the model's definition; nothing is shared with the numpy solver."""

from __future__ import annotations

from collections.abc import Sequence


def solve(name: str, rows: str, keys: Sequence[str], feats: Sequence[str], target: str,
          penalties: Sequence[float] | None = None, weight: str = "1.0::DOUBLE") -> str:
    """CTEs ending in ``{name}(keys, b0, b DOUBLE[])`` from the complete rows of CTE ``rows``."""
    m = len(feats)
    ks = ", ".join(keys)
    ak = ", ".join(f"a.{k}" for k in keys)
    on = lambda x, y: " AND ".join(f"{x}.{k} = {y}.{k}" for k in keys)
    z = ", ".join(["1.0::DOUBLE", *[f"CAST({f} AS DOUBLE)" for f in feats], f"CAST({target} AS DOUBLE)"])
    lam = "[" + ", ".join(f"{float(p)}::DOUBLE" for p in (penalties or [1.0] * m)) + "]"
    return f""",
{name}_z AS MATERIALIZED (SELECT {ks}, {weight} AS w, [{z}] AS z FROM {rows}),
{name}_g AS MATERIALIZED (
  SELECT {ks}, i, j, sum(w * z[i] * z[j]) AS g
  FROM {name}_z, (SELECT unnest(range(1, {m + 3})) AS i), (SELECT unnest(range(1, {m + 3})) AS j) GROUP BY {ks}, i, j),
{name}_c AS MATERIALIZED (
  SELECT {ak}, a.i - 1 AS i, a.j - 1 AS j, a.g / n.g - ai.g / n.g * (aj.g / n.g) AS c, a.g / n.g AS s, ai.g / n.g AS mean
  FROM {name}_g a JOIN {name}_g n ON {on('a', 'n')} AND n.i = 1 AND n.j = 1
  JOIN {name}_g ai ON {on('a', 'ai')} AND ai.i = a.i AND ai.j = 1
  JOIN {name}_g aj ON {on('a', 'aj')} AND aj.i = a.j AND aj.j = 1
  WHERE a.i > 1 AND a.j > 1),
{name}_d AS MATERIALIZED (
  SELECT {ks}, i, mean, c > 1e-12 * s AS live, CASE WHEN c > 1e-12 * s THEN sqrt(c) ELSE 1.0::DOUBLE END AS sd
  FROM {name}_c WHERE i = j),
{name}_a AS MATERIALIZED (
  SELECT {ak}, a.i, list(
    CASE WHEN a.j = {m + 1} THEN CASE WHEN p.live THEN a.c / p.sd ELSE 0.0::DOUBLE END
         WHEN a.i = a.j THEN CASE WHEN p.live THEN a.c / (p.sd * q.sd) + {lam}[a.i] ELSE 1.0::DOUBLE END
         WHEN p.live AND q.live THEN a.c / (p.sd * q.sd) ELSE 0.0::DOUBLE END ORDER BY a.j) AS r
  FROM {name}_c a JOIN {name}_d p ON {on('a', 'p')} AND p.i = a.i JOIN {name}_d q ON {on('a', 'q')} AND q.i = a.j
  WHERE a.i <= {m} GROUP BY {ak}, a.i),
{name}_e AS (
  SELECT {ks}, i, r, 0 AS k FROM {name}_a
  UNION ALL
  SELECT {ak}, a.i,
         CASE WHEN a.i = a.k + 1 THEN [x / p.r[a.k + 1] FOR x IN a.r]
              ELSE [a.r[x] - p.r[x] * (a.r[a.k + 1] / p.r[a.k + 1]) FOR x IN range(1, {m + 2})] END,
         a.k + 1
  FROM {name}_e a JOIN {name}_e p ON {on('a', 'p')} AND p.i = a.k + 1
  WHERE a.k < {m}),
{name}_b AS (
  SELECT {ak}, a.i, d.mean, CASE WHEN d.live THEN a.r[{m + 1}] / d.sd ELSE 0.0::DOUBLE END AS b
  FROM {name}_e a JOIN {name}_d d ON {on('a', 'd')} AND d.i = a.i WHERE a.k = {m}),
{name} AS MATERIALIZED (
  SELECT {ak}, y.mean - sum(a.b * a.mean) AS b0, list(a.b ORDER BY a.i) AS b
  FROM {name}_b a JOIN {name}_d y ON {on('a', 'y')} AND y.i = {m + 1} GROUP BY {ak}, y.mean)"""


def score(coefs: str, feats: Sequence[str], alias: str) -> str:
    """``b0 + sum b x`` over the horizon columns of ``alias``; a null column counts as 0."""
    x = ", ".join(f"coalesce(CAST({alias}.{f} AS DOUBLE), 0.0::DOUBLE)" if f.isidentifier() else f"CAST({f} AS DOUBLE)"
                  for f in feats)
    return f"({coefs}.b0 + list_sum([{coefs}.b[i] * ([{x}])[i] FOR i IN range(1, {len(feats) + 1})]))"


# --- two-stage forecasts ------------------------------------------------------------

def season_columns(quarter: str, qnum, qindex, changes: Sequence[str] = (), fourier: bool = False) -> dict[str, str]:
    """Additive terms of a row, by name."""
    out = {"t": f"CAST({qindex(quarter)} AS DOUBLE)"}
    for c in changes:
        year, number = int(c[:4]), int(c[5:])
        out[f"h{c}"] = f"greatest(CAST({qindex(quarter)} - {(year - 1970) * 4 + number - 1} AS DOUBLE), 0.0::DOUBLE)"
    if not fourier:
        return out | {f"q{k}": f"CAST({qnum(quarter)} = {k} AS INTEGER)::DOUBLE" for k in (2, 3, 4)}
    wave = lambda values: f"(CASE {qnum(quarter)} " + " ".join(
        f"WHEN {k + 1} THEN {v}.0::DOUBLE" for k, v in enumerate(values)) + " END)"
    return out | {"s1": wave((0, 1, 0, -1)), "c1": wave((1, 0, -1, 0)), "c2": wave((1, -1, 1, -1))}


def columns(parts: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in parts.items())


def masked(names: Sequence[str], alias: str, worldwide: Sequence[str] | None) -> dict[str, str]:
    """Regressors of a row, 0 where a Worldwide series does not use them."""
    return {f"x_{c}": f"{alias}.{c}" if worldwide is None or c in worldwide else
            f"CASE WHEN {alias}.series LIKE 'Worldwide-%' THEN 0.0::DOUBLE ELSE {alias}.{c} END" for c in names}


def additive(o, regressors: Sequence[str], target: str, name: str, horizon: str, worldwide=None, changes=(),
             fourier=False, blocks=(1.0, 1.0, 1.0, 1.0), weight: str = "1.0::DOUBLE") -> str:
    """CTE ``{name}_f(origin, quarter, series, {target})``: fit on ``tr``, score ``horizon``.
    ``o`` is the module with the quarter expressions; ``blocks`` the penalties of trend, changes,
    season and regressors."""
    terms = season_columns("quarter", o.qnum, o.qindex, changes, fourier)
    own = masked(regressors, "r", worldwide)
    feats = [*terms, *own]
    block = {"t": blocks[0], "h": blocks[1]}
    penalties = [block.get(f[0], blocks[2]) for f in terms] + [blocks[3]] * len(own)
    return f""",
{name}_t AS (SELECT origin, series, {columns(terms)}, {columns(own)}, r.{target} AS y, {weight} AS w FROM tr r),
{name}_h AS (SELECT origin, quarter, series, {columns(terms)}, {columns(own)} FROM {horizon} r){
    solve(name, f"{name}_t", ["origin", "series"], feats, "y", penalties, "w")},
{name}_f AS (
  SELECT h.origin, h.quarter, h.series, coalesce({o.r2(score('c', feats, 'h'))}, 0.0::DOUBLE) AS {target}
  FROM {name}_h h LEFT JOIN {name} c ON h.origin = c.origin AND h.series = c.series)"""


def autoregressive(o, regressors: Sequence[str], lagged: Sequence[str], target: str, name: str, horizon: str) -> str:
    """The same for the direct autoregression: a model per step."""
    series = [target, *lagged]
    wide = ", ".join(f"lag({c}, {k}) OVER w AS {c}_p{k}" for c in series for k in range(1, 8))
    picked = {f"{c}_a{k}": "CASE h " + " ".join(f"WHEN {h} THEN {c}_p{h + k}" for h in (1, 2, 3, 4)) + " END"
              for c in series for k in range(4)}
    own = masked(regressors, "r", None)
    feats = [*picked, *own]
    complete = " AND ".join(f"{f} IS NOT NULL" for f in feats)
    last = ", ".join(f"max({c}) FILTER (place = {k + 1}) AS {c}_a{k}" for c in series for k in range(4))
    return f""",
{name}_l AS (SELECT r.*, {wide} FROM tr r WINDOW w AS (PARTITION BY origin, series ORDER BY quarter)),
{name}_s AS (
  SELECT origin, series, h, {columns(picked)}, {columns(own)}, r.{target} AS y
  FROM {name}_l r CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS h)),
{name}_t AS (SELECT * FROM {name}_s WHERE {complete}){
    solve(name, f"{name}_t", ["origin", "series", "h"], feats, "y")},
{name}_v AS (
  SELECT origin, series, {last}
  FROM (SELECT *, row_number() OVER (PARTITION BY origin, series ORDER BY quarter DESC) AS place FROM tr)
  GROUP BY 1, 2),
{name}_h AS (
  SELECT r.origin, r.quarter, r.series, {o.qindex('r.quarter')} - {o.qindex('r.origin')} + 1 AS h,
         {', '.join(f'v.{f}' for f in picked)}, {columns(own)}
  FROM {horizon} r LEFT JOIN {name}_v v ON r.origin = v.origin AND r.series = v.series),
{name}_f AS (
  SELECT h.origin, h.quarter, h.series, coalesce({o.r2(score('c', feats, 'h'))}, 0.0::DOUBLE) AS {target}
  FROM {name}_h h LEFT JOIN {name} c ON h.origin = c.origin AND h.series = c.series AND h.h = c.h)"""


def two_stage(o, model: str, first, second) -> str:
    """The whole forecast of a family: ``first`` and ``second`` give the CTEs of a stage from
    its name and horizon."""
    complete = " AND ".join(f"t.{c} IS NOT NULL" for c in o.FRAME_COLUMNS)
    ctes, body = o.margin_parts("right")
    start = o._with(o.PANEL_CTES, o.training_ctes(), o.frames_ctes("f1", o.STAGE1), o.frames_ctes("f2", o.STAGE2))
    return start.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
tr0 AS (SELECT o.origin, t.* FROM train t JOIN {o.origins_values()} o ON t.quarter < o.origin WHERE {complete}),
newest AS (SELECT origin, max({o.qstart('quarter')}) AS d FROM tr0 GROUP BY origin),
tr AS MATERIALIZED (
  SELECT t.*, datediff('day', {o.qstart('t.quarter')}, n.d) AS age FROM tr0 t JOIN newest n ON t.origin = n.origin){
    first('one', 'f1')},
fc AS (SELECT origin, quarter, series, rev, '{o.TREND_SEASONAL}' AS model FROM one_f){ctes},
m2 AS MATERIALIZED ({body}){second('two', 'm2')}
SELECT c.origin, c.quarter, c.series, c.cm, r.rev, '{model}' AS model
FROM two_f c JOIN (SELECT DISTINCT * FROM one_f) r
  ON c.origin = r.origin AND c.quarter = r.quarter AND c.series = r.series"""


# Fixed values of the registered variants (the queries state them on their own).
CHANGES = ("1997Q1", "1998Q1", "1999Q1", "2000Q1")
BLOCKS = (0.1, 3.0, 0.5, 1.0)
RECENCY = ("CASE WHEN r.age < 90 THEN 1.0 WHEN r.age < 270 THEN 0.9 WHEN r.age < 360 THEN 0.8 "
           "WHEN r.age < 540 THEN 0.7 ELSE 0.5 END::DOUBLE")


def forecasts(o) -> dict[str, str]:
    def family(**how):
        return two_stage(o, "ADDITIVE", lambda n, h: additive(o, o.REV_LIST, "rev", n, h, **how),
                         lambda n, h: additive(o, o.CM_LIST, "cm", n, h, **how))

    return {
        "additive_ridge_forecast": family(),
        "additive_two_lists": family(worldwide=o.SHORT_LIST),
        "additive_changes_forecast": family(changes=CHANGES, fourier=True, blocks=BLOCKS),
        "additive_recency_forecast": family(weight=RECENCY),
        "ar_direct_forecast": two_stage(
            o, "AR_DIRECT", lambda n, h: autoregressive(o, o.REV_LIST, (), "rev", n, h),
            lambda n, h: autoregressive(o, o.REV_LIST, o.AR_COLUMNS[1:], "cm", n, h)),
    }
