"""DuckDB SQL oracles of the registered queries.

Written independently of the Spark code, from the operator semantics, as
plain SQL over the driver tables (views ``region nation customer orders
lineitem``). Conventions shared with the Spark side: money summed as
DECIMAL and cast to DOUBLE once; cents rounding ``round_even(x*100, 0)/100``
(numpy's half-even on the scaled double); quarter label
``year || 'Q' || quarter``; zero actuals give NULL errors.
"""

from __future__ import annotations

import sys

from ..operators.models.trend import TREND, TREND_SEASONAL
from . import ridge_oracle
from .queries import TWO_SERIES, WORLDWIDE_SERIES

# The fixed run as literal quarters, so that a wrong bound in the library shows up.
# One row per origin: origin, actuals hidden from, buffer start (exclusive), start
# (exclusive), end (inclusive), buffer end (exclusive).
ORIGINS = ("2000Q1", "2000Q2", "2000Q3", "2000Q4")
STAGE1 = [("2000Q1", "2000Q1", "1999Q1", "1999Q4", "2000Q4", "2001Q4"),
          ("2000Q2", "2000Q2", "1999Q2", "2000Q1", "2001Q1", "2002Q1"),
          ("2000Q3", "2000Q3", "1999Q3", "2000Q2", "2001Q2", "2002Q2"),
          ("2000Q4", "2000Q4", "1999Q4", "2000Q3", "2001Q3", "2002Q3")]
STAGE2 = [("2000Q1", "2000Q1", "1998Q1", "1998Q4", "2000Q4", "2001Q4"),
          ("2000Q2", "2000Q2", "1998Q2", "1999Q1", "2001Q1", "2002Q1"),
          ("2000Q3", "2000Q3", "1998Q3", "1999Q2", "2001Q2", "2002Q2"),
          ("2000Q4", "2000Q4", "1998Q4", "1999Q3", "2001Q3", "2002Q3")]
TRAIN_FROM, TRAIN_BEFORE = "1995Q1", "2002Q1"
LOOKBACK_MONTHS = 12
COVARIATES = {"rig_ex": "rig_ex", "rig_all": "rig_all", "pipeline": "pipeline", "wti": "wti", "brent": "brent"}
LAGS, LEADS = (1, 2, 3), (1, 2)


def r2(x: str) -> str:
    return f"(round_even(CAST({x} AS DOUBLE) * 100, 0) / 100)"


def qlabel(d: str) -> str:
    return f"(CAST(year({d}) AS VARCHAR) || 'Q' || CAST(quarter({d}) AS VARCHAR))"


def qyear(q: str) -> str:
    return f"CAST(substr({q}, 1, 4) AS INTEGER)"


def qnum(q: str) -> str:
    return f"CAST(substr({q}, 6, 1) AS INTEGER)"


def qindex(q: str) -> str:
    return f"(({qyear(q)} - 1970) * 4 + {qnum(q)} - 1)"


def qstart(q: str) -> str:
    return f"make_date({qyear(q)}, ({qnum(q)} - 1) * 3 + 1, 1)"


def values(rows: list[tuple], names: list[str]) -> str:
    body = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(names)}))"


# --- panel ---------------------------------------------------------------------

PANEL_CTES = f"""
geo AS (
  SELECT c.c_custkey AS custkey, r.r_name AS basin, c.c_mktsegment AS division
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
sales AS (
  SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS order_month,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS ship_month,
         g.basin, g.division,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS ep,
         CAST(l.l_discount AS DECIMAL(4,2)) AS disc
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN geo g ON o.o_custkey = g.custkey),
wm AS (
  SELECT order_month AS m, basin, division, sum(ep * (1 - disc)) AS weighted_fcst
  FROM sales WHERE year(order_month) > 1995 GROUP BY order_month, basin, division),
wq0 AS (
  SELECT {qlabel('m')} AS quarter, basin, division, sum(weighted_fcst) AS s
  FROM wm GROUP BY 1, 2, 3),
wq AS (
  SELECT quarter, basin, division, CAST(s AS DOUBLE) / 1000 AS weighted_fcst FROM wq0
  UNION ALL
  SELECT quarter, 'Worldwide', division, CAST(sum(s) AS DOUBLE) / 1000 FROM wq0
  GROUP BY quarter, division),
rig_cells AS (
  SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS m, g.basin,
         o.o_orderpriority AS environment, count(*) AS n_all,
         count(*) FILTER (WHERE o.o_orderstatus <> 'P') AS n_excl
  FROM orders o JOIN geo g ON o.o_custkey = g.custkey GROUP BY 1, 2, 3),
rig_long AS (
  SELECT m, basin, environment, n_all AS rig_count, 'ALL' AS scenario FROM rig_cells
  WHERE n_all > 0
  UNION ALL
  SELECT m, basin, environment, n_excl, 'EXCL' FROM rig_cells WHERE n_excl > 0),
rig AS (
  SELECT *, sum(rig_count) OVER (PARTITION BY m, basin, scenario) AS rig_total FROM rig_long),
rigb AS (
  SELECT {qlabel('m')} AS quarter, basin,
         avg(rig_total) FILTER (WHERE scenario = 'EXCL') AS rig_ex_china,
         bool_or(scenario = 'EXCL') AS has_ex,
         avg(rig_total) FILTER (WHERE scenario = 'ALL') AS rig_all,
         bool_or(scenario = 'ALL') AS has_all
  FROM rig GROUP BY 1, 2),
rigq AS (
  SELECT quarter, basin, rig_ex_china, has_ex, rig_all, has_all FROM rigb
  UNION ALL
  SELECT quarter, 'Worldwide',
         CASE WHEN bool_or(has_ex) THEN coalesce(sum(rig_ex_china) FILTER (WHERE has_ex), 0) END,
         bool_or(has_ex),
         CASE WHEN bool_or(has_all) THEN coalesce(sum(rig_all) FILTER (WHERE has_all), 0) END,
         bool_or(has_all)
  FROM rigb GROUP BY quarter),
am AS (
  SELECT ship_month AS m, basin, division, sum(ep * (1 - disc)) AS rev,
         sum(ep * (1 - disc) - 0.6 * ep) AS cm
  FROM sales GROUP BY 1, 2, 3),
aq0 AS (
  SELECT {qlabel('m')} AS quarter, basin, division, sum(cm) AS cm, sum(rev) AS rev
  FROM am GROUP BY 1, 2, 3),
aq AS (
  SELECT quarter, basin, division, CAST(cm AS DOUBLE) AS cm, CAST(rev AS DOUBLE) AS rev FROM aq0
  UNION ALL
  SELECT quarter, 'Worldwide', division, CAST(sum(cm) AS DOUBLE), CAST(sum(rev) AS DOUBLE)
  FROM aq0 GROUP BY quarter, division),
cov AS (
  SELECT w.quarter, w.basin, w.division, w.weighted_fcst, r.rig_ex_china, r.rig_all
  FROM wq w JOIN rigq r ON w.quarter = r.quarter AND w.basin = r.basin
  WHERE r.has_ex AND r.has_all),
panel AS (
  SELECT coalesce(c.quarter, a.quarter) AS quarter, coalesce(c.basin, a.basin) AS basin,
         coalesce(c.division, a.division) AS division, c.weighted_fcst, c.rig_ex_china,
         c.rig_all, a.cm, a.rev
  FROM cov c FULL OUTER JOIN aq a
    ON c.quarter = a.quarter AND c.basin = a.basin AND c.division = a.division),
keyed AS (
  SELECT *, basin || '-' || division AS series FROM panel
  WHERE basin IS NULL OR basin <> 'AFRICA'),
oilm AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '5-LOW')
              AS DOUBLE)
           / CAST(nullif(count(*) FILTER (WHERE o_orderpriority = '5-LOW'), 0) AS DOUBLE) AS brent,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '1-URGENT')
              AS DOUBLE)
           / CAST(nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 0) AS DOUBLE) AS wti
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1),
oilq AS (
  SELECT {qlabel('m')} AS quarter, avg(brent) AS brent, avg(wti) AS wti FROM oilm GROUP BY 1),
base AS (
  SELECT k.quarter, k.series, {r2('k.weighted_fcst')} AS pipeline,
         {r2('k.rig_ex_china')} AS rig_ex, {r2('k.rig_all')} AS rig_all,
         {r2('k.cm')} AS cm, {r2('k.rev')} AS rev, {r2('o.brent')} AS brent, {r2('o.wti')} AS wti
  FROM keyed k JOIN oilq o ON k.quarter = o.quarter)"""

BASE_MEASURES = ["pipeline", "rig_ex", "rig_all", "cm", "rev", "brent", "wti"]
FEATURES = [f"{p}_{kind}{k}" for p in COVARIATES for kind, ks in (("lag", LAGS), ("lead", LEADS))
            for k in ks] + [f"rev_lag{k}" for k in LAGS]
FRAME_COLUMNS = ["quarter", "series"] + BASE_MEASURES + FEATURES


def lag_select(partition: str) -> str:
    """Lag/lead columns over ``WINDOW w``."""
    parts = []
    for prefix, src in COVARIATES.items():
        parts += [f"lag({src}, {k}) OVER w AS {prefix}_lag{k}" for k in LAGS]
        parts += [f"lead({src}, {k}) OVER w AS {prefix}_lead{k}" for k in LEADS]
    parts += [f"lag(rev, {k}) OVER w AS rev_lag{k}" for k in LAGS]
    return ",\n  ".join(parts)


def window_clause(partition: str) -> str:
    return f"WINDOW w AS (PARTITION BY {partition} ORDER BY quarter)"


def training_ctes(series: tuple[str, ...] | None = None) -> str:
    series_filter = ""
    if series is not None:
        series_filter = "WHERE series IN (" + ", ".join(f"'{s}'" for s in series) + ")"
    return f""",
tbase AS (SELECT * FROM base {series_filter}),
tfeat AS (SELECT *,
  {lag_select('series')}
  FROM tbase {window_clause('series')}),
train AS (
  SELECT {', '.join(FRAME_COLUMNS)} FROM tfeat
  WHERE quarter >= '{TRAIN_FROM}' AND quarter < '{TRAIN_BEFORE}' AND rev > 0)"""


def frames_ctes(name: str, windows, mask: bool = True) -> str:
    """Inference frames for a list of windows; CTE ``name``."""
    wins = values(windows,
                  ["origin", "mask_from", "buffer_start", "start_q", "end_q", "buffer_end"])
    cm = "CASE WHEN b.quarter < w.mask_from THEN b.cm END" if mask else "b.cm"
    rev = "CASE WHEN b.quarter < w.mask_from THEN b.rev END" if mask else "b.rev"
    filled = ", ".join(f"coalesce({c}, 0) AS {c}" for c in BASE_MEASURES + FEATURES)
    return f""",
{name}_rep AS (
  SELECT w.*, b.quarter, b.series, b.pipeline, b.rig_ex, b.rig_all, {cm} AS cm, {rev} AS rev,
         b.brent, b.wti
  FROM base b CROSS JOIN {wins} w),
{name}_feat AS (SELECT *,
  {lag_select('origin, series')}
  FROM {name}_rep {window_clause('origin, series')}),
{name} AS (
  SELECT origin, quarter, series, {filled} FROM {name}_feat
  WHERE quarter > buffer_start AND quarter < buffer_end AND quarter > start_q
    AND quarter <= end_q)"""


def origins_values() -> str:
    return values([(o, i) for i, o in enumerate(ORIGINS)], ["origin", "k"])


def trend_ctes(series: str = "") -> str:
    """M10 forecasts of both variants for every origin; CTE ``fc``."""
    def d(x):
        return f"CAST({x} AS DOUBLE)"
    sums, tots, lines, avals, seas, preds_s, preds_t = [], [], [], [], [], [], []
    for y in ("rev", "cm"):
        yd = f"CAST({y} AS DECIMAL(22,2))"
        sums += [f"count({y}) AS {y}_n",
                 f"sum(CASE WHEN {y} IS NOT NULL THEN t END) AS {y}_st",
                 f"sum(CASE WHEN {y} IS NOT NULL THEN t * t END) AS {y}_stt",
                 f"sum({yd}) AS {y}_sy", f"sum(t * {yd}) AS {y}_sty"]
        tots += [f"sum({y}_{k}) AS {y}_{k}" for k in ("n", "st", "stt", "sy", "sty")]
        n, st, stt, sy, sty = (d(f"{y}_{k}") for k in ("n", "st", "stt", "sy", "sty"))
        den = f"({n} * {stt} - {st} * {st})"
        lines += [f"CASE WHEN {den} <> 0 THEN ({n} * {sty} - {st} * {sy}) / {den} "
                  f"WHEN {n} > 0 THEN CAST(0 AS DOUBLE) END AS {y}_b",
                  f"{y}_n", f"{y}_st", f"{y}_sy"]
        avals += [f"{y}_b", f"({sy} - {y}_b * {st}) / {n} AS {y}_a"]
        seas.append(f"(CAST(ss.{y}_sy AS DOUBLE) - CAST(ss.{y}_n AS DOUBLE) * l.{y}_a"
                    f" - l.{y}_b * CAST(ss.{y}_st AS DOUBLE)) / CAST(ss.{y}_n AS DOUBLE)"
                    f" AS {y}_s")
        preds_s.append(f"{r2(f'(l.{y}_a + l.{y}_b * h.t) + coalesce(s.{y}_s, 0)')} AS {y}")
        preds_t.append(f"{r2(f'l.{y}_a + l.{y}_b * h.t')} AS {y}")
    return f""",
tr AS (
  SELECT o.origin, t.quarter, t.series, t.rev, t.cm, {qindex('t.quarter')} AS t,
         {qnum('t.quarter')} AS qoy
  FROM train t JOIN {origins_values()} o ON t.quarter < o.origin),
hz AS (
  SELECT DISTINCT origin, quarter, series, {qindex('quarter')} AS t, {qnum('quarter')} AS qoy
  FROM f1),
ss AS (SELECT origin, series, qoy, {', '.join(sums)} FROM tr GROUP BY 1, 2, 3),
tot AS (SELECT origin, series, {', '.join(tots)} FROM ss GROUP BY 1, 2),
line0 AS (SELECT origin, series, {', '.join(lines)} FROM tot),
line AS (SELECT origin, series, {', '.join(avals)} FROM line0),
season AS (
  SELECT ss.origin, ss.series, ss.qoy, {', '.join(seas)}
  FROM ss JOIN line l ON ss.origin = l.origin AND ss.series = l.series),
hl AS (
  SELECT h.*, l.rev_a, l.rev_b, l.cm_a, l.cm_b, s.rev_s, s.cm_s
  FROM hz h LEFT JOIN line l ON h.origin = l.origin AND h.series = l.series
  LEFT JOIN season s ON h.origin = s.origin AND h.series = s.series AND h.qoy = s.qoy),
fc AS (
  SELECT h.origin, h.quarter, h.series, {', '.join(preds_s).replace('l.', 'h.').replace('s.', 'h.')},
         '{TREND_SEASONAL}' AS model FROM hl h
  UNION ALL
  SELECT h.origin, h.quarter, h.series, {', '.join(preds_t).replace('l.', 'h.')},
         '{TREND}' AS model FROM hl h)"""


def snapshot_ctes() -> str:
    refs = origins_values()
    err = ("CASE WHEN round_even((({p} - {a}) / nullif({a}, 0)) * 100, 0) = 0 "
           "THEN CAST(0 AS DOUBLE) ELSE round_even((({p} - {a}) / nullif({a}, 0)) * 100, 0) END")
    return f""",
rrows AS (
  SELECT quarter, series, cm, rev, model, origin AS refresh_date FROM fc
  UNION ALL
  SELECT f.quarter, f.series, f.cm, f.rev, f.model, later.origin
  FROM fc f JOIN {refs} cur ON f.origin = cur.origin
  JOIN {refs} nxt ON nxt.k = cur.k + 1
  JOIN {refs} later ON later.k > cur.k
  WHERE f.quarter < nxt.origin),
truth AS (
  SELECT DISTINCT quarter, series, cm AS actual_contribution_margin, rev AS actual_revenue
  FROM train WHERE cm IS NOT NULL AND rev IS NOT NULL),
vis AS (
  SELECT r.*,
         CASE WHEN r.quarter < r.refresh_date THEN t.actual_contribution_margin END AS acm,
         CASE WHEN r.quarter < r.refresh_date THEN t.actual_revenue END AS arev
  FROM rrows r LEFT JOIN truth t ON r.quarter = t.quarter AND r.series = t.series),
snap AS (
  SELECT DISTINCT quarter, series, {r2('cm')} AS cm, {r2('rev')} AS rev, model,
         {r2('acm')} AS actual_contribution_margin, {r2('arev')} AS actual_revenue,
         {r2(err.format(p='cm', a='acm'))} AS contribution_margin_error,
         {r2(err.format(p='rev', a='arev'))} AS revenue_error,
         strftime({qstart('quarter')}, '%b''%y') AS YM,
         replace(refresh_date, ' ', '') AS refresh_date, series AS level
  FROM vis)"""


def selection_ctes(lookback: int = LOOKBACK_MONTHS) -> str:
    midx = "({y} * 12 + ({n} - 1) * 3)"
    r_m = midx.format(y=qyear("refresh_date"), n=qnum("refresh_date"))
    q_m = midx.format(y=qyear("quarter"), n=qnum("quarter"))
    return f""",
ev AS (
  SELECT * FROM snap
  WHERE floor(CAST({q_m} AS DOUBLE) / 3) > floor(CAST({r_m} - {lookback} AS DOUBLE) / 3)
    AND quarter < refresh_date),
errs AS (
  SELECT * FROM (
    SELECT series, model, refresh_date, avg(abs(revenue_error)) AS abs_rev_error,
           avg(abs(contribution_margin_error)) AS abs_cm_error
    FROM ev GROUP BY 1, 2, 3) e
  WHERE abs_rev_error IS NOT NULL AND abs_cm_error IS NOT NULL),
wins AS (
  SELECT series, refresh_date,
         arg_min(model, {{'e': abs_rev_error, 'm': model}}) AS rev_Model,
         arg_min(model, {{'e': abs_cm_error, 'm': model}}) AS cm_Model
  FROM errs GROUP BY 1, 2)"""


def best_select(rows_from: str | None = None) -> str:
    rev_match = "s.model = w.rev_Model" if rows_from is None else f"s.model = '{rows_from}'"
    cm_match = "s.model = w.cm_Model" if rows_from is None else f"s.model = '{rows_from}'"
    return f""",
rv AS (
  SELECT DISTINCT s.quarter, s.series, s.rev, s.actual_revenue, s.revenue_error, s.YM,
         s.refresh_date, s.level, w.rev_Model
  FROM snap s JOIN wins w ON s.series = w.series AND s.refresh_date = w.refresh_date
   AND {rev_match}),
cr AS (
  SELECT DISTINCT s.quarter, s.series, s.refresh_date, s.cm, s.actual_contribution_margin,
         s.contribution_margin_error, w.cm_Model
  FROM snap s JOIN wins w ON s.series = w.series AND s.refresh_date = w.refresh_date
   AND {cm_match})
SELECT rv.quarter, rv.series, rv.rev, rv.actual_revenue, rv.revenue_error, rv.YM,
       rv.refresh_date, rv.level, rv.rev_Model, cr.cm, cr.actual_contribution_margin,
       cr.contribution_margin_error, cr.cm_Model
FROM rv LEFT JOIN cr ON rv.quarter = cr.quarter AND rv.series = cr.series
 AND rv.refresh_date = cr.refresh_date"""


def margin_ctes(how: str = "inner") -> str:
    return "\n".join(margin_parts(how))


def margin_parts(how: str) -> tuple[str, str]:
    """The CTEs and the final select of a margin frame."""
    own_cols = [c for c in FRAME_COLUMNS if c not in ("quarter", "series", "rev")]
    own_sel = ", ".join(f"nullif({c}, 0) AS {c}" if c.startswith("rev_lag") else c
                        for c in own_cols)
    out_cols = ["rev"] + own_cols
    sel = []
    for c in out_cols:
        if c.startswith("rev_lag"):
            sel.append(f"{r2(f'coalesce(e.{c}_new, o.{c})')} AS {c}")
        elif c == "rev":
            sel.append(f"{r2('e.rev')} AS rev")
        else:
            sel.append(f"{r2('o.' + c)} AS {c}")
    join = "JOIN" if how == "inner" else "RIGHT JOIN"
    keys = "o.origin AS origin, o.quarter AS quarter, o.series AS series"
    if how == "inner":
        keys = "e.origin AS origin, e.quarter AS quarter, e.series AS series"
    body = f"""SELECT {keys}, {', '.join(sel)}
  FROM ext e {join} own o ON e.origin = o.origin AND e.quarter = o.quarter
   AND e.series = o.series"""
    if how == "right":
        notnull = " AND ".join(f"{c} IS NOT NULL" for c in ["origin", "quarter", "series"]
                               + out_cols)
        body = f"SELECT * FROM ({body}) m WHERE {notnull}"
    lags = ", ".join(f"lag(rev, {k}) OVER w AS rev_lag{k}_new" for k in LAGS)
    ctes = f""",
own AS (SELECT origin, quarter, series, {own_sel} FROM f2),
chained AS (
  SELECT origin, quarter, series, rev FROM fc WHERE model = '{TREND_SEASONAL}'
  UNION ALL
  SELECT origin, quarter, series, rev FROM f2 WHERE quarter < origin),
ext AS (
  SELECT * FROM (
    SELECT origin, quarter, series, rev, {lags} FROM chained
    WINDOW w AS (PARTITION BY origin, series ORDER BY quarter)) x
  WHERE quarter >= origin)"""
    return ctes, body


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts)


def build() -> dict[str, str]:
    panel = PANEL_CTES
    train = training_ctes()
    f1 = frames_ctes("f1", STAGE1)
    f2 = frames_ctes("f2", STAGE2)
    trend = trend_ctes()
    snap = snapshot_ctes()
    sel = selection_ctes()
    fitted = ridge_oracle.forecasts(sys.modules[__name__])
    frame_cols = ", ".join(FRAME_COLUMNS)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in FRAME_COLUMNS)
    single = frames_ctes("fs", STAGE1[:1])
    single_unmasked = frames_ctes("fs", STAGE1[:1], mask=False)
    recency = f"""{panel}{train},
rw AS (
  SELECT o.origin, t.quarter, t.series, {{date}} AS d
  FROM train t JOIN {origins_values()} o ON t.quarter < o.origin WHERE {complete}),
nw AS (SELECT origin, max(d) AS newest FROM rw GROUP BY origin)
SELECT rw.origin, rw.quarter, rw.series,
       CAST(datediff('day', rw.d, nw.newest) AS BIGINT) AS days_elapsed,
       CAST(CASE WHEN datediff('day', rw.d, nw.newest) < 90 THEN 1.0
            WHEN datediff('day', rw.d, nw.newest) < 270 THEN 0.9
            WHEN datediff('day', rw.d, nw.newest) < 360 THEN 0.8
            WHEN datediff('day', rw.d, nw.newest) < 540 THEN 0.7 ELSE 0.5 END AS DOUBLE)
         AS weight
FROM rw JOIN nw ON rw.origin = nw.origin"""
    literal_date = f"make_date({qyear('t.quarter')}, {qnum('t.quarter')}, 1)"
    return {
        "weighted_fcst_monthly": _with(panel) + """
SELECT strftime(m, '%Y-%m') AS year_month, basin, division,
       CAST(weighted_fcst AS DOUBLE) AS weighted_fcst FROM wm""",
        "quarterly_with_worldwide": _with(panel) + """
SELECT quarter, basin, division, weighted_fcst FROM wq""",
        "rig_mean_worldwide": _with(panel) + f"""
SELECT quarter, basin, {r2('rig_ex_china')} AS rig_ex_china, {r2('rig_all')} AS rig_all
FROM rigq""",
        "actuals_by_scenario": _with(panel) + """
SELECT quarter, basin, division, cm, rev FROM aq""",
        "actuals_bucketed": _with(panel) + """
SELECT quarter, basin, division, cm, rev FROM aq""",
        "oil_quarterly": _with(panel) + f"""
SELECT quarter, {r2('brent')} AS brent, {r2('wti')} AS wti FROM oilq""",
        "assemble_panel": _with(panel) + f"""
SELECT quarter, basin, division, {r2('weighted_fcst')} AS weighted_fcst,
       {r2('rig_ex_china')} AS rig_ex_china, {r2('rig_all')} AS rig_all, {r2('cm')} AS cm,
       {r2('rev')} AS rev, series FROM keyed""",
        "training_frame": _with(panel, train) + "\nSELECT * FROM train",
        "worldwide_training_frame": _with(panel, training_ctes(WORLDWIDE_SERIES)) + "\nSELECT * FROM train",
        "inference_frame": _with(panel, single) + f"\nSELECT {frame_cols} FROM fs",
        "inference_frame_unmasked": _with(panel, single_unmasked)
        + f"\nSELECT {frame_cols} FROM fs",
        "walk_forward_frames": _with(panel, f1) + "\nSELECT * FROM f1",
        "recency_weights": "WITH " + recency.replace("{date}", qstart("t.quarter")),
        "recency_weights_literal": "WITH " + recency.replace("{date}", literal_date),
        "trend_seasonal_forecast": _with(panel, train, f1, trend) + "\nSELECT * FROM fc",
        "listed_trend_forecast": _with(panel, train, f1, trend)
        + "\nSELECT * FROM fc WHERE series IN ("
        + ", ".join(f"'{s}'" for s in WORLDWIDE_SERIES) + ")",
        "margin_inference_inner": _with(panel, train, f1, f2, trend, margin_ctes("inner")),
        "margin_inference_right": _with(panel, train, f1, f2, trend, margin_ctes("right")),
        "ground_truth": _with(panel, train) + f"""
SELECT DISTINCT quarter, series, cm AS actual_contribution_margin, rev AS actual_revenue
FROM train WHERE quarter < '{ORIGINS[0]}' AND cm IS NOT NULL AND rev IS NOT NULL""",
        "score_forecasts": _with(panel, train, f1, trend, snap) + "\nSELECT * FROM snap",
        "latest_snapshot": _with(panel, train, f1, trend, snap)
        + "\nSELECT * FROM snap WHERE refresh_date = (SELECT max(refresh_date) FROM snap)",
        "earliest_snapshot": _with(panel, train, f1, trend, snap)
        + "\nSELECT * FROM snap WHERE refresh_date = (SELECT min(refresh_date) FROM snap)",
        "model_errors": _with(panel, train, f1, trend, snap, sel) + "\nSELECT * FROM errs",
        "model_errors_short_window": _with(panel, train, f1, trend, snap, selection_ctes(4))
        + "\nSELECT * FROM errs",
        "winning_models": _with(panel, train, f1, trend, snap, sel) + "\nSELECT * FROM wins",
        "best_model": _with(panel, train, f1, trend, snap, sel, best_select()),
        "best_model_fixed_family": _with(panel, train, f1, trend, snap, sel,
                                         best_select(TREND)),
        "additive_frame": _with(panel, train) + f"""
SELECT d.*, {r2('o.brent')} AS brent, {r2('o.wti')} AS wti
FROM (SELECT DISTINCT quarter, series, pipeline, rig_ex, rig_all, cm, rev FROM train) d
LEFT JOIN oilq o ON d.quarter = o.quarter""",
        "combine_stage_forecasts": _with(panel, train, f1, trend) + f"""
SELECT c.origin, c.quarter, c.series, c.cm, r.rev
FROM (SELECT * FROM fc WHERE model = '{TREND}') c
JOIN (SELECT DISTINCT origin, quarter, series, rev FROM fc WHERE model = '{TREND_SEASONAL}') r
  ON c.origin = r.origin AND c.quarter = r.quarter AND c.series = r.series""",
        "two_series_forecast": _with(panel, train, f1, trend)
        + "\nSELECT * FROM fc WHERE series IN (" + ", ".join(f"'{s}'" for s in TWO_SERIES) + ")",
        "inspect_models": _with(panel, train, f1, trend, snap)
        + f"\nSELECT * FROM snap WHERE series = '{TWO_SERIES[0]}' "
        f"AND model IN ('{TREND}', '{TREND_SEASONAL}')",
        **model_parts(_with(panel, train), _with(panel, train, f1), complete),
        **fitted,
        "ridge_backtest_best": _with(panel, train, f1, trend.replace("\nfc AS (", "\nfc0 AS ("), f""",
fc AS (
  SELECT origin, quarter, series, rev, cm, model FROM fc0
  UNION ALL SELECT origin, quarter, series, rev, cm, model FROM ({fitted['additive_ridge_forecast']})
  UNION ALL SELECT origin, quarter, series, rev, cm, model FROM ({fitted['ar_direct_forecast']}))""", snap, sel, best_select()),
    }


# --- parts of the fitted families ------------------------------------------------

# The model feature lists.
REV_LIST = (["pipeline", "rig_ex", "brent", "wti"]
            + [f"{v}_{k}" for v in ("rig_ex", "pipeline", "wti", "brent")
               for k in ("lag1", "lag2", "lag3", "lead1", "lead2")])
CM_LIST = ["rev", *REV_LIST, "rev_lag1", "rev_lag2", "rev_lag3"]
SHORT_LIST = ("pipeline", "brent", "wti")
AR_COLUMNS = ("cm", "rev", "rev_lag1", "rev_lag2", "rev_lag3")


def model_parts(train: str, frames: str, complete: str) -> dict[str, str]:
    sets = f""",
tr AS (
  SELECT o.origin, t.*, CAST({qindex('t.quarter')} AS DOUBLE) AS t, {qnum('t.quarter')} AS qoy
  FROM train t JOIN {origins_values()} o ON t.quarter < o.origin WHERE {complete})"""
    season = ", ".join(f"CAST(qoy = {k} AS INTEGER)::DOUBLE AS q{k}" for k in (2, 3, 4))
    own = ", ".join(c if c in SHORT_LIST else
                    f"CASE WHEN series LIKE 'Worldwide-%' THEN 0.0::DOUBLE ELSE {c} END AS {c}"
                    for c in CM_LIST)
    wide = [f"lag({c}, {k}) OVER w AS {c}_{k}" for c in AR_COLUMNS for k in range(1, 8)]
    picked = [f"CASE h {' '.join(f'WHEN {h} THEN {c}_{h + k}' for h in range(1, 5))} END AS {c}_ar{k}"
              for c in AR_COLUMNS for k in range(4)]
    steps = "(SELECT unnest([1, 2, 3, 4])::BIGINT AS h)"
    rev_lags = [f"lag(rev, {k}) OVER w AS rev_{k}" for k in range(1, 8)]
    rev_picked = [f"CASE h {' '.join(f'WHEN {h} THEN rev_{h + k}' for h in range(1, 5))} END AS a{k}"
                  for k in range(4)]
    live = lambda cols: " + ".join(f"(count(DISTINCT {c}) > 1)::BIGINT" for c in cols)
    terms = ["t", "(qoy = 2)", "(qoy = 3)", "(qoy = 4)"]
    changing = ridge_oracle.season_columns("quarter", qnum, qindex, ridge_oracle.CHANGES, True)
    fixed = ("0.0::DOUBLE + 1.0::DOUBLE * 10.0::DOUBLE + CAST(%s AS DOUBLE) * 0.5::DOUBLE" % qindex("quarter")
             + "".join(f" + CAST({qnum('quarter')} = {k} AS INTEGER)::DOUBLE * {k - 1}.0::DOUBLE" for k in (2, 3, 4))
             + "".join(f" + {c} * 0.001::DOUBLE" for c in REV_LIST))
    return {
        "additive_design": f"""{train}{sets}
SELECT origin, quarter, series, t, {season}, {own}, cm FROM tr""",
        "ar_samples": f"""{train}{sets},
lg AS (
  SELECT origin, quarter, series, cm AS target, {', '.join(wide)} FROM tr
  WINDOW w AS (PARTITION BY origin, series ORDER BY quarter))
SELECT origin, quarter, series, h, {', '.join(picked)}, target AS cm FROM lg CROSS JOIN {steps}""",
        "additive_normal_equations": f"""{train}{sets}
SELECT origin, series, count(*) AS n_rows, {live(terms + REV_LIST)} AS n_live, true AS solved
FROM tr GROUP BY origin, series""",
        "additive_changes_design": f"""{train}{sets}
SELECT DISTINCT quarter, series, {', '.join(f"{e} AS {n}" for n, e in changing.items())}, pipeline, rev FROM (
  SELECT * FROM train WHERE {complete})""",
        "additive_block_equations": f"""{train}{sets}
SELECT origin, series, count(*) AS n_rows, {live([*changing.values(), *REV_LIST])} AS n_live, true AS solved
FROM tr GROUP BY origin, series""",
        "additive_recency_equations": f"""{train}{sets}
SELECT origin, series, count(*) AS n_rows, {live(terms + REV_LIST)} AS n_live, true AS solved
FROM tr GROUP BY origin, series""",
        "ar_normal_equations": f"""{train}{sets},
lg AS (
  SELECT *, {', '.join(rev_lags)} FROM tr
  WINDOW w AS (PARTITION BY origin, series ORDER BY quarter)),
sm AS (SELECT *, {', '.join(rev_picked)} FROM lg CROSS JOIN {steps})
SELECT origin, series, h, count(*) AS n_rows, {live(['a0', 'a1', 'a2', 'a3'] + REV_LIST)} AS n_live,
       true AS solved
FROM sm WHERE a3 IS NOT NULL GROUP BY origin, series, h""",
        "additive_fixed_scores": f"""{frames}
SELECT origin, quarter, series,
       CASE WHEN series LIKE 'Worldwide-%' THEN {r2(fixed)} ELSE 0.0::DOUBLE END AS rev FROM f1""",
        "ar_fixed_scores": f"""{frames}{sets},
last AS (
  SELECT origin, series, rev, row_number() OVER (PARTITION BY origin, series ORDER BY quarter DESC) AS k FROM tr),
l4 AS (
  SELECT origin, series, {', '.join(f'max(rev) FILTER (k = {k}) AS v{k}' for k in range(1, 5))}
  FROM last GROUP BY 1, 2),
st AS (SELECT *, {qindex('quarter')} - {qindex('origin')} + 1 AS h FROM f1)
SELECT s.origin, s.quarter, s.series,
       CASE WHEN s.series LIKE 'Worldwide-%' AND h BETWEEN 1 AND 4 THEN {r2("0.0::DOUBLE + 1.0::DOUBLE * h::DOUBLE"
       + "".join(f" + coalesce(v{k}, 0.0::DOUBLE) * 0.25::DOUBLE" for k in range(1, 5)))}
       ELSE 0.0::DOUBLE END AS rev
FROM st s LEFT JOIN l4 ON s.origin = l4.origin AND s.series = l4.series""",
        "forest_ranked_design": f"""{train}{sets},
ms AS (
  SELECT origin, series, regexp_replace(series, '-[^-]*$', '') AS basin, regexp_extract(series, '([^-]*)$', 1) AS division,
         sum(CAST(rev AS DECIMAL(22,2)) * 100) AS s, count(*) AS n FROM tr GROUP BY 1, 2),
mm AS (
  SELECT origin, series, {', '.join(
      f"CAST(sum(CAST(abs({c}) AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS {c}_size"
      for c in ("rev", "pipeline", "wti", "rig_ex_lag1"))} FROM tr GROUP BY 1, 2),
sh AS (
  SELECT origin, series, CAST(s AS DOUBLE) / n / 100 AS mean,
         CAST(sum(s) OVER (PARTITION BY origin, basin) AS DOUBLE) / sum(n) OVER (PARTITION BY origin, basin) / 100 AS bm,
         CAST(sum(s) OVER (PARTITION BY origin, division) AS DOUBLE) / sum(n) OVER (PARTITION BY origin, division) / 100 AS dm
  FROM ms),
rk AS (
  SELECT t.origin, t.quarter, t.series, t.rev, t.pipeline, t.wti, t.rig_ex_lag1, {', '.join(
      f"CAST(count(*) FILTER (u.{c} < t.{c}) + count(*) FILTER (u.{c} <= t.{c}) AS DOUBLE) / (2.0::DOUBLE * count(*)) AS r_{c}"
      for c in ("pipeline", "wti", "rig_ex_lag1"))}
  FROM tr t JOIN tr u ON t.origin = u.origin AND t.series = u.series GROUP BY ALL)
SELECT rk.origin, rk.quarter, rk.series, r_pipeline, r_wti, r_rig_ex_lag1, rk.pipeline / pipeline_size AS m_pipeline,
       rk.wti / wti_size AS m_wti, rk.rig_ex_lag1 / rig_ex_lag1_size AS m_rig_ex_lag1, sh.mean / sh.bm AS basin_share,
       sh.mean / sh.dm AS division_share, rk.rev / rev_size AS ratio
FROM rk JOIN sh ON rk.origin = sh.origin AND rk.series = sh.series
JOIN mm ON rk.origin = mm.origin AND rk.series = mm.series""",
        "forest_fixed_scores": f"""{frames.replace("WITH ", "WITH RECURSIVE ", 1)},
nd AS (SELECT * FROM (VALUES (0, 0, 'pipeline', 2500.0, 1, 2, 1.0), (0, 1, 'rig_ex', 40.5, 3, 4, 2.0),
  (0, 2, 'wti', 150000.0, 5, 6, 3.0), (0, 3, NULL, NULL, NULL, NULL, 10.5), (0, 4, NULL, NULL, NULL, NULL, 20.25),
  (0, 5, NULL, NULL, NULL, NULL, 30.125), (0, 6, 'brent_lag1', 151000.0, 7, 8, 4.0), (0, 7, NULL, NULL, NULL, NULL, 40.0),
  (0, 8, NULL, NULL, NULL, NULL, 50.0), (1, 0, NULL, NULL, NULL, NULL, 7.0), (2, 0, 'brent_lag1', 149000.0, 1, 2, 5.0),
  (2, 1, NULL, NULL, NULL, NULL, -8.0), (2, 2, 'pipeline', 9000.0, 3, 4, 6.0), (2, 3, NULL, NULL, NULL, NULL, 60.75),
  (2, 4, NULL, NULL, NULL, NULL, 70.5)) AS v(tree, node, feature, threshold, lt, rt, value)),
walk AS (
  SELECT origin, quarter, series, {{'pipeline': pipeline, 'rig_ex': rig_ex, 'wti': wti, 'brent_lag1': brent_lag1}} AS x,
         tree, 0 AS node FROM f1 CROSS JOIN (SELECT unnest([0, 1, 2]) AS tree)
  UNION ALL
  SELECT w.origin, w.quarter, w.series, w.x, w.tree,
         CASE WHEN (CASE n.feature WHEN 'pipeline' THEN w.x.pipeline WHEN 'rig_ex' THEN w.x.rig_ex WHEN 'wti' THEN w.x.wti
                    ELSE w.x.brent_lag1 END) <= n.threshold THEN n.lt ELSE n.rt END
  FROM walk w JOIN nd n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NOT NULL)
SELECT w.origin, w.quarter, w.series, {r2('sum(n.value::DOUBLE) / 3.0::DOUBLE')} AS rev
FROM walk w JOIN nd n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NULL
GROUP BY w.origin, w.quarter, w.series""",
        "forest_design": f"""{train}{sets},
ms AS (
  SELECT origin, series, regexp_replace(series, '-[^-]*$', '') AS basin,
         regexp_extract(series, '([^-]*)$', 1) AS division,
         sum(CAST(rev AS DECIMAL(22,2)) * 100) AS s, count(*) AS n FROM tr GROUP BY 1, 2),
mm AS (
  SELECT origin, series, CAST(s AS DOUBLE) / n / 100 AS series_mean,
         CAST(sum(s) OVER (PARTITION BY origin, basin) AS DOUBLE)
           / sum(n) OVER (PARTITION BY origin, basin) / 100 AS basin_mean,
         CAST(sum(s) OVER (PARTITION BY origin, division) AS DOUBLE)
           / sum(n) OVER (PARTITION BY origin, division) / 100 AS division_mean
  FROM ms)
SELECT t.origin, t.quarter, t.series, m.series_mean, m.basin_mean, m.division_mean, t.rev
FROM tr t JOIN mm m ON t.origin = m.origin AND t.series = m.series""",
    }
