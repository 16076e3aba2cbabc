"""Side-by-side check of a registered Spark query against its DuckDB oracle.

Usable from pytest and as a script:
``python tests/oracle_compare.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v  # -0.0 stays distinct from 0.0: a value hash may tell them apart
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canonical(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, repr(x)) for x in r))


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    spark_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s = sdf.toPandas()
    t1 = time.time()
    con = con or duck(sf_dir)
    d = con.execute(sql).df()
    t2 = time.time()
    out = {"query": name, "spark_rows": len(s), "oracle_rows": len(d),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    out["columns_match"] = sorted(s.columns) == sorted(d.columns)
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(s.columns) - set(d.columns))
        out["oracle_only"] = sorted(set(d.columns) - set(s.columns))
        out["match"] = False
        return out
    a, b = canonical(s), canonical(d)
    out["values_match"] = [tuple(map(repr, r)) for r in a] == [tuple(map(repr, r)) for r in b]
    if not out["values_match"] and len(a) == len(b):
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        out["n_diff_rows"] = len(diffs)
        out["example"] = diffs[:2]
    out["types"] = spark_types
    out["match"] = out["values_match"] and len(s) == len(d)
    return out


def main(argv: list[str]) -> int:
    from panelcast.plans.oracle import build
    from panelcast.plans.queries import registry
    from panelcast.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    sqls, queries = build(), registry()
    names = argv[2:] or list(sqls)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, queries[n], sqls[n], con)
        except Exception as e:  # report and continue
            r = {"query": n, "match": False, "error": repr(e)[:800]}
        bad += not r["match"]
        r.pop("types", None)
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
