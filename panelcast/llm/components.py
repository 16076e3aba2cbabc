"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (map-side combine) joined back to the edges. The
minima are written before the join, so both sides of it are plain exchanges and a
hub with a third of all edges can be split by the adaptive planner. The number of
rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).head()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node reachable) for all nodes of ``edges`` (``a, b``:
    long or any ordered type); loops and repeated edges are allowed."""
    kind = dict(edges.dtypes)["a"]
    loops = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    now = cut_lineage(edges.filter("a != b").select(
        F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct())
    state = _state(now)
    while state[0]:
        both = now.union(now.select("y", "x"))
        low = cut_lineage(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")))
        large = both.filter("y > x").join(low, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        large = cut_lineage(large)
        low = cut_lineage(large.groupBy("x").agg(F.min("y").alias("m")))
        met = large.join(low, "x")
        now = cut_lineage(met.select("x", F.col("m").alias("y"))
                          .union(met.filter("y != m").select("y", "m")).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("x").alias("node"), F.col("y").alias("root"))
    return (loops.join(cut_lineage(roots), "node", "left")
            .select("node", F.coalesce("root", "node").cast(kind).alias("root")))
