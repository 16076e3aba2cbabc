"""M2 in relational terms: a fitted forest as a table of nodes, scored by repeated joins.

``nodes`` has one row per node: tree, node (0 is the root), feature (position in the
vector, NULL in a leaf), threshold (``x <= threshold`` goes left), left, right, value. It
needs no model library to score, can be written, joined and inspected like any table,
and is the same on every engine. A row visits one node per tree and level; the join of a
level keeps the partitioning of the rows where the planner finds the table small enough to
broadcast, and shuffles by (tree, node) otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double"


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The node table of a saved MLlib tree ensemble (its ``data`` folder)."""
    n = F.col("nodeData")
    leaf = n["leftChild"] < 0
    child = lambda side: F.when(~leaf, n[side])
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(~leaf, n["split"]["featureIndex"]).alias("feature"),
        F.when(~leaf, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        child("leftChild").alias("left"), child("rightChild").alias("right"), n["prediction"].alias("value"))


def tree_shape(nodes: DataFrame) -> tuple[int, int]:
    """Number of trees and the most levels below a root, by walking the table down."""
    n_trees = nodes.where("node = 0").count()
    level, depth = nodes.where("node = 0").select("tree", "node"), 0
    below = nodes.where("left is not null").select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
    while True:
        level = below.join(level, ["tree", "node"], "left_semi").select("tree", F.col("child").alias("node"))
        if level.isEmpty():
            return n_trees, depth
        depth += 1


def score_nodes(rows: DataFrame, nodes: DataFrame, keys: Sequence[str], features: Sequence[str], n_trees: int,
                depth: int) -> DataFrame:
    """``keys, score``: the mean of the leaves each row falls into. A NULL feature counts as
    0 (N2). Keys identify a row; trees are numbered from 0."""
    keys = list(keys)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    at = rows.select(*keys, x.alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"),
                     F.lit(0).alias("node"))
    inner = nodes.where("left is not null").select("tree", "node", "feature", "threshold", "left", "right")
    for _ in range(depth):
        goes_left = F.get("_x", F.col("feature")) <= F.col("threshold")
        here = F.when(F.col("left").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, ["tree", "node"], "left").select(*keys, "_x", "tree", here.alias("node"))
    leaves = at.join(nodes.select("tree", "node", "value"), ["tree", "node"]).select(*keys, "tree", "value")
    # Summed in the order of the trees, so the mean does not depend on partitioning.
    found = F.sort_array(F.collect_list(F.struct("tree", "value")))
    total = F.aggregate(found, F.lit(0.0), lambda acc, v: acc + v["value"])
    return leaves.groupBy(*keys).agg((total / F.lit(n_trees)).alias("score"))
