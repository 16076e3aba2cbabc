"""Operator 8: mixing sources to target weights [native: DataFrame functions only].

A document's place on its source's hash line is a 60-bit hash of its id. A budget
for a source is a threshold on that line, and a larger budget takes a superset of
a smaller one (nested thresholds). To find the threshold, sizes are summed by
(source, bucket of ten leading hash bits); the bucket in which the budget falls
is the only one refined, by the next ten bits, three times over. What is left in
the boundary bucket after 30 bits (one part in 10^9 of a source) is summed by
full hash value and cut exactly. Documents are then filtered by comparing their
hash with the threshold: nothing is sorted, and every histogram is pre-aggregated
map-side, so a source holding a third of all rows is 1024 rows per task.

Targets: ``total_share`` times all sizes is shared by weight; a source takes
``max_repeat`` times its size at most, and the excess is shared again by weight
until no source is above. A source is taken ``floor(target / size)`` times whole;
the rest of the target is the budget. A document (or documents of one hash value)
is inside the budget if its midpoint is, which leaves a source within half a
document of its target.

Edge cases: a null text has size 0; sources of size 0 have target 0 and their
documents are not taken; a null source is a source of its own and comes last; a
null id hashes its text instead; rows repeated under one id are taken alike;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, narrow, word_count

HASH_DIGITS, STEP_BITS, LEVELS = 15, 10, 3
HASH_BITS = 4 * HASH_DIGITS


def hash_line(key: Column) -> Column:
    """60-bit place on the hash line, the same in any engine that has MD5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def size_and_place(id_: Column, text: Column) -> tuple[Column, Column]:
    """Words of a text, and its place on the hash line of its source."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    key = F.coalesce(id_.cast("long").cast("string"), F.concat(F.lit("text:"), text))
    return word_count(text), hash_line(key)


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """``id, source, size, place``."""
    rows = narrow(docs, id_col, text_col, source=source_col)
    size, place = size_and_place(F.col("id"), F.col("text"))
    return rows.select("id", F.col("source").cast("string").alias("source"),
                       size.alias("size"), place.alias("place"))


def cycle_weights(sources: DataFrame, cycle: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """Weights by code-point rank of the source, null last, repeating ``cycle``.

    ``sources`` has one row per source (a mixing table, thousands at most)."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in cycle]), (rank % len(cycle) + 1).cast("int")).cast("long"))


def targets(weighted: DataFrame, share: tuple[int, int] = (3, 2), max_repeat: int = 2) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size, weight``.

    Sources are capped in ascending order of cap per weight. All sums are exact
    integers and the target is a single division, so reruns agree bit for bit.
    """
    up, down = share
    cap = F.lit(max_repeat) * F.col("source_size")
    live = weighted.withColumn("cap", cap)
    whole = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    steps = (live
             .withColumn("budget", F.sum("source_size").over(whole) * up)  # times 1 / down
             .withColumn("all_w", F.sum("weight").over(whole))
             .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), none))
             .withColumn("w_before", F.coalesce(F.sum("weight").over(before), none))
             .withColumn("capped", F.col("cap") * down * (F.col("all_w") - F.col("w_before"))
                         <= F.col("weight") * (F.col("budget") - down * F.col("cap_before")))
             .withColumn("cap_sum", F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), none))
             .withColumn("free_w", F.col("all_w") - F.coalesce(
                 F.sum(F.when(F.col("capped"), F.col("weight"))).over(whole), none)))
    shared = ((F.col("weight") * (F.col("budget") - down * F.col("cap_sum"))).cast("double")
              / (F.lit(down) * F.col("free_w")).cast("double"))
    return steps.select("source", "source_size", F.when(
        F.col("capped"), F.col("cap").cast("double")).otherwise(shared).alias("target"))


def _crossing(hist: DataFrame, key: str) -> DataFrame:
    """Adds the sums before each bucket and keeps the one the budget falls in."""
    run = Window.partitionBy("source").orderBy(key)
    before = F.col("base") + F.sum("sum").over(run) - F.col("sum")
    return (hist.withColumn("before", before)
            .filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("sum"))))


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, threshold``: documents with ``place < threshold`` are in the budget.

    ``budgets`` has ``source, rest``, with rest at least 0 and below the source's size.
    """
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    edge = budgets.select("source", "rest", F.lit(0).cast("long").alias("base"),
                          F.lit(0).cast("long").alias("bucket"))
    left = sizes.select("source", "size", "place").filter("size > 0")
    for level in range(1, LEVELS + 1):
        bits = HASH_BITS - STEP_BITS * level
        rows = left.withColumn("fine", F.shiftright("place", bits))
        hit = rows.join(edge, same(rows, edge) & (F.shiftright(rows["fine"], STEP_BITS) == edge["bucket"])).drop(edge["source"])
        hist = hit.groupBy("source", "rest", "base", "fine").agg(F.sum("size").alias("sum"))
        edge = cut_lineage(_crossing(hist, "fine").select(
            "source", "rest", F.col("before").alias("base"), F.col("fine").alias("bucket")))
    rows = left.withColumn("fine", F.shiftright("place", HASH_BITS - STEP_BITS * LEVELS))
    last = rows.join(edge, same(rows, edge) & (rows["fine"] == edge["bucket"])).drop(edge["source"])
    exact = (last.groupBy("source", "rest", "base", "bucket", "place").agg(F.sum("size").alias("sum"))
             .withColumn("before", F.col("base") + F.sum("sum").over(
                 Window.partitionBy("source").orderBy("place")) - F.col("sum")))
    outside = F.when(F.col("before") + F.col("sum") / 2 > F.col("rest"), F.col("place"))
    above = F.shiftleft(F.col("bucket") + 1, HASH_BITS - STEP_BITS * LEVELS)
    return exact.groupBy("source").agg(F.coalesce(F.min(outside), F.max(above)).alias("threshold"))


def source_plan(sizes: DataFrame, weights: DataFrame | None = None, share: tuple[int, int] = (3, 2),
                max_repeat: int = 2, cycle: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """One row per source: ``p_source, source_size, target, whole, threshold``. A document
    is taken ``whole`` times, and once more if its place is below the threshold.

    ``weights`` (``source, weight`` with positive integers) replaces the weights by
    rank; sources missing from it are left out of the mix (target 0)."""
    by_source = cut_lineage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    if weights is None:
        weighted = cycle_weights(by_source, cycle)
    else:
        w = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("long").alias("weight"))
        weighted = by_source.join(w, F.col("source").eqNullSafe(F.col("w_source"))).drop("w_source")
    plan = cut_lineage(
        targets(weighted, share, max_repeat)
        .withColumn("whole", F.when(F.col("source_size") > 0,
                                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    cut = cut_lineage(thresholds(sizes, plan.filter("source_size > 0")))
    cut = cut.select(F.col("source").alias("c_source"), "threshold")
    plan = (plan.select(F.col("source").alias("t_source"), "target", "whole")
            .join(cut, F.col("t_source").eqNullSafe(F.col("c_source")), "left"))
    zero = F.lit(0).cast("long")
    return cut_lineage(
        by_source.join(plan, F.col("source").eqNullSafe(F.col("t_source")), "left").select(
            F.col("source").alias("p_source"), "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
            F.coalesce("whole", zero).alias("whole"), F.coalesce("threshold", zero).alias("threshold")))


def copies(size: Column, place: Column) -> Column:
    """How often a document joined with its source's plan is taken."""
    return F.when(size > 0, F.col("whole") + (place < F.col("threshold")).cast("long")).otherwise(0).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **options) -> DataFrame:
    """``id, source, size, place, source_size, target, copies`` for every row of ``docs``."""
    sizes = cut_lineage(sized(docs, id_col, text_col, source_col))
    plan = source_plan(sizes, **options)
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
    return joined.select("id", "source", "size", "place", "source_size", "target",
                         copies(F.col("size"), F.col("place")).alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          **options) -> DataFrame:
    """The rows of the mix with all columns of ``docs``, a repeated document once per copy.
    Rows are judged where they stand, against the plan of their source; texts don't move."""
    plan = source_plan(cut_lineage(sized(docs, id_col, text_col, source_col)), **options)
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    size, place = size_and_place(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    joined = docs.join(plan, F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col("__p_source")))
    n = F.when(size > 0, F.col("__whole") + (place < F.col("__threshold")).cast("long")).otherwise(0)
    out = joined.withColumn("__n", n).filter("__n > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n").cast("long"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
