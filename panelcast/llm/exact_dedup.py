"""Operator 3: exact dedup by 128-bit content hash with a byte comparison.

1. Every text gets a 128-bit MD5 of its UTF-8 bytes; rows are counted per hash
   with map-side combine, so a group of a third of all rows is one row per task
   when it reaches the shuffle. No text moves in this step.
2. Only hashes held by two or more rows go on. Their rows are grouped by (hash,
   *whole text*): Spark's aggregate compares the bytes of the key, which makes
   this the byte comparison inside the group, again with map-side combine.
   A hash with two different texts is a collision, and each of its texts becomes
   a class of its own.
3. Rows join back by hash (collided hashes by hash and text). The class table is
   written first, so both sides of the join are plain exchanges and the adaptive
   planner can split a hot group.

Edge cases: a null text counts as empty (all empty texts form one group); a null
id never wins over another id, and a group of null ids only keeps null; rows
repeated under one id count each, and every row with the kept id is kept; rows
without an id can't be addressed, so ``exact_dedup`` leaves them in; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, narrow


def content_hash(text: Column) -> Column:
    """128-bit hash of the UTF-8 bytes, as 16 raw bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep: str = "smallest",
                  hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """``id, hash, text_sha256, keep_id, group_size`` for every row of ``docs``.

    ``keep`` is "smallest" or "largest" (id). ``hash_of`` can be weakened in
    tests to force collisions; the result does not depend on it.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    base = narrow(docs, id_col, text_col).select(
        "id", "text", hash_of(F.col("text")).alias("hash"))
    held_twice = cut_lineage(base.groupBy("hash").count().filter("count > 1").select("hash"))
    classes = cut_lineage(
        base.join(held_twice, "hash", "left_semi").groupBy("hash", "text")
        .agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    per_hash = classes.groupBy("hash").agg(
        F.count(F.lit(1)).alias("texts"), F.first("keep_id").alias("keep_id"),
        F.first("group_size").alias("group_size"))
    one_text = cut_lineage(per_hash.filter("texts = 1").drop("texts"))
    collided = cut_lineage(per_hash.filter("texts > 1").select("hash"))
    rows = base.select("id", "hash", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    joined = rows.join(one_text, "hash", "left").join(
        collided.withColumn("hit", F.lit(True)), "hash", "left")
    plain = joined.filter("hit is null").select(
        "id", "hash", "text_sha256",
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    odd = (base.join(collided, "hash", "left_semi")
           .join(classes, ["hash", "text"])
           .select("id", "hash", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
                   "keep_id", "group_size"))
    return plain.unionByName(odd)


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str,
            key_of: Callable[[Column], Column]) -> DataFrame:
    """``docs`` less the rows whose id and text key are in ``gone`` (``id, key``).
    Rows without an id can't be named and stay."""
    names = gone.distinct().select(F.col("id").alias("__id"), F.col("key").alias("__key"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    same = (F.col(f"`{id_col}`").cast("long") == F.col("__id")) & (key_of(text) == F.col("__key"))
    # The list grows with the corpus: merged, not broadcast, at any size.
    return docs.join(cut_lineage(names).hint("merge"), same, "left_anti")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    classes = exact_classes(docs, id_col, text_col, keep)
    gone = classes.filter(~F.col("id").eqNullSafe(F.col("keep_id"))).select("id", F.col("hash").alias("key"))
    return without(docs, gone, id_col, text_col, content_hash)
