"""The registered queries of this subpackage: each applies one operator, with its
production parameters, to its whole table and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import cluster_vectors
from .common import table
from .exact_dedup import exact_classes
from .jaccard_join import jaccard_components
from .language import fold, identify, learn
from .lexical import lexical_search
from .line_dedup import LONG_WORDS, line_dedup
from .mixing import mix
from .packing import pack_documents
from .pii import KINDS, find_pii, learn as learn_pii
from .quality import quality
from .records import token_records
from .substring_dedup import substring_dedup
from .warc import archive_pages


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table(sf_dir, "documents"))


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the default of the queries only."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_line_dedup(spark, sf_dir):
    out = line_dedup(_documents(spark, sf_dir), long_words=LONG_WORDS)
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_removed",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_ngram_jaccard_join(spark, sf_dir):
    out = jaccard_components(_documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op3_exact_dedup(spark, sf_dir):
    out = exact_classes(_documents(spark, sf_dir), keep="largest")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def op4_quality_rules(spark, sf_dir):
    out = quality(_documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "chars_per_token", "byte_share",
                      "token_entropy", "script")


def op5_token_records(spark, sf_dir):
    out = token_records(_documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=2)
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_best_fit_packing(spark, sf_dir):
    out = pack_documents(_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=1)
    return out.withColumnRenamed("id", "doc_id")


def op7_warc(spark, sf_dir):
    out = archive_pages(spark.read.parquet(table(sf_dir, "pages")))
    return out.select("page_id", "payload_bytes", F.col("payload_sha1").alias("payload_digest"),
                      "record_type", "refers_to")


def op8_mixing(spark, sf_dir):
    out = mix(_documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


def op9_substring_dedup(spark, sf_dir):
    out = substring_dedup(_documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_language_id(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    held_out = fold(F.col("doc_id")) == 2
    out = identify(docs, learn(docs.filter(~held_out).select("lang", "text")))
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id")) == 2).alias("held_out"), "lang_pred", "score")


def op11_lexical_search(spark, sf_dir):
    out = lexical_search(_documents(spark, sf_dir), spark.read.parquet(table(sf_dir, "benchmark")))
    return out.withColumnRenamed("id", "doc_id")


def _digest(spans):
    """The spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str):
    return lambda span: span["kind"] == kind


def op12_pii(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    out = find_pii(docs, learn_pii(docs)).select("id", "spans")
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select(F.col("id").alias("doc_id"), *counts, F.sha2(_digest(base), 256).alias("base_sha256"),
                      _digest(F.col("spans")).alias("spans"))


def op13_centroid_clustering(spark, sf_dir):
    out = cluster_vectors(spark.read.parquet(table(sf_dir, "embeddings")))
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                      "centroid_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_records": op5_token_records,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_warc": op7_warc,
    "op8_mixing": op8_mixing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_lexical_search": op11_lexical_search,
    "op12_pii": op12_pii,
    "op13_centroid_clustering": op13_centroid_clustering,
}
