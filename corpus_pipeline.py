"""The corpus pipeline: from raw documents to packed training sequences.

Stages, each written as Parquet and read again as the next one's input:

1. quality rules: documents that the fertility bands or base rules reject go;
2. exact dedup: of equal texts the row with the largest id stays;
3. n-gram Jaccard join: of each component of similar texts the smallest id stays;
4. mixing: sources are repeated or thinned to their target weights, a document
   taken twice stands twice;
5. best-fit packing: the packing plan of the token pieces.

All but the last return the columns of ``documents``. Rows without an id can't be
addressed by a deduplication and stay; an empty table gives an empty plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import cut_lineage, table
from panelcast.llm.exact_dedup import exact_dedup
from panelcast.llm.jaccard_join import near_dedup
from panelcast.llm.mixing import mixed
from panelcast.llm.packing import pack_documents
from panelcast.llm.quality import good_documents
from panelcast.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, vocabulary("piece_bpe_32k.model"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs, keep="largest")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=1)
    return out.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", source_mix),
    ("best_fit_packing", packed_sequences),
]

#: The tokenizer stages can't be expressed in SQL; tests/llm/test_pipeline.py has the
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents"))
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
