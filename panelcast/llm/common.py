"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package

# Fixed value: what counts as a word in every operator here.
WORD = r"[^\x20\x09-\x0D]+"


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           **more: str) -> DataFrame:
    """``(id, text, ...)`` under internal names: extra or clashing columns of the
    input never reach an operator; a null text counts as empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    rest = [F.col(f"`{col}`").alias(name) for name, col in more.items()]
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text, *rest)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def table(docs_dir: str, name: str) -> str:
    return f"{docs_dir.rstrip('/')}/{name}.parquet"


def scalar(df: DataFrame):
    """The single value of a one-row, one-column aggregate."""
    return df.head()[0]


__all__ = ["WORD", "cut_lineage", "narrow", "scalar", "ship_package", "table", "word_count"]
