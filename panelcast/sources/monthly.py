"""The four monthly business tables themselves (S1-S4), read from Parquet or CSV.

A user who has them does not need the star schema: these extracts feed the same
panel. Tables are ``weighted`` (year_month, basin, division, weighted_fcst),
``rig`` (year_month, basin, environment, rig_count, rig_total, scenario),
``actuals`` (year_month, basin, division, total, scenario) and ``oil``
(year_month, brent, wti). Other column names are given as a mapping. ``year_month``
may be ``yyyy-MM``, ``yyyy-MM-dd`` or a date; NaN becomes NULL on the way in.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import business as biz

COLUMNS = {
    "weighted": {"year_month": "string", "basin": "string", "division": "string",
                 "weighted_fcst": "decimal(38,4)"},
    "rig": {"year_month": "string", "basin": "string", "environment": "string", "rig_count": "double",
            "rig_total": "double", "scenario": "string"},
    "actuals": {"year_month": "string", "basin": "string", "division": "string", "total": "decimal(38,4)",
                "scenario": "string"},
    "oil": {"year_month": "string", "brent": "double", "wti": "double"},
}
# The scenario labels of the source tables.
SCENARIOS = {"RIG COUNT": biz.RIG_ALL, "RIG COUNT WITHOUT CHINA": biz.RIG_EXCL,
             "CONTRIBUTION MARGIN(KUSD)": biz.ACTUALS_CM, "TOTAL REVENUE(KUSD)": biz.ACTUALS_REV}
WEIGHTED_MIN_MONTH = "1996-01"


@dataclass(frozen=True)
class Extracts:
    weighted: DataFrame
    rig: DataFrame
    actuals: DataFrame
    oil: DataFrame
    eliminations: str = biz.ELIMINATIONS_BASIN


def shaped(df: DataFrame, table: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """The columns of an extract with their types; ``names`` maps ours to the source's."""
    names = names or {}
    out = []
    for name, kind in COLUMNS[table].items():
        source = names.get(name, name)
        if source not in df.columns and name in ("environment", "rig_count"):
            out.append(F.lit(None).cast(kind).alias(name))  # read by nothing downstream
            continue
        c = F.col(f"`{source}`")
        if dict(df.dtypes)[source] in ("double", "float"):
            c = F.when(~F.isnan(c), c)  # NaN is no value
        elif kind != "string" and dict(df.dtypes)[source] == "string":
            c = F.when(~F.lower(F.trim(c)).isin("nan", ""), F.trim(c))
        if name == "year_month":
            c = F.substring(c.cast("string"), 1, 7)
        if name == "scenario":
            known = F.create_map(*[F.lit(x) for kv in SCENARIOS.items() for x in kv])
            c = F.coalesce(F.try_element_at(known, c), c)
        out.append(c.cast(kind).alias(name))
    return df.select(*out)


def read_monthly(spark: SparkSession, root: str, fmt: str = "parquet",
                 names: Mapping[str, Mapping[str, str]] | None = None, min_month: str = WEIGHTED_MIN_MONTH,
                 eliminations: str = biz.ELIMINATIONS_BASIN) -> Extracts:
    """Extracts from ``root/<table>`` (``fmt`` parquet or csv with a header). The
    weighted forecast starts at ``min_month`` (P1)."""
    def read(table: str) -> DataFrame:
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        return shaped(reader.format(fmt).load(f"{root.rstrip('/')}/{table}"), table, (names or {}).get(table))

    return Extracts(read("weighted").where(F.col("year_month") >= min_month), read("rig"), read("actuals"),
                    read("oil"), eliminations)


def write_monthly(extracts: Extracts, root: str, fmt: str = "parquet") -> None:
    """Writes the four tables, e.g. those derived from the star schema."""
    for table in COLUMNS:
        writer = getattr(extracts, table).write.mode("overwrite")
        writer = writer.option("header", True) if fmt == "csv" else writer
        writer.format(fmt).save(f"{root.rstrip('/')}/{table}")
