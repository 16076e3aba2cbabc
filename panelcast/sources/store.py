"""Snapshot store and model artefacts: sinks K1-K5, reads S5-S9.

The reference appends scored snapshots and best-model rows to SQL tables
and pickles one model file per series. Here they are Parquet tables:

* snapshots and best-model rows are partitioned by refresh_date and written with
  *dynamic* partition overwrite, so rerunning a refresh replaces it as a whole
  (also families it no longer has) and leaves every other refresh untouched;
* the newest/oldest refresh is found from the names of the folders, and only that
  refresh's files are scanned;
* a run of the whole driver stages its tables and models and publishes them together
  (:mod:`.runs`); the reads here take published tables as well;
* a missing table reads as an empty frame with the right schema (S8);
  any other read error propagates;
* ridge coefficients are a table keyed by (family, target, origin, series);
  forests use MLlib's own ``write().save`` / ``load`` (``models/forest.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import runs

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("quarter", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("cm", T.DoubleType()),
    T.StructField("rev", T.DoubleType()),
    T.StructField("model", T.StringType()),
    T.StructField("actual_contribution_margin", T.DoubleType()),
    T.StructField("actual_revenue", T.DoubleType()),
    T.StructField("contribution_margin_error", T.DoubleType()),
    T.StructField("revenue_error", T.DoubleType()),
    T.StructField("YM", T.StringType()),
    T.StructField("refresh_date", T.StringType()),
    T.StructField("level", T.StringType()),
])

COEFFICIENT_SCHEMA = T.StructType([
    T.StructField("family", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("h", T.IntegerType()),
    T.StructField("beta", T.ArrayType(T.DoubleType())),
])

# K1: the reference's if_exists values -> Spark save modes.
SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def write_table(df: DataFrame, path: str, if_exists: str = "fail") -> None:
    """K1: table write with mode fail / replace / append."""
    df.write.mode(SAVE_MODES[if_exists]).parquet(path)


def append_snapshot(df: DataFrame, path: str) -> None:
    """K2: append scored snapshots; rerunning a refresh replaces it as a whole."""
    (df.select(*[f.name for f in SNAPSHOT_SCHEMA.fields])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("refresh_date").parquet(path))


def append_best(df: DataFrame, path: str) -> None:
    """K3: append best-model rows, idempotent per refresh."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("refresh_date").parquet(path))


def export_csv(df: DataFrame, path: str, sort_by: list[str] | None = None) -> None:
    """K4: CSV export of a stage output, with header.

    ``sort_by`` orders the rows at this presentation edge only (O1, e.g. the
    ground truth by series and quarter); it is a range-partitioned sort, so
    the files come out in order without funnelling rows through one task.
    Strings are written as they are, so a division code ``N/A`` is not
    turned into NULL on the way back (read it with ``nullValue`` unset).
    """
    out = df.orderBy(*sort_by) if sort_by else df
    out.write.mode("overwrite").option("header", True).csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None
               ) -> DataFrame:
    """S7 with the S8 fallback: whole table, or an empty frame if it does not exist."""
    if not _exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


BEST_SCHEMA = T.StructType([
    *[SNAPSHOT_SCHEMA[c] for c in ("quarter", "series", "rev", "actual_revenue", "revenue_error", "YM", "refresh_date",
                                   "level")],
    T.StructField("rev_Model", T.StringType()),
    *[SNAPSHOT_SCHEMA[c] for c in ("cm", "actual_contribution_margin", "contribution_margin_error")],
    T.StructField("cm_Model", T.StringType()),
])


def _read(spark: SparkSession, path: str, schema: T.StructType, only: list[str] | None = None) -> DataFrame:
    if runs.manifest(spark, path.rstrip("/").rsplit("/", 1)[0]) is not None:
        return runs.read(spark, path, schema, only)
    df = read_table(spark, path, schema)
    return df if only is None else df.where(F.col("refresh_date").isin(only))


def read_snapshots(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """Snapshots (of the refreshes ``only``): a published table of a store, or a plain one."""
    return _read(spark, path, SNAPSHOT_SCHEMA, only)


def read_best(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    return _read(spark, path, BEST_SCHEMA, only)


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest refresh, whose name comes from the folders or the manifest."""
    return read_snapshots(spark, path, runs.refreshes(spark, path)[-1:])


def earliest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the oldest refresh."""
    return read_snapshots(spark, path, runs.refreshes(spark, path)[:1])


def history_before(spark: SparkSession, path: str, origin: str) -> DataFrame:
    """Rows of the newest snapshot refreshed before ``origin``, for quarters before it
    (P10): the history a new refresh carries forward (``quarter, series, cm, rev, model``)."""
    newest = [r for r in runs.refreshes(spark, path) if r < origin][-1:]
    return (read_snapshots(spark, path, newest).where(F.col("quarter") < origin)
            .select("quarter", "series", "cm", "rev", "model"))


def save_coefficients(coefs: DataFrame, path: str, family: str, target: str) -> None:
    """K5: ridge coefficients ``(origin, series[, h], beta)`` of one family/target
    (``h`` is the forecast step of the direct autoregression, NULL otherwise)."""
    step = F.col("h").cast("int") if "h" in coefs.columns else F.lit(None).cast("int")
    (coefs.select(F.lit(family).alias("family"), F.lit(target).alias("target"), "origin",
                  "series", step.alias("h"), "beta")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("family", "target", "origin").parquet(path))


def load_coefficients(spark: SparkSession, path: str, family: str, target: str,
                      origin: str | None = None) -> DataFrame:
    """Coefficients of one family/target (and origin), partition-pruned."""
    df = read_table(spark, path, COEFFICIENT_SCHEMA).where(
        (F.col("family") == family) & (F.col("target") == target))
    if origin is not None:
        df = df.where(F.col("origin") == origin)
    return df.select("origin", "series", "h", "beta")
