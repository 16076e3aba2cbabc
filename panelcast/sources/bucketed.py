"""Orders and lineitem as tables bucketed by order key.

Written once, every later join of lines with their orders reads both sides by bucket:
the lines, by far the larger side, never cross the network again (S1, S3). The order key
is stored as a long on both sides, because a bucket is the hash of the stored type. The
number of buckets is a parameter of the layout: about the bytes of lineitem over 512 MB,
so that a bucket fits a task; ``suggested_buckets`` takes it from the file sizes. Rows are
dealt by key before the write, so a bucket is one file.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .tables import Tables

KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
BUCKET_BYTES, LEAST = 512 << 20, 8


def suggested_buckets(t: Tables) -> int:
    """Buckets of about ``BUCKET_BYTES`` of the lineitem files."""
    size = int(str(t.lineitem._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(LEAST, -(-size // BUCKET_BYTES))


def write_bucketed(t: Tables, prefix: str, folder: str, buckets: int | None = None) -> None:
    """Tables ``{prefix}_orders`` and ``{prefix}_lineitem`` of the session's catalogue, their
    files under ``folder`` (shared by the executors)."""
    n = buckets or suggested_buckets(t)
    for name, key in KEYS.items():
        rows = getattr(t, name)
        rows = rows.withColumn(key, F.col(key).cast("long")).repartition(n, key)
        (rows.write.mode("overwrite").bucketBy(n, key).sortBy(key).option("path", f"{folder}/{prefix}_{name}")
         .saveAsTable(f"{prefix}_{name}"))


def drop_bucketed(spark: SparkSession, prefix: str) -> None:
    """Forgets the tables; their files stay."""
    for name in KEYS:
        spark.sql(f"DROP TABLE IF EXISTS `{prefix}_{name}`")


class BucketedTables(Tables):
    """The star schema with its two large tables read from their bucketed form."""

    def __init__(self, spark: SparkSession, root: str, prefix: str):
        super().__init__(spark, root)
        self.prefix = prefix

    @cached_property
    def orders(self) -> DataFrame:
        return self.spark.table(f"{self.prefix}_orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.spark.table(f"{self.prefix}_lineitem")


@contextlib.contextmanager
def bucketed(t: Tables, buckets: int | None = None) -> Iterator[BucketedTables]:
    """The tables in bucketed form inside the block, among the application's intermediates."""
    prefix = f"panelcast_{uuid.uuid4().hex}"
    write_bucketed(t, prefix, scratch_dir(t.spark), buckets)
    try:
        yield BucketedTables(t.spark, t.root, prefix)
    finally:
        drop_bucketed(t.spark, prefix)
