"""Parquet table access for the driver-generated star schema."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

class Tables:
    """Lazy ``spark.read.parquet`` per table; nothing is scanned until an action.

    Every reader is a plain Parquet scan, so Catalyst pushes filters and
    column pruning into it (``PushedFilters`` / ``ReadSchema`` in explain).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    @cached_property
    def region(self) -> DataFrame:
        return self.read("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")
