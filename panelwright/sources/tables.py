"""Access to one directory of Parquet tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Lazy handles on ``<root>/<name>.parquet``; attribute access reads a table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def read(self, name: str, *columns: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return df.select(*columns) if columns else df

    lineitem = cached_property(lambda self: self.read("lineitem"))
    orders = cached_property(lambda self: self.read("orders"))
    supplier = cached_property(lambda self: self.read("supplier"))
    part = cached_property(lambda self: self.read("part"))
    customer = cached_property(lambda self: self.read("customer"))
    nation = cached_property(lambda self: self.read("nation"))
    region = cached_property(lambda self: self.read("region"))
