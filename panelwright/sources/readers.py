"""Scans: Parquet, any Spark source with typed keys, delimited lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def typed_projection(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Replace columns by a cast that yields NULL for malformed values; others pass unchanged."""
    return df.select(
        *[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns]
    )


def scan_source(spark: SparkSession, fmt: str, options: dict[str, str], casts: dict[str, str]) -> DataFrame:
    """A table of any Spark source (``jdbc`` and the like) with its key columns cast safely.

    For ``jdbc`` pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in
    ``options`` so that the read is spread over executors.
    """
    return typed_projection(spark.read.format(fmt).options(**options).load(), casts)


def scan_lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small delimited dimension with a header row and a declared schema."""
    return spark.read.csv(path, header=True, schema=schema)
