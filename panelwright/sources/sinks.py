"""Writers. Output is always produced by executors; nothing loops over countries on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_index
from ..operators.market import contiguous_lag, quality_filter


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str, order: list[str] | None = None) -> None:
    """One directory per value of ``by``, ZSTD.

    The rebalance hint clusters rows by the column but lets Spark split a partition that is too
    large, so the dominant country becomes several files written by several tasks.
    """
    out = df.hint("rebalance", by)
    if order:
        out = out.sortWithinPartitions(by, *order)
    out.write.mode("overwrite").option("compression", "zstd").partitionBy(by).parquet(path)


def final_filter(df: DataFrame, end: Column) -> DataFrame:
    """Main securities up to ``end`` with last month's market equity (contiguous months only)."""
    out = contiguous_lag(df.withColumn("midx", month_index("eom")), ["me"], suffix="_lag1")
    return quality_filter(out).filter(F.col("eom") <= end)


def export_projection(df: DataFrame, columns: list[str], present: str | None = None, country: str | None = None) -> DataFrame:
    """Column subset; optionally only rows with ``present``; missing country as 'null_country'."""
    out = df if present is None else df.filter(F.col(present).isNotNull())
    out = out.select(*columns)
    if country:
        out = out.withColumn(country, F.coalesce(F.col(country), F.lit("null_country")))
    return out


def date_capped(df: DataFrame, date: str, end: Column) -> DataFrame:
    return df.filter(F.col(date) <= end)
