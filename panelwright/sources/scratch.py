"""Where intermediate tables live.

On a cluster the folder is the shared one named in ``spark.checkpoint.dir``, so a lost executor
costs nothing that was already written. Only a local session, where the setting may be absent,
falls back to a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {SETTING} to a shared folder to run on a cluster")
    root = tempfile.mkdtemp(prefix="panelwright-")
    spark.conf.set(SETTING, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a stage as a table and read it back: cuts the lineage, keeps column pruning, and lets
    several consumers share the work."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, label: str, by: list[str], sort: list[str] | None = None) -> DataFrame:
    """Like :func:`stage`, as a table in buckets of ``by``: joins and aggregations on these columns need no exchange of
    it. The rows are dealt by the same columns first, so that each bucket is one file."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    name = f"panelwright_{path.rsplit('-', 1)[1]}"
    writer = df.repartition(n, *by).write.bucketBy(n, *by)
    if sort:
        writer = writer.sortBy(*sort)
    writer.format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)
