"""Connected components of links, by alternating star contractions; no vertex gathers its neighbours in a list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage


def _stars(edges: DataFrame, all_neighbours: bool) -> DataFrame:
    """Hang neighbours of each vertex on the least of them: the greater ones, or the vertex and the smaller ones."""
    if all_neighbours:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("least"))
    joined = near.join(least, "a").withColumn("least", F.least("a", "least"))
    if all_neighbours:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(joined.select("a", F.col("least").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node, and the least node it can reach. No links give no rows; repeated
    links, loops and null ends change nothing."""
    edges = stage(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct(), "links")
    state = None
    while True:
        edges = stage(_stars(_stars(edges, True), False), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
