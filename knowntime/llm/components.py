"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import drop, stage_at


def _large_star(edges: DataFrame) -> tuple[DataFrame, str]:
    """Every node above u is linked to the smallest node around u instead."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low, path = stage_at(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")), "low")
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), path


def _small_star(edges: DataFrame) -> tuple[DataFrame, str]:
    """u and every smaller node around it are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low, path = stage_at(down.groupBy("a").agg(F.min("b").alias("low")), "low")
    moved = down.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), path


def components(edges: DataFrame) -> DataFrame:
    """(a, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Nodes may be of any ordered type; nodes without an edge are not returned.
    Every step is an aggregation with map-side combine and a join that
    adaptive execution can split; the loop ends when no edge moves.
    """
    spark = edges.sparkSession
    edges, path = stage_at(edges.where("a <> b").select("a", "b").distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        large, low = _large_star(edges)
        large, middle = stage_at(large, "large")
        drop(spark, low, path)
        small, low = _small_star(large)
        edges, path = stage_at(small, "edges")
        drop(spark, low, middle)
    roots = edges.select(F.col("b").alias("a"), F.col("b").alias("component")).distinct()
    return edges.select("a", F.col("b").alias("component")).unionByName(roots)
