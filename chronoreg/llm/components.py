"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (a > b); the result's edges are distinct and again a > b."""
    both = edges.union(edges.select("b", "a")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
    large = both.join(least, "node").where("other > node AND other > least").select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()
    least = large.groupBy("node").agg(F.min("other").alias("least"))
    small = large.join(least, "node")
    moved = small.where("other > least").select(F.col("other").alias("a"), F.col("least").alias("b"))
    return moved.union(small.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): the smallest node that it reaches.

    Each round stages its edges and compares two sums of them with the round before; the driver sees only these sums.
    """
    edges = common.stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        edges = common.stage(_stars(edges))
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(edges.select("b", "b").distinct())
