"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _pairs(df: DataFrame) -> DataFrame:
    return df.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, root): every node with an edge to another, and the smallest node of its component.

    Each round hangs the larger neighbours of a node on its smallest one, then all on it; a round's edges are written
    to the shared folder. Minima are aggregated before the shuffle, so a node with very many edges is no hot task.
    """
    now = stored(_pairs(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "edges")
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = None
    while (after := state(now)) != before:
        before = after
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _pairs(both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = stored(_pairs(small), "small-star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())
