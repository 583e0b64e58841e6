"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def stars(edges: DataFrame) -> DataFrame:
    """For an edge table (a, b): node and root, the smallest node of its component, for all nodes but the roots.

    Every round is written to the shared folder; rounds end when a round changes no edge.
    """
    now = written(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        # sums may wrap; decimal keeps them apart from overflow errors
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = sign
        now = written(_small_star(_large_star(now).distinct()).distinct(), "edges")
