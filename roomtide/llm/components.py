"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.runtime import stage


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of edges (a, b): root is the smallest node reachable.

    Each round hangs larger neighbours, then smaller ones, on the smallest; the number of rounds
    grows with the logarithm of the nodes.  A node with many edges contributes partial minima, and
    its join rows may be split.  Loops are dropped; an empty table gives an empty one.
    """
    links = stage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        links = stage(small)
        # Equal contents have equal sums; a round that changes nothing is the last.
        sums = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == last:
            break
        last = sums
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
