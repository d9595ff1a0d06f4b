"""Connected components of very many links by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.workspace import stage


def components(links: DataFrame) -> DataFrame:
    """(v, root) of every vertex of ``links`` (a, b; longs): vertices have one root if and only if links connect them.

    Each round joins every vertex with the first of its neighbours (itself included) in an order drawn anew, and goes on with the links between what
    is left, so the number of rounds grows with the logarithm of the longest path. Each round is written. A vertex with very many links is one
    row per task in the grouping, and in the join its links are split by Spark like any heavy key.
    """
    left = stage(links.filter("a <> b").select("a", "b").distinct(), "links")
    labels, turn = None, 0
    while not left.isEmpty():
        order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("v"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = stage(both.groupBy("a").agg(F.min(order("b")).alias("m"))
                      .select(F.col("a").alias("v"), F.least(F.col("m"), order("a"))["v"].alias("root")), "parents")
        if labels is None:
            labels = first
        else:
            labels = stage(labels.join(first.select(F.col("v").alias("root"), F.col("root").alias("_next")), "root", "left")
                           .select("v", F.coalesce("_next", "root").alias("root")), "labels")
        to_a, to_b = first.select(F.col("v").alias("a"), F.col("root").alias("_a")), first.select(F.col("v").alias("b"), F.col("root").alias("_b"))
        left = stage(left.join(to_a, "a").select("_a", "b").join(to_b, "b").filter("_a <> _b")
                     .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")
        turn += 1
    return labels if labels is not None else left.select(F.col("a").alias("v"), F.col("b").alias("root"))
