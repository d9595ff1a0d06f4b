"""Merging ranked lists and assembling retrieval results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.operators.skew import topk

# Scores and texts when one side finds nothing, and the score of a keyword match.
VECTOR_FALLBACK, VECTOR_FALLBACK_TEXT = 0.5, "Fallback: Check sensor."
KEYWORD_FALLBACK, KEYWORD_FALLBACK_TEXT = 0.0, "No log match"
KEYWORD_MATCH = 0.9


def rrf(lists: list[DataFrame], k: int, c: int = 60) -> DataFrame:
    """Reciprocal rank fusion of lists (query_id, item_id, rank): the sum of 1 / (c + rank), ties by id."""
    rows = reduce(DataFrame.unionByName, [df.select("query_id", "item_id", "rank") for df in lists])
    fused = rows.groupBy("query_id", "item_id").agg(F.round(F.sum(1.0 / (c + F.col("rank"))), 6).alias("score"))
    return topk(fused, ["query_id"], [F.col("score").desc(), F.col("item_id")], k)


def hybrid_search(queries: DataFrame, vector: DataFrame, keyword: DataFrame, weights: tuple[float, float] = (0.7, 0.3)) -> DataFrame:
    """Confidence and context per query from its best vector hit (query_id, content, distance) and keyword hit
    (query_id, content). A side without a hit contributes its fallback score and text."""
    v = vector.select("query_id", F.col("content").alias("_vt"), (1 - F.col("distance")).alias("_vs"))
    t = keyword.select("query_id", F.col("content").alias("_kt"), F.lit(KEYWORD_MATCH).alias("_ks"))
    score = (weights[0] * F.coalesce("_vs", F.lit(VECTOR_FALLBACK)) + weights[1] * F.coalesce("_ks", F.lit(KEYWORD_FALLBACK)))
    context = F.concat(F.lit("Manual Context: "), F.coalesce("_vt", F.lit(VECTOR_FALLBACK_TEXT)),
                       F.lit(" | Log Context: "), F.coalesce("_kt", F.lit(KEYWORD_FALLBACK_TEXT)))
    return (queries.join(v, "query_id", "left").join(t, "query_id", "left")
            .withColumn("search_confidence", F.round(score, 6)).withColumn("context", context)
            .withColumn("sources", F.array_compact(F.array(F.when(F.col("_vs").isNotNull(), "manual"),
                                                           F.when(F.col("_ks").isNotNull(), "log"))))
            .drop("_vt", "_vs", "_kt", "_ks"))
