"""Scores of texts by their content: each different text is scored once, in this batch or in an earlier one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleet_engine.operators.skew import salted_join
from fleet_engine.workspace import fits, folder_exists, stage

Score = Callable[[DataFrame, str, str], DataFrame]


def text_digest(text: str) -> Column:
    """Key of a text: its SHA-256, and an empty key for NULL, which scores may treat unlike an empty text."""
    return F.when(F.col(text).isNull(), F.lit("")).otherwise(F.sha2(F.col(text), 256))


def stored_scores(spark: SparkSession, store: str) -> DataFrame | None:
    """(digest, scores), one row per text that was ever scored; None before the first batch."""
    if not folder_exists(spark, store):
        return None
    return spark.read.parquet(store).drop("batch").dropDuplicates(["digest"])


def score_once(df: DataFrame, id: str, text: str, score: Score, store: str) -> DataFrame:
    """The scores of every row of ``df``, as ``score(df, id, text)`` gives them, with each different text scored once.

    ``score`` takes (df, id, text), returns the id and its scores, and must depend on the text alone: a word list, a trained model, a call of
    ``complete_batch``, but no weights of the batch. Digests travel, not texts: only texts that ``store`` does not hold are read, and copies
    are dropped in each partition before the shuffle. New scores become a folder of ``store``, which one writer at a time extends; if two do, a text may be
    scored twice and one score counts. Rows come back by digest, those of a text that very many rows hold in many tasks. NULL texts are scored once, too. An empty ``df``
    gives no rows and adds an empty folder.
    """
    spark = df.sparkSession
    keyed = stage(df.select(id, text_digest(text).alias("digest")), "score-keys")
    known = stored_scores(spark, store)
    fresh = keyed.select("digest").distinct()
    fresh = stage(fresh if known is None else fresh.join(known.select("digest"), "digest", "left_anti"), "score-fresh")
    rows = df.select(text_digest(text).alias("digest"), text)
    if fits(fresh, 200_000):
        rows = rows.join(F.broadcast(fresh), "digest", "left_semi").dropDuplicates(["digest"])
    else:
        rows = rows.dropDuplicates(["digest"]).join(fresh, "digest", "left_semi")
    score(rows, "digest", text).write.parquet(f"{store}/batch={uuid.uuid4().hex}")
    return salted_join(keyed, stored_scores(spark, store), "digest", id, how="left").drop("digest")
