"""Silver models composed from the operators. Write their results once: gold, audit and search all read them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.functions.text import tokens
from fleet_engine.operators.clean import fault_base
from fleet_engine.operators.enrich import (FAULT_RULES, answer_column, category_votes, sentiment, sentiment_column,
                                           summarize)
from fleet_engine.workspace import spread, stage

# Fixed value: what the fault model asks each note.
COMPONENT_QUESTION = "What was the specific vehicle component mentioned?"


def score_telemetry(silver: DataFrame, id: str, rules: dict[str, list[str]] | None = None) -> DataFrame:
    """Silver telemetry with ``log_summary`` and ``fault_category`` per note; rows without a note keep NULLs.

    ``silver`` is read several times and should be a written table.
    """
    notes = silver.filter(F.col("mechanic_notes").isNotNull()).select(id, "mechanic_notes")
    summaries = summarize(notes, id, "mechanic_notes").select(id, F.col("summary").alias("log_summary"))
    category = category_votes(F.col("_w"), rules or FAULT_RULES)
    classed = silver.withColumn("_w", tokens("mechanic_notes")).withColumn("fault_category", F.when(F.col("_w").isNotNull(), category))
    return classed.drop("_w").join(summaries, id, "left")


def score_faults(bronze: DataFrame, id: str, lexicon: DataFrame | None = None, question: str = COMPONENT_QUESTION) -> DataFrame:
    """Fault key, vehicle with and without mask, note, sentiment and named component of every event with a note."""
    notes = fault_base(bronze, keep=(id, "vin"))
    if lexicon is None:
        words = notes.withColumn("_w", tokens("raw_log"))
        scored = words.withColumn("driver_frustration_score", sentiment_column(F.col("_w"))).drop("_w")
    else:
        scores = sentiment(notes, id, "raw_log", lexicon).withColumnRenamed("sentiment", "driver_frustration_score")
        scored = notes.join(scores, id)
    return scored.withColumn("target_component_extracted", F.get(answer_column("raw_log", question), 0)["answer"])


def fault_analysis(bronze: DataFrame, id: str, lexicon: DataFrame | None = None, question: str = COMPONENT_QUESTION) -> DataFrame:
    """``score_faults`` with a one-sentence summary per note."""
    # written because the summary reads the notes three times
    faults = spread(stage(score_faults(bronze, id, lexicon, question), "faults"), id)
    summaries = summarize(faults, id, "raw_log").select(id, F.col("summary").alias("concise_fault_summary"))
    return faults.join(summaries, id)
