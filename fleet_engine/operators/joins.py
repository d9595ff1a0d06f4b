"""Joins between requests, ground truth, manuals, logs and experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.operators.skew import SALTS, dim_join, key_counts, salted_join, topk
from fleet_engine.workspace import BROADCAST_BYTES, broadcast_bounded, stage

# Texts that stand in for missing context.
NO_MANUAL = "No manual data found for this VIN."
NO_LOGS = "No diagnostic logs found."
NO_VEHICLE = "No specific vehicle found. Be generally helpful."


def eval_join(truth: DataFrame, audit: DataFrame, truth_key: str = "vin_context", audit_key: str = "vin_reference") -> DataFrame:
    """Ground truth with its audit rows; truth rows without a match or without a key stay with NULLs.

    A vehicle with very many audit rows is split over tasks; only its ground truth is repeated.
    """
    audit = stage(audit.withColumnRenamed(audit_key, truth_key), "audit")      # read three times
    counts = key_counts(audit, truth_key)
    rest = [c for c in audit.columns if c != truth_key]
    small = broadcast_bounded(truth, max_bytes=BROADCAST_BYTES // SALTS)       # its rows of hot keys are repeated for each salt
    scored = salted_join(audit.filter(F.col(truth_key).isNotNull()), small, truth_key, rest, counts=counts)
    lone = truth.join(counts.select(truth_key), truth_key, "left_anti")
    return scored.select(*truth.columns, *rest).unionByName(
        lone.select(*truth.columns, *[F.lit(None).cast(audit.schema[c].dataType).alias(c) for c in rest]))


def candidate_counts(queries: DataFrame, corpus: DataFrame, key: str, query_id: str = "query_id") -> DataFrame:
    """Corpus rows that each query may match under its key.

    This is what a search will scan. The pairs themselves are never rows here: searches compare blocks of queries with
    blocks of corpus rows (``operators.blocks``) and hand on matches only.
    """
    counts = key_counts(corpus, key, "candidates")
    return (salted_join(queries.select(query_id, key), counts, key, query_id, how="left")
            .select(query_id, key, F.coalesce("candidates", F.lit(0)).alias("candidates")))


def vehicle_context(manuals: DataFrame, logs: DataFrame, k: int = 3) -> DataFrame:
    """One row per vehicle: up to ``k`` chunks joined in order, and its newest log.

    ``manuals`` has (vin, source_file, chunk_index, chunk_text), ``logs`` (vin, log_id, log_text). Both are cut to a few
    rows per vehicle before anything is collected.
    """
    order = [F.col("source_file"), F.col("chunk_index")]
    chunks = (topk(manuals.filter(F.col("vin").isNotNull()), ["vin"], order, k, "_rank").groupBy("vin")
              .agg(F.array_sort(F.collect_list(F.struct("_rank", "chunk_text"))).alias("_chunks"))
              .select("vin", F.array_join(F.transform("_chunks", lambda c: c["chunk_text"]), " | ").alias("manual_context")))
    newest = logs.filter(F.col("vin").isNotNull()).groupBy("vin").agg(F.max_by("log_text", "log_id").alias("log_context"))
    return chunks.join(newest, "vin", "full_outer")


def assemble_context(requests: DataFrame, manuals: DataFrame, logs: DataFrame, k: int = 3, vin: str = "vin",
                     request_id: str = "request_id") -> DataFrame:
    """Each request with its context text; requests that name no vehicle get the general text."""
    per_vin = vehicle_context(manuals, logs, k).withColumnRenamed("vin", vin)
    joined = salted_join(requests, per_vin, vin, request_id, how="left")
    known = F.concat(F.lit("Manual Reference: "), F.coalesce("manual_context", F.lit(NO_MANUAL)),
                     F.lit("\nDiagnostic Logs: "), F.coalesce("log_context", F.lit(NO_LOGS)))
    named = F.col(vin).isNotNull() & (F.col(vin) != "NONE")
    return joined.withColumn("context", F.when(named, known).otherwise(F.lit(NO_VEHICLE))).drop("manual_context", "log_context")


# Provider and prompt version of a request without an experiment.
DEFAULT_PROVIDER, DEFAULT_PROMPT_VERSION = "SNOWFLAKE", "diagnostic_expert_json"


def apply_experiments(requests: DataFrame, registry: DataFrame, provider: str = DEFAULT_PROVIDER,
                      prompt_version: str = DEFAULT_PROMPT_VERSION) -> DataFrame:
    """Provider and prompt version per request: the experiment's where it names one, else the defaults."""
    known = registry.select(F.col("id").alias("experiment_id"), F.col("llm_provider").alias("_p"),
                            F.col("prompt_version").alias("_v"))
    return (dim_join(requests, known, "experiment_id", requests.columns, "left")
            .withColumn("provider", F.coalesce("_p", F.lit(provider)))
            .withColumn("prompt_version", F.coalesce("_v", F.lit(prompt_version))).drop("_p", "_v"))
