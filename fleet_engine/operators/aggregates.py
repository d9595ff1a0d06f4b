"""Gold facts, histories, summaries, gates and comparisons."""

from __future__ import annotations

from pyspark.ml.feature import IDFModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.operators.enrich import embed_groups, fit_embedding
from fleet_engine.operators.skew import dim_join, with_page

PAGE_ROWS = 10_000

# Verdicts and thresholds of the deployment gate.
GATE_PASS = "PASS — Deploy Approved"
GATE_FAIL = "FAIL — Accuracy below 80% SLA. Deployment BLOCKED."
METRIC_THRESHOLDS = {"faithfulness": 0.80, "relevance": 0.75, "answer_correctness": 0.80}


def gold_errors(silver: DataFrame) -> DataFrame:
    """Coded faults and highest temperature per vehicle; combined before the shuffle."""
    return silver.groupBy("vin_reference").agg(
        F.count("diagnostic_error_code").alias("total_critical_errors"),
        F.max("engine_temperature_celsius").alias("max_engine_temp_recorded"))


def _ordered(order: str, value: str):
    """Values of a group in ``order``; NULL values are left out, as an array aggregate does."""
    kept = F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(order), F.col(value).alias("v"))))
    return F.transform(F.array_sort(kept), lambda s: s["v"])


def gold_history(silver: DataFrame, order: str = "event_id", page_rows: int = PAGE_ROWS) -> DataFrame:
    """Summaries and categories per vehicle and ``page`` as arrays in ``order``; ``fault_categories_distinct`` has no repeats.

    Page p of a vehicle holds its rows p * ``page_rows`` and following, so the pages in their order are the whole history and no array
    grows with it. ``silver`` should be a written table.
    """
    return (with_page(silver, "vin_reference", order, page_rows).groupBy("vin_reference", "page").agg(
        _ordered(order, "log_summary").alias("full_vehicle_history_summaries"),
        _ordered(order, "fault_category").alias("distinct_fault_categories"),
        F.array_sort(F.collect_set("fault_category")).alias("fault_categories_distinct")))


def _history_of(vin: str):
    return F.concat(F.lit("Vehicle "), F.coalesce(vin, F.lit("")), F.lit(" history: "))


def gold_context(history: DataFrame) -> DataFrame:
    """Readable history per vehicle and page."""
    return history.select("vin_reference", "page", F.concat(
        _history_of("vin_reference"), F.array_join("full_vehicle_history_summaries", " | ")).alias("context"))


def gold_dealership(silver: DataFrame, as_of: str, dim: int = 768, model: IDFModel | None = None) -> DataFrame:
    """One row per vehicle: facts, number of summaries, and the vector of "Vehicle <vin> history: <summaries>".

    Word counts add up, so that text is never built; its summaries in order are ``gold_history``.
    """
    facts = silver.groupBy("vin_reference").agg(
        F.count("diagnostic_error_code").alias("total_critical_errors"),
        F.max("engine_temperature_celsius").alias("max_engine_temp_recorded"), F.count("log_summary").alias("n_summaries"))
    model = model or fit_embedding(silver, "log_summary", dim)
    notes = silver.select("vin_reference", F.col("log_summary").alias("_text")).filter(F.col("_text").isNotNull())
    prefixes = facts.select("vin_reference", _history_of("vin_reference").alias("_text"))
    vectors = embed_groups(notes.unionByName(prefixes), "vin_reference", "_text", dim, model)
    return (facts.join(vectors.withColumnRenamed("vin_reference", "_vin"), F.col("vin_reference").eqNullSafe(F.col("_vin")))
            .select("vin_reference", "total_critical_errors", "max_engine_temp_recorded", "n_summaries",
                    F.col("embedding").alias("vehicle_history_embedding"), F.lit(as_of).cast("timestamp").alias("last_aggregated_at")))


def fault_summary(faults: DataFrame, key: str, score: str = "driver_frustration_score", ts: str = "recorded_at") -> DataFrame:
    """Fault count, mean score, strongly negative faults and newest fault per key."""
    return faults.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_fault_count"), F.avg(score).alias("avg_frustration"),
        F.count_if(F.col(score) < -0.5).alias("high_frustration_count"), F.max(ts).alias("latest_fault_at"))


def quality_gate(scores: DataFrame, score: str = "faithfulness_score", threshold: float = 0.80) -> DataFrame:
    """One verdict row; no rows or only NULL scores fail."""
    mean = F.avg(score)
    return scores.agg(F.count(F.lit(1)).alias("total_evaluations"), F.round(mean, 3).alias("avg_faithfulness"),
                      F.round(F.min(score), 3).alias("min_faithfulness"),
                      F.when(mean >= threshold, GATE_PASS).otherwise(GATE_FAIL).alias("deployment_gate_status"))


def metric_gates(scores_long: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """One verdict per metric of (metric, score) rows; a configured metric without scores fails."""
    spark = scores_long.sparkSession
    limits = spark.createDataFrame(sorted((thresholds or METRIC_THRESHOLDS).items()), "metric string, threshold double")
    means = scores_long.groupBy("metric").agg(F.count("score").alias("n"), F.avg("score").alias("mean"))
    return (limits.join(means, "metric", "left")
            .select("metric", "threshold", F.coalesce("n", F.lit(0)).alias("n_scores"), F.round("mean", 6).alias("mean_score"),
                    F.coalesce(F.col("mean") >= F.col("threshold"), F.lit(False)).alias("passed")))


def benchmark_summary(results: DataFrame, cases: DataFrame, by: str = "experiment") -> DataFrame:
    """Accuracy and mean latency per experiment. A failed call (``ok`` false) counts as a failure with latency 0.

    ``results`` has (experiment, case_id, ok, confidence, latency), ``cases`` (case_id, min_confidence).
    """
    passed = F.coalesce(F.col("ok") & (F.col("confidence") >= F.col("min_confidence")), F.lit(False))
    latency = F.when(F.col("ok"), F.coalesce("latency", F.lit(0.0))).otherwise(F.lit(0.0))
    return (dim_join(results, cases, "case_id", results.columns)
            .groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count_if(passed).alias("passed"),
                             F.round(100 * F.avg(passed.cast("int")), 6).alias("accuracy"),
                             F.round(F.avg(latency), 6).alias("avg_latency")))


def ab_compare(summary: DataFrame, baseline: str, challenger: str, sla: float = 80.0, by: str = "experiment") -> DataFrame:
    """Baseline against challenger in one row; a baseline below the SLA fails the build."""
    def accuracy(name):
        return F.max(F.when(F.col(by) == name, F.col("accuracy")))

    both = summary.agg(accuracy(baseline).alias("baseline_accuracy"), accuracy(challenger).alias("challenger_accuracy"))
    ok = F.coalesce(F.col("baseline_accuracy") >= sla, F.lit(False))
    wins = F.col("challenger_accuracy") >= F.col("baseline_accuracy")
    return both.withColumn("sla_met", ok).withColumn(
        "result", F.when(~ok, "BLOCKED").when(wins, "CHALLENGER").otherwise("BASELINE"))


def run_metrics(runs: DataFrame) -> DataFrame:
    """Runs, tokens, latency and confidence per experiment from the nested run log."""
    return runs.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("metrics.tokens").alias("tokens"),
        F.round(F.avg("metrics.latency_total"), 6).alias("avg_latency"),
        F.round(F.avg("metrics.confidence"), 6).alias("avg_confidence"))
