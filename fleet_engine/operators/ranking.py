"""Ordered reports with a limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.operators.clean import recent


def most_frustrating(faults: DataFrame, k: int = 10, score: str = "driver_frustration_score", tie: str = "fault_id") -> DataFrame:
    """The strongly negative faults, worst first."""
    return faults.filter(F.col(score) < -0.5).orderBy(F.col(score), F.col(tie)).limit(k)


def top_vehicles(gold: DataFrame, k: int = 5) -> DataFrame:
    """Vehicles with most coded faults."""
    return (gold.select("vin_reference", "total_critical_errors")
            .orderBy(F.col("total_critical_errors").desc(), F.col("vin_reference")).limit(k))


def top_queries(history: DataFrame, as_of: str, prefix: str, k: int = 10, interval: str = "24 HOURS") -> DataFrame:
    """Longest jobs of the last day under a tag prefix, in seconds and gigabytes.

    ``history`` has (query_id, query_text, query_tag, start_time, elapsed_ms, bytes_scanned, cpu_ms).
    """
    return (recent(history, "start_time", interval, as_of).filter(F.startswith(F.col("query_tag"), F.lit(prefix)))
            .orderBy(F.col("elapsed_ms").desc(), F.col("query_id")).limit(k)
            .select("query_id", "query_text", (F.col("elapsed_ms") / 1000).alias("duration_seconds"),
                    (F.col("bytes_scanned") / 1024 / 1024 / 1024).alias("gb_scanned"),
                    (F.col("cpu_ms") / 1000).alias("cpu_seconds"), "query_tag"))
