"""A processing queue with claims: PENDING, PROCESSING under a claim with a lease, then COMPLETED or FAILED.

The status log is append-only. A run writes its claims before it works, reads the log back, and works only on what it won: the earliest live claim of a
file. A claim whose lease has run out without a result is taken again; if the first owner finishes after all, the first result counts.
Each step of a run is one folder of the log named after the claim, so a step that is repeated replaces itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleet_engine.operators.documents import process_pending
from fleet_engine.operators.skew import salted_join
from fleet_engine.workspace import folder_exists, stage

LOG = "ingestion_id string, filename string, status string, error_message string, claim_id string, at timestamp_ntz, until timestamp_ntz"
DONE = ("COMPLETED", "FAILED")


def _put(rows: DataFrame, log: str, step: str) -> None:
    rows.select(*[c.split()[0] for c in LOG.split(", ")]).write.mode("overwrite").parquet(f"{log}/step={step}")


def _row(status: str | Column, at: Column, claim: str | None, until: Column | None = None, error: Column | None = None) -> dict[str, Column]:
    null = F.lit(None)
    return {"status": F.lit(status) if isinstance(status, str) else status, "error_message": null.cast("string") if error is None else error, "claim_id": F.lit(claim).cast("string"),
            "at": at, "until": null.cast("timestamp_ntz") if until is None else until}


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(log) if folder_exists(spark, log) else spark.createDataFrame([], LOG)


def enqueue(queue: DataFrame, log: str, step: str, filename: str = "filename") -> None:
    """Log registered files as PENDING."""
    rows = queue.select("ingestion_id", F.col(filename).alias("filename"), F.col("received_at").cast("timestamp_ntz").alias("_at"))
    _put(rows.withColumns(_row("PENDING", F.col("_at"), None)), log, f"register-{step}")


def _order(status: Column) -> Column:
    return F.when(status == "PENDING", 0).when(status == "PROCESSING", 1).otherwise(2)


def queue_state(log: DataFrame, now: str) -> DataFrame:
    """(ingestion_id, filename, status, error_message, claim_id): the first result of a file, else the earliest claim that is live at ``now``, else PENDING.

    Combined before the shuffle: one row per file and input partition."""
    at, live = F.lit(now).cast("timestamp_ntz"), F.col("until") > F.lit(now).cast("timestamp_ntz")
    row = F.struct("at", F.coalesce("claim_id", F.lit("")).alias("claim_id"), "status", "error_message")
    known = log.filter(F.col("at") <= at).groupBy("ingestion_id").agg(
        F.first("filename").alias("filename"), F.min(F.when(F.col("status").isin(*DONE), row)).alias("_done"), F.min(F.when((F.col("status") == "PROCESSING") & live, row)).alias("_claim"))
    best = F.coalesce("_done", "_claim")
    return known.select("ingestion_id", "filename", F.coalesce(best["status"], F.lit("PENDING")).alias("status"), best["error_message"].alias("error_message"), best["claim_id"].alias("claim_id"))


def claim(spark: SparkSession, log: str, claim_id: str, now: str, lease: str) -> DataFrame:
    """Claim all files that wait at ``now``, for ``lease`` (an interval such as ``10 MINUTES``), and return those that this claim won."""
    waiting = queue_state(read_log(spark, log), now).filter("status = 'PENDING'")
    at = F.lit(now).cast("timestamp_ntz")
    _put(waiting.select("ingestion_id", "filename").withColumns(_row("PROCESSING", at, claim_id, at + F.expr(f"INTERVAL {lease}"))), log, f"claim-{claim_id}")
    return queue_state(read_log(spark, log), now).filter((F.col("status") == "PROCESSING") & (F.col("claim_id") == claim_id)).select("ingestion_id", "filename")


def run_claimed(queue: DataFrame, files: DataFrame, log: str, out: str, claim_id: str, now: str, lease: str, finished: str | None = None, mode: str = "text") -> None:
    """One run over the queue under a claim: chunks below ``out``, then the results in the log. Chunks come first, so a result always has its chunks."""
    spark = queue.sparkSession
    won = stage(claim(spark, log, claim_id, now, lease), "claimed")
    rows = salted_join(queue.withColumn("status", F.lit("PENDING")), won.select("ingestion_id"), "ingestion_id", "ingestion_id")
    chunks, status, _ = process_pending(rows, files, now, mode)
    chunks.write.mode("overwrite").parquet(f"{out}/claim_id={claim_id}")
    at = F.lit(finished or now).cast("timestamp_ntz")
    result = won.join(status.withColumnsRenamed({"status": "_status", "error_message": "_error"}).drop("processed_at"), "ingestion_id")
    _put(result.withColumns(_row(F.col("_status"), at, claim_id, None, F.col("_error"))), log, f"result-{claim_id}")


def finished_chunks(spark: SparkSession, log: str, out: str, now: str) -> DataFrame:
    """Chunks of the claims whose result counts."""
    counts = queue_state(read_log(spark, log), now).filter("status = 'COMPLETED'").select(F.col("filename").alias("source_file"), "claim_id")
    return spark.read.option("basePath", out).parquet(out).withColumn("claim_id", F.col("claim_id").cast("string")).join(counts, ["source_file", "claim_id"], "left_semi").drop("claim_id")


def status_history(log: DataFrame) -> DataFrame:
    """(ingestion_id, step, status, claim_id, error_message) of every file in the order of its states, numbered from 1."""
    order = Window.partitionBy("ingestion_id").orderBy("at", _order(F.col("status")), F.col("claim_id").asc_nulls_first())
    return log.select("ingestion_id", F.row_number().over(order).alias("step"), "status", "claim_id", "error_message")
