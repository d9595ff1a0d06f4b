"""Upload notifications: validation, dead letters, queue rows, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleet_engine.functions.text import vin_from_filename

UPLOAD_SCHEMA = T.StructType([T.StructField("Records", T.ArrayType(T.StructType([
    T.StructField("s3", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([
            T.StructField("key", T.StringType()), T.StructField("size", T.LongType())])),
    ]))])))])


def classify_uploads(events: DataFrame, exts: tuple[str, ...] = (".pdf",), max_mb: float = 50.0) -> DataFrame:
    """One row per notification with its file facts and ``reason``, NULL when the file is accepted."""
    record = events.select(F.explode("Records").alias("r")).select(
        F.col("r.s3.bucket.name").alias("bucket"),
        F.coalesce(F.try_url_decode("r.s3.object.key"), F.col("r.s3.object.key")).alias("key"),
        (F.coalesce(F.col("r.s3.object.size"), F.lit(0)) / F.lit(1024 * 1024)).alias("mb"))
    named = record.withColumn("filename", F.element_at(F.split("key", "/"), -1))
    # a leading dot names a hidden file, it does not start an extension
    named = named.withColumn("extension", F.lower(F.regexp_extract("filename", "^\\.*[^.].*?(\\.[^.]*)$", 1)))
    limit = f"{max_mb:g}"
    reason = (F.when(~F.col("extension").isin(*exts), F.concat(F.lit("unsupported extension '"), F.col("extension"), F.lit("'")))
              .when(F.col("mb") > max_mb, F.concat(F.format_string("%.1f", "mb"), F.lit(f"MB exceeds {limit}MB limit"))))
    return named.select("bucket", "key", "filename", "extension", F.round("mb", 2).alias("size_mb"), reason.alias("reason"))


def validate_uploads(events: DataFrame, exts: tuple[str, ...] = (".pdf",), max_mb: float = 50.0) -> tuple[DataFrame, DataFrame]:
    """Accepted files, and rejects with their reason for a dead-letter table."""
    rows = classify_uploads(events, exts, max_mb)
    return rows.filter(F.col("reason").isNull()).drop("reason"), rows.filter(F.col("reason").isNotNull())


def register_uploads(ok: DataFrame, received_at: Column | str) -> DataFrame:
    """Accepted files as PENDING queue rows. The id is a hash of place and time: no counter, same on every replay."""
    at = F.lit(received_at) if isinstance(received_at, str) else received_at
    at = at.cast("timestamp_ntz")
    stamp = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    return ok.select(
        F.md5(F.concat_ws("|", F.col("bucket"), F.col("key"), stamp)).alias("ingestion_id"),
        F.col("bucket").alias("s3_bucket"), F.col("key").alias("s3_key"), "filename",
        vin_from_filename("filename", "UNKNOWN").alias("vin_reference"), F.lit("PENDING").alias("status"),
        F.lit(None).cast("string").alias("error_message"), F.col("size_mb").alias("file_size_mb"),
        at.alias("received_at"), F.lit(None).cast("timestamp_ntz").alias("processed_at"))


def classified_summary(classified: DataFrame) -> DataFrame:
    """Counts of accepted, rejected and all records, in one pass over the classified notifications."""
    ok = F.col("reason").isNull()
    return classified.agg(F.count_if(ok).alias("processed"), F.count_if(~ok).alias("errors"), F.count("*").alias("total_records"))


def ingest_summary(ok: DataFrame, rejects: DataFrame) -> DataFrame:
    """The same from accepted and rejected records that were written apart."""
    return classified_summary(ok.select(F.lit(None).cast("string").alias("reason")).unionAll(rejects.select("reason")))
