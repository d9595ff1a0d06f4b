"""Bronze to silver: sentinels, range gates, keys, filters, deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleet_engine.functions.text import mask_tail

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def clean_sentinel(df: DataFrame, col: str, bad: str = "ERROR", value: float = -999.0, strict: bool = False,
                   out: str | None = None) -> DataFrame:
    """Numbers as doubles and the ``bad`` word as ``value``. Other text gives NULL, or stops the job when ``strict``."""
    raw = F.col(col)
    number = F.expr(f"try_cast(`{col}` AS double)")
    if strict:
        number = F.when(number.isNull(), F.raise_error(F.concat(F.lit(f"{col} is not a number: "),
                                                                 F.coalesce(raw, F.lit("NULL"))))).otherwise(number)
    return df.withColumn(out or col, F.when(raw == bad, F.lit(value)).otherwise(number))


def silver_telemetry(bronze: DataFrame, lo: float = -50, hi: float = 250, keep: tuple[str, ...] = ()) -> DataFrame:
    """Business names; rows without a code, with code NONE or outside the temperature gate are dropped."""
    return (bronze.filter((F.col("error_code") != "NONE") & F.col("engine_temp").between(lo, hi))
            .select(*keep, F.col("vin").alias("vin_reference"), F.col("error_code").alias("diagnostic_error_code"),
                    F.col("engine_temp").alias("engine_temperature_celsius"), F.col("log_text").alias("mechanic_notes")))


def pending_files(queue: DataFrame) -> DataFrame:
    """Queue rows that wait for processing."""
    return (queue.filter(F.col("status") == "PENDING")
            .select("ingestion_id", F.col("filename").alias("source_file"), "vin_reference", "s3_key", "file_size_mb",
                    "status", "received_at"))


def valid_logs(df: DataFrame, col: str = "log_text") -> DataFrame:
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def with_fault_id(df: DataFrame, vin: str = "vin", at: str = "recorded_at", code: str = "error_code") -> DataFrame:
    """Fault key from vehicle, time and code; NULL when one of them is NULL."""
    return df.withColumn("fault_id", F.md5(F.concat(F.col(vin), F.date_format(at, STAMP), F.col(code))))


def fault_base(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Faults with a note: key, masked vehicle, time and the raw note."""
    return with_fault_id(valid_logs(bronze)).select(
        *keep, "fault_id", mask_tail("vin").alias("vin_masked"), "recorded_at", F.col("log_text").alias("raw_log"))


def filter_key(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == value)


def critical_temp(df: DataFrame, threshold: float = 110.0, col: str = "engine_temp") -> DataFrame:
    return df.filter(F.col(col) > threshold)


def has_error(df: DataFrame, col: str = "error_code") -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def optional_eq(df: DataFrame, col: str, value=None) -> DataFrame:
    """Equality when a value is given. Without one all rows with a key pass: NULL keys never equal themselves."""
    return df.filter(F.col(col).isNotNull() if value is None else F.col(col) == value)


def dedupe(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``. Each partition keeps one row per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= 1).drop("_rn")


def recent(df: DataFrame, ts: str, interval: str, as_of: str) -> DataFrame:
    """Rows younger than ``interval`` (such as ``24 HOURS``) at ``as_of``. The bound is a literal, so it is pushed down."""
    return df.filter(F.col(ts) > F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL {interval}"))


def preview(df: DataFrame, col: str, order: list[Column], n: int = 200, k: int = 20) -> DataFrame:
    """The first ``k`` rows by ``order`` with the first ``n`` characters of a text, for display."""
    return df.orderBy(*order).limit(k).withColumn(col, F.left(F.col(col), F.lit(n)))
