"""Shared scratch space: tables written here survive the loss of any executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIRS: dict[str, str] = {}
BROADCAST_BYTES = 32 << 20
MANY = 64              # partitions, some GB: a table with as many is never dealt out anew


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``. Only a local master may fall back to a folder of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="fleet-")
    return _LOCAL_DIRS[app]


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; never reused, so a replay cannot see an older run."""
    return f"{shared_dir(spark)}/fleet/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back: later readers share the work and the lineage ends here."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like ``stage``, with the folder, so that the caller can drop it once no later plan reads it."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder. What was computed from it must have been written before: a lost executor cannot go back to it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none where it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)] if folder_exists(spark, path) else []


def fits(df: DataFrame, max_rows: int = 10_000, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows that take at most ``max_bytes`` as JSON; one more row than that is read at most."""
    row_bytes = F.octet_length(F.to_json(F.struct("*"))).cast("bigint") + 8 * len(df.columns)
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()
    return size["n"] <= max_rows and size["bytes"] <= max_bytes


def broadcast_bounded(df: DataFrame, max_rows: int = 10_000, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only where ``fits`` has measured rows and bytes; larger inputs join by shuffle."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a small table that sits in a few unsplittable files out to all cores. Tables of ``MANY`` partitions stay as they are
    on any cluster and are not shuffled. Meant for tables as read: asking a longer plan for its partitions
    would run its shuffles."""
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df if parts >= min(cores, MANY) else df.repartition(min(cores, 8 * parts), *keys)
