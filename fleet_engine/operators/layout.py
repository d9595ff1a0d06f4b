"""Table layout, snapshots and job history."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleet_engine.session import tagged
from fleet_engine.sources.tables import materialize
from fleet_engine.workspace import stage


def write_clustered(df: DataFrame, path: str, cols: list[str], date_col: str | None = None, bloom: str | None = None,
                    mode: str = "overwrite") -> None:
    """Write files that each cover a narrow range of ``cols``, optionally below one folder per day of ``date_col``.

    Ranges are sampled, so a frequent key spans several files. ``bloom`` adds a Parquet bloom filter on a column.
    """
    if date_col:
        df = df.withColumn("event_date", F.to_date(date_col))
        cols = ["event_date", *cols]
    writer = df.repartitionByRange(*cols).sortWithinPartitions(*cols).write.mode(mode)
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
    (writer.partitionBy("event_date") if date_col else writer).parquet(path)


def lookup(table: DataFrame, key: str, value) -> DataFrame:
    """Rows of one key; on a clustered table the pushed filter skips all other row groups."""
    return table.filter(F.col(key) == value)


def _running(df: DataFrame, order: str, values: list[str]) -> DataFrame:
    """Running totals over a global order without sorting everything in one task: totals inside range partitions, plus the
    sums of the partitions before (one small row per partition)."""
    # written once, so that both readers see the same partition numbers
    parts = stage(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = parts.groupBy("_part").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in values])
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (parts.join(F.broadcast(offsets), "_part")        # one row per shuffle partition
            .select(order, *[(F.sum(v).over(inside) + F.col(f"_off_{v}")).alias(f"cum_{v}") for v in values]))


def file_ranges(table: DataFrame, col: str) -> DataFrame:
    """Smallest and largest key per data file."""
    return (table.filter(F.col(col).isNotNull()).groupBy(F.col("_metadata.file_path").alias("file_path"))
            .agg(F.min(col).alias("lo"), F.max(col).alias("hi")))


def depth_of_ranges(ranges: DataFrame) -> DataFrame:
    """Mean number of ranges that a range overlaps, itself included: 1.0 means disjoint files, above 4 means recluster.

    Overlaps of [lo, hi] are the ranges that start up to hi less those that end before lo, both from running counts.
    """
    starts = ranges.select(F.col("lo").alias("v"), F.lit(1).alias("starts"), F.lit(0).alias("ends"))
    ends = ranges.select(F.col("hi").alias("v"), F.lit(0).alias("starts"), F.lit(1).alias("ends"))
    points = starts.unionAll(ends).groupBy("v").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    cum = _running(points, "v", ["starts", "ends"]).join(points.select("v", "ends"), "v")
    at_hi = cum.select(F.col("v").alias("hi"), F.col("cum_starts").alias("_started"))
    at_lo = cum.select(F.col("v").alias("lo"), (F.col("cum_ends") - F.col("ends")).alias("_ended"))
    depth = F.col("_started") - F.col("_ended")
    return (ranges.join(at_hi, "hi").join(at_lo, "lo")
            .agg(F.count(F.lit(1)).alias("files"), F.round(F.avg(depth), 6).alias("average_depth"),
                 F.max(depth).alias("max_depth"))
            .withColumn("needs_clustering", F.coalesce(F.col("average_depth") > 4.0, F.lit(False))))


def clustering_depth(table: DataFrame, col: str) -> DataFrame:
    return depth_of_ranges(file_ranges(table, col))


MANIFEST = T.StructType([T.StructField("snapshot_at", T.TimestampNTZType()), T.StructField("path", T.StringType())])
RETENTION_DAYS = 7


def _commit(spark: SparkSession, root: str, ts: str, path: str) -> None:
    row = spark.range(1).select(F.lit(ts).cast("timestamp_ntz").alias("snapshot_at"), F.lit(path).alias("path"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def save_snapshot(df: DataFrame, root: str, ts: str) -> str:
    """Write a version; it counts from the moment its manifest row is written."""
    path = f"{root}/data/{''.join(c for c in ts if c.isdigit())}"
    df.write.mode("errorifexists").parquet(path)
    _commit(df.sparkSession, root, ts, path)
    return path


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def read_as_of(spark: SparkSession, root: str, ts: str, now: str | None = None, days: int = RETENTION_DAYS) -> DataFrame:
    """The table as it was at ``ts``. With ``now``, times before the retention window are refused."""
    rows = manifest(spark, root).filter(F.col("snapshot_at") <= F.lit(ts).cast("timestamp_ntz"))
    if now is not None:
        age = spark.range(1).select((F.lit(ts).cast("timestamp_ntz") >= F.expr(f"TIMESTAMP_NTZ '{now}' - INTERVAL {days} DAYS")).alias("ok"))
        if not age.first()["ok"]:
            raise ValueError(f"{ts} is outside the retention of {days} days")
    path = rows.agg(F.max_by("path", "snapshot_at").alias("path")).first()["path"]
    if path is None:
        raise ValueError(f"no snapshot at or before {ts}")
    return spark.read.parquet(path)


def rollback(spark: SparkSession, root: str, ts: str, now: str) -> None:
    """Make the version at ``ts`` current again from ``now`` on; its files are reused, not copied."""
    path = (manifest(spark, root).filter(F.col("snapshot_at") <= F.lit(ts).cast("timestamp_ntz"))
            .agg(F.max_by("path", "snapshot_at").alias("path")).first()["path"])
    if path is None:
        raise ValueError(f"no snapshot at or before {ts}")
    _commit(spark, root, now, path)


def expired_snapshots(spark: SparkSession, root: str, now: str, days: int = RETENTION_DAYS) -> DataFrame:
    """Data folders that no time inside the retention window can read; the storage's lifecycle rule removes them."""
    bound = F.expr(f"TIMESTAMP_NTZ '{now}' - INTERVAL {days} DAYS")
    rows = manifest(spark, root)
    oldest_needed = rows.filter(F.col("snapshot_at") <= bound).agg(F.max("snapshot_at")).scalar()
    used = rows.filter(F.col("snapshot_at") >= F.coalesce(oldest_needed, F.lit("0001-01-01").cast("timestamp_ntz")))
    return rows.select("path").distinct().join(used.select("path"), "path", "left_anti")


def snapshot_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that were added, removed or changed from ``a`` to ``b``; rows are compared null-safe. Keys are unique per side."""
    rest = [c for c in a.columns if c not in keys]
    old = a.select(*keys, F.struct(*rest).alias("_old"))
    new = b.select(*keys, F.struct(*rest).alias("_new"))
    both = old.join(new, keys, "full_outer")
    change = (F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
              .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed"))
    return both.withColumn("change", change).filter(F.col("change").isNotNull()).select(*keys, "change")


def refresh_mv(df: DataFrame, name: str, path: str) -> DataFrame:
    """Replace a precomputed aggregate and return it."""
    return materialize(df, name, "table", "overwrite", path)


TRACK_SCHEMA = ("query_id string, query_text string, query_tag string, start_time timestamp_ntz, elapsed_ms bigint, "
                "rows_written bigint")


def tracked_write(df: DataFrame, path: str, history: str, tag: str, text: str) -> None:
    """Write a table under a job tag and append what ran to the history table; rows are counted while they are written."""
    spark, seen, started = df.sparkSession, Observation(), time.time()
    with tagged(spark, tag, text):
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    row = (uuid.uuid4().hex, text, tag, datetime.fromtimestamp(started, timezone.utc).replace(tzinfo=None),
           round((time.time() - started) * 1000), seen.get["n"])
    spark.createDataFrame([row], TRACK_SCHEMA).coalesce(1).write.mode("append").parquet(history)


LOG_SCHEMA = T.StructType([
    T.StructField("Event", T.StringType()),
    T.StructField("Job ID", T.LongType()),
    T.StructField("Submission Time", T.LongType()),
    T.StructField("Completion Time", T.LongType()),
    T.StructField("Stage IDs", T.ArrayType(T.LongType())),
    T.StructField("Stage ID", T.LongType()),
    T.StructField("Properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("Task Metrics", T.StructType([
        T.StructField("Executor CPU Time", T.LongType()),
        T.StructField("Input Metrics", T.StructType([T.StructField("Bytes Read", T.LongType())])),
    ])),
])


def query_history(spark: SparkSession, event_log: str) -> DataFrame:
    """Jobs of finished applications from Spark's event logs, in the shape that ``ranking.top_queries`` takes."""
    previous = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        log = spark.read.schema(LOG_SCHEMA).json(event_log).withColumn("app", F.col("_metadata.file_name"))
        start = log.filter(F.col("Event") == "SparkListenerJobStart").select(
            "app", F.col("Job ID").alias("job"), F.col("Submission Time").alias("began"),
            F.col("Stage IDs").alias("stages"), F.col("Properties")["spark.jobGroup.id"].alias("query_tag"),
            F.col("Properties")["spark.job.description"].alias("query_text"))
        end = log.filter(F.col("Event") == "SparkListenerJobEnd").select(
            "app", F.col("Job ID").alias("job"), F.col("Completion Time").alias("ended"))
        task = log.filter(F.col("Event") == "SparkListenerTaskEnd").groupBy("app", F.col("Stage ID").alias("stage")).agg(
            F.sum(F.col("Task Metrics.Executor CPU Time")).alias("cpu_ns"),
            F.sum(F.col("Task Metrics.Input Metrics.Bytes Read")).alias("bytes"))
        cost = (start.select("app", "job", F.explode("stages").alias("stage")).join(task, ["app", "stage"])
                .groupBy("app", "job").agg(F.sum("cpu_ns").alias("cpu_ns"), F.sum("bytes").alias("bytes")))
        return (start.drop("stages").join(end, ["app", "job"]).join(cost, ["app", "job"], "left")
                .select(F.concat_ws("/", "app", F.col("job").cast("string")).alias("query_id"), "query_text", "query_tag",
                        F.timestamp_millis("began").cast("timestamp_ntz").alias("start_time"),
                        (F.col("ended") - F.col("began")).alias("elapsed_ms"),
                        F.coalesce("bytes", F.lit(0)).alias("bytes_scanned"),
                        (F.coalesce("cpu_ns", F.lit(0)) / 1e6).alias("cpu_ms")))
    finally:
        spark.conf.set("spark.sql.caseSensitive", previous)
