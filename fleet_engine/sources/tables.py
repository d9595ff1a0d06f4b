"""Tables, views, file listings, run logs and the response cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType([
    T.StructField("experiment_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("vin", T.StringType()),
    T.StructField("metrics", T.StructType([
        T.StructField("tokens", T.LongType()),
        T.StructField("latency_total", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
    ])),
])


def materialize(df: DataFrame, name: str, kind: str = "table", mode: str = "overwrite", path: str | None = None,
                partition_by: list[str] | None = None) -> DataFrame:
    """Publish a model as a table (written now) or a view (evaluated by each reader) and return it read back."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode(mode).format("parquet")
        if path:
            writer = writer.option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"unknown kind: {kind}")
    return df.sparkSession.table(name)


def list_files(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Name, size and time of every file below ``path`` with the suffix; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True)
            .load(path)
            .select(F.col("path"), F.element_at(F.split("path", "/"), -1).alias("filename"),
                    F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")))


def append_runs(runs: DataFrame, path: str) -> None:
    """Append experiment runs as JSON lines."""
    runs.select(*RUN_SCHEMA.names).write.mode("append").json(path)


def read_runs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read run logs: JSON lines, or one pretty-printed object per file with ``multi_line``."""
    return spark.read.schema(RUN_SCHEMA).option("multiLine", multi_line).json(path)


def prompt_hash(prompt: str = "prompt"):
    return F.sha2(F.col(prompt), 256)


def with_response_cache(prompts: DataFrame, cache: DataFrame, prompt: str = "prompt") -> tuple[DataFrame, DataFrame]:
    """Split distinct prompts into those still to be answered and those the cache (prompt_hash, response) answers.

    Prompts are made distinct first, so a prompt that many requests share reaches the join as one row.
    """
    distinct = (prompts.select(prompt_hash(prompt).alias("prompt_hash"), F.col(prompt).alias("prompt"))
                .dropDuplicates(["prompt_hash"]))
    known = cache.select("prompt_hash", "response")
    return (distinct.join(known.select("prompt_hash"), "prompt_hash", "left_anti"),
            distinct.join(known, "prompt_hash"))
