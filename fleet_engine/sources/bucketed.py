"""Tables bucketed by the id of their texts: a join by that id moves the other side to the texts, which stay where they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleet_engine.operators.skew import dim_join, hot_keys, key_counts
from fleet_engine.workspace import run_dir


def write_texts(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Write ``df`` as a table of ``buckets`` buckets, one sorted file each, at ``path`` (default: a new folder of the shared space).

    ``key`` should tell rows apart, as document ids do. Rows without one are left out: no join by it can meet them. Take at least as many buckets as shuffle
    partitions, or Spark may shuffle the texts for the sake of parallelism, and so many that a bucket is some hundred MB.
    """
    spark = df.sparkSession
    (df.filter(F.col(key).isNotNull()).repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path or run_dir(spark, "texts")).saveAsTable(table))


def join_texts(spark: SparkSession, facts: DataFrame, table: str, key: str, spread: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """``facts`` with the ``columns`` (default: all) of their text in ``table``; facts without a text drop out.

    Only the facts are shuffled, to the buckets. Facts whose key very many of them share do not go to one bucket: the texts of these at most 1,000 keys are
    read by bucket and sent to the facts, by broadcast if they are small when measured, else salted.
    """
    texts = spark.table(table).select(key, *(c for c in columns or spark.table(table).columns if c != key))
    hot = hot_keys(key_counts(facts, key), key)
    if not hot:
        return facts.join(texts, key)
    often = F.col(key).isin(hot)
    return facts.filter(~often).join(texts, key).unionByName(dim_join(facts.filter(often), texts.filter(often), key, spread))
