"""Telemetry feeds: JSON event files, merged feeds, literal rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("engine_temp_c", T.StringType()),     # a number, or a word such as ERROR
    T.StructField("error_code", T.StringType()),
    T.StructField("cloud_source", T.StringType()),
])


def read_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, multi_line: bool = True) -> DataFrame:
    """All ``*.json`` files of a folder. ``multi_line`` reads one JSON array per file; otherwise one object per line,
    which Spark can split and is the format to prefer for large feeds."""
    return (spark.read.schema(schema).option("multiLine", multi_line)
            .option("pathGlobFilter", "*.json").json(path))


def union_sources(feeds: dict[str, DataFrame], tag: str = "cloud_source") -> DataFrame:
    """Stack feeds of the same shape by column name, tagged with their source; missing columns become NULL."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def rows_df(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Literal rows (seed data, ground truth) as a DataFrame."""
    return spark.createDataFrame(rows, schema)
