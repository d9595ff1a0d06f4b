"""Corpus pipeline: documents to packed training sequences, in five stages that each write what the next one reads."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleet_engine.llm.common import table
from fleet_engine.llm.decontaminate import decontaminate
from fleet_engine.llm.jaccard import keep_one
from fleet_engine.llm.line_dedup import line_dedup
from fleet_engine.llm.packing import pack
from fleet_engine.llm.quality_rules import quality_rules, train_quality
from fleet_engine.workspace import drop_folder, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the plain rules and the classifier accept."""
    docs = docs.select(*COLUMNS)
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs, model, keep=tuple(COLUMNS)).filter("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; ``n_chars`` follows the text."""
    kept = line_dedup(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return keep_one(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a sequence."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("jaccard_join", near_duplicates), ("decontamination", decontamination), ("packing", packing)]
ORACLE_SQL = None    # trained verdicts and a greedy packing are not SQL; tests/llm compare each stage with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents").select(*COLUMNS), None
    for name, apply in STAGES[:-1]:
        docs, path = staged(apply(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop_folder(spark, before)      # the next stage's table is whole: nothing reads this one again
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
