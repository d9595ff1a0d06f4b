"""One registered query per corpus operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleet_engine.llm.clusters import cluster_vectors, with_inertia
from fleet_engine.llm.common import table
from fleet_engine.llm.decontaminate import leaks
from fleet_engine.llm.jaccard import jaccard_join
from fleet_engine.llm.lexical import lexical_search
from fleet_engine.llm.licenses import license_scan
from fleet_engine.llm.line_dedup import line_dedup
from fleet_engine.llm.packing import pack
from fleet_engine.llm.quality_rules import quality_rules, train_quality
from fleet_engine.llm.sharding import shard_documents
from fleet_engine.llm.sql import CLUSTERS_SQL, JACCARD_SQL, LEXICAL_SQL, LICENSES_SQL, LINES_SQL, REPEATS_SQL, WARC_SQL
from fleet_engine.llm.suffixes import remove_repeats
from fleet_engine.llm.toxicity import score_toxicity, train_toxicity
from fleet_engine.llm.url_filter import url_filter
from fleet_engine.llm.warc import read_records, write_archive
from fleet_engine.workspace import run_dir

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")    # the ranks of byte_bpe_50k.json
TOXIC_FROM = 0.7


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (shard_documents(table(spark, sf_dir, "documents"), shards=16)
            .withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("detections")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = write_archive(table(spark, sf_dir, "pages"), run_dir(spark, "warc"))
    return read_records(spark, archive).drop("digest_matches")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_text_links")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), digest_only=True)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(cluster_vectors(table(spark, sf_dir, "embeddings")))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_toxicity, op3_license_scan, op4_warc, op5_packing, op6_jaccard_join, op7_line_dedup,
                                   op8_suffix_dedup, op9_quality, op10_decontamination, op11_lexical_search, op12_url_filter, op13_clusters)}
ORACLE = {"op3_license_scan": LICENSES_SQL, "op4_warc": WARC_SQL, "op6_jaccard_join": JACCARD_SQL, "op7_line_dedup": LINES_SQL,
          "op8_suffix_dedup": REPEATS_SQL, "op11_lexical_search": LEXICAL_SQL, "op13_clusters": CLUSTERS_SQL}
