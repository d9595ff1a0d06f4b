"""Search service over an index, and batch diagnosis from request to structured answer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import IDFModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleet_engine.operators.enrich import embed_text
from fleet_engine.operators.fusion import hybrid_search
from fleet_engine.operators.inference import ModelFn, complete_batch, parse_diagnosis, render_prompts, with_tokens
from fleet_engine.operators.joins import apply_experiments
from fleet_engine.operators.keywords import bm25_index, bm25_topk, keyword_search, write_index
from fleet_engine.operators.vectors import vector_topk
from fleet_engine.workspace import broadcast_bounded, stage


@dataclass
class SearchService:
    """A written BM25 index whose rows carry filterable attributes."""

    postings: DataFrame
    attributes: tuple[str, ...]

    def search(self, queries: DataFrame, k: int, filters: dict[str, object] | None = None,
               query_id: str = "query_id", text: str = "text") -> DataFrame:
        """Best ``k`` documents per query among those with the given attribute values; weights stay those of the whole
        corpus. The filters reach the scan of the index."""
        rows = self.postings
        for name, value in (filters or {}).items():
            if name not in self.attributes:
                raise ValueError(f"{name} is not an attribute of this index")
            rows = rows.filter(F.col(name) == value)
        return bm25_topk(rows, queries, k, query_id, text)


def search_service(docs: DataFrame, id: str, text: str, attributes: tuple[str, ...], path: str) -> SearchService:
    """Build the index over a query, write it to ``path`` and open it."""
    write_index(bm25_index(docs, id, text, attributes), path)
    return open_search(docs.sparkSession, path, attributes)


def open_search(spark: SparkSession, path: str, attributes: tuple[str, ...]) -> SearchService:
    return SearchService(spark.read.parquet(path), attributes)


def _with_content(hits: DataFrame, texts: DataFrame) -> DataFrame:
    """Hits with their ``content``. The ids of the hits go to the texts first, so texts that nobody found are not shuffled."""
    hits = stage(hits, "found")
    wanted = broadcast_bounded(hits.select("item_id").distinct(), 2_000_000)
    return hits.join(texts.select("item_id", "content").join(wanted, "item_id", "left_semi"), "item_id")


def diagnose_batch(requests: DataFrame, registry: DataFrame, manuals: DataFrame, logs: DataFrame, embedder: IDFModel,
                   templates: dict[str, str], model_fn: ModelFn, cache: DataFrame | None = None) -> DataFrame:
    """Structured diagnosis per request, all requests in one job.

    ``requests`` has (request_id, symptoms, vin, error_code, experiment_id); ``manuals`` (item_id, vin, content, embedding)
    with vectors of ``embedder``; ``logs`` (item_id, vin, content). Requests whose template cannot be filled come back with
    ``rejected_field`` and no answer.
    """
    asked = (apply_experiments(requests, registry).withColumn("vin", F.coalesce("vin", F.lit("GENERAL")))
             .withColumn("code", F.coalesce("error_code", F.lit("NONE")))
             .withColumn("question", F.concat_ws(" ", "symptoms", F.coalesce("error_code", F.lit("")))))
    lookup = asked.select(F.col("request_id").alias("query_id"), "vin", "question")
    near = vector_topk(embed_text(lookup, "query_id", "question", model=embedder, keep=("vin",)), manuals, 1, key="vin")
    vector = _with_content(near, manuals)
    named = keyword_search(lookup, logs, "vin", 1, pattern="question", text="content")
    keyword = _with_content(named, logs)
    found = hybrid_search(asked.withColumnRenamed("request_id", "query_id"), vector, keyword)
    # searched once; rendered rows and rejects both read the written result
    found = stage(found, "diagnose")
    rendered, rejects = render_prompts(found, templates, "prompt_version",
                                       {"context": "context", "symptoms": "symptoms", "error_code": "code"})
    answered = parse_diagnosis(with_tokens(complete_batch(rendered, "prompt", model_fn, cache), "prompt"), "response")
    wanted = ["request_id", "provider_used", "search_confidence", "result", "sources", "tokens", "llm_latency", "error",
              "rejected_field"]
    done = (answered.withColumnsRenamed({"query_id": "request_id", "provider": "provider_used", "latency": "llm_latency"})
            .withColumn("rejected_field", F.lit(None).cast("string")))
    out = (rejects.withColumnsRenamed({"query_id": "request_id", "provider": "provider_used", "missing_field": "rejected_field"}))
    for name in wanted:
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(done.schema[name].dataType))
    return done.select(*wanted).unionByName(out.select(*wanted))
