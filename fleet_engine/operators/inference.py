"""Batch inference: prompts out, structured answers in, with guard, cache, parsing and grading."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleet_engine.functions.text import token_estimate, tokens
from fleet_engine.operators.skew import key_counts, salted_join
from fleet_engine.sources.tables import prompt_hash, with_response_cache
from fleet_engine.workspace import stage

# The structured answer and what replaces an answer that cannot be read.
DIAGNOSIS_TYPE = ("struct<diagnosis:string,confidence_score:double,supporting_evidence:string,"
                  "recommended_actions:array<struct<action:string,acceptance_criteria:string>>>")
FALLBACK_DIAGNOSIS = "Analysis Incomplete"
FALLBACK_EVIDENCE = "Could not parse LLM response."

# Refusal, domain words and vehicle pattern of the agent.
REFUSAL = "I am an Automotive AI. I cannot answer queries unrelated to vehicles and diagnostics!"
DOMAIN_TERMS = ["car", "vehicle", "truck", "engine", "brake", "brakes", "transmission", "battery", "oil", "coolant",
                "diagnostic", "diagnostics", "misfire", "vin", "fault", "manual", "automotive", "service", "torque"]
VIN_PATTERN = "VIN[A-Z0-9_]+"

# Fixed value: the template used when a version is unknown.
DEFAULT_TEMPLATE = "Answer the question: {question}"

ModelFn = Callable[[list[str]], list[str]]


def complete_batch(df: DataFrame, prompt: str, model_fn: ModelFn, cache: DataFrame | None = None,
                   make_model: bool = False) -> DataFrame:
    """Add ``response``, ``error`` and ``latency`` (seconds per prompt of its batch) to every row, asking the model once per distinct uncached prompt.

    ``model_fn`` answers a list of prompts; with ``make_model`` it is a factory called once per partition, the place to
    load weights. A prompt that fails gets an error text and does not stop its batch.
    """
    if cache is None:
        todo = (df.select(prompt_hash(prompt).alias("prompt_hash"), F.col(prompt).alias("prompt"))
                .dropDuplicates(["prompt_hash"]))
    else:
        todo, known = with_response_cache(df, cache, prompt)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_fn() if make_model else model_fn
        for batch in batches:
            asked, started = batch["prompt"].tolist(), time.perf_counter()
            try:
                answers, errors = list(model(asked)), [None] * len(asked)
                if len(answers) != len(asked):
                    raise ValueError("model returned a different number of answers")
            except Exception:                      # one bad prompt must not take its batch along: ask one by one
                answers, errors = [], []
                for text in asked:
                    try:
                        answers.append(model([text])[0])
                        errors.append(None)
                    except Exception as e:
                        answers.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
            each = (time.perf_counter() - started) / max(1, len(asked))
            yield pd.DataFrame({"prompt_hash": batch["prompt_hash"].tolist(), "response": answers, "error": errors,
                                "latency": each}).astype({"response": object, "error": object})

    # written, so that no later reader asks the model again
    answers = stage(todo.mapInPandas(run, "prompt_hash string, response string, error string, latency double"), "answers")
    if cache is not None:
        answers = answers.unionByName(known.select("prompt_hash", "response", F.lit(None).cast("string").alias("error"),
                                                   F.lit(0.0).alias("latency")))
    hashed = df.withColumn("prompt_hash", prompt_hash(prompt))
    return salted_join(hashed, answers, "prompt_hash", df.columns, counts=key_counts(hashed, "prompt_hash"), how="left")


def with_tokens(df: DataFrame, col: str, out: str = "tokens") -> DataFrame:
    return df.withColumn(out, token_estimate(col))


def token_cost(df: DataFrame, col: str, by: str) -> DataFrame:
    """Requests and estimated tokens per group."""
    return with_tokens(df, col).groupBy(by).agg(F.count(F.lit(1)).alias("requests"), F.sum("tokens").alias("tokens"))


def render_prompts(df: DataFrame, templates: dict[str, str], version_col: str, fields: dict[str, str],
                   default: str = DEFAULT_TEMPLATE) -> tuple[DataFrame, DataFrame]:
    """Fill ``{field}`` places of each row's template version. Returns rendered rows and rejects.

    ``templates`` is configuration and becomes a literal map, so no join is needed. A field the template names but the
    call does not supply makes the row a reject with ``missing_field``. Doubled braces are literal braces.
    """
    table = F.create_map(*[F.lit(x) for pair in templates.items() for x in pair]) if templates else F.lit(None)
    template = F.coalesce(table[F.col(version_col)], F.lit(default)) if templates else F.lit(default)
    # literal braces are set aside, so that neither a template nor a value can be read as a field by mistake
    opened, closed = "\u0001", "\u0002"
    shaped = F.replace(F.replace(template, F.lit("{{"), F.lit(opened)), F.lit("}}"), F.lit(closed))
    needed = F.regexp_extract_all(shaped, F.lit("\\{([a-zA-Z_]+)\\}"), F.lit(1))
    missing = F.array_except(needed, F.array(*[F.lit(f) for f in fields]))
    parts = F.split(shaped, "[{}]")        # odd positions are field names
    values = F.create_map(*[x for f, c in fields.items() for x in (F.lit(f), F.coalesce(F.col(c).cast("string"), F.lit("")))])
    filled = F.array_join(F.transform(F.col("_parts"), lambda p, i: F.when(i % 2 == 1, F.col("_values")[p]).otherwise(
        F.translate(p, opened + closed, "{}"))), "")
    rows = df.withColumn("_parts", parts).withColumn("_values", values).withColumn("missing_field", F.get(missing, 0))
    rendered = rows.filter(F.col("missing_field").isNull()).withColumn("prompt", filled)
    rejects = rows.filter(F.col("missing_field").isNotNull())
    return rendered.drop("_parts", "_values", "missing_field"), rejects.drop("_parts", "_values")


def diagnosis_column(raw: Column) -> Column:
    """A model answer as the diagnosis struct; any answer without all four valid fields becomes the fallback."""
    text = F.trim(F.regexp_replace(raw, "```(?:json)?", ""))
    doc = F.try_parse_json(text)
    score = F.try_variant_get(doc, "$.confidence_score", "double")
    diagnosis = F.try_variant_get(doc, "$.diagnosis", "string")
    evidence = F.try_variant_get(doc, "$.supporting_evidence", "string")
    actions = F.try_variant_get(doc, "$.recommended_actions", "array<struct<action:string,acceptance_criteria:string>>")
    whole = F.forall(actions, lambda a: a["action"].isNotNull() & a["acceptance_criteria"].isNotNull())
    valid = score.isNotNull() & diagnosis.isNotNull() & evidence.isNotNull() & actions.isNotNull() & whole
    parsed = F.struct(diagnosis.alias("diagnosis"), score.alias("confidence_score"),
                      evidence.alias("supporting_evidence"), actions.alias("recommended_actions"))
    fallback = F.struct(F.lit(FALLBACK_DIAGNOSIS).alias("diagnosis"), F.lit(0.0).alias("confidence_score"),
                        F.lit(FALLBACK_EVIDENCE).alias("supporting_evidence"),
                        F.array().cast("array<struct<action:string,acceptance_criteria:string>>").alias("recommended_actions"))
    return F.when(valid, parsed.cast(DIAGNOSIS_TYPE)).otherwise(fallback.cast(DIAGNOSIS_TYPE))


def parse_diagnosis(df: DataFrame, raw: str, out: str = "result") -> DataFrame:
    return df.withColumn(out, diagnosis_column(F.col(raw)))


def overlap_precision(expected: Column, actual: Column, question: Column | None = None) -> Column:
    """Share of the answer's distinct words that the expected answer, or the question, holds; NULL when either answer is NULL."""
    said, known = F.array_distinct(tokens(actual)), F.array_distinct(tokens(expected))
    if question is not None:
        known = F.array_union(known, tokens(F.coalesce(question, F.lit(""))))
    share = F.size(F.array_intersect(said, known)) / F.size(said)
    score = F.when(F.size(said) == 0, F.lit(0.0)).otherwise(share)
    return F.when(expected.isNotNull() & actual.isNotNull(), F.round(score, 6))


def judge(df: DataFrame, expected: str, actual: str, question: str | None = None) -> DataFrame:
    """Grade answers: the verdict as JSON and the score read back out of it. A model-backed judge writes the same JSON.

    With a ``question`` its words count as known: an answer that repeats the question makes nothing up. A NULL question adds none.
    """
    score = overlap_precision(F.col(expected), F.col(actual), None if question is None else F.col(question))
    reason = "share of answer words in the expected answer" + ("" if question is None else " or the question")
    verdict = F.to_json(F.struct(score.alias("faithfulness"), F.lit(reason).alias("reason")))
    graded = df.withColumn("faithfulness_eval", F.when(score.isNotNull(), verdict))
    return graded.withColumn("faithfulness_score", score_from_verdict(F.col("faithfulness_eval")))


def score_from_verdict(verdict: Column, field: str = "faithfulness") -> Column:
    return F.try_variant_get(F.try_parse_json(verdict), f"$.{field}", "double")


def guardrail(df: DataFrame, prompt: str, domain_terms: list[str] | None = None) -> DataFrame:
    """``in_domain`` for prompts with a domain word; the others carry the refusal as their answer."""
    allowed = F.exists(tokens(prompt), lambda w: w.isin(*(domain_terms or DOMAIN_TERMS)))
    return (df.withColumn("in_domain", F.coalesce(allowed, F.lit(False)))
            .withColumn("refusal", F.when(~F.col("in_domain"), F.lit(REFUSAL))))


def extract_vin(df: DataFrame, prompt: str, pattern: str = VIN_PATTERN, out: str = "vin_reference") -> DataFrame:
    """The first vehicle named in a prompt, else ``NONE``."""
    return df.withColumn(out, F.coalesce(F.nullif(F.regexp_extract(prompt, f"({pattern})", 1), F.lit("")), F.lit("NONE")))


def audit_report(responses: DataFrame, as_of: str) -> DataFrame:
    """Stored answers with typed fields; rows without an answer are dropped."""
    doc = F.try_parse_json("ai_response_json")
    return (responses.filter(F.col("ai_response_json").isNotNull()).select(
        "vin_reference", "diagnostic_question", doc.alias("ai_response_json"), "confidence_score",
        F.lit(as_of).cast("timestamp_ntz").alias("evaluated_at"),
        F.try_variant_get(doc, "$.diagnosis", "string").alias("parsed_diagnosis"),
        F.try_variant_get(doc, "$.confidence_score", "double").alias("parsed_confidence"),
        F.try_variant_get(doc, "$.supporting_evidence", "string").alias("parsed_evidence")))
