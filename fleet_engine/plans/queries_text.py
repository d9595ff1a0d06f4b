"""Registered queries: text scores and batch inference (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleet_engine.operators import enrich, inference
from fleet_engine.operators.scorestore import score_once
from fleet_engine.plans import domain
from fleet_engine.plans.domain import (LANGUAGE_RULES, LEXICON_SQL, REQUESTS_SQL, RESPONSES_SQL, TRUTH_SQL, answer_sql,
                                       sentiment_sql, summary_sql, votes_sql, words_sql)
from fleet_engine.plans.registry import ORACLE, query
from fleet_engine.workspace import run_dir

NOW = domain.AS_OF


def docs(spark, sf_dir):
    return domain.read(spark, sf_dir, "documents")


@query("d1_summarize", f"WITH {summary_sql('documents', 'doc_id', 'text')} SELECT doc_id, summary, score FROM summaries")
def summarize(spark, sf_dir):
    return enrich.summarize(docs(spark, sf_dir), "doc_id", "text")


@query("d2_sentiment", f"WITH {LEXICON_SQL}, {sentiment_sql('documents', 'doc_id', 'text')} SELECT doc_id, sentiment FROM sentiments")
def sentiment(spark, sf_dir):
    return enrich.sentiment(docs(spark, sf_dir), "doc_id", "text", domain.learned_lexicon(spark, sf_dir))


def _listed(words):
    return f"len(list_filter({words_sql('text')}, lambda w: w IN ({', '.join(repr(w) for w in words)})))"


@query("d2_sentiment_default", f"""SELECT doc_id, round(coalesce((p - n) / nullif(p + n, 0), 0), 6)::DOUBLE AS sentiment
FROM (SELECT doc_id, {_listed(enrich.POSITIVE_WORDS)} AS p, {_listed(enrich.NEGATIVE_WORDS)} AS n FROM documents)""")
def sentiment_default(spark, sf_dir):
    return enrich.sentiment(docs(spark, sf_dir), "doc_id", "text")


@query("d2_scored_once", ORACLE["d2_sentiment_default"])
def scored_once(spark, sf_dir):
    return score_once(docs(spark, sf_dir), "doc_id", "text", enrich.sentiment, run_dir(spark, "scores"))


@query("d2_fit_lexicon", f"WITH {LEXICON_SQL} SELECT term, weight, docs FROM lexicon")
def fit_lexicon(spark, sf_dir):
    return domain.learned_lexicon(spark, sf_dir)


@query("d3_classify_keywords", f"SELECT doc_id, {votes_sql(words_sql('text'), LANGUAGE_RULES)} AS category FROM documents")
def classify_keywords(spark, sf_dir):
    return enrich.classify_keywords(docs(spark, sf_dir), "doc_id", "text", LANGUAGE_RULES)


@query("d3_text_classifier", "SELECT lang, count(*) AS n, true AS mostly_right FROM documents GROUP BY lang")
def text_classifier(spark, sf_dir):
    rows = docs(spark, sf_dir)
    model = enrich.fit_text_classifier(rows, "text", "lang")
    scored = enrich.apply_text_classifier(model, rows, "doc_id", "text").join(rows.select("doc_id", "lang"), "doc_id")
    right = F.avg((F.col("lang") == F.col("predicted_label")).cast("int"))
    return scored.groupBy("lang").agg(F.count("*").alias("n"), (right >= 0.9).alias("mostly_right"))


QUESTION = "Which of the parts is in the most need of a new thing?"


@query("d4_extract_answer", f"""SELECT doc_id, CASE WHEN ans.h > 0 THEN ans.a END AS answer,
  CASE WHEN ans.h > 0 THEN round(ans.h / len(list_distinct({words_sql(repr(QUESTION))})), 6)::DOUBLE END AS score
FROM (SELECT doc_id, {answer_sql('text', QUESTION)} AS ans FROM documents)""")
def extract_answer(spark, sf_dir):
    best = F.get("answers", 0)
    return (enrich.extract_answer(docs(spark, sf_dir), "doc_id", "text", QUESTION)
            .select("doc_id", best["answer"].alias("answer"), best["score"].alias("score")))


@query("d5_embed_text", f"""SELECT doc_id, 768 AS dim, CASE WHEN len({words_sql('text')}) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm
FROM documents""")
def embed_text(spark, sf_dir):
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return enrich.embed_text(docs(spark, sf_dir), "doc_id", "text").select(
        "doc_id", F.size("embedding").alias("dim"), F.round(F.sqrt(square), 4).alias("norm"))


def count_model(prompts: list[str]) -> list[str]:
    """Deterministic stand-in for a model: answers with the length of the prompt."""
    return [f"{len(p)} characters" for p in prompts]


@query("d6_complete_batch", f"""WITH {REQUESTS_SQL}
SELECT request_id, length(symptoms)::VARCHAR || ' characters' AS response, NULL::VARCHAR AS error FROM requests""")
def complete_batch(spark, sf_dir):
    return (inference.complete_batch(domain.requests(spark, sf_dir), "symptoms", count_model)
            .select("request_id", "response", "error"))


@query("d7_token_cost", f"""WITH {REQUESTS_SQL}
SELECT experiment_id, count(*) AS requests, sum(length(symptoms) // 4)::BIGINT AS tokens FROM requests GROUP BY 1""")
def token_cost(spark, sf_dir):
    return inference.token_cost(domain.requests(spark, sf_dir), "symptoms", "experiment_id")


TEMPLATES = {"EXP_A": 'Vehicle {vin} reports: {symptoms} Code: {code}. Answer as {{"diagnosis": ""}}',
             "EXP_B": "Answer from {context}: {symptoms}"}


@query("d8_render_prompts", f"""WITH {REQUESTS_SQL}
SELECT request_id, NULL AS missing_field, 'Vehicle ' || coalesce(vin, '') || ' reports: ' || symptoms || ' Code: ' || coalesce(error_code, '')
       || '. Answer as {{"diagnosis": ""}}' AS prompt FROM requests WHERE experiment_id = 'EXP_A'
UNION ALL SELECT request_id, 'context', NULL FROM requests WHERE experiment_id = 'EXP_B'
UNION ALL SELECT request_id, 'question', NULL FROM requests WHERE experiment_id = 'EXP_UNKNOWN'""")
def render_prompts(spark, sf_dir):
    rendered, rejects = inference.render_prompts(domain.requests(spark, sf_dir), TEMPLATES, "experiment_id",
                                                 {"vin": "vin", "symptoms": "symptoms", "code": "error_code"})
    return (rendered.select("request_id", F.lit(None).cast("string").alias("missing_field"), "prompt")
            .unionByName(rejects.select("request_id", "missing_field", F.lit(None).cast("string").alias("prompt"))))


@query("d9_parse_diagnosis", f"""WITH {RESPONSES_SQL}
SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN text ELSE 'Analysis Incomplete' END AS diagnosis,
       CASE WHEN role = 'assistant' THEN turn / 10.0::DOUBLE ELSE 0.0 END AS confidence_score,
       CASE WHEN role = 'assistant' THEN role ELSE 'Could not parse LLM response.' END AS supporting_evidence,
       CASE WHEN role = 'assistant' THEN 'Check pressure' END AS first_action FROM responses""")
def parse_diagnosis(spark, sf_dir):
    return inference.parse_diagnosis(domain.responses(spark, sf_dir), "raw").select(
        "conv_id", "turn", "result.diagnosis", "result.confidence_score", "result.supporting_evidence",
        F.get("result.recommended_actions", 0)["action"].alias("first_action"))


def audit_rows(spark, sf_dir):
    """Assistant turns as stored answers, system turns without one."""
    rows = domain.responses(spark, sf_dir).filter(F.col("role") != "user")
    body = F.to_json(F.struct(F.col("text").alias("diagnosis"), (F.col("turn") / 10).cast("string").alias("confidence_score"),
                              F.col("role").alias("supporting_evidence")))
    return rows.select(F.col("vin").alias("vin_reference"), "conv_id", "turn", F.lit("What is wrong?").alias("diagnostic_question"),
                       F.when(F.col("role") == "assistant", body).alias("ai_response_json"),
                       (F.col("turn") / 10).alias("confidence_score"))


AUDIT_SQL = RESPONSES_SQL + """, audit AS (
  SELECT vin AS vin_reference, 'What is wrong?' AS diagnostic_question, turn / 10.0::DOUBLE AS confidence_score,
         text AS parsed_diagnosis, turn / 10.0::DOUBLE AS parsed_confidence, role AS parsed_evidence
  FROM responses WHERE role = 'assistant')"""


def audit(spark, sf_dir):
    return inference.audit_report(audit_rows(spark, sf_dir), NOW)


TRUTH_JOIN_SQL = f"{TRUTH_SQL}, {AUDIT_SQL}, joined AS (SELECT * FROM truth LEFT JOIN audit ON vin_context = vin_reference)"

JUDGED_SQL = TRUTH_JOIN_SQL + f""", judged AS (SELECT *, CASE WHEN parsed_diagnosis IS NOT NULL THEN
    CASE WHEN len({words_sql('parsed_diagnosis')}) = 0 THEN 0.0
    ELSE round(len(list_intersect(list_distinct({words_sql('parsed_diagnosis')}), list_distinct({words_sql('expected_answer')})))
      / len(list_distinct({words_sql('parsed_diagnosis')})), 6) END END::DOUBLE AS faithfulness_score FROM joined)"""


def judged(spark, sf_dir):
    from fleet_engine.operators.joins import eval_join

    joined = eval_join(domain.ground_truth(spark, sf_dir), audit(spark, sf_dir).drop("ai_response_json"))
    return inference.judge(joined, "expected_answer", "parsed_diagnosis")


@query("d10_judge", f"""WITH {JUDGED_SQL} SELECT item_id, parsed_diagnosis, faithfulness_score FROM judged""")
def judge(spark, sf_dir):
    return judged(spark, sf_dir).select("item_id", "parsed_diagnosis", "faithfulness_score")


@query("d10_judge_question", f"""WITH {TRUTH_JOIN_SQL},
asked AS (SELECT conv_id, arg_min(text, turn) AS input_query FROM conversations WHERE role = 'user' GROUP BY conv_id),
said AS (SELECT item_id, input_query, parsed_diagnosis, list_distinct({words_sql('parsed_diagnosis')}) AS w,
    list_concat({words_sql('expected_answer')}, {words_sql("coalesce(input_query, '')")}) AS known FROM joined LEFT JOIN asked ON conv_id = item_id)
SELECT item_id, input_query, parsed_diagnosis, (CASE WHEN parsed_diagnosis IS NOT NULL THEN
  CASE WHEN len(w) = 0 THEN 0.0 ELSE round(len(list_intersect(w, list_distinct(known))) / len(w), 6) END END)::DOUBLE AS faithfulness_score FROM said""")
def judge_question(spark, sf_dir):
    """The first question of the item's conversation is graded along."""
    from fleet_engine.operators.joins import eval_join

    asked = domain.read(spark, sf_dir, "conversations").filter("role = 'user'").groupBy(F.col("conv_id").alias("item_id")).agg(F.min_by("text", "turn").alias("input_query"))
    truth = domain.ground_truth(spark, sf_dir).join(asked, "item_id", "left")
    joined = eval_join(truth, audit(spark, sf_dir).drop("ai_response_json"))
    graded = inference.judge(joined, "expected_answer", "parsed_diagnosis", "input_query")
    return graded.select("item_id", "input_query", "parsed_diagnosis", "faithfulness_score")


DOMAIN_WORDS = ["the", "and"]


@query("d11_guardrail", f"""WITH {REQUESTS_SQL}, g AS (
  SELECT request_id, len(list_filter({words_sql('symptoms')}, lambda w: w IN ('the', 'and'))) > 0 AS in_domain FROM requests)
SELECT request_id, in_domain, CASE WHEN NOT in_domain THEN '{inference.REFUSAL}' END AS refusal FROM g""")
def guardrail(spark, sf_dir):
    return (inference.guardrail(domain.requests(spark, sf_dir), "symptoms", DOMAIN_WORDS)
            .select("request_id", "in_domain", "refusal"))


@query("d12_extract_vin", f"""WITH {REQUESTS_SQL}
SELECT request_id, CASE WHEN turn = 0 THEN coalesce(vin, 'NONE') ELSE 'NONE' END AS vin_reference FROM requests""")
def extract_vin(spark, sf_dir):
    spoken = F.when(F.col("turn") == 0, F.concat_ws(" ", F.lit("On"), F.col("vin"), F.lit("please:"), F.lower("symptoms")))
    rows = domain.requests(spark, sf_dir).withColumn("prompt", F.coalesce(spoken, F.lower("symptoms"))).drop("vin")
    return inference.extract_vin(rows, "prompt").select("request_id", "vin_reference")


@query("d13_audit_report", f"""WITH {AUDIT_SQL}
SELECT *, '{NOW}.000000' AS evaluated_at FROM audit""")
def audit_report(spark, sf_dir):
    from fleet_engine.operators.clean import STAMP

    return (audit(spark, sf_dir).drop("ai_response_json")
            .withColumn("evaluated_at", F.date_format("evaluated_at", STAMP)))
