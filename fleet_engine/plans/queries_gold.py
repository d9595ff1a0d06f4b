"""Registered queries: joins (E), aggregates (F), ranked reports (G)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fleet_engine.functions.text import mask_tail
from fleet_engine.operators import aggregates, documents, joins, ranking
from fleet_engine.operators.clean import STAMP
from fleet_engine.operators.skew import topk
from fleet_engine.plans import domain, medallion
from fleet_engine.plans.domain import FAULTS_SQL, MANUALS_SQL, REQUESTS_SQL, SCORED_SQL, SILVER_SQL, STAMP_SQL, summary_sql
from fleet_engine.plans.queries_ingest import TEXT_BLOCKS_SQL, experiment_runs
from fleet_engine.plans.queries_text import AUDIT_SQL, JUDGED_SQL, TRUTH_JOIN_SQL, audit, judged
from fleet_engine.plans.registry import ORACLE, query
from fleet_engine.sources import bucketed, tables
from fleet_engine.workspace import run_dir, spread

NOW = domain.AS_OF


@query("e1_eval_join", f"WITH {TRUTH_JOIN_SQL} SELECT item_id, vin_context, parsed_diagnosis, confidence_score FROM joined")
def eval_join(spark, sf_dir):
    return (joins.eval_join(domain.ground_truth(spark, sf_dir), audit(spark, sf_dir).drop("ai_response_json"))
            .select("item_id", "vin_context", "parsed_diagnosis", "confidence_score"))


@query("e2_lateral_chunks", f"""WITH {MANUALS_SQL}, {REQUESTS_SQL}, wanted AS (SELECT DISTINCT vin FROM requests),
f AS (SELECT filename AS source_file, vin AS vin_reference, content AS text FROM manuals JOIN wanted USING (vin)),
b AS (SELECT source_file, vin_reference, {TEXT_BLOCKS_SQL} AS b FROM f)
SELECT source_file, vin_reference, unnest(b) AS chunk_text, generate_subscripts(b, 1) - 1 AS chunk_index FROM b""")
def lateral_chunks(spark, sf_dir):
    manuals = domain.manuals(spark, sf_dir).withColumnRenamed("filename", "source_file")
    wanted = domain.requests(spark, sf_dir).select("vin").distinct()
    files = manuals.join(wanted, "vin", "left_semi").select("source_file", F.col("vin").alias("vin_reference"))
    return (documents.lateral_chunks(files, manuals)
            .select("source_file", "vin_reference", "chunk_text", F.col("chunk_index").cast("long")))


@query("e2_lateral_bucketed", ORACLE["e2_lateral_chunks"])
def lateral_bucketed(spark, sf_dir):
    manuals = domain.manuals(spark, sf_dir).withColumnRenamed("filename", "source_file")
    wanted = domain.requests(spark, sf_dir).select("vin").distinct()
    table = f"manual_texts_{uuid.uuid4().hex}"
    bucketed.write_texts(manuals, table, "source_file", int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = spark.table(table).join(wanted, "vin", "left_semi").select("source_file", F.col("vin").alias("vin_reference"))
    return (documents.lateral_chunks_bucketed(files, table)
            .select("source_file", "vin_reference", "chunk_text", F.col("chunk_index").cast("long")))


@query("e3_candidate_counts", f"""WITH {MANUALS_SQL}, {REQUESTS_SQL}
SELECT request_id, r.vin, count(m.doc_id) AS candidates FROM requests r LEFT JOIN manuals m ON m.vin = r.vin GROUP BY ALL""")
def candidate_counts(spark, sf_dir):
    return joins.candidate_counts(domain.requests(spark, sf_dir), domain.manuals(spark, sf_dir), "vin", "request_id")


def manual_chunks(spark, sf_dir):
    return documents.chunk_documents(domain.manuals(spark, sf_dir).withColumnRenamed("filename", "source_file"),
                                     "source_file", "content", keep=("vin",))


def vehicle_logs(spark, sf_dir):
    return domain.bronze(spark, sf_dir).filter(F.col("log_text").isNotNull()).select(
        "vin", F.col("event_id").alias("log_id"), "log_text")


@query("e4_assemble_context", f"""WITH {MANUALS_SQL}, {REQUESTS_SQL},
c AS (SELECT filename, vin, unnest(b) AS t, generate_subscripts(b, 1) AS i
  FROM (SELECT filename, vin, {TEXT_BLOCKS_SQL.replace('text', 'content')} AS b FROM manuals)),
r AS (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY filename, i) AS rn FROM c),
m AS (SELECT vin, string_agg(t, ' | ' ORDER BY rn) AS t FROM r WHERE rn <= 3 GROUP BY vin),
l AS (SELECT vin, arg_max(content, doc_id) AS t FROM manuals GROUP BY vin)
SELECT request_id, CASE WHEN q.vin IS NULL THEN 'No specific vehicle found. Be generally helpful.' ELSE
  'Manual Reference: ' || coalesce(m.t, 'No manual data found for this VIN.') || chr(10) || 'Diagnostic Logs: '
  || coalesce(l.t, 'No diagnostic logs found.') END AS context
FROM requests q LEFT JOIN m ON m.vin = q.vin LEFT JOIN l ON l.vin = q.vin""")
def assemble_context(spark, sf_dir):
    return (joins.assemble_context(domain.requests(spark, sf_dir), manual_chunks(spark, sf_dir), vehicle_logs(spark, sf_dir))
            .select("request_id", "context"))


# An experiment registry for the test requests.
REGISTRY = [("EXP_A", "SNOWFLAKE", "diagnostic_agent_v2"), ("EXP_B", "OPENAI", "diagnostic_agent_v1")]


def registry(spark):
    return spark.createDataFrame(REGISTRY, "id string, llm_provider string, prompt_version string")


@query("e5_apply_experiments", f"""WITH {REQUESTS_SQL}
SELECT request_id, CASE experiment_id WHEN 'EXP_B' THEN 'OPENAI' ELSE 'SNOWFLAKE' END AS provider,
       CASE experiment_id WHEN 'EXP_A' THEN 'diagnostic_agent_v2' WHEN 'EXP_B' THEN 'diagnostic_agent_v1'
            ELSE 'diagnostic_expert_json' END AS prompt_version FROM requests""")
def apply_experiments(spark, sf_dir):
    return (joins.apply_experiments(domain.requests(spark, sf_dir), registry(spark))
            .select("request_id", "provider", "prompt_version"))


GOLD_SQL = SILVER_SQL + """, gold AS (
  SELECT vin_reference, count(diagnostic_error_code) AS total_critical_errors,
         max(engine_temperature_celsius) AS max_engine_temp_recorded FROM silver GROUP BY vin_reference)"""


def gold(spark, sf_dir):
    return aggregates.gold_errors(domain.silver(spark, sf_dir))


@query("f1_gold_errors", f"WITH {GOLD_SQL} SELECT * FROM gold")
def gold_errors(spark, sf_dir):
    return gold(spark, sf_dir)


HISTORY_PAGE = 4       # entries of an array: small, so that vehicles have several pages here

HISTORY_SQL = SCORED_SQL + f""", numbered AS (
  SELECT *, ((row_number() OVER (PARTITION BY vin_reference ORDER BY event_id) - 1) // {HISTORY_PAGE})::INT AS page FROM scored),
history AS (
  SELECT vin_reference, page, coalesce(string_agg(log_summary, ' | ' ORDER BY event_id) FILTER (WHERE log_summary IS NOT NULL), '') AS summaries,
         coalesce(string_agg(fault_category, ',' ORDER BY event_id), '') AS categories,
         coalesce(string_agg(DISTINCT fault_category, ',' ORDER BY fault_category), '') AS distinct_categories,
         count(log_summary) AS n_summaries FROM numbered GROUP BY vin_reference, page)"""


def history(spark, sf_dir):
    return aggregates.gold_history(domain.silver_scored(spark, sf_dir), page_rows=HISTORY_PAGE)


@query("f2_gold_history", f"WITH {HISTORY_SQL} SELECT * FROM history")
def gold_history(spark, sf_dir):
    return history(spark, sf_dir).select(
        "vin_reference", "page", F.array_join("full_vehicle_history_summaries", " | ").alias("summaries"),
        F.array_join("distinct_fault_categories", ",").alias("categories"),
        F.array_join("fault_categories_distinct", ",").alias("distinct_categories"),
        F.size("full_vehicle_history_summaries").cast("long").alias("n_summaries"))


@query("f3_gold_context", f"""WITH {HISTORY_SQL}
SELECT vin_reference, page, 'Vehicle ' || vin_reference || ' history: ' || summaries AS context FROM history""")
def gold_context(spark, sf_dir):
    return aggregates.gold_context(history(spark, sf_dir))


@query("f4_gold_dealership", f"""WITH {SCORED_SQL}
SELECT vin_reference, count(diagnostic_error_code) AS total_critical_errors, max(engine_temperature_celsius) AS max_engine_temp_recorded,
       count(log_summary) AS n_summaries, 768 AS dim, 1.0::DOUBLE AS norm FROM scored GROUP BY vin_reference""")
def gold_dealership(spark, sf_dir):
    vector = F.col("vehicle_history_embedding")
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return aggregates.gold_dealership(domain.silver_scored(spark, sf_dir), NOW).select(
        "vin_reference", "total_critical_errors", "max_engine_temp_recorded", "n_summaries", F.size(vector).alias("dim"), F.round(norm, 4).alias("norm"))


@query("f0_fault_analysis", f"""WITH {FAULTS_SQL}, {summary_sql('notes', 'event_id', 'raw_log')}
SELECT event_id, fault_id, vin_masked, driver_frustration_score, target_component_extracted, summary AS concise_fault_summary
FROM faults JOIN summaries USING (event_id)""")
def fault_analysis(spark, sf_dir):
    model = medallion.fault_analysis(domain.bronze(spark, sf_dir), "event_id", domain.learned_lexicon(spark, sf_dir),
                                     domain.COMPONENT_QUESTION)
    return model.select("event_id", "fault_id", "vin_masked", "driver_frustration_score", "target_component_extracted",
                        "concise_fault_summary")


# the mean times the count has the few decimals of the scores; the mean itself may lie on a rounding edge
FAULT_SUMMARY_COLUMNS = f"""'***-***-' || right(vin, 4) AS vin_masked, count(*) AS total_fault_count,
       round(avg(driver_frustration_score) * count(*), 6) AS total_frustration,
       count(*) FILTER (WHERE driver_frustration_score < -0.5) AS high_frustration_count,
       strftime(max(recorded_at), {STAMP_SQL}) AS latest_fault_at"""


def shown_summary(summary):
    """The summary per vehicle, masked only here: masked names are no key."""
    return summary.select(mask_tail("vin").alias("vin_masked"), "total_fault_count", "high_frustration_count",
                          F.round(F.col("avg_frustration") * F.col("total_fault_count"), 6).alias("total_frustration"),
                          F.date_format("latest_fault_at", STAMP).alias("latest_fault_at"))


@query("f5_fault_summary", f"""WITH {FAULTS_SQL}
SELECT {FAULT_SUMMARY_COLUMNS} FROM faults GROUP BY vin""")
def fault_summary(spark, sf_dir):
    return shown_summary(aggregates.fault_summary(domain.faults(spark, sf_dir), "vin"))


@query("f6_quality_gate", f"""WITH {JUDGED_SQL}
SELECT count(*) AS total_evaluations, round(avg(faithfulness_score), 3) AS avg_faithfulness,
       round(min(faithfulness_score), 3) AS min_faithfulness,
       CASE WHEN avg(faithfulness_score) >= 0.80 THEN '{aggregates.GATE_PASS}' ELSE '{aggregates.GATE_FAIL}' END AS deployment_gate_status
FROM judged""")
def quality_gate(spark, sf_dir):
    return aggregates.quality_gate(judged(spark, sf_dir))


@query("f7_metric_gates", f"""WITH {JUDGED_SQL}, long AS (
  SELECT 'faithfulness' AS metric, faithfulness_score AS score FROM judged
  UNION ALL SELECT 'relevance', parsed_confidence FROM judged),
limits(metric, threshold) AS (VALUES ('faithfulness', 0.8::DOUBLE), ('relevance', 0.75::DOUBLE), ('answer_correctness', 0.8::DOUBLE))
SELECT l.metric, threshold, count(score) AS n_scores, round(avg(score), 6) AS mean_score,
       coalesce(avg(score) >= threshold, false) AS passed FROM limits l LEFT JOIN long USING (metric) GROUP BY l.metric, threshold""")
def metric_gates(spark, sf_dir):
    rows = judged(spark, sf_dir)
    scores = rows.select(F.inline(F.array(F.struct(F.lit("faithfulness").alias("metric"), F.col("faithfulness_score").alias("score")),
                                          F.struct(F.lit("relevance").alias("metric"), F.col("parsed_confidence").alias("score")))))
    return aggregates.metric_gates(scores)


def benchmark_results(spark, sf_dir):
    """Events as benchmark calls of one experiment per event type; sign-ups stand for failed calls."""
    return domain.read(spark, sf_dir, "events").select(
        F.col("event_type").alias("experiment"), F.col("user_id").alias("case_id"), (F.col("event_type") != "signup").alias("ok"),
        (F.col("value") / 100).alias("confidence"), (F.col("value") / 50).alias("latency"))


def benchmark_cases(spark, sf_dir):
    return domain.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("case_id"), ((F.col("c_custkey") % 5) / 10).alias("min_confidence"))


SUMMARY_SQL = """summary AS (
  SELECT event_type AS experiment, count(*) AS total,
         count(*) FILTER (WHERE event_type <> 'signup' AND value / 100 >= (c_custkey % 5) / 10.0::DOUBLE) AS passed,
         round(100 * avg(CASE WHEN event_type <> 'signup' AND value / 100 >= (c_custkey % 5) / 10.0::DOUBLE THEN 1 ELSE 0 END), 6) AS accuracy,
         round(avg(CASE WHEN event_type <> 'signup' THEN value / 50 ELSE 0.0 END), 6) AS avg_latency
  FROM events JOIN customer ON c_custkey = user_id GROUP BY event_type)"""


@query("f8_benchmark_summary", f"WITH {SUMMARY_SQL} SELECT * FROM summary")
def benchmark_summary(spark, sf_dir):
    return aggregates.benchmark_summary(benchmark_results(spark, sf_dir), benchmark_cases(spark, sf_dir))


@query("f9_ab_compare", f"""WITH {SUMMARY_SQL}, b AS (
  SELECT max(accuracy) FILTER (WHERE experiment = 'view') AS baseline_accuracy,
         max(accuracy) FILTER (WHERE experiment = 'click') AS challenger_accuracy FROM summary)
SELECT *, baseline_accuracy >= 80 AS sla_met, CASE WHEN baseline_accuracy < 80 THEN 'BLOCKED'
  WHEN challenger_accuracy >= baseline_accuracy THEN 'CHALLENGER' ELSE 'BASELINE' END AS result FROM b""")
def ab_compare(spark, sf_dir):
    return aggregates.ab_compare(benchmark_summary(spark, sf_dir), "view", "click")


@query("f10_run_metrics", f"""WITH {AUDIT_SQL}
SELECT 'EXP_' || turn::VARCHAR AS experiment_id, count(*) AS runs, sum(length(text) // 4)::BIGINT AS tokens,
       round(avg(length(text) / 1000.0::DOUBLE), 6) AS avg_latency, round(avg(turn / 10.0::DOUBLE), 6) AS avg_confidence
FROM responses WHERE role = 'assistant' GROUP BY 1""")
def run_metrics(spark, sf_dir):
    path = run_dir(spark, "runs")
    tables.append_runs(experiment_runs(spark, sf_dir), path)
    return aggregates.run_metrics(tables.read_runs(spark, path))


@query("g1_most_frustrating", f"""WITH {FAULTS_SQL}
SELECT event_id, raw_log, driver_frustration_score FROM faults WHERE driver_frustration_score < -0.5
ORDER BY driver_frustration_score, event_id LIMIT 10""")
def most_frustrating(spark, sf_dir):
    return (ranking.most_frustrating(domain.faults(spark, sf_dir), tie="event_id")
            .select("event_id", "raw_log", "driver_frustration_score"))


@query("g2_top_vehicles", f"""WITH {GOLD_SQL}
SELECT vin_reference, total_critical_errors FROM gold ORDER BY total_critical_errors DESC, vin_reference LIMIT 5""")
def top_vehicles(spark, sf_dir):
    return ranking.top_vehicles(gold(spark, sf_dir))


@query("g3_topk_per_key", """SELECT * FROM (
  SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents)
WHERE rank <= 3""")
def topk_per_key(spark, sf_dir):
    rows = domain.read(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return topk(rows, ["source"], [F.col("n_chars").desc(), F.col("doc_id")], 3).withColumn("rank", F.col("rank").cast("long"))


def job_history(spark, sf_dir):
    """Events as a job history."""
    return domain.read(spark, sf_dir, "events").select(
        F.col("event_id").alias("query_id"), F.col("event_type").alias("query_text"),
        F.concat(F.lit("fleet."), F.col("event_type")).alias("query_tag"), F.col("ts").alias("start_time"),
        (F.col("value") * 1000).alias("elapsed_ms"), (F.col("user_id") * 1073741824).alias("bytes_scanned"),
        (F.col("value") * 500).alias("cpu_ms"))


@query("g4_top_queries", f"""SELECT event_id AS query_id, event_type AS query_text, value * 1000 / 1000 AS duration_seconds,
  user_id::DOUBLE AS gb_scanned, value * 500 / 1000 AS cpu_seconds, 'fleet.' || event_type AS query_tag
FROM events WHERE ts > TIMESTAMP '{NOW}' - INTERVAL 24 HOURS AND event_type LIKE 'error%' ORDER BY value * 1000 DESC, event_id LIMIT 10""")
def top_queries(spark, sf_dir):
    return ranking.top_queries(job_history(spark, sf_dir), NOW, "fleet.error")
