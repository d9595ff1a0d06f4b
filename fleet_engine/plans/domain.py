"""Domain tables built from the given tables, once in Spark and once as SQL text for the comparison.

Every table is used whole. ``documents``, ``conversations`` and ``benchmark`` find their vehicle through the event of the
same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleet_engine.operators.clean import clean_sentinel, silver_telemetry
from fleet_engine.operators.enrich import fit_lexicon
from fleet_engine.plans.medallion import score_faults, score_telemetry
from fleet_engine.workspace import spread, stage

AS_OF = "2024-01-31 00:00:00"
COMPONENT_QUESTION = "Which of the parts is it about, in the end or on the whole?"

# Frequent words of the languages in the test texts; they stand in for fault categories.
LANGUAGE_RULES = {
    "ENGLISH": ["the", "of", "and", "that", "is", "to"],
    "FRENCH": ["le", "la", "des", "que", "du", "une"],
    "GERMAN": ["der", "die", "und", "das", "ist", "von"],
    "SPANISH": ["el", "los", "las", "y", "por", "una"],
}


# text tables and their keys: work on them is bound by the processor, so small ones are dealt out to all cores
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id"}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return spread(rows, TEXT_TABLES[table]) if table in TEXT_TABLES else rows


def vin(col: str = "user_id"):
    number = F.col(col).cast("string")
    return F.concat(F.lit("VIN"), F.when(F.length(number) < 10, F.lpad(number, 10, "0")).otherwise(number))     # longer ids are never cut


def vehicle_of_event(spark: SparkSession, sf_dir: str, id: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(F.col("event_id").alias(id), vin().alias("vin"))


def bronze(spark: SparkSession, sf_dir: str, notes: bool = True) -> DataFrame:
    """Telemetry; the join to the notes is made only for readers of the notes."""
    events = read(spark, sf_dir, "events")
    kind = F.col("event_type")
    code = (F.when(kind == "view", "NONE").when(kind == "error", "P0300").when(kind == "purchase", "P0420")
            .when(kind == "signup", "P0217"))
    if notes:
        texts = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), F.col("text").alias("log_text"))
        events = events.join(texts, "event_id", "left")
    else:
        events = events.withColumn("log_text", F.lit(None).cast("string"))
    return events.select(
        "event_id", vin().alias("vin"),
        F.when(kind == "signup", "ERROR").otherwise(F.col("value").cast("string")).alias("engine_temp_raw"),
        code.alias("error_code"), "log_text", F.col("ts").alias("recorded_at"),
        F.when(F.col("event_id") % 2 == 0, "AWS_S3").otherwise("AZURE_BLOB").alias("cloud_source"))


def clean_bronze(spark: SparkSession, sf_dir: str, notes: bool = False) -> DataFrame:
    return clean_sentinel(bronze(spark, sf_dir, notes), "engine_temp_raw", out="engine_temp")


def silver(spark: SparkSession, sf_dir: str, notes: bool = False) -> DataFrame:
    return silver_telemetry(clean_bronze(spark, sf_dir, notes), keep=("event_id", "recorded_at"))


def silver_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with summary and category of each note, written: histories count the rows before they read them."""
    rows = spread(stage(silver(spark, sf_dir, notes=True), "silver"), "event_id")
    return stage(score_telemetry(rows, "event_id", LANGUAGE_RULES), "scored")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
            .withColumn("positive", F.col("toxic") == 0))


def learned_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_lexicon(labelled_documents(spark, sf_dir), "text", "positive")


def faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults with a note, scored by the lexicon learned from the labels."""
    return score_faults(bronze(spark, sf_dir), "event_id", learned_lexicon(spark, sf_dir), COMPONENT_QUESTION)


def manuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as uploaded manuals of their vehicle."""
    docs = read(spark, sf_dir, "documents").join(vehicle_of_event(spark, sf_dir, "doc_id"), "doc_id", "left")
    return docs.select("doc_id", "vin", "lang", "source", "n_chars",
                       F.concat_ws("_", "vin", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".pdf"))).alias("filename"),
                       F.col("text").alias("content"))


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upload notification per document: German files have a wrong extension, Spanish ones an upper-case one."""
    ext = F.when(F.col("lang") == "de", ".exe").when(F.col("lang") == "es", ".PDF").otherwise(".pdf")
    key = F.concat(F.lit("incoming/"), F.replace("filename", F.lit(".pdf"), F.lit("+of%20plant")), ext)
    record = F.struct(F.struct(
        F.struct(F.lit("vehicle-docs").alias("name")).alias("bucket"),
        F.struct(key.alias("key"), (F.col("n_chars") * 10000).alias("size")).alias("object")).alias("s3"))
    return manuals(spark, sf_dir).select(F.array(record).alias("Records"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as diagnosis requests."""
    turns = read(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    events = read(spark, sf_dir, "events").select(
        F.col("event_id").alias("conv_id"), vin().alias("vin"),
        F.when(F.col("event_type") == "error", "P0300").when(F.col("event_type") == "purchase", "P0420").alias("error_code"))
    return turns.join(events, "conv_id", "left").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("request_id"),
        "conv_id", "turn", F.col("text").alias("symptoms"), "vin", "error_code",
        F.when(F.col("turn") == 0, "EXP_B").when(F.col("turn") == 2, "EXP_UNKNOWN").otherwise("EXP_A").alias("experiment_id"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw model answers: assistant turns as fenced JSON, user turns as JSON that lacks fields, system turns as plain text."""
    turns = read(spark, sf_dir, "conversations").join(vehicle_of_event(spark, sf_dir, "conv_id"), "conv_id", "left")
    action = F.array(F.struct(F.lit("Check pressure").alias("action"), F.lit("45 PSI").alias("acceptance_criteria")))
    full = F.to_json(F.struct(F.col("text").alias("diagnosis"), (F.col("turn") / 10).alias("confidence_score"),
                              F.col("role").alias("supporting_evidence"), action.alias("recommended_actions")))
    part = F.to_json(F.struct(F.col("text").alias("diagnosis"), F.lit("high").alias("confidence_score")))
    raw = (F.when(F.col("role") == "assistant", F.concat(F.lit("```json\n"), full, F.lit("\n```")))
           .when(F.col("role") == "user", part).otherwise(F.col("text")))
    return turns.select("conv_id", "turn", "role", "vin", "text", raw.alias("raw"))


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "benchmark").join(vehicle_of_event(spark, sf_dir, "item_id"), "item_id", "left")
    return items.select("item_id", F.col("text").alias("expected_answer"),
                        F.when(F.col("item_id") % 10 != 0, F.col("vin")).alias("vin_context"))


# ---- the same tables as SQL ---------------------------------------------------------------------------------------

STAMP_SQL = "'%Y-%m-%d %H:%M:%S.%f'"


def words_sql(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def sentences_sql(text: str) -> str:
    return f"list_filter(list_transform(string_split_regex({text}, '[.\\n]+'), lambda s: trim(s)), lambda s: s <> '')"


def vin_sql(col: str = "user_id") -> str:
    return f"('VIN' || lpad({col}::VARCHAR, greatest(length({col}::VARCHAR), 10)::INT, '0'))"


def votes_sql(words: str, rules: dict[str, list[str]]) -> str:
    """Category of a word list: most votes, first listed on a tie."""
    counts = {label: f"len(list_filter({words}, lambda w: w IN ({', '.join(repr(x) for x in listed)})))"
              for label, listed in rules.items()}
    top = f"greatest({', '.join(counts.values())})"
    arms = " ".join(f"WHEN {n} = {top} THEN '{label}'" for label, n in counts.items())
    return f"CASE WHEN {top} = 0 THEN 'OTHER' {arms} END"


BRONZE_SQL = f"""bronze AS (
  SELECT e.event_id, {vin_sql()} AS vin, CASE WHEN event_type = 'signup' THEN 'ERROR' ELSE value::VARCHAR END AS engine_temp_raw,
         CASE event_type WHEN 'view' THEN 'NONE' WHEN 'error' THEN 'P0300' WHEN 'purchase' THEN 'P0420'
              WHEN 'signup' THEN 'P0217' END AS error_code,
         d.text AS log_text, e.ts AS recorded_at,
         CASE WHEN e.event_id % 2 = 0 THEN 'AWS_S3' ELSE 'AZURE_BLOB' END AS cloud_source,
         CASE WHEN event_type = 'signup' THEN -999.0 ELSE value END::DOUBLE AS engine_temp
  FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id)"""

SILVER_SQL = BRONZE_SQL + """, silver AS (
  SELECT event_id, recorded_at, vin AS vin_reference, error_code AS diagnostic_error_code,
         engine_temp AS engine_temperature_celsius, log_text AS mechanic_notes
  FROM bronze WHERE error_code <> 'NONE' AND engine_temp BETWEEN -50 AND 250)"""


def summary_sql(source: str, id: str, text: str, out: str = "summaries") -> str:
    """CTEs that end in ``out`` (id, summary, score)."""
    return f"""{out}_s AS (SELECT {id}, unnest(ss) AS sentence, generate_subscripts(ss, 1) - 1 AS pos
    FROM (SELECT {id}, {sentences_sql(text)} AS ss FROM {source} WHERE {text} IS NOT NULL)),
  {out}_w AS (SELECT {id}, pos, unnest({words_sql('sentence')}) AS term FROM {out}_s),
  {out}_df AS (SELECT term, count(DISTINCT {id}) AS df FROM {out}_w GROUP BY term),
  {out}_n AS (SELECT count(*) AS n FROM {source} WHERE {text} IS NOT NULL),
  {out}_sc AS (SELECT {id}, pos, round(avg(ln((n + 1.0) / (df + 1.0))), 6) AS score
    FROM {out}_w JOIN {out}_df USING (term) CROSS JOIN {out}_n GROUP BY {id}, pos),
  {out}_b AS (SELECT *, row_number() OVER (PARTITION BY {id} ORDER BY score DESC, pos) AS rn FROM {out}_sc),
  {out} AS (SELECT d.{id}, coalesce(s.sentence, '') AS summary, b.score FROM {source} d
    LEFT JOIN (SELECT * FROM {out}_b WHERE rn = 1) b ON b.{id} = d.{id}
    LEFT JOIN {out}_s s ON s.{id} = b.{id} AND s.pos = b.pos WHERE d.{text} IS NOT NULL)"""


SCORED_SQL = f"""{SILVER_SQL}, {summary_sql('silver', 'event_id', 'mechanic_notes')},
  scored AS (SELECT s.*, m.summary AS log_summary,
      CASE WHEN mechanic_notes IS NOT NULL THEN {votes_sql(words_sql('mechanic_notes'), LANGUAGE_RULES)} END AS fault_category
    FROM silver s LEFT JOIN summaries m USING (event_id))"""

LEXICON_SQL = f"""lex_src AS (SELECT d.doc_id, toxic = 0 AS positive, text FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
  lex_n AS (SELECT count(*) FILTER (WHERE positive) AS p, count(*) FILTER (WHERE NOT positive) AS n FROM lex_src),
  lex_w AS (SELECT positive, unnest(list_distinct({words_sql('text')})) AS term FROM lex_src),
  lex_t AS (SELECT term, count(*) FILTER (WHERE positive) AS i, count(*) FILTER (WHERE NOT positive) AS o FROM lex_w GROUP BY term),
  lexicon AS (SELECT term, i + o AS docs, round(greatest(-3.0::DOUBLE, least(3.0::DOUBLE,
      ln(((i + 1.0::DOUBLE) / (p + 2)) / ((o + 1.0::DOUBLE) / (n + 2))))), 6) AS weight FROM lex_t CROSS JOIN lex_n)"""


def sentiment_sql(source: str, id: str, text: str, out: str = "sentiments") -> str:
    """CTEs that end in ``out`` (id, sentiment) by the learned lexicon."""
    return f"""{out}_w AS (SELECT {id}, unnest({words_sql(text)}) AS term FROM {source}),
  {out}_a AS (SELECT {id}, sum(weight) FILTER (WHERE weight > 0) AS pos, -sum(weight) FILTER (WHERE weight < 0) AS neg
    FROM {out}_w JOIN lexicon USING (term) GROUP BY {id}),
  {out} AS (SELECT d.{id}, round(coalesce((coalesce(pos, 0) - coalesce(neg, 0))
      / nullif(coalesce(pos, 0) + coalesce(neg, 0), 0), 0.0), 6)::DOUBLE AS sentiment
    FROM {source} d LEFT JOIN {out}_a a ON a.{id} = d.{id})"""


def answer_sql(text: str, question: str) -> str:
    """Best sentence for a question as a struct (h, i, a); h = 0 means no overlap."""
    asked = f"list_distinct({words_sql(repr(question))})"
    return (f"list_max(list_transform({sentences_sql(text)}, lambda s, i: "
            f"{{'h': len(list_intersect({asked}, {words_sql('s')})), 'i': -i, 'a': s}}))")


FAULTS_SQL = f"""{BRONZE_SQL}, {LEXICON_SQL},
  notes AS (SELECT event_id, vin, md5(vin || strftime(recorded_at, {STAMP_SQL}) || error_code) AS fault_id,
      '***-***-' || right(vin, 4) AS vin_masked, recorded_at, log_text AS raw_log
    FROM bronze WHERE log_text IS NOT NULL AND log_text <> ''),
  {sentiment_sql('notes', 'event_id', 'raw_log')},
  faults AS (SELECT n.*, s.sentiment AS driver_frustration_score,
      CASE WHEN ans.h > 0 THEN ans.a END AS target_component_extracted
    FROM (SELECT *, {answer_sql('raw_log', COMPONENT_QUESTION)} AS ans FROM notes) n JOIN sentiments s USING (event_id))"""

MANUALS_SQL = f"""manuals AS (
  SELECT d.doc_id, {vin_sql()} AS vin, lang, source, n_chars, text AS content,
         concat_ws('_', {vin_sql()}, source, d.doc_id::VARCHAR || '.pdf') AS filename
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id)"""

UPLOADS_SQL = MANUALS_SQL + """, uploads AS (
  SELECT doc_id, 'vehicle-docs' AS bucket, filename AS stored,
         'incoming/' || replace(filename, '.pdf', ' of plant') || ext AS key,
         replace(filename, '.pdf', ' of plant') || ext AS filename,
         lower(ext) AS extension, n_chars * 10000 / 1048576.0::DOUBLE AS mb, vin
  FROM (SELECT *, CASE lang WHEN 'de' THEN '.exe' WHEN 'es' THEN '.PDF' ELSE '.pdf' END AS ext FROM manuals)),
  classified AS (SELECT *, round(mb, 2) AS size_mb,
      CASE WHEN extension <> '.pdf' THEN 'unsupported extension ''' || extension || ''''
           WHEN mb > 50 THEN printf('%.1f', mb) || 'MB exceeds 50MB limit' END AS reason FROM uploads)"""

REQUESTS_SQL = f"""requests AS (
  SELECT c.conv_id::VARCHAR || '-' || turn::VARCHAR AS request_id, c.conv_id, turn, text AS symptoms, {vin_sql()} AS vin,
         CASE event_type WHEN 'error' THEN 'P0300' WHEN 'purchase' THEN 'P0420' END AS error_code,
         CASE turn WHEN 0 THEN 'EXP_B' WHEN 2 THEN 'EXP_UNKNOWN' ELSE 'EXP_A' END AS experiment_id
  FROM conversations c LEFT JOIN events e ON e.event_id = c.conv_id WHERE role = 'user')"""

RESPONSES_SQL = f"""responses AS (
  SELECT conv_id, turn, role, {vin_sql()} AS vin, text FROM conversations c LEFT JOIN events e ON e.event_id = c.conv_id)"""

TRUTH_SQL = f"""truth AS (
  SELECT item_id, text AS expected_answer, CASE WHEN item_id % 10 <> 0 THEN {vin_sql()} END AS vin_context
  FROM benchmark b LEFT JOIN events e ON e.event_id = b.item_id)"""
