"""Registered queries: streams (I), quality (J), governance (K), risk (L), layout (M), metrics layer (N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleet_engine.operators import governance, layout, quality, ranking, risk, semantic
from fleet_engine.operators.aggregates import fault_summary
from fleet_engine.operators.clean import STAMP
from fleet_engine.operators.textindex import TextIndex, search_index
from fleet_engine.plans import domain
from fleet_engine.plans.domain import BRONZE_SQL, FAULTS_SQL, REQUESTS_SQL, RESPONSES_SQL, SILVER_SQL, STAMP_SQL, words_sql
from fleet_engine.plans.queries_gold import FAULT_SUMMARY_COLUMNS, GOLD_SQL, gold, shown_summary
from fleet_engine.plans.queries_ingest import CHUNKS_SQL, FILES_SQL, HOT_VEHICLE, NOW, QUEUE_SQL, RUN_SQL, queue, stored_files, with_rows
from fleet_engine.plans.queries_search import QUERY_TEXTS, bm25_sql, query_texts
from fleet_engine.plans.registry import query
from fleet_engine.streaming import streams
from fleet_engine.workspace import run_dir, stage


def arriving(spark, sf_dir, table):
    """A given table as a stream of its files."""
    schema = domain.read(spark, sf_dir, table).schema
    return streams.stream_table(spark, f"{sf_dir.rstrip('/')}/{{{table}.parquet}}", schema)


@query("i1_stream_pending", f"WITH {QUEUE_SQL} SELECT count(*) AS first_run, 0::BIGINT AS second_run FROM queue")
def stream_pending(spark, sf_dir):
    source, out, seen = (run_dir(spark, n) for n in ("queue", "pending", "checkpoint"))
    rows = queue(spark, sf_dir)
    rows.write.parquet(source)
    counts = []
    for i in range(2):
        streams.append_batches(streams.stream_pending(spark, source, rows.schema), out, seen).awaitTermination()
        counts.append(spark.read.parquet(out).agg(F.count("*").alias("n")).withColumn("run", F.lit(i)))
    # the second run must leave the table as the first one made it
    both = counts[0].unionByName(counts[1])
    return both.agg(F.max(F.when(F.col("run") == 0, F.col("n"))).alias("first_run"), (F.max("n") - F.min("n")).alias("second_run"))


@query("i2_run_queue", f"WITH {RUN_SQL} {CHUNKS_SQL}")
def run_queue(spark, sf_dir):
    source, out, seen = (run_dir(spark, n) for n in ("queue", "parsed", "checkpoint"))
    rows = queue(spark, sf_dir)
    rows.write.parquet(source)
    streams.run_queue(streams.stream_pending(spark, source, rows.schema), stored_files(spark, sf_dir), out, seen, NOW).awaitTermination()
    return spark.read.parquet(f"{out}/chunks").select("source_file", "vin_reference", "chunk_text", F.col("chunk_index").cast("long"))


@query("i3_watch_files", FILES_SQL)
def watch_files(spark, sf_dir):
    out, seen = run_dir(spark, "files"), run_dir(spark, "checkpoint")
    streams.append_batches(streams.watch_files(spark, sf_dir, "*.parquet"), out, seen).awaitTermination()
    return with_rows(spark, sf_dir, spark.read.parquet(out))


@query("i4_refresh_index", f"WITH {bm25_sql(QUERY_TEXTS, 5)} SELECT query_id, doc_id, score, rank FROM best")
def refresh_index(spark, sf_dir):
    index, seen = run_dir(spark, "index"), run_dir(spark, "checkpoint")
    streams.refresh_index(arriving(spark, sf_dir, "documents"), "doc_id", "text", index, seen).awaitTermination()
    return search_index(TextIndex(spark, index), query_texts(spark, sf_dir), 5)


FAULT_SUMMARY_SQL = f"WITH {FAULTS_SQL} SELECT {FAULT_SUMMARY_COLUMNS} FROM faults GROUP BY vin"


@query("i5_stream_fault_summary", FAULT_SUMMARY_SQL)
def stream_fault_summary(spark, sf_dir):
    source, out, seen = (run_dir(spark, n) for n in ("faults", "summary", "checkpoint"))
    rows = domain.faults(spark, sf_dir)
    rows.write.parquet(source)
    stream = streams.stream_table(spark, source, rows.schema)
    streams.stream_fault_summary(stream, "vin", out, seen).awaitTermination()
    return shown_summary(streams.read_fault_summary(spark, out, "vin"))


@query("i6_stream_silver", f"WITH {SILVER_SQL} SELECT event_id, vin_reference, diagnostic_error_code, engine_temperature_celsius FROM silver")
def stream_silver(spark, sf_dir):
    source, out, seen = (run_dir(spark, n) for n in ("telemetry", "silver", "checkpoint"))
    rows = domain.bronze(spark, sf_dir).select(*streams.TELEMETRY_SCHEMA.names)
    rows.unionAll(rows).write.json(source)          # every event is delivered twice
    streams.append_once(streams.stream_silver(spark, source), "event_id", "recorded_at", out, seen).awaitTermination()
    return spark.read.parquet(out).select("event_id", "vin_reference", "diagnostic_error_code", "engine_temperature_celsius")


CHECKS = [quality.expect_not_null("event_id"), quality.expect_not_null("log_text"), quality.expect_not_null("error_code"),
          quality.expect_between("engine_temp", -40, 300), quality.expect_row_count(1, 5_000),
          quality.expect_unique("event_id"), quality.expect_unique("vin", "error_code")]


@query("j1_not_null", f"WITH {BRONZE_SQL} SELECT 'not_null(log_text)' AS \"check\", count(*) FILTER (WHERE log_text IS NULL) AS failures, "
       "count(*) FILTER (WHERE log_text IS NULL) = 0 AS passed FROM bronze")
def not_null(spark, sf_dir):
    return quality.run_suite(domain.bronze(spark, sf_dir), [quality.expect_not_null("log_text")])


@query("j2_unique", f"""WITH {BRONZE_SQL} SELECT vin, error_code, count(*) AS n FROM bronze
WHERE vin IS NOT NULL AND error_code IS NOT NULL GROUP BY ALL HAVING count(*) > 1""")
def unique(spark, sf_dir):
    return quality.duplicates(domain.bronze(spark, sf_dir, notes=False), ["vin", "error_code"])


@query("j3_schema", "SELECT 'type' AS \"check\", 'value' AS \"column\", 'string' AS expected, 'double' AS actual "
       "UNION ALL SELECT 'column_set', 'props', 'absent', 'present'")
def schema(spark, sf_dir):
    rows = domain.read(spark, sf_dir, "events")
    return quality.expect_schema(rows, types={"event_id": "bigint", "value": "string"}, ordered=rows.columns,
                                 names=set(rows.columns) - {"props"})


@query("j4_between", f"""WITH {BRONZE_SQL} SELECT 'between(engine_temp,-40,300)' AS "check",
count(*) FILTER (WHERE NOT engine_temp BETWEEN -40 AND 300) AS failures,
count(*) FILTER (WHERE NOT engine_temp BETWEEN -40 AND 300) = 0 AS passed FROM bronze""")
def between(spark, sf_dir):
    return quality.run_suite(domain.clean_bronze(spark, sf_dir), [quality.expect_between("engine_temp", -40, 300)])


@query("j5_row_count", """SELECT 'row_count(1,1000000000000)' AS "check", CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END::BIGINT AS failures,
count(*) >= 1 AS passed FROM lineitem""")
def row_count(spark, sf_dir):
    return quality.run_suite(domain.read(spark, sf_dir, "lineitem"), [quality.expect_row_count(1, 10 ** 12)])


@query("j6_freshness", f"""WITH {BRONZE_SQL} SELECT strftime(max(recorded_at), {STAMP_SQL}) AS newest,
max(recorded_at) >= TIMESTAMP '{NOW}' - INTERVAL 24 HOURS AS fresh, count(*) FILTER (WHERE error_code IS NULL) AS null_count,
count(*) AS n_rows FROM bronze""")
def freshness(spark, sf_dir):
    rows = domain.bronze(spark, sf_dir, notes=False)
    nulls = quality.null_metric(rows, "error_code").agg(F.struct(F.max("null_count").alias("a"), F.max("n_rows").alias("b"))).scalar()
    return (quality.freshness(rows, "recorded_at", "24 HOURS", NOW).withColumn("_n", nulls)
            .select("newest", "fresh", F.col("_n.a").alias("null_count"), F.col("_n.b").alias("n_rows")))


@query("j7_run_suite", f"""WITH {BRONZE_SQL}, r AS (
  SELECT 'not_null(event_id)' AS "check", count(*) FILTER (WHERE event_id IS NULL) AS failures FROM bronze
  UNION ALL SELECT 'not_null(log_text)', count(*) FILTER (WHERE log_text IS NULL) FROM bronze
  UNION ALL SELECT 'not_null(error_code)', count(*) FILTER (WHERE error_code IS NULL) FROM bronze
  UNION ALL SELECT 'between(engine_temp,-40,300)', count(*) FILTER (WHERE NOT engine_temp BETWEEN -40 AND 300) FROM bronze
  UNION ALL SELECT 'row_count(1,5000)', CASE WHEN count(*) BETWEEN 1 AND 5000 THEN 0 ELSE 1 END FROM bronze
  UNION ALL SELECT 'unique(event_id)', count(*) FROM (SELECT event_id FROM bronze GROUP BY event_id HAVING count(*) > 1)
  UNION ALL SELECT 'unique(vin,error_code)', count(*) FROM (SELECT vin, error_code FROM bronze
    WHERE vin IS NOT NULL AND error_code IS NOT NULL GROUP BY vin, error_code HAVING count(*) > 1))
SELECT "check", failures::BIGINT AS failures, failures = 0 AS passed FROM r""")
def run_suite(spark, sf_dir):
    return quality.run_suite(domain.clean_bronze(spark, sf_dir, notes=True), CHECKS)


RULES = {"mail": "[a-z0-9._]+@[a-z0-9.]+", "license": "licen[cs]e", "secret": "(api[_-]?key|password|secret)"}


@query("j8_scan_rules", """WITH lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS line_no
  FROM (SELECT doc_id, string_split_regex(text, '\\r?\\n') AS l FROM documents))
""" + " UNION ALL ".join(f"SELECT doc_id, line_no, '{n}' AS rule, trim(line) AS line FROM lines WHERE regexp_matches(line, '(?i){p}')"
                         for n, p in RULES.items()))
def scan_rules(spark, sf_dir):
    out = quality.scan_rules(domain.read(spark, sf_dir, "documents"), RULES)
    return out.withColumn("line_no", F.col("line_no").cast("long"))


@query("j8_require_rules", " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS rule FROM documents WHERE NOT regexp_matches(text, '(?i){p}')" for n, p in RULES.items()))
def require_rules(spark, sf_dir):
    return quality.require_rules(domain.read(spark, sf_dir, "documents"), RULES)


@query("k1_apply_masks", f"""WITH {GOLD_SQL}
SELECT 'ANALYST_ROLE' AS role, '***-MASKED-VIN-***' AS vin_reference, total_critical_errors FROM gold
UNION ALL SELECT 'CORTEX_DEV_ROLE', vin_reference, total_critical_errors FROM gold""")
def apply_masks(spark, sf_dir):
    rows = gold(spark, sf_dir).select("vin_reference", "total_critical_errors")
    seen = [governance.apply_masks(rows, {"vin_reference": governance.Policy()}, role).withColumn("role", F.lit(role))
            for role in ("ANALYST_ROLE", "CORTEX_DEV_ROLE")]
    return seen[0].unionByName(seen[1])


@query("k3_tag_inventory", f"""WITH {GOLD_SQL}, {RESPONSES_SQL}
SELECT 'gold' AS table_name, 'vin_reference' AS column_name, 'SENSITIVE' AS level, count(vin_reference) AS non_null FROM gold
UNION ALL SELECT 'responses', 'vin', 'SENSITIVE', count(vin) FROM responses
UNION ALL SELECT 'responses', 'text', 'CONFIDENTIAL', count(text) FROM responses""")
def tag_inventory(spark, sf_dir):
    answers = domain.responses(spark, sf_dir)
    answers = governance.tag(governance.tag(answers, "vin", "SENSITIVE"), "text", "CONFIDENTIAL")
    return governance.tag_inventory({"gold": governance.tag(gold(spark, sf_dir), "vin_reference", "SENSITIVE"), "responses": answers})


@query("k4_role_views", f"WITH {GOLD_SQL} SELECT '***-MASKED-VIN-***' AS vin_reference, total_critical_errors, max_engine_temp_recorded FROM gold")
def role_views(spark, sf_dir):
    tables = {"gold": governance.tag(gold(spark, sf_dir), "vin_reference", "SENSITIVE"), "bronze": domain.bronze(spark, sf_dir)}
    views = governance.role_views(tables, {"ANALYST_ROLE": ["gold"]}, {}, "ANALYST_ROLE")
    return views["gold"]


RISK_SQL = SILVER_SQL + """, risk AS (SELECT event_id, engine_temperature_celsius,
  CASE WHEN engine_temperature_celsius > 110 THEN 1 ELSE 0 END AS is_at_risk, engine_temperature_celsius * 1.5 AS temp_variance FROM silver)"""
SLOT_SQL = "('0x' || substr(md5(event_id::VARCHAR || ':42'), 1, 7))::BIGINT % 10000 < 8000"


@query("l1_risk_features", f"WITH {RISK_SQL} SELECT event_id, is_at_risk, temp_variance FROM risk")
def risk_features(spark, sf_dir):
    return risk.risk_features(domain.silver(spark, sf_dir)).select("event_id", "is_at_risk", "temp_variance")


@query("l2_split", f"WITH {RISK_SQL} SELECT event_id, CASE WHEN {SLOT_SQL} THEN 'train' ELSE 'test' END AS part FROM risk")
def split(spark, sf_dir):
    train, test = risk.split(domain.silver(spark, sf_dir), "event_id")
    return (train.select("event_id", F.lit("train").alias("part")).unionByName(test.select("event_id", F.lit("test").alias("part"))))


def trained(spark, sf_dir):
    train, test = risk.split(risk.risk_features(domain.silver(spark, sf_dir)), "event_id")
    return risk.train_risk(stage(train.select("event_id", "is_at_risk", *risk.FEATURES), "train")), test


@query("l3_train_risk", f"WITH {RISK_SQL} SELECT count(*) AS n, 100 AS trees, true AS accurate FROM risk WHERE NOT {SLOT_SQL}")
def train_risk(spark, sf_dir):
    model, test = trained(spark, sf_dir)
    return (risk.class_metrics(risk.score(model, test))
            .select("n", F.lit(model.stages[-1].getNumTrees).alias("trees"), (F.col("accuracy") >= 0.98).alias("accurate")))


NEAR = 5     # degrees around the threshold between which a forest of few rows may place its cut


@query("l4_score", f"""WITH {RISK_SQL} SELECT event_id, is_at_risk,
  CASE WHEN abs(engine_temperature_celsius - 110) > {NEAR} THEN is_at_risk END AS predicted_risk_class FROM risk WHERE NOT {SLOT_SQL}""")
def score(spark, sf_dir):
    model, test = trained(spark, sf_dir)
    clear = F.abs(F.col("engine_temperature_celsius") - 110) > NEAR
    return risk.score(model, test).select("event_id", "is_at_risk", F.when(clear, F.col("predicted_risk_class")).alias("predicted_risk_class"))


@query("l5_class_metrics", f"""WITH {RISK_SQL}, p AS (SELECT is_at_risk AS y, CASE WHEN temp_variance > 180 THEN 1 ELSE 0 END AS h FROM risk)
SELECT count(*) AS n, round(avg(CASE WHEN y = h THEN 1 ELSE 0 END), 6) AS accuracy,
       round(count(*) FILTER (WHERE y = 1 AND h = 1) / count(*) FILTER (WHERE h = 1), 6)::DOUBLE AS precision FROM p""")
def class_metrics(spark, sf_dir):
    rows = risk.risk_features(domain.silver(spark, sf_dir))
    return risk.class_metrics(rows.withColumn("predicted_risk_class", F.when(F.col("temp_variance") > 180, 1).otherwise(0)))


@query("l6_register_model", f"WITH {RISK_SQL} SELECT count(*) AS scored, true AS first_saved, false AS second_saved FROM risk WHERE NOT {SLOT_SQL}")
def register_model(spark, sf_dir):
    model, test = trained(spark, sf_dir)
    root = run_dir(spark, "models")
    first = risk.register_model(spark, model, root, "risk", "v1")
    again = risk.register_model(spark, model, root, "risk", "v1")
    scored = risk.score(risk.load_model(root, "risk", "v1"), test)
    return scored.agg(F.count("*").alias("scored")).withColumns({"first_saved": F.lit(first), "second_saved": F.lit(again)})


@query("m1_clustered_lookup", f"WITH {BRONZE_SQL} SELECT event_id, vin, error_code FROM bronze WHERE vin = '{HOT_VEHICLE}'")
def clustered_lookup(spark, sf_dir):
    path = run_dir(spark, "clustered")
    layout.write_clustered(domain.bronze(spark, sf_dir), path, ["vin"], date_col="recorded_at", bloom="vin")
    return layout.lookup(spark.read.parquet(path), "vin", HOT_VEHICLE).select("event_id", "vin", "error_code")


@query("m2_clustering_depth", "SELECT count(*) AS n_rows, false AS needs_clustering, true AS narrow FROM lineitem")
def clustering_depth(spark, sf_dir):
    path = run_dir(spark, "clustered")
    layout.write_clustered(domain.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), path, ["l_orderkey"])
    table = spark.read.parquet(path)
    depth = layout.clustering_depth(table, "l_orderkey").first()
    return table.agg(F.count("*").alias("n_rows")).withColumns(
        {"needs_clustering": F.lit(depth["needs_clustering"]), "narrow": F.lit(depth["max_depth"] <= 2)})


@query("m2_depth_of_ranges", """WITH f AS (SELECT l_orderkey AS id, min(l_partkey) AS lo, max(l_partkey) AS hi FROM lineitem GROUP BY l_orderkey),
e AS (SELECT lo AS v, 1 AS s, 0 AS e FROM f UNION ALL SELECT hi, 0, 1 FROM f),
p AS (SELECT v, sum(s) AS s, sum(e) AS e FROM e GROUP BY v),
c AS (SELECT v, sum(s) OVER (ORDER BY v) AS cs, sum(e) OVER (ORDER BY v) - e AS ce FROM p),
d AS (SELECT a.cs - b.ce AS depth FROM f JOIN c a ON a.v = hi JOIN c b ON b.v = lo)
SELECT count(*) AS files, round(avg(depth), 6) AS average_depth, max(depth)::BIGINT AS max_depth, avg(depth) > 4 AS needs_clustering FROM d""")
def depth_of_ranges(spark, sf_dir):
    """Part ranges of the orders stand for file ranges."""
    ranges = domain.read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"))
    return layout.depth_of_ranges(ranges.select("lo", "hi"))


@query("m3_snapshots", f"""WITH {SILVER_SQL}, {GOLD_SQL.split(', gold AS (')[1].join(['gold AS (', ''])}
SELECT 'day 1' AS moment, count(*) AS n, sum(total_critical_errors)::BIGINT AS errors FROM gold
UNION ALL SELECT 'day 2', count(*), 0::BIGINT FROM gold UNION ALL SELECT 'day 3', count(*), sum(total_critical_errors)::BIGINT FROM gold""")
def snapshots(spark, sf_dir):
    root = run_dir(spark, "snapshots")
    first = gold(spark, sf_dir)
    layout.save_snapshot(first, root, "2024-01-01 00:00:00")
    layout.save_snapshot(first.withColumn("total_critical_errors", F.lit(0).cast("long")), root, "2024-01-02 00:00:00")
    layout.rollback(spark, root, "2024-01-01 12:00:00", "2024-01-03 00:00:00")
    parts = [layout.read_as_of(spark, root, f"2024-01-0{d} 00:00:00", "2024-01-03 00:00:00")
             .agg(F.count("*").alias("n"), F.sum("total_critical_errors").alias("errors")).withColumn("moment", F.lit(f"day {d}"))
             for d in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("m4_snapshot_diff", f"""WITH {SILVER_SQL},
a AS (SELECT vin_reference, count(*) AS n FROM silver WHERE engine_temperature_celsius < 100 GROUP BY 1),
b AS (SELECT vin_reference, count(*) AS n FROM silver WHERE engine_temperature_celsius < 20 OR engine_temperature_celsius > 240 GROUP BY 1)
SELECT vin_reference, CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL JOIN b USING (vin_reference) WHERE a.n IS DISTINCT FROM b.n""")
def snapshot_diff(spark, sf_dir):
    rows = domain.silver(spark, sf_dir)
    temp = F.col("engine_temperature_celsius")
    a, b = (rows.filter(c).groupBy("vin_reference").agg(F.count("*").alias("n")) for c in (temp < 100, (temp < 20) | (temp > 240)))
    return layout.snapshot_diff(a, b, ["vin_reference"])


@query("m5_tracked_write", " UNION ALL ".join(f"SELECT 'fleet.{t}' AS query_tag, 'copy {t}' AS query_text, count(*) AS rows_written FROM {t}"
                                               for t in ("events", "conversations", "lineitem")))
def tracked_write(spark, sf_dir):
    history = run_dir(spark, "history")
    for table in ("events", "conversations", "lineitem"):
        layout.tracked_write(domain.read(spark, sf_dir, table), run_dir(spark, table), history, f"fleet.{table}", f"copy {table}")
    return spark.read.parquet(history).select("query_tag", "query_text", "rows_written")


@query("m6_refresh_mv", FAULT_SUMMARY_SQL)
def refresh_mv(spark, sf_dir):
    path = run_dir(spark, "mv")
    summary = fault_summary(domain.faults(spark, sf_dir), "vin")
    return shown_summary(layout.refresh_mv(summary, "fleet_" + path.rsplit("-", 1)[1], path))


@query("n1_metric_query", f"""WITH {GOLD_SQL}
SELECT vin_reference AS vin, sum(total_critical_errors)::BIGINT AS total_critical_errors, max(max_engine_temp_recorded) AS max_temperature
FROM gold WHERE total_critical_errors > 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""")
def metric_query(spark, sf_dir):
    return semantic.metric_query(semantic.GOLD_MODEL, gold(spark, sf_dir), ["total_critical_errors", "max_temperature"], ["vin"],
                                 "total_critical_errors > 1", [F.col("total_critical_errors").desc(), F.col("vin")], 25)


@query("n2_filtered_metric", f"""WITH {FAULTS_SQL}
SELECT vin_masked AS vehicle_vin, count(fault_id) AS total_faults,
       count(fault_id) FILTER (WHERE driver_frustration_score < -0.5) AS high_frustration_faults FROM faults GROUP BY 1""")
def filtered_metric(spark, sf_dir):
    rows = domain.faults(spark, sf_dir).withColumn("concise_fault_summary", F.lit(None).cast("string"))
    return semantic.metric_query(semantic.FAULT_MODEL, rows, ["total_faults", "high_frustration_faults"], ["vehicle_vin"])


# Phrases of business users, one per event type.
PHRASES = {"error": " Broken Part ", "view": "truck", "click": "angry customers", "purchase": "total faults", "signup": "weather"}


@query("n3_resolve_terms", """WITH t(event_type, term, kind, name) AS (VALUES
  ('error', ' Broken Part ', 'dimension', 'component_issue'), ('view', 'truck', 'dimension', 'vehicle_vin'),
  ('click', 'angry customers', 'metric', 'high_frustration_faults'), ('purchase', 'total faults', 'metric', 'total_faults'),
  ('signup', 'weather', NULL, NULL)) SELECT event_id, term, kind, name FROM events JOIN t USING (event_type)""")
def resolve_terms(spark, sf_dir):
    phrase = F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair])[F.col("event_type")]
    terms = domain.read(spark, sf_dir, "events").select("event_id", phrase.alias("term"))
    return semantic.resolve_terms(terms, semantic.FAULT_MODEL)


STORED = {"articles": "of the and a in is that", "french": "le la de que du un une"}


def _jaccard_sql(question: str) -> str:
    known = f"list_distinct({words_sql(repr(question))})"
    asked = f"list_distinct({words_sql('symptoms')})"
    return f"round(len(list_intersect({asked}, {known})) / len(list_distinct(list_concat({asked}, {known}))), 6)::DOUBLE"


@query("n4_match_verified", f"""WITH {REQUESTS_SQL}, s AS (
  SELECT request_id, {_jaccard_sql(STORED['articles'])} AS a, {_jaccard_sql(STORED['french'])} AS f FROM requests)
SELECT request_id, CASE WHEN greatest(a, f) = 0 THEN NULL WHEN a >= f THEN 'articles' ELSE 'french' END AS verified_query,
       greatest(a, f) AS similarity FROM s""")
def match_verified(spark, sf_dir):
    return semantic.match_verified(domain.requests(spark, sf_dir), STORED, "request_id", "symptoms")


RUNNABLE = {
    "articles": semantic.StoredQuery(STORED["articles"], "SELECT vin_reference, total_critical_errors FROM {gold} ORDER BY total_critical_errors DESC LIMIT :k",
                                     ("gold",), {"k": 5}),
    "french": semantic.StoredQuery(STORED["french"], "SELECT count(*) AS n_vehicles, sum(total_critical_errors) AS n_errors FROM {gold} WHERE total_critical_errors >= :least",
                                   ("gold",), {"least": 1})}


@query("n4_run_verified", f"""WITH {GOLD_SQL}, {REQUESTS_SQL}, s AS (
  SELECT request_id, {_jaccard_sql(STORED['articles'])} AS a, {_jaccard_sql(STORED['french'])} AS f FROM requests), m AS (
  SELECT request_id, CASE WHEN greatest(a, f) = 0 THEN NULL WHEN a >= f THEN 'articles' ELSE 'french' END AS verified_query, greatest(a, f) AS similarity FROM s),
r AS (SELECT 'articles' AS verified_query, to_json(t)::VARCHAR AS answer FROM (
    SELECT '***-MASKED-VIN-***' AS vin_reference, total_critical_errors FROM gold ORDER BY total_critical_errors DESC LIMIT 5) t
  UNION ALL SELECT 'french', to_json(t)::VARCHAR FROM (
    SELECT count(*) AS n_vehicles, sum(total_critical_errors)::BIGINT AS n_errors FROM gold WHERE total_critical_errors >= 1) t)
SELECT request_id, m.verified_query, similarity, answer FROM m LEFT JOIN r ON r.verified_query = m.verified_query""")
def run_verified(spark, sf_dir):
    return semantic.run_verified(domain.requests(spark, sf_dir), RUNNABLE, {"gold": role_views(spark, sf_dir)}, "request_id", "symptoms")


@query("n5_keyword_coverage", f"""WITH w AS (SELECT item_id, list_distinct({words_sql('text')}) AS k FROM benchmark),
f AS (SELECT item_id, k, doc_id, len(list_filter(k, lambda x: contains(lower(d.text), x))) AS found
  FROM w JOIN documents d ON d.doc_id = item_id)
SELECT item_id AS case_id, found, len(k) AS expected, round(found / len(k), 6)::DOUBLE AS coverage FROM f""")
def keyword_coverage(spark, sf_dir):
    from fleet_engine.functions.text import tokens

    cases = domain.read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("case_id"),
                                                          F.array_distinct(tokens("text")).alias("expected_keywords"))
    answers = domain.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("case_id"), F.col("text").alias("answer"))
    out = semantic.keyword_coverage(answers, cases)
    return out.select("case_id", F.col("found").cast("long"), F.col("expected").cast("long"), "coverage")
