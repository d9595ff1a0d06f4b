"""Text scores and batch inference."""

import json

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from fleet_engine.operators import aggregates, enrich, inference, joins


def test_summary_picks_the_rarest_sentence(spark):
    df = spark.createDataFrame([(1, "the car. the broken injector. the car"), (2, "the car. the car"), (3, ""), (4, None)], "id int, t string")
    got = {r["id"]: r["summary"] for r in enrich.summarize(df, "id", "t").collect()}
    assert got == {1: "the broken injector", 2: "the car", 3: ""}
    two = {r["id"]: r["summary"] for r in enrich.summarize(df, "id", "t", 2).collect()}
    assert two[1] == "the car. the broken injector"


def test_sentiment_range_and_default(spark):
    df = spark.createDataFrame([(1, "good good bad"), (2, "nothing here"), (3, "Broken, WORN"), (4, None)], "id int, t string")
    got = {r["id"]: r["sentiment"] for r in enrich.sentiment(df, "id", "t").collect()}
    assert got == {1: round(1 / 3, 6), 2: 0.0, 3: -1.0, 4: 0.0}


def test_learned_lexicon(spark):
    labelled = spark.createDataFrame([("nice ride", True), ("nice car", True), ("awful car", False)], "t string, pos boolean")
    lexicon = enrich.fit_lexicon(labelled, "t", "pos")
    weights = {r["term"]: r["weight"] for r in lexicon.collect()}
    assert weights["nice"] > 0 > weights["awful"]
    df = spark.createDataFrame([(1, "nice nice"), (2, "awful"), (3, "unknown"), (4, "")], "id int, t string")
    got = {r["id"]: r["sentiment"] for r in enrich.sentiment(df, "id", "t", lexicon).collect()}
    assert got == {1: 1.0, 2: -1.0, 3: 0.0, 4: 0.0}


def test_classes_are_closed(spark):
    df = spark.createDataFrame([(1, "Misfire on cylinder, brake ok"), (2, "squealing brake pads"), (3, "hello"), (4, None),
                                (5, "battery and gear")], "id int, t string")
    got = {r["id"]: r["category"] for r in enrich.classify_keywords(df, "id", "t").collect()}
    assert got == {1: "ENGINE", 2: "BRAKES", 3: "OTHER", 4: "OTHER", 5: "ELECTRICAL"}


def test_text_classifier_learns_language(spark):
    from conftest import SF_DIR
    from fleet_engine.plans import domain

    docs = domain.read(spark, SF_DIR, "documents")
    model = enrich.fit_text_classifier(docs, "text", "lang")
    scored = enrich.apply_text_classifier(model, docs, "doc_id", "text").join(docs.select("doc_id", "lang"), "doc_id")
    assert scored.filter("lang = predicted_label").count() / docs.count() > 0.9


def test_extract_answer(spark):
    df = spark.createDataFrame([(1, "Fuel is fine. Torque specification is 15. Torque"), (2, "none")], "id int, t string")
    got = {r["id"]: r["answers"] for r in enrich.extract_answer(df, "id", "t", "torque specification").collect()}
    assert [(a["answer"], a["score"]) for a in got[1]] == [("Torque specification is 15", 1.0)] and got[2] == []


def test_embeddings(spark):
    df = spark.createDataFrame([(1, "a", "spark plug worn"), (2, "a", "coil worn out"), (3, "b", "spark plug worn"), (4, "b", "")],
                               "id int, k string, t string")
    model = enrich.fit_embedding(df, "t", 64)
    got = {r["id"]: np.array(r["embedding"]) for r in enrich.embed_text(df, "id", "t", model=model).collect()}
    assert all(len(v) == 64 for v in got.values()) and np.allclose(got[1], got[3]) and not got[4].any()
    assert abs(np.linalg.norm(got[1]) - 1) < 1e-6
    # the vector of a group is that of its joined texts
    joined = spark.createDataFrame([(1, "spark plug worn coil worn out")], "id int, t string")
    one = np.array(enrich.embed_text(joined, "id", "t", model=model).first()["embedding"])
    group = {r["k"]: np.array(r["embedding"]) for r in enrich.embed_groups(df, "k", "t", model=model).collect()}
    assert np.allclose(group["a"], one, atol=1e-6)


def test_complete_batch_asks_once_and_isolates_errors(spark):
    seen = spark.sparkContext.accumulator(0)

    def model(prompts):
        seen.add(len(prompts))
        if any("bad" in p for p in prompts):
            raise RuntimeError("no answer")
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([(i, p) for i, p in enumerate(["x", "x", "y", "bad", "known", "x"])], "id int, prompt string")
    cache = spark.createDataFrame([("known",)], "p string").select(F.sha2("p", 256).alias("prompt_hash"), F.lit("cached").alias("response"))
    got = {r["id"]: (r["response"], r["error"]) for r in inference.complete_batch(df, "prompt", model, cache).collect()}
    assert got[0] == got[1] == got[5] == ("X", None) and got[2] == ("Y", None) and got[4] == ("cached", None)
    assert got[3][0] is None and "no answer" in got[3][1]

    def factory():
        return lambda prompts: [str(len(p)) for p in prompts]

    assert {r["response"] for r in inference.complete_batch(df, "prompt", factory, make_model=True).collect()} == {"1", "3", "5"}


def test_render_prompts(spark):
    df = spark.createDataFrame([(1, "v1", "noise {vin}", "V1"), (2, "v2", "x", "V1"), (3, "zz", "x", "V1"), (4, "v1", None, "V1")],
                               "id int, version string, symptoms string, vin string")
    templates = {"v1": 'For {vin}: {symptoms} as {{"a": 1}}', "v2": "{context} {symptoms}"}
    ok, bad = inference.render_prompts(df, templates, "version", {"vin": "vin", "symptoms": "symptoms"})
    assert rows(ok.select("id", "prompt")) == [(1, 'For V1: noise {vin} as {"a": 1}'), (4, 'For V1:  as {"a": 1}')]
    assert rows(bad.select("id", "missing_field")) == [(2, "context"), (3, "question")]


def test_parse_diagnosis(spark):
    good = {"diagnosis": "clog", "confidence_score": "0.9", "supporting_evidence": "p. 12",
            "recommended_actions": [{"action": "check", "acceptance_criteria": "45 PSI"}]}
    lacking = {k: v for k, v in good.items() if k != "supporting_evidence"}
    broken_action = {**good, "recommended_actions": [{"action": "check"}]}
    raws = [json.dumps(good), "```json\n" + json.dumps(good) + "\n```", json.dumps(lacking), "sorry", json.dumps(broken_action),
            json.dumps({**good, "confidence_score": "high"}), None]
    df = spark.createDataFrame(list(enumerate(raws)), "id int, raw string")
    got = {r["id"]: r["result"] for r in inference.parse_diagnosis(df, "raw").collect()}
    for i in (0, 1):
        assert got[i]["diagnosis"] == "clog" and got[i]["confidence_score"] == 0.9
        assert got[i]["recommended_actions"][0]["acceptance_criteria"] == "45 PSI"
    for i in range(2, 7):
        assert got[i]["diagnosis"] == "Analysis Incomplete" and got[i]["confidence_score"] == 0.0 and got[i]["recommended_actions"] == []


def test_truth_join_judge_and_gate(spark):
    truth = spark.createDataFrame([(1, "check the coil", "V1"), (2, "stop now", "V2"), (3, "reset", None)],
                                  "eval_id int, expected_answer string, vin_context string")
    audit = spark.createDataFrame([("V1", "check coil"), ("V1", "buy shoes"), ("V9", "x"), (None, "y")], "vin_reference string, parsed_diagnosis string")
    joined = joins.eval_join(truth, audit)
    assert rows(joined.select("eval_id", "parsed_diagnosis")) == [(1, "buy shoes"), (1, "check coil"), (2, None), (3, None)]
    graded = inference.judge(joined, "expected_answer", "parsed_diagnosis")
    scores = sorted(r["faithfulness_score"] for r in graded.collect() if r["faithfulness_score"] is not None)
    assert scores == [0.0, 1.0]
    asked = joined.withColumn("input_query", F.when(F.col("parsed_diagnosis") == "buy shoes", F.lit("Which shoes?")))
    known = inference.judge(asked, "expected_answer", "parsed_diagnosis", "input_query")
    assert sorted(r["faithfulness_score"] for r in known.collect() if r["faithfulness_score"] is not None) == [0.5, 1.0]
    assert rows(aggregates.quality_gate(graded)) == [(4, 0.5, 0.0, aggregates.GATE_FAIL)]
    assert aggregates.quality_gate(graded.limit(0)).first()["deployment_gate_status"].startswith("FAIL")
    good = spark.createDataFrame([(0.9,), (0.8,), (None,)], "faithfulness_score double")
    assert "PASS" in aggregates.quality_gate(good).first()["deployment_gate_status"]
    long = spark.createDataFrame([("faithfulness", 0.9), ("relevance", 0.7)], "metric string, score double")
    assert {r["metric"]: r["passed"] for r in aggregates.metric_gates(long).collect()} == {
        "faithfulness": True, "relevance": False, "answer_correctness": False}


def test_benchmark_and_comparison(spark):
    cases = spark.createDataFrame([("CASE_001", 0.70), ("CASE_002", 0.75), ("CASE_003", 0.65)], "case_id string, min_confidence double")
    results = spark.createDataFrame([("base", "CASE_001", True, 0.70, 1.0), ("base", "CASE_002", True, 0.9, 2.0), ("base", "CASE_003", False, None, None),
                                     ("new", "CASE_001", True, 0.799, 1.0), ("new", "CASE_002", True, 0.799, 1.0), ("new", "CASE_003", True, 0.799, 1.0)],
                                    "experiment string, case_id string, ok boolean, confidence double, latency double")
    summary = aggregates.benchmark_summary(results, cases)
    assert rows(summary) == [("base", 3, 2, 66.666667, 1.0), ("new", 3, 3, 100.0, 1.0)]
    assert aggregates.ab_compare(summary, "base", "new").first()["result"] == "BLOCKED"
    assert aggregates.ab_compare(summary, "base", "new", sla=60.0).first()["result"] == "CHALLENGER"
    assert aggregates.ab_compare(summary, "new", "base").first()["result"] == "BASELINE"


def test_guard_vin_and_context(spark):
    df = spark.createDataFrame([("1", "What about my engine, VIN123?"), ("2", "Tell me a joke"), ("3", "brake VIN456 and VIN123")], "request_id string, prompt string")
    guarded = {r["request_id"]: (r["in_domain"], r["refusal"]) for r in inference.guardrail(df, "prompt").collect()}
    assert guarded["1"] == (True, None) and guarded["2"][0] is False and guarded["2"][1] == inference.REFUSAL
    named = inference.extract_vin(df, "prompt")
    assert {r["request_id"]: r["vin_reference"] for r in named.collect()} == {"1": "VIN123", "2": "NONE", "3": "VIN456"}
    manuals = spark.createDataFrame([("VIN123", "f", i, f"c{i}") for i in range(5)], "vin string, source_file string, chunk_index int, chunk_text string")
    logs = spark.createDataFrame([("VIN456", 1, "old"), ("VIN456", 2, "new")], "vin string, log_id int, log_text string")
    out = joins.assemble_context(named, manuals, logs, vin="vin_reference")
    got = {r["request_id"]: r["context"] for r in out.collect()}
    assert got["1"] == "Manual Reference: c0 | c1 | c2\nDiagnostic Logs: No diagnostic logs found."
    assert got["2"] == joins.NO_VEHICLE
    assert got["3"] == "Manual Reference: No manual data found for this VIN.\nDiagnostic Logs: new"
    registry = spark.createDataFrame([("E1", "OPENAI", "v2")], "id string, llm_provider string, prompt_version string")
    asked = spark.createDataFrame([(1, "E1"), (2, "E9"), (3, None)], "request_id int, experiment_id string")
    assert rows(joins.apply_experiments(asked, registry).select("request_id", "provider", "prompt_version")) == [
        (1, "OPENAI", "v2"), (2, "SNOWFLAKE", "diagnostic_expert_json"), (3, "SNOWFLAKE", "diagnostic_expert_json")]


def test_silver_models(spark):
    from fleet_engine.plans import medallion

    silver = spark.createDataFrame([(1, "Engine misfire. Fuel fine. Fuel fine"), (2, None), (3, "brake pads worn")], "event_id long, mechanic_notes string")
    got = {r["event_id"]: (r["log_summary"], r["fault_category"]) for r in medallion.score_telemetry(silver, "event_id").collect()}
    assert got == {1: ("Engine misfire", "ENGINE"), 2: (None, None), 3: ("brake pads worn", "BRAKES")}
    bronze = spark.createDataFrame([(1, "VIN0001234", "P1", "Broken pump. All good good", "2024-01-01 00:00:00"), (2, "V", "P1", "", "2024-01-01 00:00:00"),
                                    (3, "V", None, "component pump failed", "2024-01-01 00:00:00")],
                                   "event_id long, vin string, error_code string, log_text string, recorded_at string")
    bronze = bronze.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))
    faults = {r["event_id"]: r for r in medallion.fault_analysis(bronze, "event_id").collect()}
    assert set(faults) == {1, 3} and faults[1]["vin_masked"] == "***-***-1234" and faults[3]["fault_id"] is None
    assert faults[1]["driver_frustration_score"] == round(1 / 3, 6) and faults[3]["driver_frustration_score"] == -1.0
    assert faults[3]["target_component_extracted"] == "component pump failed" and faults[1]["target_component_extracted"] is None


def test_the_best_sentence_is_looked_for_once(spark):
    df = spark.createDataFrame([(1, "A pump. The pump of the engine\nengine"), (2, "none"), (3, None), (4, "")], "id int, t string")
    found = enrich.extract_answer(df, "id", "t", "pump engine")
    assert rows(found.select("id", "answers.answer", "answers.score")) == [(1, ["The pump of the engine"], [1.0]), (2, [], []), (3, [], []), (4, [], [])]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("array_max(") == 1
