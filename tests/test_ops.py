"""Streams, quality, governance, risk, layout, history and metrics layer."""

import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from conftest import ROOT, rows
from pyspark.sql import functions as F

from fleet_engine.operators import governance, layout, quality, ranking, risk, semantic
from fleet_engine.operators.aggregates import fault_summary
from fleet_engine.operators.textindex import TextIndex, add_documents, asked_blocks, index_postings, search_index
from fleet_engine.streaming import streams


def test_queue_stream_runs_once_per_row(spark, tmp_path):
    source, out, seen = (str(tmp_path / n) for n in ("queue", "out", "seen"))
    schema = "ingestion_id string, filename string, vin_reference string, status string"
    files = spark.createDataFrame([("a.pdf", "one\ntwo"), ("b.pdf", "three")], "filename string, content string")

    def run():
        stream = streams.stream_pending(spark, source, spark.createDataFrame([], schema).schema)
        streams.run_queue(stream, files, out, seen, "2024-01-31 00:00:00").awaitTermination()
        return spark.read.parquet(f"{out}/chunks").count(), spark.read.parquet(f"{out}/status").count()

    spark.createDataFrame([("1", "a.pdf", "V", "PENDING"), ("2", "x.pdf", "V", "PENDING"), ("3", "a.pdf", "V", "FAILED")], schema).write.parquet(source)
    assert run() == (2, 2) and run() == (2, 2)
    spark.createDataFrame([("4", "b.pdf", "V", "PENDING")], schema).write.mode("append").parquet(source)
    assert run() == (3, 3)


def test_watch_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "VIN1_a.pdf").write_bytes(b"123")
    (tmp_path / "in" / "b.txt").write_bytes(b"1")

    def run():
        stream = streams.watch_files(spark, str(tmp_path / "in"), "*.pdf")
        streams.append_batches(stream, str(tmp_path / "out"), str(tmp_path / "seen")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")).select("filename", "size_bytes"))

    assert run() == [("VIN1_a.pdf", 3)]
    (tmp_path / "in" / "VIN2_b.pdf").write_bytes(b"12")
    assert run() == [("VIN1_a.pdf", 3), ("VIN2_b.pdf", 2)]


def test_index_refresh_equals_full_build(spark, tmp_path):
    from fleet_engine.operators.keywords import bm25_index

    source, index, seen = (str(tmp_path / n) for n in ("docs", "index", "seen"))
    batches = [[(1, "brake pad worn"), (2, "")], [(3, "brake oil oil"), (4, "engine")]]
    for batch in batches:
        df = spark.createDataFrame(batch, "doc_id long, text string")
        df.write.mode("append").parquet(source)
        streams.refresh_index(streams.stream_table(spark, source, df.schema), "doc_id", "text", index, seen).awaitTermination()
    whole = spark.createDataFrame(batches[0] + batches[1], "doc_id long, text string")

    def shown(p):
        return rows(p.select("term", "doc_id", F.round("impact", 9), "df"))

    assert shown(index_postings(TextIndex(spark, index))) == shown(bm25_index(whole, "doc_id", "text"))


def test_index_refresh_replaces_and_deletes(spark, tmp_path):
    from fleet_engine.operators.keywords import bm25_index

    source, index, seen = (str(tmp_path / n) for n in ("docs", "index", "seen"))
    for batch in ([(1, "brake pad"), (2, "oil"), (3, "coil")], [(1, "brake disc"), (3, None)]):
        df = spark.createDataFrame(batch, "doc_id long, text string")
        df.write.mode("append").parquet(source)
        streams.refresh_index(streams.stream_table(spark, source, df.schema), "doc_id", "text", index, seen).awaitTermination()
    now = spark.createDataFrame([(1, "brake disc"), (2, "oil")], "doc_id long, text string")

    def shown(p):
        return rows(p.select("term", "doc_id", F.round("impact", 9), "df"))

    assert shown(index_postings(TextIndex(spark, index))) == shown(bm25_index(now, "doc_id", "text"))


def test_index_of_repeated_and_null_rows(spark, tmp_path):
    """Two versions in one batch: the newest counts; NULL ids are left out; a version of an older batch is replaced once."""
    from fleet_engine.operators.keywords import bm25_index

    index = TextIndex(spark, str(tmp_path / "index"), slots=3)
    schema = "doc_id long, text string, at int"
    for n, batch in enumerate([[(1, "a b", 1), (1, "c", 2), (2, "", 1), (None, "a", 1)], [(1, "d d", 5), (1, "e", 4), (3, "a", 1)], [(2, None, 1), (3, "a f", 2)]]):
        for _ in range(2):                       # each batch is replayed
            add_documents(index, spark.createDataFrame(batch, schema), "doc_id", "text", n, "at")
    now = spark.createDataFrame([(1, "d d"), (3, "a f")], "doc_id long, text string")
    shown = lambda p: rows(p.select("term", "doc_id", F.round("impact", 9), "df"))
    assert shown(index_postings(index)) == shown(bm25_index(now, "doc_id", "text"))
    assert rows(search_index(index, spark.createDataFrame([(1, "D a"), (2, None), (3, "zz")], "query_id long, text string"), 5).select("query_id", "doc_id", "rank")) == [(1, 1, 1), (1, 3, 2)]
    nothing = TextIndex(spark, str(tmp_path / "none"))
    assert search_index(nothing, spark.createDataFrame([(1, "a")], "query_id long, text string"), 5).count() == 0


def test_search_after_a_refresh_reads_only_asked_terms(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path / "index"))
    docs = spark.range(300).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 40), i -> concat('w', (id * 7 + i * i) % 500))) AS text")
    add_documents(index, docs, "doc_id", "text", 0)
    add_documents(index, docs.filter("doc_id = 7").selectExpr("doc_id", "'w1 brandnew' AS text"), "doc_id", "text", 1)
    words = spark.createDataFrame([("brandnew",), ("w1",)], "term string").selectExpr("term", f"int(pmod(xxhash64(term), {index.slots})) AS slot")
    asked = {r.slot for r in words.collect()}
    for part in asked_blocks(index, words, index.batches()):
        filters = part._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]
        assert "slot" in filters.split("PushedFilters")[0]
        assert {int(f.split("slot=")[1].split("/")[0]) for f in part.inputFiles()} == asked
    assert [(r.doc_id, r.rank) for r in search_index(index, spark.createDataFrame([(1, "brandnew")], "query_id long, text string"), 3).collect()] == [(7, 1)]


def test_blocks_that_cannot_reach_the_floor_are_not_read(spark, tmp_path):
    """Every text has common words; queries also hold one rare word, so most ranges stay below the floor."""
    from fleet_engine.operators.keywords import bm25_index, bm25_topk

    docs = spark.range(4000).selectExpr("id AS doc_id", "concat_ws(' ', 'the of and', concat('rare', id % 400), concat('some', id % 40), if(id % 3 = 0, 'the the to', 'a')) AS text")
    queries = spark.range(30).selectExpr("id AS query_id", "concat('the of a rare', id * 13) AS text")
    index, work = TextIndex(spark, str(tmp_path / "index")), {}
    add_documents(index, docs, "doc_id", "text", 0)
    got = search_index(index, queries, 5, work=work)
    assert rows(got) == rows(bm25_topk(bm25_index(docs, "doc_id", "text"), queries, 5).select(*got.columns))
    assert 0 < work["read"] < 0.5 * work["pairs"]


def test_filters_per_query_and_stored_fields(spark, tmp_path):
    docs = spark.createDataFrame([(1, "oil pump", "en", "a"), (2, "oil", "de", "b"), (3, "oil oil pump", None, "c"), (4, None, "en", "d"), (5, "oil oil", "en", None)],
                                 "doc_id long, text string, lang string, source string")
    index = TextIndex(spark, str(tmp_path / "index"), ("lang",), ("source",))
    add_documents(index, docs, "doc_id", "text", 0)
    add_documents(index, docs.filter("doc_id = 2").withColumn("source", F.lit("new")), "doc_id", "text", 1)
    asked = spark.createDataFrame([(1, "oil", "en"), (2, "oil", "de"), (3, "oil", None), (4, "oil", "fr"), (5, "oil", "en")], "query_id long, text string, lang string")
    got = search_index(index, asked, 9, fields=("source",), filters=("lang",))
    found = {q: {(r.doc_id, r.source) for r in got.collect() if r.query_id == q} for q in range(1, 6)}
    assert found[1] == found[5] == {(1, "a"), (5, None)} and found[2] == {(2, "new")} and found[3] == {(1, "a"), (2, "new"), (3, "c"), (5, None)} and not found[4]
    with pytest.raises(ValueError):
        search_index(index, asked, 1, filters=("source",))


@pytest.mark.parametrize("adds", [1, 1 << 21])
def test_ranges_meet_all_queries_at_once(spark, tmp_path, monkeypatch, adds):
    """With very many (query, block) pairs none becomes a row; the hits are the same, with filters, replaced documents, NULL queries and text ids."""
    from fleet_engine.operators import textindex

    index = TextIndex(spark, str(tmp_path / "index"), ("lang", "year"), ("source",))
    docs = spark.range(500).selectExpr("concat('d', id) AS doc_id", "concat_ws(' ', 'the of', concat('w', id % 7), if(id % 3 = 0, 'the and', 'to'), concat('x', id % 50)) AS text",
                                       "if(id % 11 = 0, NULL, if(id % 2 = 0, 'en', 'de')) AS lang", "int(id % 5) AS year", "concat('s', id % 4) AS source")
    add_documents(index, docs, "doc_id", "text", 0)
    add_documents(index, docs.filter("year = 3").withColumn("text", F.expr("if(lang = 'en', NULL, concat(text, ' new the'))")), "doc_id", "text", 1)
    asked = spark.createDataFrame([(1, "the of w3", "en", None), (2, "new the x4", None, 3), (3, "w1 to", "de", 2), (4, None, None, None), (5, "zz", "en", 1), (6, "the of w3", "en", None),
                                   (7, "and the", None, None)], "query_id long, text string, lang string, year int")
    plain = rows(search_index(index, asked, 6, fields=("source",), filters=("lang", "year")))
    monkeypatch.setattr(textindex, "PAIR_ROWS", 0)
    monkeypatch.setattr(textindex, "ADDS", adds)
    made = []
    monkeypatch.setattr(textindex, "stage", lambda df, name, real=textindex.stage: made.append(name) or real(df, name))
    work = {}
    assert rows(search_index(index, asked, 6, fields=("source",), filters=("lang", "year"), work=work)) == plain and len(plain) > 20
    assert "index-bounds" not in made and work["pairs"] > 0
    assert rows(search_index(index, asked, 6)) == rows(search_index(index, asked.drop("lang", "year"), 6))


def test_late_and_repeated_events_reach_silver_once(spark, tmp_path):
    source, out, seen = (str(tmp_path / n) for n in ("in", "out", "seen"))
    schema = "event_id long, vin string, engine_temp_raw string, error_code string, log_text string, recorded_at string"
    for batch in ([(1, "a", "90", "P1", None, "2024-01-10 00:00:00"), (2, "a", "91", "P1", None, "2024-01-10 00:00:00")],
                  [(3, "b", "92", "P1", None, "2024-01-02 00:00:00"), (1, "a", "90", "P1", None, "2024-01-10 00:00:00"), (4, "b", "93", "P1", None, None)],
                  [(4, "b", "93", "P1", None, None)]):
        spark.createDataFrame(batch, schema).write.mode("append").json(source)
        streams.append_once(streams.stream_silver(spark, source), "event_id", "recorded_at", out, seen).awaitTermination()
    assert rows(spark.read.parquet(out).select("event_id", "vin_reference")) == [(1, "a"), (2, "a"), (3, "b"), (4, "b")]


def test_incremental_summary_equals_batch(spark, tmp_path):
    source, out, seen = (str(tmp_path / n) for n in ("faults", "out", "seen"))
    schema = "vin string, driver_frustration_score double, recorded_at timestamp_ntz"
    parts = [[("a", -0.9, None), ("a", 0.5, None), ("b", None, None)], [("a", -0.6, None), ("c", 0.25, None)]]
    for i, part in enumerate(parts):
        df = spark.createDataFrame(part, schema).withColumn("recorded_at", F.lit(f"2024-01-0{i + 1} 00:00:00").cast("timestamp_ntz"))
        df.write.mode("append").parquet(source)
        streams.stream_fault_summary(streams.stream_table(spark, source, df.schema), "vin", out, seen).awaitTermination()
    def shown(df):
        return rows(df.withColumn("avg_frustration", F.round("avg_frustration", 9)).select("vin", "total_fault_count", "avg_frustration", "high_frustration_count", "latest_fault_at"))

    assert shown(streams.read_fault_summary(spark, out, "vin")) == shown(fault_summary(spark.read.parquet(source), "vin"))


def forget_last_commit(checkpoint):
    """Make a stream run its last batch again, as if it had been stopped before the end."""
    newest = max((Path(checkpoint) / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    newest.unlink()
    (newest.parent / f".{newest.name}.crc").unlink(missing_ok=True)


def test_silver_batch_reads_only_its_days(spark, tmp_path):
    """A batch looks into the folders of its own days; repeats inside a batch keep the earliest, rows without an id all stay, and a replay changes nothing."""
    source, out, seen = (str(tmp_path / n) for n in ("in", "out", "seen"))
    schema = "event_id long, note string, at timestamp_ntz"
    batches = [[(i, "x", f"2024-01-{1 + i % 20:02d} 10:00:00") for i in range(60)],
               [(3, "again", "2024-01-04 11:00:00"), (100, "late", "2024-01-04 12:00:00"), (100, "early", "2024-01-04 01:00:00"), (None, "a", "2024-01-05 00:00:00"), (None, "b", None)],
               [(100, "early", "2024-01-04 01:00:00"), (None, "a", "2024-01-05 00:00:00")]]
    for batch in batches:
        df = spark.createDataFrame([(i, n, at) for i, n, at in batch], "event_id long, note string, t string").selectExpr("event_id", "note", "cast(t as timestamp_ntz) at")
        df.coalesce(1).write.mode("append").parquet(source)
        streams.append_once(streams.stream_table(spark, source, df.schema), "event_id", "at", out, seen).awaitTermination()
    kept = spark.read.parquet(out)
    assert rows(kept.filter("event_id >= 60").select("event_id", "note")) == [(100, "early")]
    assert kept.filter("event_id < 60").count() == 60 and kept.filter("event_id IS NULL").count() == 3
    known = streams.known_ids(spark, out, "event_id", "bigint", [date(2024, 1, 4), date(2031, 1, 1)], 1)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "event_day" in plan.split("PartitionFilters: ")[1].split("]")[0] and "2024-01-04" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert known.inputFiles() and all("event_day=2024-01-04" in f for f in known.inputFiles())
    before = rows(kept.select("event_id", "note", "batch_id"))
    forget_last_commit(seen)
    streams.append_once(streams.stream_table(spark, source, df.schema), "event_id", "at", out, seen).awaitTermination()
    assert rows(spark.read.parquet(out).select("event_id", "note", "batch_id")) == before


def test_summary_table_does_not_grow_with_batches(spark, tmp_path):
    source, out, seen = (str(tmp_path / n) for n in ("faults", "out", "seen"))
    files = []
    for i in range(5):
        df = spark.createDataFrame([(f"v{k}" if k else None, -0.1 * k * i, None) for k in range(0, 9, 1 + i % 2)], "vin string, driver_frustration_score double, t string")
        df = df.selectExpr("vin", "driver_frustration_score", f"timestamp_ntz'2024-01-0{i + 1} 00:00:00' AS recorded_at")
        df.coalesce(1).write.mode("append").parquet(source)
        for again in (False, True):
            streams.stream_fault_summary(streams.stream_table(spark, source, df.schema), "vin", out, seen, buckets=4).awaitTermination()
            if not again and i == 3:
                forget_last_commit(seen)
        summary = streams.read_fault_summary(spark, out, "vin")
        files.append(len(summary.inputFiles()))
        assert "Exchange" not in summary._jdf.queryExecution().executedPlan().toString()
        shown = lambda d: rows(d.withColumn("avg_frustration", F.round("avg_frustration", 9)).select("vin", "total_fault_count", "avg_frustration", "high_frustration_count", "latest_fault_at"))
        assert shown(summary) == shown(fault_summary(spark.read.parquet(source), "vin"))
    assert max(files) <= 4 and len(list(Path(out).glob("rows/*/*"))) <= 8


def test_forest_scores_after_a_tracked_write(spark, tmp_path):
    """An observed write leaves a manager in the session that must not travel with a model."""
    from fleet_engine.operators import risk

    layout.tracked_write(spark.range(10), str(tmp_path / "t"), str(tmp_path / "h"), "tag", "text")
    data = spark.range(200).selectExpr("id", "double(id) AS engine_temperature_celsius")
    model = risk.train_risk(risk.risk_features(data), trees=3)
    assert risk.class_metrics(risk.score(model, risk.risk_features(data))).first()["accuracy"] > 0.9


def test_compaction_keeps_the_results(spark, tmp_path):
    """A compacted table has two folders, says the same as before, and a stream goes on with it; so it is when it is compacted again."""
    paths = {n: str(tmp_path / n) for n in ("docs", "index0", "seen1", "events", "silver0", "seen2", "faults", "sums0", "seen3")}
    batches = [[(1, "brake pad"), (2, "oil"), (3, "coil")], [(1, "brake disc"), (3, None)], [(4, "oil oil")], [(1, "pad"), (2, None)], [(5, "disc")]]

    def state(i):
        return (rows(index_postings(TextIndex(spark, paths[f"index{i}"])).select("term", "doc_id", F.round("impact", 9), "df")),
                rows(spark.read.parquet(paths[f"silver{i}"]).select("event_id", "event_day")), rows(streams.read_fault_summary(spark, paths["sums0"], "vin")))

    at = 0
    for turn, batch in enumerate(batches):
        docs = spark.createDataFrame(batch, "doc_id long, text string")
        events = docs.selectExpr("doc_id event_id", "'v' vin", "'90' engine_temp_raw", "'P1' error_code", "text log_text", f"'2024-01-0{turn // 2 + 1} 00:00:00' recorded_at")
        faults = docs.selectExpr("concat('v', doc_id) vin", f"-0.25D * {turn} driver_frustration_score", f"timestamp_ntz '2024-01-0{turn + 1} 00:00:00' recorded_at")
        docs.write.mode("append").parquet(paths["docs"])
        events.write.mode("append").json(paths["events"])
        faults.write.mode("append").parquet(paths["faults"])
        streams.refresh_index(streams.stream_table(spark, paths["docs"], docs.schema), "doc_id", "text", paths[f"index{at}"], paths["seen1"]).awaitTermination()
        streams.append_once(streams.stream_silver(spark, paths["events"]), "event_id", "recorded_at", paths[f"silver{at}"], paths["seen2"]).awaitTermination()
        streams.stream_fault_summary(streams.stream_table(spark, paths["faults"], faults.schema), "vin", paths["sums0"], paths["seen3"]).awaitTermination()
        if turn in (2, 3):
            before, at = state(at), at + 1
            paths |= {n: str(tmp_path / n) for n in (f"index{at}", f"silver{at}")}
            streams.compact_index(spark, paths[f"index{at - 1}"], paths[f"index{at}"])
            streams.compact_batches(spark, paths[f"silver{at - 1}"], paths[f"silver{at}"], ("event_day",))
            assert state(at) == before
    index, silver, sums = state(at)
    assert {(r[0], r[1]) for r in index} == {("pad", 1), ("oil", 4), ("disc", 5)}
    assert len(silver) == len(set(silver)) and {r[0] for r in silver} == {1, 2, 3, 4, 5}
    assert sum(r[1] for r in sums) == sum(map(len, batches))


def test_suite_and_schema(spark, diagnostics):
    checks = [quality.expect_not_null("vin"), quality.expect_not_null("error_code"), quality.expect_between("engine_temp", -40, 120),
              quality.expect_row_count(1, 10), quality.expect_row_count(6, 10), quality.expect_unique("vin"), quality.expect_unique("vin", "error_code")]
    report = quality.run_suite(diagnostics, checks)
    assert [r["failures"] for r in report.collect()] == [0, 1, 1, 0, 1, 2, 0]
    assert rows(quality.suite_gate(report)) == [(4, False)]
    assert rows(quality.suite_gate(quality.run_suite(diagnostics, checks[:1]))) == [(0, True)]
    wrong = quality.expect_schema(diagnostics, types={"vin": "string", "engine_temp": "float"}, ordered=["vin"], names={"vin", "x"})
    assert wrong.filter("check = 'type'").count() == 1 and wrong.filter("check = 'ordered_columns'").count() == 1
    assert {r["column"] for r in wrong.filter("check = 'column_set'").collect()} == {"x", "error_code", "engine_temp", "log_text", "recorded_at"}
    assert quality.expect_schema(diagnostics, ordered=diagnostics.columns, names=set(diagnostics.columns)).count() == 0
    times = diagnostics.withColumn("at", F.col("recorded_at").cast("timestamp_ntz"))
    assert quality.freshness(times, "at", "24 HOURS", "2024-03-08 00:00:00").first()["fresh"] is True
    assert quality.freshness(times, "at", "1 HOURS", "2024-03-08 00:00:00").first()["fresh"] is False
    assert quality.freshness(times.limit(0), "at", "1 HOURS", "2024-03-08 00:00:00").first()["fresh"] is False
    assert rows(quality.null_metric(diagnostics, "error_code")) == [(1, 5)]


def test_column_checks_share_one_pass(diagnostics):
    report = quality.run_suite(diagnostics, [quality.expect_not_null(c) for c in diagnostics.columns])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_text_rules(spark):
    docs = spark.createDataFrame([("a.py", "x = 1\nrole = 'ADMIN'  # ok\ny  # admin"), ("b.py", None), ("c.py", "try: pass")], "doc_id string, text string")
    found = quality.scan_rules(docs, {"no_admin": "admin"}, comment="#")
    assert rows(found) == [("a.py", 2, "no_admin", "role = 'ADMIN'  # ok")]
    assert rows(quality.require_rules(docs, {"has_try": "TRY"})) == [("a.py", "has_try"), ("b.py", "has_try")]


def test_masks_never_leak(spark, diagnostics):
    policies = {"vin": governance.Policy()}
    assert {r["vin"] for r in governance.apply_masks(diagnostics, policies, "ANALYST_ROLE").collect()} == {governance.MASK}
    assert rows(governance.apply_masks(diagnostics, policies, "CORTEX_DEV_ROLE")) == rows(diagnostics)
    tagged = governance.tag(governance.tag(diagnostics, "vin", "SENSITIVE"), "log_text", "PUBLIC")
    assert governance.tagged_columns(tagged) == {"vin": "SENSITIVE", "log_text": "PUBLIC"}
    assert {r["vin"] for r in governance.mask_tagged(tagged.filter("engine_temp > 0"), "INTERN").collect()} == {governance.MASK}
    with pytest.raises(ValueError):
        governance.tag(diagnostics, "vin", "SECRET")
    assert rows(governance.tag_inventory({"d": tagged, "e": diagnostics})) == [("d", "log_text", "PUBLIC", 5), ("d", "vin", "SENSITIVE", 5)]
    views = governance.role_views({"d": tagged, "raw": diagnostics}, {"INTERN": ["d"]}, {}, "INTERN")
    assert set(views) == {"d"} and spark.table("intern__d").select("vin").distinct().first()[0] == governance.MASK
    assert governance.role_views({"d": tagged}, {}, {}, "NOBODY") == {}


def test_risk(spark, tmp_path):
    df = spark.range(600).select(F.col("id").alias("event_id"), (F.col("id") % 200).cast("double").alias("engine_temperature_celsius"))
    train, test = risk.split(risk.risk_features(df), "event_id")
    assert train.count() + test.count() == 600 and 430 < train.count() < 530
    again, _ = risk.split(risk.risk_features(df.repartition(7)), "event_id")
    assert rows(again.select("event_id")) == rows(train.select("event_id"))
    model = risk.train_risk(train, trees=10)
    metrics = risk.class_metrics(risk.score(model, test)).first()
    assert metrics["accuracy"] > 0.95
    assert risk.register_model(spark, model, str(tmp_path), "rf", "v1") and not risk.register_model(spark, model, str(tmp_path), "rf", "v1")
    assert rows(risk.score(risk.load_model(str(tmp_path), "rf", "v1"), test)) == rows(risk.score(model, test))
    none = spark.createDataFrame([(1, 0)], "is_at_risk int, predicted_risk_class int")
    assert rows(risk.class_metrics(none)) == [(1, 0.0, 0.0)]


def test_clustered_table_and_depth(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4000, 1, 8).select((F.hash("id") % 1000).alias("k"), "id")
        df.write.parquet(str(tmp_path / "plain"))
        layout.write_clustered(df, str(tmp_path / "clustered"), ["k"], bloom="k")
        plain, clustered = (layout.clustering_depth(spark.read.parquet(str(tmp_path / n)), "k").first() for n in ("plain", "clustered"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert plain["files"] == 8 and plain["average_depth"] == 8.0 and plain["needs_clustering"]
    assert clustered["files"] == 4 and clustered["average_depth"] == 1.0 and not clustered["needs_clustering"]
    table = spark.read.parquet(str(tmp_path / "clustered"))
    hit = layout.lookup(table, "k", 7)
    assert rows(hit) == rows(df.filter("k = 7"))
    assert "EqualTo(k,7)" in hit._jdf.queryExecution().executedPlan().toString()


def test_depth_against_brute_force(spark):
    import random

    rng = random.Random(5)
    ranges = [tuple(sorted((rng.randrange(40), rng.randrange(40)))) for _ in range(60)]
    got = layout.depth_of_ranges(spark.createDataFrame(ranges, "lo int, hi int")).first()
    depths = [sum(a <= hi and b >= lo for a, b in ranges) for lo, hi in ranges]
    assert got["files"] == 60 and got["max_depth"] == max(depths) and got["average_depth"] == round(sum(depths) / 60, 6)


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "s")
    day = "2024-01-{:02d} 00:00:00".format
    layout.save_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), root, day(1))
    layout.save_snapshot(spark.createDataFrame([(1, "a"), (2, "c"), (3, None)], "id int, v string"), root, day(2))
    old, new = layout.read_as_of(spark, root, "2024-01-01 12:00:00"), layout.read_as_of(spark, root, day(2))
    assert old.count() == 2 and new.count() == 3
    assert rows(layout.snapshot_diff(old, new, ["id"])) == [(2, "changed"), (3, "added")]
    assert rows(layout.snapshot_diff(new, old, ["id"])) == [(2, "changed"), (3, "removed")]
    layout.rollback(spark, root, day(1), day(3))
    assert rows(layout.read_as_of(spark, root, day(9))) == rows(old)
    with pytest.raises(ValueError):
        layout.read_as_of(spark, root, "2023-12-31 00:00:00")
    with pytest.raises(ValueError):
        layout.read_as_of(spark, root, day(1), now=day(20))
    assert layout.expired_snapshots(spark, root, day(5)).count() == 0
    gone = layout.expired_snapshots(spark, root, day(20)).collect()
    assert len(gone) == 1 and gone[0]["path"].endswith("20240102000000")


def test_metrics_layer(spark):
    faults = spark.createDataFrame([("f1", "v1", "pad", "s", -0.9), ("f2", "v1", "oil", "s", 0.1), (None, "v2", "oil", "s", -0.8)],
                                   "fault_id string, vin_masked string, target_component_extracted string, concise_fault_summary string, driver_frustration_score double")
    got = semantic.metric_query(semantic.FAULT_MODEL, faults, ["total_faults", "high_frustration_faults"], ["vehicle_vin"])
    assert rows(got) == [("v1", 2, 1), ("v2", 0, 0)]
    assert rows(semantic.metric_query(semantic.FAULT_MODEL, faults, ["total_faults"])) == [(2,)]
    with pytest.raises(ValueError):
        semantic.metric_query(semantic.FAULT_MODEL, faults, ["revenue"])
    terms = spark.createDataFrame([(" Truck",), ("angry customers",), ("weather",)], "term string")
    assert rows(semantic.resolve_terms(terms, semantic.FAULT_MODEL)) == [
        (" Truck", "dimension", "vehicle_vin"), ("angry customers", "metric", "high_frustration_faults"), ("weather", None, None)]
    asked = spark.createDataFrame([(1, "Which vehicles have the most critical errors?"), (2, "xyz")], "request_id int, question string")
    matched = {r["request_id"]: r["verified_query"] for r in semantic.match_verified(asked).collect()}
    assert matched == {1: "Critical Dealership Issues", 2: None}
    gold = spark.createDataFrame([("v1", 7), ("v2", None), ("v3", 9)], "vin_reference string, total_critical_errors long")
    stored = {"worst": semantic.StoredQuery("Which vehicles have the most critical errors?",
                                            "SELECT * FROM {gold} WHERE total_critical_errors IS NULL OR total_critical_errors > :least", ("gold",), {"least": 7}),
              "secret": semantic.StoredQuery("Who owns them?", "SELECT * FROM {owners}", ("owners",))}
    asked = asked.union(spark.createDataFrame([(3, "Who owns this?"), (4, None)], asked.schema))
    answered = semantic.run_verified(asked, stored, {"gold": gold})
    assert sorted(((r["request_id"], r["verified_query"], r["answer"]) for r in answered.collect()), key=repr) == [
        (1, "worst", '{"vin_reference":"v2","total_critical_errors":null}'), (1, "worst", '{"vin_reference":"v3","total_critical_errors":9}'),
        (2, None, None), (3, "secret", None), (4, None, None)]
    assert {r["answer"] for r in semantic.run_verified(asked, stored, {}).collect()} == {None}
    cases = spark.createDataFrame([("C1", ["Catalyst", "Efficiency", "Bank 1"])], "case_id string, expected_keywords array<string>")
    answers = spark.createDataFrame([("C1", "catalyst efficiency low")], "case_id string, answer string")
    assert rows(semantic.keyword_coverage(answers, cases)) == [("C1", 2, 3, round(2 / 3, 6))]
    worst = ranking.most_frustrating(faults.fillna("f3", ["fault_id"]), k=1)
    assert worst.first()["fault_id"] == "f1"


def test_tracked_write(spark, tmp_path):
    for n in (3, 5):
        layout.tracked_write(spark.range(n), str(tmp_path / "t"), str(tmp_path / "h"), "fleet.ml", f"write {n}")
    got = spark.read.parquet(str(tmp_path / "h"))
    assert rows(got.select("query_text", "query_tag", "rows_written")) == [("write 3", "fleet.ml", 3), ("write 5", "fleet.ml", 5)]
    assert got.filter("elapsed_ms >= 0 and start_time is not null").count() == 2 and spark.read.parquet(str(tmp_path / "t")).count() == 5


HISTORY_JOB = """
import sys
from datetime import date
from pathlib import Path
sys.path.insert(0, {root!r})
from fleet_engine.session import get_session, tagged
spark = get_session("history", "local[2]", event_log={log!r}, conf={{"spark.ui.showConsoleProgress": "false"}})
with tagged(spark, "fleet.api", "count some rows"):
    spark.range(1000).repartition(2).count()
spark.range(10).count()
spark.stop()
"""


def test_job_history(spark, tmp_path):
    subprocess.run([sys.executable, "-c", HISTORY_JOB.format(root=str(ROOT), log=str(tmp_path))], check=True, timeout=120, capture_output=True)
    history = layout.query_history(spark, str(tmp_path))
    tagged = history.filter("query_tag = 'fleet.api'")
    assert tagged.count() >= 1 and history.filter("query_tag is null").count() >= 1
    assert tagged.first()["query_text"] == "count some rows" and tagged.first()["elapsed_ms"] >= 0
    now = history.agg(F.date_format(F.max("start_time") + F.expr("interval 1 hour"), "yyyy-MM-dd HH:mm:ss")).first()[0]
    top = ranking.top_queries(history, now, "fleet.", 5)
    assert {r["query_tag"] for r in top.collect()} == {"fleet.api"}
