"""Sources, cleaning and documents."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleet_engine.operators import aggregates, clean, documents
from fleet_engine.sources import events, tables, uploads
from fleet_engine.workspace import broadcast_bounded, fits, run_dir, spread, stage

# Two feeds with whole, broken and negative numbers, a sentinel, and codes that the readers must tell apart.
TRUCKS = [{"vin": "truck-7", "engine_temp_c": 71.25, "error_code": "B1000", "cloud_source": "AWS_S3"},
          {"vin": "truck-8", "engine_temp_c": "ERROR", "error_code": "B1000", "cloud_source": "AWS_S3"},
          {"vin": "truck-9", "engine_temp_c": -12, "error_code": "NONE", "cloud_source": "AWS_S3"},
          {"vin": "truck-7", "engine_temp_c": 249, "error_code": "C0040", "cloud_source": "AWS_S3"}]
VANS = [{"vin": "van-1", "engine_temp_c": 301, "error_code": "C0040", "cloud_source": "AZURE_BLOB"},
        {"vin": "van-2", "engine_temp_c": -3.5, "error_code": "B1201", "cloud_source": "AZURE_BLOB"}]


def test_event_files_to_silver(spark, tmp_path):
    for name, feed in (("trucks.json", TRUCKS), ("vans.json", VANS)):
        (tmp_path / name).write_text(json.dumps(feed, indent=1))
    (tmp_path / "readme.md").write_text("not an event file")
    raw = events.read_events(spark, str(tmp_path))
    assert raw.count() == len(TRUCKS + VANS)
    cleaned = clean.clean_sentinel(raw, "engine_temp_c", out="engine_temp").withColumn("log_text", F.lit(None).cast("string"))
    assert rows(cleaned.select("vin", "engine_temp")) == sorted(
        [(e["vin"], -999.0 if e["engine_temp_c"] == "ERROR" else float(e["engine_temp_c"])) for e in TRUCKS + VANS], key=repr)
    kept = clean.silver_telemetry(cleaned)          # neither the sentinel, nor code NONE, nor a temperature out of bounds
    assert [r[0] for r in rows(kept.select("vin_reference"))] == ["truck-7", "truck-7", "van-2"]


def test_sentinel_strict_and_lenient(spark):
    df = spark.createDataFrame([("ERROR",), ("7.5",), ("hot",)], "t string")
    assert rows(clean.clean_sentinel(df, "t")) == sorted([(-999.0,), (7.5,), (None,)], key=repr)
    with pytest.raises(Exception, match="not a number"):
        clean.clean_sentinel(df, "t", strict=True).collect()


def test_filters_and_gold(diagnostics):
    assert diagnostics.count() == 5
    assert clean.filter_key(diagnostics, "vin", "VIN_AWS_001").count() == 2
    assert rows(clean.critical_temp(diagnostics).select("vin", "engine_temp")) == [("VIN_AZURE_002", 125.0)]
    assert clean.filter_key(clean.has_error(diagnostics), "vin", "VIN_AZURE_002").count() == 1
    gold = aggregates.gold_errors(clean.silver_telemetry(diagnostics))
    found = {r[0]: tuple(r)[1:] for r in gold.collect()}
    assert found["VIN_AWS_001"] == (2, 101.2) and found["VIN_AZURE_002"] == (1, 125.0)


def test_null_codes_are_dropped_and_bounds_are_inclusive(spark):
    df = spark.createDataFrame([("a", None, 1.0, "x"), ("b", "NONE", 1.0, "x"), ("c", "P1", -50.0, "x"), ("d", "P1", 250.0, "x"),
                                ("e", "P1", 250.1, "x")], "vin string, error_code string, engine_temp double, log_text string")
    assert [r[0] for r in rows(clean.silver_telemetry(df).select("vin_reference"))] == ["c", "d"]


def test_optional_filter_drops_null_keys(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(clean.optional_eq(df, "k")) == [("a",)]
    assert rows(clean.optional_eq(df, "k", "b")) == []


def test_fault_id_is_null_when_a_part_is(diagnostics):
    faults = clean.with_fault_id(diagnostics.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz")))
    assert faults.filter(F.col("fault_id").isNull()).count() == 1
    assert faults.select("fault_id").distinct().count() == 5


def test_mask_tail_keeps_short_values(spark):
    from fleet_engine.functions.text import mask_tail

    df = spark.createDataFrame([("VIN_AWS_001",), ("AB",), (None,)], "v string")
    assert rows(df.select(mask_tail("v"))) == sorted([("***-***-_001",), ("***-***-AB",), (None,)], key=repr)


def test_union_of_feeds_fills_missing_columns(spark):
    a, b = spark.createDataFrame([("v1", 1)], "vin string, t int"), spark.createDataFrame([("v2",)], "vin string")
    assert rows(events.union_sources({"A": a, "B": b})) == [("v1", 1, "A"), ("v2", None, "B")]


def test_append_and_read_back(spark, diagnostics, tmp_path):
    path = str(tmp_path / "t")
    tables.materialize(diagnostics, "t_append", "table", "append", path)
    assert tables.materialize(diagnostics, "t_append", "table", "append", path).count() == 10
    assert tables.materialize(diagnostics, "v_diag", "view").count() == 5
    with pytest.raises(ValueError):
        tables.materialize(diagnostics, "x", "cube")


def upload(key, size):
    return ([((("docs",), (key, size)),)],)


def upload_df(spark, *notes):
    return spark.createDataFrame([([(((("docs",), (k, s))),)],) for k, s in notes], uploads.UPLOAD_SCHEMA)


def test_upload_validation(spark):
    df = upload_df(spark, ("incoming/manual.pdf", 1048576), ("incoming/virus.exe", 1024), ("incoming/massive_manual.pdf", 104857600),
                   ("incoming/VIN9_a+b%20c.PDF", 52428800), ("incoming/.pdf", 10), ("incoming/100%25_50%.pdf", None))
    ok, rejects = uploads.validate_uploads(df)
    good = {r["key"]: r for r in ok.collect()}
    assert good["incoming/manual.pdf"]["size_mb"] == 1.0 and good["incoming/manual.pdf"]["extension"] == ".pdf"
    assert good["incoming/manual.pdf"]["filename"] == "manual.pdf"
    assert good["incoming/VIN9_a b c.PDF"]["size_mb"] == 50.0                # exactly the limit passes
    reasons = {r["key"]: r["reason"] for r in rejects.collect()}
    assert "unsupported extension" in reasons["incoming/virus.exe"]
    assert "exceeds 50MB limit" in reasons["incoming/massive_manual.pdf"]
    assert "unsupported extension" in reasons["incoming/.pdf"]
    assert rows(uploads.ingest_summary(ok, rejects)) == [(3, 3, 6)]
    queue = uploads.register_uploads(ok, "2024-01-31 00:00:00")
    assert {r["filename"]: r["vin_reference"] for r in queue.collect()}["manual.pdf"] == "UNKNOWN"
    assert {r["filename"]: r["vin_reference"] for r in queue.collect()}["VIN9_a b c.PDF"] == "VIN9"
    assert clean.pending_files(queue).count() == 3


def test_vin_from_filename_with_and_without_default(spark):
    from fleet_engine.functions.text import vin_from_filename

    df = spark.createDataFrame([("a/VIN123_engine_manual.pdf",), ("b/manual.pdf",)], "p string")
    assert [r[0] for r in df.select(vin_from_filename("p")).collect()] == ["VIN123", "manual.pdf"]
    assert [r[0] for r in df.select(vin_from_filename("p", "UNKNOWN")).collect()] == ["VIN123", "UNKNOWN"]


def test_chunking_text_and_html(spark):
    df = spark.createDataFrame([(1, "Chapter 1\r\n\n  Oil.  \nEnd", "<html><style>p{x}</style><!-- no --><p>A &amp; B<br>C <b>d</b></p>"
                                 "<script>var t='</p>'</script><div>E</div></html>"), (2, "", ""), (3, None, None)],
                               "id int, t string, h string")
    assert rows(documents.chunk_documents(df, "id", "t")) == [(1, 0, "Chapter 1"), (1, 1, "Oil."), (1, 2, "End")]
    html = documents.chunk_documents(df, "id", "h", "html")
    assert rows(html) == [(1, 0, "A & B"), (1, 1, "C d"), (1, 2, "E")]
    with pytest.raises(ValueError):
        documents.chunk_documents(df, "id", "t", "pdf")


def test_queue_run_isolates_failures(spark):
    queue = spark.createDataFrame([("1", "a.pdf", "V1", "PENDING"), ("2", "b.pdf", "V2", "PENDING"), ("3", "c.pdf", "V3", "PENDING"),
                                   ("4", "a.pdf", "V1", "COMPLETED")], "ingestion_id string, filename string, vin_reference string, status string")
    files = spark.createDataFrame([("a.pdf", "one\ntwo"), ("b.pdf", " \n ")], "filename string, content string")
    chunks, status, report = documents.process_pending(queue, files, "2024-01-31 00:00:00")
    assert rows(chunks.select("source_file", "chunk_index", "chunk_text")) == [("a.pdf", 0, "one"), ("a.pdf", 1, "two")]
    assert rows(status.drop("processed_at")) == [("1", "COMPLETED", None), ("2", "FAILED", "no text in file"), ("3", "FAILED", "file not found")]
    assert rows(report) == [(1, 2)]
    log = queue.select("ingestion_id", "status", F.lit(None).cast("string").alias("error_message"), F.lit(0).alias("seq")).unionByName(
        status.drop("processed_at").withColumn("seq", F.lit(1)))
    assert {r[0]: r[1] for r in documents.latest_status(log).collect()} == {"1": "COMPLETED", "2": "FAILED", "3": "FAILED", "4": "COMPLETED"}


def test_run_log_round_trip(spark, tmp_path):
    run = {"experiment_id": "EXP_002", "timestamp": "2024-03-08 10:30:00.5", "vin": "VIN_AWS_003",
           "metrics": {"tokens": 83, "latency_total": 1.4, "confidence": 0.799}}
    (tmp_path / "r1.json").write_text(json.dumps(run, indent=2))
    (tmp_path / "r2.json").write_text(json.dumps({**run, "metrics": {"tokens": 17, "latency_total": 1.0, "confidence": 0.799}}, indent=2))
    pretty = tables.read_runs(spark, str(tmp_path), multi_line=True)
    assert rows(aggregates.run_metrics(pretty)) == [("EXP_002", 2, 100, 1.2, 0.799)]
    tables.append_runs(pretty, str(tmp_path / "out"))
    tables.append_runs(pretty, str(tmp_path / "out"))
    assert tables.read_runs(spark, str(tmp_path / "out")).count() == 4


def test_list_files_reads_no_content(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "VIN1_a.pdf").write_bytes(b"12345")
    (tmp_path / "b.txt").write_bytes(b"1")
    listed = tables.list_files(spark, str(tmp_path), ".pdf")
    assert rows(listed.select("filename", "size_bytes")) == [("VIN1_a.pdf", 5)]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_response_cache_splits_distinct_prompts(spark):
    asked = spark.createDataFrame([("a",), ("a",), ("b",)], "prompt string")
    cache = asked.limit(1).select(F.sha2("prompt", 256).alias("prompt_hash"), F.lit("A").alias("response"))
    todo, known = tables.with_response_cache(asked, cache)
    assert rows(todo.select("prompt")) == [("b",)] and rows(known.select("prompt", "response")) == [("a", "A")]


def test_workspace(spark):
    assert run_dir(spark, "x") != run_dir(spark, "x")
    assert rows(stage(spark.range(3), "r")) == [(0,), (1,), (2,)]
    assert "broadcast" in broadcast_bounded(spark.range(3), 3)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in broadcast_bounded(spark.range(4), 3)._jdf.queryExecution().analyzed().toString().lower()
    long = spark.createDataFrame([(1, "x" * 5000, ["y" * 100]), (2, None, None)], "id int, text string, words array<string>")
    assert fits(long, 2) and not fits(long, 2, 5000) and not fits(long, 1) and fits(long.filter("id = 2"), 2, 5000) and fits(long.limit(0), 0, 0)
    big = spark.range(0, 100, 1, 64)
    assert spread(big, "id") is big and spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == 8


def test_claims_and_leases(spark, tmp_path):
    """A killed run's files are taken again after the lease; of two runs at once one wins each file; the first result counts."""
    from fleet_engine.operators import workqueue

    log, out = str(tmp_path / "log"), str(tmp_path / "chunks")
    queue = spark.createDataFrame([(f"i{n}", f"f{n}.pdf", "V", "2024-01-01 00:00:00") for n in range(4)], "ingestion_id string, filename string, vin_reference string, received_at string")
    files = spark.createDataFrame([(f"f{n}.pdf", f"line {n}" if n else "") for n in range(3)], "filename string, content string")
    workqueue.enqueue(queue, log, "a")
    workqueue.enqueue(queue, log, "a")                              # repeated registration of the same step
    at = lambda minute: f"2024-01-01 01:{minute:02d}:00"            # noqa: E731
    state = lambda minute: {r.ingestion_id: (r.status, r.claim_id) for r in workqueue.queue_state(workqueue.read_log(spark, log), at(minute)).collect()}
    assert set(state(0).values()) == {("PENDING", None)}
    assert workqueue.claim(spark, log, "killed", at(0), "10 MINUTES").count() == 4
    assert workqueue.claim(spark, log, "late", at(5), "10 MINUTES").count() == 0     # all are claimed
    assert set(state(5).values()) == {("PROCESSING", "killed")} and set(state(11).values()) == {("PENDING", None)}
    workqueue.run_claimed(queue, files, log, out, "second", at(12), "10 MINUTES", at(14))
    assert state(13) == {f"i{n}": ("PROCESSING", "second") for n in range(4)}
    assert state(14) == {"i0": ("FAILED", "second"), "i1": ("COMPLETED", "second"), "i2": ("COMPLETED", "second"), "i3": ("FAILED", "second")}
    # the first owner was only slow: its later result does not count, nor do its chunks
    slow = spark.createDataFrame([("i1", "f1.pdf", "FAILED", "late", "killed", at(20), None)], "ingestion_id string, filename string, status string, error_message string, claim_id string, at string, until string")
    workqueue._put(slow.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("at", "until")}), log, "result-killed")
    assert state(30)["i1"] == ("COMPLETED", "second")
    assert sorted(r.chunk_text for r in workqueue.finished_chunks(spark, log, out, at(30)).collect()) == ["line 1", "line 2"]
    steps = {}
    for r in workqueue.status_history(workqueue.read_log(spark, log)).orderBy("step").collect():
        steps.setdefault(r.ingestion_id, []).append(r.status)
    assert steps["i0"] == ["PENDING", "PROCESSING", "PROCESSING", "FAILED"] and steps["i1"][-2:] == ["COMPLETED", "FAILED"]
    workqueue.run_claimed(queue, files, log, out, "idle", at(40), "10 MINUTES")
    assert state(41) == state(30)


def test_two_claims_at_once_share_nothing(spark, tmp_path):
    """Both runs saw the files waiting and wrote claims: each file belongs to one of them."""
    from fleet_engine.operators import workqueue

    log = str(tmp_path / "log")
    workqueue.enqueue(spark.createDataFrame([(f"i{n}", f"f{n}", "2024-01-01 00:00:00") for n in range(6)], "ingestion_id string, filename string, received_at string"), log, "a")
    waiting = workqueue.queue_state(workqueue.read_log(spark, log), "2024-01-01 01:00:00")
    for name in ("x", "y"):
        at = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
        workqueue._put(waiting.select("ingestion_id", "filename").withColumns(workqueue._row("PROCESSING", at, name, at + F.expr("INTERVAL 5 MINUTES"))), log, f"claim-{name}")
    assert {r.claim_id for r in workqueue.queue_state(workqueue.read_log(spark, log), "2024-01-01 01:01:00").collect()} == {"x"}
