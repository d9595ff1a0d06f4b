"""Texts that are scored once and texts that stay in their buckets."""

import uuid

import pytest
from conftest import SF_DIR, rows

from fleet_engine.operators import enrich, skew
from fleet_engine.operators.scorestore import score_once, stored_scores
from fleet_engine.sources.bucketed import join_texts, write_texts


def test_each_text_is_scored_once(spark, tmp_path):
    store = str(tmp_path / "scores")
    first = spark.createDataFrame([(1, "good brake"), (2, "good brake"), (3, None), (4, ""), (None, "bad leak")], "id long, text string")
    second = spark.createDataFrame([(5, "good brake"), (6, "poor"), (6, "poor"), (7, None)], "id long, text string")
    given = []

    def score(df, id, text):
        given.append(sorted(r[id] for r in df.collect()))
        return enrich.sentiment(df, id, text)

    for batch in (first, second):
        assert rows(score_once(batch, "id", "text", score, store)) == rows(enrich.sentiment(batch, "id", "text"))
    assert [len(g) for g in given] == [4, 1] and stored_scores(spark, store).count() == 5
    assert score_once(first.limit(0), "id", "text", score, store).count() == 0 and given[-1] == []


def test_scored_once_on_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = score_once(docs, "doc_id", "text", enrich.sentiment, str(tmp_path / "scores"))
    assert rows(got) == rows(enrich.sentiment(docs, "doc_id", "text"))
    assert stored_scores(spark, str(tmp_path / "scores")).count() == docs.select("text").distinct().count() < docs.count()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_texts_are_not_shuffled(spark, no_broadcast):
    texts = spark.createDataFrame([(i, f"text {i}", i * 2) for i in range(50)] + [(None, "lost", 0)], "id long, text string, more int")
    table = f"texts_{uuid.uuid4().hex}"
    write_texts(texts, table, "id", 8)
    facts = spark.createDataFrame([(k, k % 60) for k in range(200)] + [(999, None)], "fact long, id long")
    joined = join_texts(spark, facts, table, "id", "fact", ["text"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and "more" not in plan
    assert rows(joined.select("fact", "id", "text")) == rows(facts.join(texts, "id").select("fact", "id", "text"))
    spark.sql(f"DROP TABLE {table}")


def test_hot_ids_do_not_meet_in_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(skew.hot_keys, "__defaults__", ("n_rows", 100))
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "id long, text string")
    table = f"texts_{uuid.uuid4().hex}"
    write_texts(texts, table, "id", 8)
    facts = spark.createDataFrame([(k, 3 if k % 3 else k % 25) for k in range(300)], "fact long, id long")
    joined = join_texts(spark, facts, table, "id", "fact")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "EqualTo(id,3)" in plan
    assert rows(joined.select("fact", "id", "text")) == rows(facts.join(texts, "id").select("fact", "id", "text"))
    spark.sql(f"DROP TABLE {table}")
