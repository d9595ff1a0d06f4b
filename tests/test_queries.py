"""Every registered query against its SQL on the smallest tables, and what their plans must not hold."""

import sys

import pytest
from conftest import ROOT, SF_DIR

sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).count() == 5
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLE:
        assert check.compare(df, con, ORACLE[name]) is None
    else:
        assert df.count() > 0


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "b9_recent")
    assert "GreaterThan(ts," in plan and "text" not in plan
    gold = plan_of(spark, "f1_gold_errors")
    assert "props" not in gold and "log_text" not in gold and "documents" not in gold


def test_limits_are_pushed_below_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(spark, "g3_topk_per_key") and "WindowGroupLimit" in plan_of(spark, "b8_dedupe")
    assert "TakeOrderedAndProject" in plan_of(spark, "g2_top_vehicles")


def test_row_scores_need_no_shuffle(spark):
    from fleet_engine.operators import enrich

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for scored in (enrich.sentiment(docs, "doc_id", "text"), enrich.classify_keywords(docs, "doc_id", "text"),
                   enrich.extract_answer(docs, "doc_id", "text", "which part")):
        assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
