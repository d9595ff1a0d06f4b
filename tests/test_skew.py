"""Balanced joins and groupings give the rows of the plain ones."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleet_engine.operators import aggregates, skew


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(7)
    keys = ["hot"] * 400 + [None] * 100 + [f"k{rng.randrange(60)}" for _ in range(700)]
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k string")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(40)], "k string, v int")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(facts, dim, how):
    want = rows(facts.join(dim, "k", how).select("id", "k", "v"))
    assert rows(skew.salted_join(facts, dim, "k", "id", how=how, min_rows=50).select("id", "k", "v")) == want
    assert rows(skew.salted_join(facts, dim, "k", "id", how=how).select("id", "k", "v")) == want
    assert rows(skew.dim_join(facts, dim, "k", "id", how, max_rows=0).select("id", "k", "v")) == want


def test_hot_rows_are_spread(facts, spark):
    hot = skew.hot_keys(skew.key_counts(facts, "k"), "k", min_rows=50)
    assert hot == ["hot"]
    joined = skew.salted_join(facts, spark.createDataFrame([("hot", 1)], "k string, v int").hint("merge"), "k", "id", min_rows=50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        used = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in used) == 400 and max(r["count"] for r in used) < 250


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_frequent_join(facts, limit):
    one = facts.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("v"))
    want = rows(facts.join(one, "k").select("id", "k", "v"))
    assert rows(skew.frequent_join(facts, one, "k", "n", share=0.02, broadcast_bytes=limit).select("id", "k", "v")) == want


def test_pages_are_whole_and_bounded(facts):
    paged = skew.with_page(facts, "k", "id", 50)
    assert rows(paged.select("id", "k")) == rows(facts)
    sizes = {(r["k"], r["page"]): r["count"] for r in paged.groupBy("k", "page").count().collect()}
    assert len([p for k, p in sizes if k == "hot"]) == 8 and max(sizes.values()) < 100
    assert len([p for k, p in sizes if k is None]) == 2


def test_history_pages_hold_everything(spark):
    silver = spark.createDataFrame([(i, "v", f"s{i}" if i % 3 else None, "A" if i % 2 else "B") for i in range(90)],
                                   "event_id long, vin_reference string, log_summary string, fault_category string")
    whole = aggregates.gold_history(silver).collect()
    assert len(whole) == 1 and whole[0]["full_vehicle_history_summaries"] == [f"s{i}" for i in range(90) if i % 3]
    assert whole[0]["fault_categories_distinct"] == ["A", "B"] and len(whole[0]["distinct_fault_categories"]) == 90
    pages = aggregates.gold_history(silver, page_rows=20).collect()
    assert len(pages) == 5
    assert sorted(s for p in pages for s in p["full_vehicle_history_summaries"]) == sorted(f"s{i}" for i in range(90) if i % 3)
    in_order = [s for p in sorted(pages, key=lambda p: p["page"]) for s in p["full_vehicle_history_summaries"]]
    assert in_order == [f"s{i}" for i in range(90) if i % 3]
    context = aggregates.gold_context(aggregates.gold_history(silver)).first()["context"]
    assert context.startswith("Vehicle v history: s1 | s2 | s4")
