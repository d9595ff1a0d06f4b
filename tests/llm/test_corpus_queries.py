"""The registered corpus queries next to their SQL, and the pipeline stage by stage."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT / "tests"), str(ROOT / "tools")]
from conftest import SF_DIR  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
import corpus_pipeline  # noqa: E402
from fleet_engine.workspace import stage  # noqa: E402

NAMES = [n for n in entry.queries() if n.startswith("op")]
NATIVE = ("op1_", "op3_", "op10_")


def test_all_operators_are_registered():
    assert [int(n[2:].split("_")[0]) for n in NAMES] == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name.startswith(NATIVE):
        assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan
    if name in entry.oracle_sql():
        assert check.compare(df, check.connect(SF_DIR), entry.oracle_sql()[name]) is None
    else:
        assert df.count() > 0


def test_pipeline_stages(spark):
    """Each stage on what the one before kept: rows only go, texts only lose lines, and no stage undoes another."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    seen = [{r.doc_id: r.text for r in docs.collect()}]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = stage(apply(spark, docs, SF_DIR), "test")
        assert docs.columns == corpus_pipeline.COLUMNS
        seen.append({r.doc_id: r.text for r in docs.collect()})
        assert docs.count() == len(seen[-1])
    good, lines, single, clean = seen[1:]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert all(len(t.split()) >= 50 for t in good.values()) and sum(labels.get(i) == 0 for i in good) <= 1
    assert sum(i not in good for i, q in labels.items() if q == 1 and len(seen[0][i].split()) >= 50) <= 2
    assert set(lines) == set(good) and all(set(lines[i].split("\n")) <= set(good[i].split("\n")) for i in lines)
    assert set(single) < set(lines) and all(single[i] == lines[i] for i in single) and len(set(single.values())) == len(single)
    assert set(clean) == {i for i, t in single.items() if not any(b in t for b in bench)} and set(clean) < set(single)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == set(clean)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, SF_DIR).collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)
