"""Searches against brute force, on both ways of running them, with one key that holds a third of the rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleet_engine.operators import fusion, keywords, retrieval, vectors
from fleet_engine.workspace import run_dir, stage

RNG = random.Random(3)


def vector_rows(n, id_from, keys=True):
    gen = np.random.default_rng(id_from)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 17 == 1 else f"k{i % 5}")
        out.append((id_from + i, key, [float(x) for x in np.round(gen.normal(size=6), 1)]))
    return out


@pytest.fixture(scope="module")
def vector_tables(spark):
    q, c = vector_rows(70, 1000), vector_rows(300, 5000)
    c += [(9000 + i, "hot", list(c[0][2])) for i in range(20)]       # exact copies: ties by id
    schema = "{} long, k string, embedding array<float>"
    return q, c, spark.createDataFrame(q, schema.format("query_id")), spark.createDataFrame(c, schema.format("item_id"))


def brute(q, c, k, keyed, radius=math.inf):
    out = []
    for qid, qk, qv in q:
        found = []
        for cid, ck, cv in c:
            if keyed and (ck is None or (qk is not None and ck != qk)):
                continue
            d = round(float(np.sqrt(((np.float32(qv).astype(float) - np.float32(cv).astype(float)) ** 2).sum())), 6)
            if d < radius:
                found.append((d, cid))
        out += [(qid, cid, d, r + 1) for r, (d, cid) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


BOTH = [{}, {"broadcast_bytes": 0, "block_rows": 16}]


@pytest.mark.parametrize("sizes", BOTH)
@pytest.mark.parametrize("keyed", [True, False])
def test_vector_topk(vector_tables, sizes, keyed):
    q, c, queries, corpus = vector_tables
    got = vectors.vector_topk(queries, corpus, 4, key="k" if keyed else None, **sizes)
    assert rows(got) == brute(q, c, 4, keyed)


@pytest.mark.parametrize("sizes", BOTH)
def test_vector_within(vector_tables, sizes):
    q, c, queries, corpus = vector_tables
    assert rows(vectors.vector_within(queries, corpus, 1.5, 3, **sizes)) == brute(q, c, 3, False, 1.5)


def test_grid_makes_no_row_per_pair(vector_tables):
    _, _, queries, corpus = vector_tables
    plan = vectors.vector_topk(queries, corpus, 4, key="k", **BOTH[1])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "FlatMapCoGroups" in plan


def test_pivots_spare_cells_and_copies(spark):
    """Clustered vectors: a query meets few cells, and a corpus row is copied to fewer blocks than a grid of all queries would copy it to."""
    rnd = random.Random(11)
    mids = [[rnd.uniform(-50, 50) for _ in range(5)] for _ in range(20)]
    point = lambda i: [m + rnd.gauss(0, 1) for m in mids[i % 20]]
    c = [(i, None, point(i)) for i in range(800)] + [(900 + i, None, list(mids[0])) for i in range(60)]
    q = [(i, None, point(i)) for i in range(300)] + [(400, None, [1000.0] * 5), (401, None, list(mids[0]))]
    queries, corpus = spark.createDataFrame(q, "query_id long, k string, embedding array<float>"), spark.createDataFrame(c, "item_id long, k string, embedding array<float>")
    work = {}
    got = vectors.pivot_topk(queries, corpus, 4, pivots=30, block_rows=16, visited=work)
    assert rows(got) == brute(q, c, 4, False) and work["visited"] < 0.35 * work["pairs"]
    centres = vectors.pick_pivots(corpus, 30)
    cells = vectors._cells_of(corpus, centres)
    known = vectors._Cells.of(cells, centres, "block_key")
    meets = Counter(r.block_key for r in vectors._visits(queries, known, 4, 1, False).collect())
    copies = sum(-(-meets[r.block_key] // 16) for r in cells.collect()) / len(c)
    assert copies < -(-len(q) // 16) / 3
    assert rows(vectors.pivot_topk(queries, corpus, 3, radius=2.0, pivots=30, block_rows=16)) == brute(q, c, 3, False, 2.0)
    assert vectors.pivot_topk(queries, corpus.limit(0), 4).count() == 0 and vectors.pivot_topk(queries.limit(0), corpus, 4).count() == 0
    assert rows(vectors.pivot_topk(queries, corpus.limit(2), 4)) == brute(q, [(r.item_id, None, r.embedding) for r in corpus.limit(2).collect()], 4, False)


@pytest.mark.parametrize("sizes", BOTH)
def test_ann(vector_tables, sizes):
    q, c, queries, corpus = vector_tables
    centres = vectors.fit_cells(corpus, 8)
    indexed = stage(vectors.assign_cells(corpus, centres), "cells")
    want = brute(q, c, 5, False)
    assert rows(vectors.ann_topk(queries, indexed, centres, 5, probes=1, exact=True, **sizes)) == want
    near = {(r["query_id"], r["item_id"]) for r in vectors.ann_topk(queries, indexed, centres, 5, probes=4, **sizes).collect()}
    recall = len(near & {(a, b) for a, b, _, _ in want}) / len(want)
    assert recall > 0.7
    fewer = vectors.ann_topk(queries, indexed, centres, 400, probes=1).count()
    assert fewer < 70 * 320                                          # one cell per query only


LOGS = [(i, "hot" if i % 3 == 0 else f"k{i % 4}", t) for i, t in enumerate(
    ["Engine 100% hot", "engine cold", "a_b under", "axb", "ENGINE", "", "brake\\pad", "It's \"worn\"", "Öl LEAK", None] * 9)]
PATTERNS = [(1, "hot", "engine"), (2, "k1", "ENGINE"), (3, "hot", "100%"), (4, "k2", "a_b"), (5, "hot", "öl leak"), (6, "hot", "it's"),
            (7, "k3", "\\pad"), (8, "hot", "%"), (9, "k0", "zzz"), (10, "hot", ""), (11, "hot", None), (12, None, "engine"), (13, "hot", "engine")]


@pytest.mark.parametrize("sizes", BOTH)
@pytest.mark.parametrize("keyed", [True, False])
def test_keyword_search(spark, sizes, keyed):
    queries = spark.createDataFrame(PATTERNS, "query_id long, k string, pattern string")
    logs = spark.createDataFrame(LOGS, "item_id long, k string, text string")
    want = []
    for qid, key, pattern in PATTERNS:
        if pattern is not None:
            hits = [i for i, k, t in LOGS if t is not None and (not keyed or k == key) and pattern.lower() in t.lower()]
            want += [(qid, i, r + 1) for r, i in enumerate(sorted(hits)[:2])]
    got = keywords.keyword_search(queries, logs, "k" if keyed else None, 2, **sizes)
    assert rows(got) == sorted(want, key=repr)


def test_like_escape(spark):
    from fleet_engine.functions.text import like_escape

    df = spark.createDataFrame([("50%_a\\b",)], "t string").withColumn("p", F.concat(F.lit("%"), like_escape("t"), F.lit("%")))
    assert df.select(F.expr("'x 50%_a\\\\b' ilike p"), F.expr("'x 50X_a\\\\b' ilike p")).first()[:] == (True, False)


def corpus_texts(n):
    words = [f"w{i}" for i in range(150)]
    weights = [1 / (i + 1) for i in range(150)]
    return [(i, " ".join(RNG.choices(words, weights, k=RNG.randrange(0, 40))), "en" if i % 2 else "de") for i in range(n)]


def bm25(docs, queries, k, keep=lambda d: True):
    toks = {i: [t for t in re.split("[^a-z0-9]+", x.lower()) if t] for i, x, _ in docs}
    toks = {i: t for i, t in toks.items() if t}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    df = Counter(t for ts in toks.values() for t in set(ts))
    out = []
    for qid, text in queries:
        scores = {}
        for i, ts in toks.items():
            tf = Counter(ts)
            s = sum(math.log(1 + (n - df[t] + .5) / (df[t] + .5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (.25 + .75 * len(ts) / avg))
                    for t in set(text.split()) if tf[t])
            if s and keep(i):
                scores[i] = round(s, 6)
        out += [(qid, i, s, r + 1) for r, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("direct", [10 ** 9, 0])
def test_bm25(spark, direct):
    docs = corpus_texts(250)
    queries = [(q, " ".join(f"w{int(RNG.paretovariate(0.6)) % 150}" for _ in range(RNG.randrange(1, 12)))) for q in range(40)] + [(99, "nothing"), (98, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    postings = stage(keywords.bm25_index(df, "doc_id", "text"), "postings")
    got = keywords.bm25_topk(postings, spark.createDataFrame(queries, "query_id long, text string"), 5, direct_hits=direct)
    assert rows(got) == bm25(docs, queries, 5)


def test_search_service_filters_attributes(spark):
    docs = corpus_texts(120)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    queries = [(1, "w3 w10 w0"), (2, "w50")]
    path = run_dir(spark, "service")
    service = retrieval.search_service(df, "doc_id", "text", ("lang",), path)
    asked = spark.createDataFrame(queries, "query_id long, text string")
    assert rows(service.search(asked, 4)) == bm25(docs, queries, 4)
    german = {i for i, _, lang in docs if lang == "de"}
    again = retrieval.open_search(spark, path, ("lang",))
    assert rows(again.search(asked, 4, {"lang": "de"})) == bm25(docs, queries, 4, lambda d: d in german)
    with pytest.raises(ValueError):
        again.search(asked, 4, {"vin": "x"})


def test_fusion(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "query_id int, item_id string, rank int")
    b = spark.createDataFrame([(1, "y", 1), (1, "z", 2)], "query_id int, item_id string, rank int")
    got = fusion.rrf([a, b], 2).collect()
    assert [(r["item_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [("y", round(1 / 61 + 1 / 62, 6)), ("x", round(1 / 61, 6))]
    queries = spark.createDataFrame([(1,), (2,)], "query_id int")
    vec = spark.createDataFrame([(1, "manual", 0.18)], "query_id int, content string, distance double")
    key = spark.createDataFrame([(1, "log")], "query_id int, content string")
    found = {r["query_id"]: r for r in fusion.hybrid_search(queries, vec, key).collect()}
    assert found[1]["search_confidence"] == round(0.7 * 0.82 + 0.3 * 0.9, 6) and found[1]["sources"] == ["manual", "log"]
    assert found[2]["search_confidence"] == 0.35 and found[2]["sources"] == []
    assert found[2]["context"] == "Manual Context: Fallback: Check sensor. | Log Context: No log match"


def test_long_vectors_keep_their_near_neighbours():
    """Vectors of norm 8,000 with copies a millionth apart: the product form alone cannot tell them apart."""
    import numpy as np
    import pandas as pd

    from fleet_engine.operators.blocks import VectorKernel

    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 64)) * 1000
    corpus = np.concatenate([base + rng.normal(size=base.shape) * 1e-6 for _ in range(5)])
    ids = np.arange(len(corpus))
    kernel = VectorKernel(pd.DataFrame({"query_id": np.arange(60), "embedding": list(base)}), 1)
    kernel.feed(pd.DataFrame({"item_id": ids, "embedding": list(corpus)}))
    exact = np.array([np.sqrt(((corpus - q) ** 2).sum(axis=1)).min() for q in base])
    assert np.allclose(kernel.best.limit, exact, atol=2e-6)


def test_words_are_counted_in_slices_of_bounded_size():
    import pyarrow as pa

    lists = [["a"] * 3, None, [], ["b"] * 9, ["c", "d"], ["e"]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(lists, pa.list_(pa.string()))], ["doc_id", "_w"])
    cut = list(keywords.word_slices(iter([batch, batch.slice(3), batch.slice(0, 0)]), 4))
    assert [c.column(0).to_pylist() for c in cut] == [[0, 1, 2], [3], [4, 5], [3], [4, 5]]
    assert [x for c in cut[:3] for x in c.column(1).to_pylist()] == lists


def test_vectors_without_structure_are_not_copied_per_cell(spark, monkeypatch):
    """Where pivots spare little, a vector is copied once per block, however many cells its query would visit."""
    gen = np.random.default_rng(8)
    c = [(i, None, [float(x) for x in gen.normal(size=24)]) for i in range(400)]
    q = [(i, None, v) for i, _, v in c[::2]]
    queries, corpus = spark.createDataFrame(q, "query_id long, k string, embedding array<float>"), spark.createDataFrame(c, "item_id long, k string, embedding array<float>")
    copied = []
    plain = vectors.stage
    monkeypatch.setattr(vectors, "stage", lambda df, name: copied.append((name, (out := plain(df, name)).count())) or out)
    got = vectors.pivot_topk(queries, corpus, 4, pivots=30, block_rows=16)
    assert rows(got) == brute(q, c, 4, False)
    assert sum(n for name, n in copied if name in ("pivot-first", "pivot-second")) <= 2 * len(q)
    assert rows(vectors.pivot_topk(queries, corpus, 4, radius=5.0, pivots=30, block_rows=16)) == brute(q, c, 4, False, 5.0)


def test_kernel_far_from_the_origin_and_beyond_single_precision():
    import pandas as pd

    from fleet_engine.operators.blocks import VectorKernel

    rng = np.random.default_rng(6)
    for shift, scale in ((1e6, 1.0), (0.0, 1e18), (0.0, 1e-8)):
        corpus = rng.normal(size=(3000, 8)) * scale + shift
        corpus[5] = np.nan
        asked = corpus[:40:2]
        kernel = VectorKernel(pd.DataFrame({"query_id": np.arange(20), "embedding": list(asked)}), 3)
        kernel.feed(pd.DataFrame({"item_id": np.arange(3000), "embedding": list(corpus)}))
        want = np.round(np.sqrt(((np.delete(corpus, 5, 0)[None] - asked[:, None]) ** 2).sum(2)), 6)
        assert np.array_equal(kernel.best.limit, np.sort(want, axis=1)[:, 2])


def test_only_texts_that_were_found_are_shuffled(spark):
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(300)] + [(None, "x"), (4, "again")], "item_id long, content string")
    hits = spark.createDataFrame([("a", 4), ("b", 4), ("c", 200), ("d", 999)], "query_id string, item_id long")
    got = retrieval._with_content(hits, texts)
    assert rows(got.select("query_id", "item_id", "content")) == rows(hits.join(texts, "item_id").select("query_id", "item_id", "content"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
