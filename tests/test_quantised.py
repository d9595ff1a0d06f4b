"""Search by codes against exact search."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleet_engine.operators import quantised, vectors


@pytest.fixture(scope="module")
def clustered(spark):
    rnd = np.random.default_rng(1)
    middle = rnd.normal(size=(12, 16)) * 6
    data = [(i, (middle[i % 12] + rnd.normal(size=16)).tolist()) for i in range(600)]
    return spark.createDataFrame([*data, (600, data[0][1]), (601, data[0][1])], "item_id long, embedding array<double>")


def test_short_list_finds_most_and_distances_are_exact(spark, clustered):
    centres = vectors.fit_cells(clustered, 6)
    indexed = vectors.assign_cells(clustered, centres)
    book = quantised.fit_codes(indexed, centres, 8, 32)
    coded = quantised.encode_cells(indexed, book)
    assert coded.count() == 602 and coded.agg(F.max(F.length("code"))).first()[0] == 8
    asked = clustered.filter("item_id % 20 = 0").withColumnRenamed("item_id", "query_id")
    exact = {(q, i): d for q, i, d, _ in rows(vectors.vector_topk(asked, clustered, 10))}
    found = {(q, i): d for q, i, d, _ in rows(quantised.quantised_topk(asked, clustered, coded, book, 10, short=60, probes=3))}
    blocks = rows(quantised.quantised_topk(asked, clustered, coded, book, 10, short=60, probes=3, broadcast_bytes=0, block_rows=50))
    assert len(found) == 310 and {(q, i): d for q, i, d, _ in blocks} == found
    assert sum(p in exact for p in found) >= 0.9 * len(exact) and all(exact[p] == found[p] for p in found if p in exact)
    first = [r for r in rows(quantised.quantised_topk(asked, clustered, coded, book, 3, short=20, probes=1)) if r[0] == 0]
    assert first == [(0, 0, 0.0, 1), (0, 600, 0.0, 2), (0, 601, 0.0, 3)]


def test_empty_corpus(spark, clustered):
    centres = vectors.fit_cells(clustered, 4)
    none = vectors.assign_cells(clustered.limit(0), centres)
    book = quantised.fit_codes(none, centres, 4)
    coded = quantised.encode_cells(none, book)
    asked = clustered.limit(2).withColumnRenamed("item_id", "query_id")
    assert coded.count() == 0 and quantised.quantised_topk(asked, clustered.limit(0), coded, book, 5).count() == 0
