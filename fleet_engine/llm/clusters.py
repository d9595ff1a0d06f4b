"""Centroid clustering with heap-ordered bounds: exact Lloyd rounds that only look again at vectors whose bound gap has expired.

A vector keeps the gap between its lower bound (second nearest centroid) and its upper bound (own centroid). When centroids move, all gaps of
a cluster shrink by the same amount, so that amount is added up once per cluster (its drift) and the stored keys never change. The heap of a
cluster is its rows in key order: each round writes the rows that it scanned as one segment, sorted by (cluster, key) inside each file. Popping
reads the rows of a cluster whose key its drift has passed, a predicate that reaches the Parquet scan, so row groups that hold unexpired keys
alone are not read; pushing writes the rescanned rows as the next segment. Drift only grows, so a row of an older segment is still in force
exactly while its key lies above the drift, and nothing is ever rewritten or deleted row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.workspace import drop_folder, staged

DIMS, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
LARGEST = 1 << 27      # integers beyond this are clamped: a squared distance of 64 such components still fits a long
SLACK = 1e-3           # covers the rounding of bounds of any such vectors; ties always expire
STEP = 4096            # vectors compared with the centroids at once


@dataclass
class Clusters:
    """``rows``: (id, cluster, distance) of each kept vector. ``centroids``: k lists of integers. ``scanned``: vectors compared in each assignment, if asked for."""

    rows: DataFrame
    centroids: list[list[int]]
    scanned: list[int]


@dataclass
class _Segment:
    rows: DataFrame
    path: str


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(_id, v array<int>) of the vectors with exactly ``dims`` components, none NULL or non-finite, as integers floor(scale * x)."""
    x = F.col(vector_col).cast("array<double>")
    usable = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int"))
    return vectors.select(F.col(id_col).alias("_id"), F.col(vector_col)).filter(F.coalesce(usable, F.lit(False))).select("_id", whole.alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``seed`` and their id; a NULL id counts as empty text, equal ids go by their components."""
    order = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in kept.orderBy(order, "v").limit(k).select("v").collect()]


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (int64) between integer rows. The product runs in floating point only where every sum is a whole number below 2^53."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if x.shape[1] * largest * largest < 1 << 51:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def _scanner(centroids: list[list[int]], drift: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compare rows (_id, v, old) with all centroids; equal distances go to the smaller number."""
    base = np.array(centroids, np.int64)
    names = ["_id", "v", "old", "cluster", "key"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, STEP) for i in range(0, batch.num_rows, STEP)):
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, -1)
                d = squared_distances(x, base)
                near = d.argmin(axis=1)
                at = np.arange(len(d))
                upper = np.sqrt(d[at, near])
                rest = d.astype(np.float64)
                rest[at, near] = np.inf
                key = np.sqrt(rest.min(axis=1)) - upper + drift[near]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near.astype(np.int32)), pa.array(key)], names)

    return scan


def _write(rows: DataFrame, centroids: list[list[int]], drift: np.ndarray, id_type: str) -> _Segment:
    scanned = rows.mapInArrow(_scanner(centroids, drift), f"_id {id_type}, v array<int>, old int, cluster int, key double")
    return _Segment(*staged(scanned.sortWithinPartitions("cluster", "key"), "cluster-heaps"))


def _between(low: np.ndarray | None, high: np.ndarray | None) -> str:
    """Rows whose key lies above ``low`` and at or below ``high`` of their cluster, as a predicate that the Parquet reader understands."""
    limits = [f"(cluster = {c}" + (f" AND key > {float(low[c]) + SLACK!r}D" if low is not None else "") + (f" AND key <= {float(high[c]) + SLACK!r}D)" if high is not None else ")")
              for c in range(len(high if low is None else low))]
    return " OR ".join(limits)


def _popped(segment: _Segment, before: np.ndarray | None, now: np.ndarray) -> DataFrame:
    """Rows of the heaps in ``segment`` whose key the drift ``now`` has passed and that were in force until now (``before`` had not passed it)."""
    return segment.rows.filter(_between(before, now)).selectExpr("_id", "v", "cluster AS old")


def _move(segment: _Segment, sums: list[list[int]], counts: list[int], dims: int) -> None:
    """Take the segment's rows out of their old clusters' sums and into their new ones'; a row per cluster reaches the driver."""
    sides = "array(named_struct('c', cluster, 's', 1L), named_struct('c', old, 's', -1L))"
    moved = segment.rows.filter("old IS NULL OR old <> cluster").selectExpr("v", f"explode(filter({sides}, e -> e.c IS NOT NULL)) AS e")
    totals = [F.expr(f"sum(e.s * v[{i}]) AS s{i}") for i in range(dims)]
    for r in moved.groupBy(F.expr("e.c").alias("c")).agg(F.expr("sum(e.s) AS n"), *totals).collect():
        counts[r["c"]] += r["n"]
        sums[r["c"]] = [s + r[f"s{i}"] for i, s in enumerate(sums[r["c"]])]


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, k: int = CENTROIDS,
                    rounds: int = ROUNDS, scale: int = SCALE, seed: str = "2:", count_scans: bool = False) -> Clusters:
    """Lloyd rounds over all whole vectors, exact in integers, then one more assignment.

    Vectors of another length, with a NULL or a non-finite component, or NULL themselves, are left out; components beyond 2^27 after scaling are
    clamped. Each round assigns every vector to its nearest centroid (squared Euclidean distance, ties to the smaller number) and replaces each
    centroid that has vectors by the floor of their mean; a centroid without vectors stays. Fewer vectors than ``k`` give as many centroids;
    an empty table gives no rows. Repeated rows and ids are vectors of their own. Sums are 64-bit: 6 * 10^10 vectors at the clamp.
    """
    spark = vectors.sparkSession
    kept = whole_vectors(vectors, id_col, vector_col, dims, scale)
    id_type = kept.schema["_id"].dataType.simpleString()
    centroids = first_centroids(kept, k, seed)
    if not centroids:
        empty = kept.limit(0).select(F.col("_id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return Clusters(empty, [], [])
    k = len(centroids)
    sums, counts, drift = [[0] * dims for _ in range(k)], [0] * k, np.zeros(k)
    before = drift
    segments = [_write(kept.withColumn("old", F.lit(None).cast("int")), centroids, drift, id_type)]
    for _ in range(rounds):
        _move(segments[-1], sums, counts, dims)
        after = [[s // n for s in total] if n else old for total, n, old in zip(sums, counts, centroids)]
        step = np.sqrt(np.array([sum((a - b) ** 2 for a, b in zip(x, y)) for x, y in zip(after, centroids)], np.float64))
        others = np.array([max([step[j] for j in range(k) if j != c], default=0.0) for c in range(k)])
        centroids, drift = after, drift + step + others
        # a row of the newest segment has met no drift but this one; older rows were in force if the last drift left them
        popped = [_popped(s, None if s is segments[-1] else before, drift) for s in segments]
        segments.append(_write(reduce(DataFrame.union, popped), centroids, drift, id_type))
        before = drift
    scanned = [s.rows.count() for s in segments] if count_scans else []
    live = reduce(DataFrame.union, [(s.rows if s is segments[-1] else s.rows.filter(_between(drift, None))).select("_id", "v", "cluster") for s in segments])
    base = spark.createDataFrame([(c, v) for c, v in enumerate(centroids)], "cluster int, _at array<int>")    # k rows
    distance = F.expr("aggregate(zip_with(v, _at, (a, b) -> (bigint(a) - b) * (bigint(a) - b)), 0L, (a, b) -> a + b)")
    rows, _ = staged(live.join(F.broadcast(base), "cluster").select(F.col("_id").alias(id_col), "cluster", distance.alias("distance")), "clusters")
    for segment in segments:
        drop_folder(spark, segment.path)
    return Clusters(rows, centroids, scanned)


def with_inertia(found: Clusters) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256): distances summed over the cluster and over all, and a digest of the centroid."""
    spark = found.rows.sparkSession
    within = {r["cluster"]: r["d"] for r in found.rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    facts = spark.createDataFrame([(c, within.get(c, 0), sum(within.values()), digests[c]) for c in range(len(digests))],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.rows.join(F.broadcast(facts), "cluster").select(*found.rows.columns, "cluster_inertia", "inertia", "centroid_sha256")
