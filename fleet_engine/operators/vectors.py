"""Vector search: exact, within a distance, and by cells."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleet_engine.operators.blocks import BLOCK_ROWS, BROADCAST_BYTES, VectorKernel, block_search, dense_search
from fleet_engine.operators.skew import topk
from fleet_engine.workspace import stage

PIVOTS = 64            # cells of an exact search without keys
BLOCK_BYTES = 8 << 20  # of the vectors in a block
DENSE_SHARE = 0.25     # of all (query, cell) pairs: with more of them to visit, cells spare too little for a copy of the query each
DENSE_ROWS = 4         # blocks of the usual size that a dense search holds at once


def _keyed(df: DataFrame, id_from: str, id_to: str, key: str | None) -> DataFrame:
    block = F.lit(0) if key is None else F.col(key)
    return df.select(F.col(id_from).alias(id_to), block.alias("block_key"), "embedding")


def _search(queries, corpus, k, radius=None, keyed=True, **sizes) -> DataFrame:
    found = block_search(queries, corpus, partial(VectorKernel, k=k, radius=radius), k, 8 * F.size("embedding"), keyed, **sizes)
    return found.select("query_id", "item_id", F.col("score").alias("distance"), "rank")


def vector_topk(queries: DataFrame, corpus: DataFrame, k: int, key: str | None = None, query_id: str = "query_id",
                item_id: str = "item_id", radius: float | None = None,
                broadcast_bytes: int = BROADCAST_BYTES, block_rows: int | None = None) -> DataFrame:
    """Exact nearest ``k`` by Euclidean distance (6 decimals, ties by id), within the query's ``key`` when one is given.

    Queries whose key is NULL search every corpus row that has a key. Queries without a key that are too large to send to every executor meet the
    corpus by pivots (``pivot_topk``).
    """
    sizes = {"broadcast_bytes": broadcast_bytes, "block_rows": block_rows or _block_rows(queries)}
    asked, rows = _keyed(queries, query_id, "query_id", key), _keyed(corpus, item_id, "item_id", key)
    if key is None:
        return _unkeyed(asked, rows, k, radius, sizes)
    found = _search(asked, rows, k, radius, True, **sizes)
    free = queries.filter(F.col(key).isNull())
    if free.isEmpty():
        return found
    everywhere = _unkeyed(_keyed(free, query_id, "query_id", None), _keyed(corpus.filter(F.col(key).isNotNull()), item_id, "item_id", None), k, radius, sizes)
    return found.unionByName(everywhere)


def _block_rows(queries: DataFrame) -> int:
    """Rows of a block of about ``BLOCK_BYTES``, from the size of the first vector."""
    first = queries.select(F.size("embedding").alias("n")).first()
    return max(64, BLOCK_BYTES // (8 * max(1, first["n"] or 1))) if first else 64


def _unkeyed(queries: DataFrame, corpus: DataFrame, k: int, radius: float | None, sizes: dict) -> DataFrame:
    size = queries.agg(F.coalesce(F.sum(8 * F.size("embedding") + 64), F.lit(0)).alias("n")).first()["n"]
    if size <= sizes["broadcast_bytes"]:
        return _search(queries, corpus, k, radius, False, **sizes)
    return pivot_topk(queries, corpus, k, radius, block_rows=sizes["block_rows"])


def pick_pivots(corpus: DataFrame, pivots: int) -> np.ndarray:
    """The corpus vectors of the smallest id hashes, at most ``pivots``, different ones."""
    rows = corpus.select("embedding").orderBy(F.xxhash64("item_id"), "item_id").limit(pivots).collect()
    return np.unique(np.array([r["embedding"] for r in rows], np.float64), axis=0) if rows else np.zeros((0, 0))


def _cells_of(corpus: DataFrame, centres: np.ndarray) -> DataFrame:
    """(item_id, block_key, embedding, cell_distance): each row in the cell of its nearest centre; no shuffle."""
    shared = corpus.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            to = _to_centres(batch["embedding"], shared.value)
            cell = to.argmin(axis=1)
            yield batch.assign(block_key=cell.astype(np.int32), cell_distance=to[np.arange(len(to)), cell])

    rows = corpus.select("item_id", "embedding")
    return rows.mapInPandas(assign, T.StructType([*rows.schema.fields, T.StructField("block_key", T.IntegerType()), T.StructField("cell_distance", T.DoubleType())]))


def _to_centres(vectors: pd.Series, centres: np.ndarray) -> np.ndarray:
    rows = np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)
    square = (rows ** 2).sum(1)[:, None] + (centres ** 2).sum(1)[None, :] - 2.0 * rows @ centres.T
    return np.sqrt(np.maximum(square, 0.0))


@dataclass
class _Cells:
    """What is known of each cell: its centre, rows, and their smallest and largest distance to it. One entry per centre."""

    centres: np.ndarray
    rows: np.ndarray
    least: np.ndarray
    most: np.ndarray

    @classmethod
    def of(cls, indexed: DataFrame, centres: np.ndarray, cell: str) -> _Cells:
        found = indexed.groupBy(cell).agg(F.count(F.lit(1)).alias("n"), F.min("cell_distance").alias("a"), F.max("cell_distance").alias("b")).collect()
        rows, least, most = np.zeros(len(centres), np.int64), np.full(len(centres), np.inf), np.full(len(centres), -np.inf)
        for r in found:
            rows[r[cell]], least[r[cell]], most[r[cell]] = r["n"], r["a"], r["b"]
        return cls(centres, rows, least, most)

    def first(self, to: np.ndarray, k: int, probes: int) -> np.ndarray:
        """(query, cell) flags of the ``probes`` nearest cells, and as many more as it takes to hold ``k`` rows."""
        order = np.argsort(np.where(self.rows[None, :] > 0, to, np.inf), axis=1, kind="stable")
        before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        chosen = np.zeros(to.shape, bool)
        np.put_along_axis(chosen, order, (before < k) | (np.arange(to.shape[1]) < probes), axis=1)
        return chosen & (self.rows > 0)[None, :]

    def lower(self, to: np.ndarray) -> np.ndarray:
        """No row of a cell is nearer to the query than this: by the cell's ring around its centre, and by the plane between that centre and the query's nearest."""
        ring = np.maximum(to - self.most[None, :], self.least[None, :] - to)
        near = to.argmin(axis=1)
        gap = np.sqrt(np.maximum(((self.centres[near][:, None, :] - self.centres[None, :, :]) ** 2).sum(2), 0.0))
        own = to[np.arange(len(to)), near][:, None]
        plane = np.divide(to ** 2 - own ** 2, 2 * gap, out=np.zeros_like(to), where=gap > 0)
        return np.maximum(np.maximum(ring, plane), 0.0)


def _visits(asked: DataFrame, cells: _Cells, k: int, probes: int, second: bool, count: bool = False) -> DataFrame:
    """(query_id, embedding, block_key): the cells that each query visits first, or (with its ``_bound``) those that it must still visit; with ``count`` how many (n)."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for whole in batches:
            for start in range(0, len(whole), 1024):
                batch = whole.iloc[start:start + 1024]
                to = _to_centres(batch["embedding"], known.centres)
                chosen = known.first(to, k, probes)
                if second:
                    bound = batch["_bound"].fillna(np.inf).to_numpy()[:, None]
                    # distances are rounded to 6 decimals, and the product form of ``to`` loses some digits
                    chosen = ~chosen & (known.rows > 0)[None, :] & (known.lower(to) <= bound + 2e-6 + 1e-6 * to)
                if count:
                    yield pd.DataFrame({"n": [int(chosen.sum())]})
                    continue
                query, cell = np.nonzero(chosen)
                yield pd.DataFrame({"query_id": batch["query_id"].to_numpy()[query], "embedding": batch["embedding"].to_numpy()[query], "block_key": cell.astype(np.int32)})

    schema = T.StructType([asked.schema["query_id"], asked.schema["embedding"], T.StructField("block_key", T.IntegerType())])
    return asked.mapInPandas(visit, "n long" if count else schema)


def _bounded(asked: DataFrame, first: DataFrame, k: int, radius: float | None) -> DataFrame:
    """Queries with ``_bound``, the k-th distance so far or the radius; NULL where there is neither."""
    kth = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("distance")).alias("_kth"))
    bound = F.col("_kth") if radius is None else F.least(F.col("_kth"), F.lit(float(radius)))
    return asked.join(kth, "query_id", "left").withColumn("_bound", bound).drop("_kth")


def pivot_topk(queries: DataFrame, corpus: DataFrame, k: int, radius: float | None = None, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS,
               visited: dict[str, int] | None = None) -> DataFrame:
    """Exact nearest ``k`` of very many queries without a key, as a join by pivots.

    Corpus rows fall into the cells of ``pivots`` of them. A query first visits the cells nearest to it that hold ``k`` rows; its k-th distance there (or
    ``radius``) is a bound, and it then visits only cells that can hold a nearer row. Both visits run block against block within a cell, so a row is
    copied once per block of queries that visit its cell. Where many cells are left to visit (vectors without structure), all pairs are compared under
    that bound instead (``dense_search``). ``visited`` receives how many (query, cell) pairs there were and how many were visited.
    """
    queries = stage(queries.select("query_id", "embedding"), "pivot-queries")
    centres = pick_pivots(corpus, pivots)
    if not len(centres):
        return _search(queries.withColumn("block_key", F.lit(0)), corpus.select("item_id", F.lit(0).alias("block_key"), "embedding"), k, radius, block_rows=block_rows)
    rows = stage(_cells_of(corpus, centres), "pivot-cells")
    cells = _Cells.of(rows, centres, "block_key")
    sizes = {"broadcast_bytes": 0, "block_rows": block_rows}
    near = stage(_visits(queries, cells, k, 1, False), "pivot-first")
    first = stage(_search(near, rows.drop("cell_distance"), k, radius, **sizes), "pivot-found")
    bounded = _bounded(queries, first, k, radius)
    pairs = queries.count() * int((cells.rows > 0).sum())
    still = _visits(bounded, cells, k, 1, True, count=True).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    if visited is not None:
        visited |= {"pairs": pairs, "visited": near.count() + still}
    if still > DENSE_SHARE * pairs:
        found = dense_search(bounded, rows.select("item_id", "embedding"), partial(VectorKernel, k=k, radius=radius), k, queries.count(), DENSE_ROWS * block_rows)
        return found.select("query_id", "item_id", F.col("score").alias("distance"), "rank")
    far = stage(_visits(bounded, cells, k, 1, True), "pivot-second")
    second = _search(far, rows.drop("cell_distance"), k, radius, **sizes)
    return _merge(first, second, k)


def _merge(first: DataFrame, second: DataFrame, k: int) -> DataFrame:
    both = first.unionByName(second).drop("rank")
    return topk(both, ["query_id"], [F.col("distance"), F.col("item_id")], k).select("query_id", "item_id", "distance", "rank")


def vector_within(queries: DataFrame, corpus: DataFrame, radius: float, k: int, **options) -> DataFrame:
    """The nearest ``k`` that are closer than ``radius``."""
    return vector_topk(queries, corpus, k, radius=radius, **options)


def fit_cells(corpus: DataFrame, cells: int, seed: int = 42, max_iter: int = 5) -> np.ndarray:
    """Centres of a k-means partition of the corpus; their number is a parameter, not a share of the data."""
    data = corpus.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return np.array(KMeans(k=cells, seed=seed, maxIter=max_iter).fit(data).clusterCenters())


def _distances(df: DataFrame, centres: np.ndarray) -> DataFrame:
    """Add ``_to``, the distance of each vector to every centre."""
    shared = df.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf("array<double>")
    def to_centres(vectors: pd.Series) -> pd.Series:
        rows, base = np.array(vectors.tolist(), dtype=np.float64), shared.value
        square = (rows ** 2).sum(1)[:, None] + (base ** 2).sum(1)[None, :] - 2.0 * rows @ base.T
        return pd.Series(list(np.sqrt(np.maximum(square, 0.0))))

    return df.withColumn("_to", to_centres("embedding"))


def assign_cells(corpus: DataFrame, centres: np.ndarray) -> DataFrame:
    """Corpus rows with the cell of their nearest centre and the distance to it; no shuffle."""
    near = F.array_min("_to")
    return (_distances(corpus, centres).withColumn("cell", (F.array_position("_to", near) - 1).cast("int"))
            .withColumn("cell_distance", near).drop("_to"))


def ann_topk(queries: DataFrame, indexed: DataFrame, centres: np.ndarray, k: int, probes: int = 4, exact: bool = False,
             query_id: str = "query_id", item_id: str = "item_id",
             broadcast_bytes: int = BROADCAST_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Nearest ``k`` over a corpus indexed by ``assign_cells``: each query visits its ``probes`` nearest cells only (an exact search as many more as hold ``k`` rows).

    With ``exact`` it then visits every further cell that could still hold a nearer row, by its k-th distance so far; cells that it has seen are not
    visited again. Cells are searched in blocks, so a crowded cell is many tasks.
    """
    sizes = {"broadcast_bytes": broadcast_bytes, "block_rows": block_rows}
    asked = queries.select(F.col(query_id).alias("query_id"), "embedding")
    corpus = indexed.select(F.col(item_id).alias("item_id"), F.col("cell").alias("block_key"), "embedding")
    cells = _Cells.of(indexed, centres, "cell")
    first = _search(_visits(asked, cells, k if exact else 0, probes, False), corpus, k, **sizes)
    if not exact:
        return first
    first = stage(first, "ann-first")
    return _merge(first, _search(_visits(_bounded(asked, first, k, None), cells, k, probes, True), corpus, k, **sizes), k)
