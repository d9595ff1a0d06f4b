"""Approximate vector search over short codes: residuals in their cells, cut into parts, each part the number of a code word; exact distances for a short list."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleet_engine.operators.blocks import BLOCK_ROWS, BROADCAST_BYTES, DECIMALS, Best, block_search, sortable
from fleet_engine.operators.skew import salted_join, topk
from fleet_engine.operators.vectors import _Cells, _visits
from fleet_engine.workspace import stage

SAMPLE_ROWS = 10_000   # vectors that the code words are fitted on; every vector is indexed
ROUNDS = 8


def _nearest(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words ** 2).sum(1)[None, :] - 2.0 * rows @ words.T).argmin(axis=1)


@dataclass
class CodeBook:
    """Centres of the cells and, for each part of a residual, its code words."""

    centres: np.ndarray
    words: list[np.ndarray]

    def parts(self, residuals: np.ndarray) -> list[np.ndarray]:
        return np.array_split(residuals, len(self.words), axis=1)

    def encode(self, residuals: np.ndarray) -> np.ndarray:
        """(row, part) numbers of the nearest code words."""
        return np.stack([_nearest(part, words) for part, words in zip(self.parts(residuals), self.words)], axis=1).astype(np.uint8)

    def tables(self, residuals: np.ndarray) -> np.ndarray:
        """(row, part, word) squared distances from the part of a query's residual to each code word."""
        most = max(len(words) for words in self.words)
        out = np.zeros((len(residuals), len(self.words), most))
        for p, (part, words) in enumerate(zip(self.parts(residuals), self.words)):
            out[:, p, :len(words)] = ((part[:, None, :] - words[None, :, :]) ** 2).sum(2)
        return out


def fit_codes(indexed: DataFrame, centres: np.ndarray, parts: int, words: int = 64, item_id: str = "item_id", sample_rows: int = SAMPLE_ROWS) -> CodeBook:
    """Code words (at most 256 a part) from the ``sample_rows`` rows of ``assign_cells`` with the smallest id hashes. The same rows give the same words."""
    if not 1 <= words <= 256:
        raise ValueError("a code word's number is one byte")
    rows = indexed.orderBy(F.xxhash64(item_id), item_id).select("cell", "embedding").limit(sample_rows).collect()
    if not rows:
        return CodeBook(centres, [np.zeros((1, len(part))) for part in np.array_split(np.zeros(centres.shape[1]), parts)])
    residuals = np.array([r["embedding"] for r in rows], np.float64) - centres[[r["cell"] for r in rows]]
    found = []
    for part in np.array_split(residuals, parts, axis=1):
        book = np.unique(part[:words], axis=0)
        for _ in range(ROUNDS):
            near = _nearest(part, book)
            held = np.bincount(near, minlength=len(book))
            sums = np.zeros_like(book)
            np.add.at(sums, near, part)
            book = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], book)
        found.append(book)
    return CodeBook(centres, found)


def encode_cells(indexed: DataFrame, book: CodeBook, item_id: str = "item_id") -> DataFrame:
    """(item_id, cell, cell_distance, code): a byte per part instead of the vector; no shuffle."""
    shared = indexed.sparkSession.sparkContext.broadcast(book)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            rows = np.array(batch["embedding"].tolist(), np.float64).reshape(len(batch), -1)
            codes = known.encode(rows - known.centres[batch["cell"].to_numpy()]) if len(batch) else np.zeros((0, 1), np.uint8)
            yield batch.drop(columns="embedding").assign(code=[c.tobytes() for c in codes])

    rows = indexed.select(F.col(item_id).alias("item_id"), "cell", "cell_distance", "embedding")
    return rows.mapInPandas(encode, T.StructType([*(f for f in rows.schema.fields if f.name != "embedding"), T.StructField("code", T.BinaryType())]))


class CodeKernel:
    """Squared distance as far as the codes tell it: a sum of table entries per row."""

    CELLS = 1 << 21

    def __init__(self, queries: pd.DataFrame, book: CodeBook, k: int):
        self.ids = queries["query_id"].to_numpy()
        self.tables = book.tables(np.array(queries["embedding"].tolist(), np.float64))
        self.best = Best(len(queries), k)

    def feed(self, corpus: pd.DataFrame) -> None:
        codes = np.frombuffer(b"".join(corpus["code"]), np.uint8).reshape(len(corpus), -1)
        ids = sortable(corpus["item_id"])
        step = max(1, self.CELLS // max(1, len(codes)))
        for start in range(0, len(self.ids), step):
            table = self.tables[start:start + step]
            about = np.zeros((len(table), len(codes)))
            for p in range(codes.shape[1]):
                about += table[:, p, :][:, codes[:, p]]
            bound = self.best.limit[start:start + step]
            if len(codes) > self.best.k:
                bound = np.minimum(bound, np.partition(about, self.best.k - 1, axis=1)[:, self.best.k - 1])
            q, c = np.nonzero(about <= bound[:, None])
            self.best.offer(q + start, about[q, c], ids[c])


def short_list(queries: DataFrame, coded: DataFrame, book: CodeBook, short: int, probes: int,
               broadcast_bytes: int = BROADCAST_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, item_id): the ``short`` rows nearest to each query by their codes, in its ``probes`` nearest cells."""
    cells = _Cells.of(coded, book.centres, "cell")
    seen = _visits(queries.select("query_id", "embedding"), cells, 0, probes, False)
    centres = F.array(*[F.lit([float(x) for x in c]) for c in book.centres])
    residual = F.zip_with(F.col("embedding").cast("array<double>"), F.get(centres, F.col("block_key")), lambda x, c: x - c)
    asked = seen.withColumn("embedding", residual)
    corpus = coded.select("item_id", F.col("cell").alias("block_key"), "code")
    return block_search(asked, corpus, partial(CodeKernel, book=book, k=short), short, 8 * F.size("embedding"), True,
                        broadcast_bytes=broadcast_bytes, block_rows=block_rows).select("query_id", "item_id")


def quantised_topk(queries: DataFrame, corpus: DataFrame, coded: DataFrame, book: CodeBook, k: int, short: int = 100, probes: int = 4,
                   query_id: str = "query_id", item_id: str = "item_id", **sizes) -> DataFrame:
    """Nearest ``k`` by exact distance (6 decimals, ties by id) among the short list that the codes give.

    Codes alone are searched; of full vectors a query meets ``short``, which are joined by id, an item on very many lists in many tasks. Cells are searched in blocks, so a
    crowded cell is many tasks.
    """
    asked = stage(queries.select(F.col(query_id).alias("query_id"), "embedding"), "code-queries")
    near = stage(short_list(asked, coded, book, max(k, short), probes, **sizes), "short-lists")
    vectors = corpus.select(F.col(item_id).alias("item_id"), F.col("embedding").alias("_there"))
    pairs = salted_join(salted_join(near, vectors, "item_id", "query_id"), asked, "query_id", "item_id")
    square = F.aggregate(F.zip_with("embedding", "_there", lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda a, x: a + x)
    measured = pairs.select("query_id", "item_id", F.round(F.sqrt(square), DECIMALS).alias("distance"))
    return topk(measured, ["query_id"], [F.col("distance"), F.col("item_id")], k).select("query_id", "item_id", "distance", "rank")
