"""Search of many queries in a corpus by comparing blocks, never by making a row per pair.

A kernel holds a block of queries, is fed corpus batches and keeps the best ``k`` hits per query. Two ways to run it:

* few queries (counted, and bounded in bytes): every corpus partition gets all of them; the corpus is not shuffled;
* many queries: queries and corpus are cut into blocks of bounded size per key and each pair of blocks is one group. A key
  that holds a third of the rows becomes many groups of the same size as the others.

Both hand on at most ``k`` hits per query and task; a final top-k per query merges them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleet_engine.operators.skew import key_counts, salted_join, topk
from fleet_engine.workspace import stage

BROADCAST_BYTES = 32 << 20
BLOCK_ROWS = 4096
DECIMALS = 6
DENSE_BLOCKS = 6       # of each side at least: 36 tasks for 12 copies of a row


class Best:
    """The best ``k`` (score ascending, then id) per query, kept as flat arrays while batches arrive."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.limit = np.full(n_queries, np.inf)      # score of the k-th hit so far
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.id = None

    def offer(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(query):
            return
        ids = np.concatenate([self.id, ids]) if self.id is not None else ids
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        order = np.lexsort((ids, score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.r_[True, query[1:] != query[:-1]]
        position = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
        keep = position < self.k
        self.query, self.score, self.id = query[keep], score[keep], ids[keep]
        full = position[keep] == self.k - 1
        self.limit[self.query[full]] = self.score[full]


def sortable(values: pd.Series) -> np.ndarray:
    """Ids as an array that sorts: numbers as they are, text as fixed-width text."""
    array = values.to_numpy()
    return array.astype(str) if array.dtype == object else array


class VectorKernel:
    """Euclidean distance, rounded; hits farther than ``radius`` are dropped. A column ``_bound`` of the queries is a limit that their k-th distance is known to keep."""

    CELLS = 1 << 21                                  # distances computed at once
    PAIRS = 1 << 17                                  # pairs measured exactly at once
    FIRST = 1024                                     # rows that give queries without a limit their first one

    def __init__(self, queries: pd.DataFrame, k: int, radius: float | None = None):
        self.ids = queries["query_id"].to_numpy()
        self.matrix = np.array(queries["embedding"].tolist(), dtype=np.float64)
        self.radius = np.inf if radius is None else radius
        self.best = Best(len(queries), k)
        if "_bound" in queries:
            self.best.limit = queries["_bound"].fillna(np.inf).to_numpy(dtype=np.float64, copy=True)

    def feed(self, corpus: pd.DataFrame) -> None:
        rows = np.array(corpus["embedding"].tolist(), dtype=np.float64)
        ids = sortable(corpus["item_id"])
        finite = np.isfinite(rows).all(axis=1) if rows.ndim == 2 else np.zeros(len(rows), bool)
        if not finite.all():                         # no distance to them is a number
            rows, ids = rows[finite], ids[finite]
        start, size = 0, self.FIRST if np.isinf(np.minimum(self.best.limit, self.radius)).any() else len(rows)
        while start < len(rows):
            self._feed(rows[start:start + size], ids[start:start + size])
            start, size = start + size, 8 * size

    def _feed(self, rows: np.ndarray, ids: np.ndarray) -> None:
        # the products of single precision only select; what they leave is measured exactly. Moved to their middle, vectors are short and lose fewer digits
        middle = rows.mean(axis=0)
        moved = rows - middle
        square = (moved ** 2).sum(axis=1)
        step = max(1, self.CELLS // len(rows))
        found = []
        for start in range(0, len(self.ids), step):
            part = slice(start, start + step)
            asked = self.matrix[part] - middle
            own = (asked ** 2).sum(axis=1)
            short = max(square.max(), own[np.isfinite(own)].max(initial=0.0)) < 1e30
            near = self._near(asked, own, moved, square, part, np.float32 if short else np.float64)
            if short and np.count_nonzero(near) > near.size // 4 and len(rows) > 4 * self.best.k:
                near = self._near(asked, own, moved, square, part, np.float64)
            q, c = np.nonzero(near)
            for at in range(0, len(q), self.PAIRS):
                one, other = q[at:at + self.PAIRS] + start, c[at:at + self.PAIRS]
                exact = np.round(np.sqrt(((self.matrix[one] - rows[other]) ** 2).sum(axis=1)), DECIMALS)
                good = (exact < self.radius) & (exact <= self.best.limit[one])
                found.append((one[good], exact[good], ids[other[good]]))
            if sum(len(f[0]) for f in found) > self.CELLS:
                self._offer(found)
                found = []
        self._offer(found)

    def _near(self, asked: np.ndarray, own: np.ndarray, moved: np.ndarray, square: np.ndarray, part: slice, kind: type) -> np.ndarray:
        """Flags of the pairs whose distance may be within the limit: the square of a distance is ``own - 2 * gain``, up to ``error``."""
        gain = asked.astype(kind) @ moved.astype(kind).T
        gain -= (square / 2).astype(kind)
        error = np.finfo(kind).eps * (64 + moved.shape[1]) * (own + square.max())
        limit = np.minimum(self.best.limit[part], self.radius) + 1e-5
        if np.isinf(limit).any() and len(moved) > self.best.k:
            at = len(moved) - self.best.k
            kth = own - 2 * np.partition(gain, at, axis=1)[:, at].astype(np.float64)
            limit = np.minimum(limit, np.sqrt(np.maximum(kth + error, 0.0)) + 1e-5)
        floor = (own - limit ** 2 - error) / 2
        return gain >= np.nextafter(floor.astype(kind), kind(-np.inf))[:, None]

    def _offer(self, found: list) -> None:
        if found:
            self.best.offer(*(np.concatenate(x) for x in zip(*found)))


class SubstringKernel:
    """Corpus texts that contain the query text; both sides are lower case already. The first ids win."""

    HITS = 1 << 20                                   # hits held before they are cut to the best

    def __init__(self, queries: pd.DataFrame, k: int):
        import ahocorasick

        self.ids = queries["query_id"].to_numpy()
        self.best = Best(len(queries), k)
        holders: dict[str, list[int]] = {}
        for i, pattern in enumerate(queries["pattern"]):
            holders.setdefault(pattern, []).append(i)
        self.always = holders.pop("", [])
        self.machine = ahocorasick.Automaton()
        for pattern, positions in holders.items():
            self.machine.add_word(pattern, positions)
        self.searchable = bool(holders)
        if self.searchable:
            self.machine.make_automaton()

    def feed(self, corpus: pd.DataFrame) -> None:
        ids = sortable(corpus["item_id"])
        query, rows = [], []
        for row, text in enumerate(corpus["text"]):
            found = set(self.always)
            if self.searchable:
                for _, positions in self.machine.iter(text):
                    found.update(positions)
            query.extend(found)
            rows.extend([row] * len(found))
            if len(query) > self.HITS:
                self._flush(query, ids, rows)
                query, rows = [], []
        self._flush(query, ids, rows)

    def _flush(self, query: list[int], ids: np.ndarray, rows: list[int]) -> None:
        self.best.offer(np.array(query, dtype=np.int64), np.zeros(len(query)), ids[np.array(rows, dtype=np.int64)])


Kernel = Callable[[pd.DataFrame], "VectorKernel | SubstringKernel"]


def _hits(kernels: list) -> pd.DataFrame:
    """The hits of all kernels as one frame: with many keys, a frame per key would cost more than the search."""
    found = [k for k in kernels if len(k.best.query)]
    if not found:
        return pd.DataFrame(columns=["query_id", "item_id", "score"])
    return pd.DataFrame({"query_id": np.concatenate([k.ids[k.best.query] for k in found]),
                         "item_id": np.concatenate([k.best.id for k in found]),
                         "score": np.concatenate([k.best.score for k in found])})


def _hit_schema(queries: DataFrame, corpus: DataFrame) -> str:
    kinds = [dict(df.dtypes)[c] for df, c in ((queries, "query_id"), (corpus, "item_id"))]
    return f"query_id {kinds[0]}, item_id {kinds[1]}, score double"


def _scan(corpus: DataFrame, rows: list, columns: list[str], kernel: Kernel, schema: str) -> DataFrame:
    """Feed each corpus partition to the kernels of the keys it meets; the corpus stays where it is."""
    shared = corpus.sparkSession.sparkContext.broadcast(
        {key: part.drop(columns="block_key") for key, part in pd.DataFrame(rows, columns=columns).groupby("block_key")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kernels = {}
        for batch in batches:
            for key, positions in batch.groupby("block_key", sort=False).indices.items():
                if key not in shared.value:
                    continue
                if key not in kernels:
                    kernels[key] = kernel(shared.value[key])
                kernels[key].feed(batch.iloc[positions])
        if kernels:
            yield _hits(list(kernels.values()))

    return corpus.mapInPandas(run, schema)


def _grid(queries: DataFrame, corpus: DataFrame, kernel: Kernel, schema: str, block_rows: int, keyed: bool) -> DataFrame:
    """Cut both sides into blocks per key and run the kernel once per pair of blocks."""
    if keyed:
        counts = {"q": key_counts(queries, "block_key", "_q"), "c": key_counts(corpus, "block_key", "_c")}
        cells = counts["q"].join(counts["c"], "block_key").select(
            "block_key", *[F.ceil(F.col(f"_{s}") / block_rows).cast("int").alias(f"_n{s}") for s in counts])
    else:
        blocks = {s: F.lit(max(1, -(-df.count() // block_rows))) for s, df in (("q", queries), ("c", corpus))}

    def cut(df, row_id, own, other):
        if keyed:
            df = salted_join(df, cells, "block_key", row_id, counts=counts[own], weight=f"_{own}")
        else:
            df = df.withColumns({f"_n{s}": n for s, n in blocks.items()})
        return (df.withColumn(f"_b{own}", F.pmod(F.xxhash64(row_id), F.col(f"_n{own}")).cast("int"))
                .withColumn(f"_b{other}", F.explode(F.sequence(F.lit(0), F.col(f"_n{other}") - 1)))
                .drop("_nq", "_nc"))

    group = ["block_key", "_bq", "_bc"]
    left = cut(queries, "query_id", "q", "c").groupBy(*group)
    right = cut(corpus, "item_id", "c", "q").groupBy(*group)

    def run(some: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if some.empty or rows.empty:
            return pd.DataFrame(columns=["query_id", "item_id", "score"])
        block = kernel(some)
        block.feed(rows)
        return _hits([block])

    return left.cogroup(right).applyInPandas(run, schema)


def dense_search(queries: DataFrame, corpus: DataFrame, kernel: Kernel, k: int, n_queries: int, block_rows: int) -> DataFrame:
    """Best ``k`` corpus rows per query where nearly every pair has to be looked at: ``queries`` (query_id, embedding, _bound), ``corpus`` (item_id, embedding).

    Queries are cut into blocks of at most about ``block_rows`` rows, the corpus into as few parts as give every core work. A task gets a block first and then a
    part, batch by batch: a row is copied once per block or part, a task holds a block and a batch, and hands on ``k`` hits per query.
    """
    blocks = max(DENSE_BLOCKS, -(-n_queries // block_rows))
    parts = max(1, -(-DENSE_BLOCKS ** 2 // blocks))
    kinds = {c: df.schema[c].dataType for df, c in ((queries, "query_id"), (corpus, "item_id"))}

    def to(own, n_own, n_other, scale_own, scale_other):
        place = F.pmod(F.xxhash64(own), F.lit(n_own)).cast("int") * scale_own
        return F.explode(F.transform(F.sequence(F.lit(0), F.lit(n_other - 1)), lambda i: (place + i * scale_other).cast("int"))).alias("_task")

    asked = queries.select("query_id", F.lit(None).cast(kinds["item_id"]).alias("item_id"), "embedding", "_bound", F.lit(0).alias("_side"), to("query_id", blocks, parts, parts, 1))
    rows = corpus.select(F.lit(None).cast(kinds["query_id"]).alias("query_id"), "item_id", "embedding", F.lit(None).cast("double").alias("_bound"), F.lit(1).alias("_side"),
                         to("item_id", parts, blocks, 1, parts))
    dealt = asked.unionByName(rows).repartitionById(blocks * parts, F.col("_task")).sortWithinPartitions("_side").drop("_task")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, block = [], None
        for batch in batches:
            second = (batch["_side"] == 1).to_numpy()
            if not second.all():
                held.append(batch[~second].drop(columns=["item_id", "_side"]))
            if second.any():
                if block is None:
                    if not held:
                        return
                    block, held = kernel(pd.concat(held, ignore_index=True).astype({"query_id": held[0]["query_id"].dtype})), []
                block.feed(batch[second].astype({"item_id": np.int64}) if integral else batch[second])
        if block is not None:
            yield _hits([block])

    integral = kinds["item_id"].simpleString() in ("bigint", "int", "smallint", "tinyint")
    found = dealt.mapInPandas(run, _hit_schema(queries, corpus))
    return topk(found, ["query_id"], [F.col("score"), F.col("item_id")], k)


def block_search(queries: DataFrame, corpus: DataFrame, kernel: Kernel, k: int, row_bytes: Column, keyed: bool = True,
                 broadcast_bytes: int = BROADCAST_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Best ``k`` corpus rows per query. ``queries`` has (query_id, block_key, ...), ``corpus`` (item_id, block_key, ...).

    Without ``keyed`` the key is one constant. ``row_bytes`` measures one query; queries are sent to the executors only when together they fit ``broadcast_bytes``.
    """
    queries, corpus = (df.filter(F.col("block_key").isNotNull()) for df in (queries, corpus))
    queries = stage(queries, "queries")             # measured first, then read again
    schema = _hit_schema(queries, corpus)
    size = queries.agg(F.coalesce(F.sum(row_bytes + F.lit(64)), F.lit(0)).alias("size")).first()["size"]
    if size <= broadcast_bytes:
        if keyed:       # only rows of asked keys leave the JVM; the keys are a part of the queries just measured
            corpus = corpus.join(F.broadcast(queries.select("block_key").distinct()), "block_key", "left_semi")
        found = _scan(corpus, queries.collect(), queries.columns, kernel, schema)
    else:
        found = _grid(queries, corpus, kernel, schema, block_rows, keyed)
    return topk(found, ["query_id"], [F.col("score"), F.col("item_id")], k)
