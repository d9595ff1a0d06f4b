"""Ranked lexical search with hashed max-sketches.

An index row holds, beside a document's terms and their counts, a sketch: one byte per coordinate, the largest count of any term that hashes there.
For one document an impact only grows with the count, so the sketch holds the coordinatewise maxima of the document's impacts in a form that needs no
corpus statistics, and later documents leave earlier rows valid. A search looks a batch of queries up in the sketches: weight times sketched impact,
summed over a query's terms, is at least the document's score. Documents are then scored exactly in descending order of that bound until it
falls below the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleet_engine.llm.common import text_chunks
from fleet_engine.workspace import drop_folder, staged

WIDTH = 8                  # coordinates per distinct term, at least; rounded up to a power of two
FULL = 255                 # a sketched count that stands for all from here on
QUERY_BYTES = 1 << 20      # texts of the queries looked up in one pass
CELLS = 1 << 22            # bounds and lookups held at once
K1, B = 1000, 75           # fixed values of the scoring rule, as are the numbers in it
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


def _finish(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def term_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of every term: a maximal run of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased.

    In UTF-8 such a run is a run of bytes, so whole texts are read byte by byte without decoding.
    """
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\0".join(coded) + b"\0", np.uint8)
    word = _WORD[data]
    at = np.flatnonzero(word)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.ones(len(at), bool)
    first[1:] = np.diff(at) > 1
    begin = np.flatnonzero(first)
    place = (np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))).astype(np.uint64)
    with np.errstate(over="ignore"):
        letters = _finish((_LOWER[data[at]] + np.uint64(1)) * _STEP ^ _finish(place + np.uint64(1)))
        hashes = _finish(np.add.reduceat(letters, begin))
    return np.searchsorted(np.cumsum([len(c) + 1 for c in coded]), at[begin], side="right"), hashes


def _distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, count) in the order of both."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    begin = np.flatnonzero(new)
    return owner[begin], hashes[begin], np.diff(np.append(begin, len(owner)))


def _widths(n: np.ndarray, width: int) -> np.ndarray:
    return 1 << np.ceil(np.log2(np.maximum(1, n * width))).astype(np.int64)


def _pieces(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    """A binary value for each stretch of ``values``."""
    size = values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer((begins * size).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, n_terms, terms, counts, sketch) of every row with at least one term; meant to be written once and read by many searches.

    Runs where the document is, over its whole text. NULL and empty texts and texts without a term have no row.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("_text"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, "_text"):
            owner, hashes = term_hashes(texts)
            total = np.bincount(owner, minlength=len(texts))
            rows = np.flatnonzero(total)
            if not len(rows):
                continue
            doc, term, count = _distinct(owner, hashes)
            sizes = np.bincount(doc, minlength=len(texts))[rows]
            begins = np.concatenate([[0], np.cumsum(sizes)])
            wide = _widths(sizes, width)
            ends = np.concatenate([[0], np.cumsum(wide)])
            sketch = np.zeros(ends[-1], np.uint8)
            which = np.repeat(np.arange(len(rows)), sizes)
            np.maximum.at(sketch, ends[which] + (term & (wide[which] - 1).astype(np.uint64)).astype(np.int64), np.minimum(count, FULL).astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows)), pa.array(total[rows].astype(np.int64)), _pieces(term, begins), _pieces(count.astype(np.int32), begins), _pieces(sketch, ends)],
                ["doc_id", "n_terms", "terms", "counts", "sketch"])

    return source.mapInArrow(index, "doc_id bigint, n_terms bigint, terms binary, counts binary, sketch binary")


def _flat(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column one after the other, and where each row begins."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype), np.concatenate([[0], np.cumsum([len(r) // np.dtype(dtype).itemsize for r in rows])]).astype(np.int64)


@dataclass
class _Batch:
    """Queries that are looked up together: sorted distinct term hashes, and per query its terms with their repeats (CSR)."""

    terms: np.ndarray
    begins: np.ndarray
    term: np.ndarray
    repeats: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> _Batch:
        query, hashes, repeats = _distinct(*term_hashes(texts))
        terms, place = np.unique(hashes, return_inverse=True)
        return cls(terms, np.searchsorted(query, np.arange(len(texts) + 1)), place, repeats)

    def matrix(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.terms), len(self.begins) - 1), np.float64)
        out[self.term, np.repeat(np.arange(len(self.begins) - 1), np.diff(self.begins))] = weights[self.term] * self.repeats
        return out


def document_frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Documents that hold each of the (sorted) term hashes."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, total = shared.value, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            held = _flat(batch.column(0), np.uint64)[0]
            place = np.minimum(np.searchsorted(asked, held), len(asked) - 1)
            total += np.bincount(place[asked[place] == held], minlength=len(asked))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "df"])

    found = index.select("terms").mapInArrow(count, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toPandas()   # a row per query term
    out = np.zeros(len(terms), np.int64)
    out[found["term"].to_numpy(np.int64)] = found["df"].to_numpy(np.int64)
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (K1 * tf + 8 * m)


class _Best:
    """The best ``k`` (score descending, id ascending, NULL ids last) per query while documents arrive."""

    def __init__(self, n_queries: int, k: int):
        self.k, self.floor = k, np.ones(n_queries, np.int64)       # only scores above 0 count
        self.query = self.score = self.id = np.zeros(0, np.int64)
        self.unnamed = np.zeros(0, bool)

    def offer(self, query: np.ndarray, score: np.ndarray, id: np.ndarray, unnamed: np.ndarray) -> None:
        good = score >= self.floor[query]
        query, score, id, unnamed = (np.concatenate([old, new[good]]) for old, new in zip((self.query, self.score, self.id, self.unnamed), (query, score, id, unnamed)))
        order = np.lexsort((id, unnamed, -score, query))
        query = query[order]
        first = np.ones(len(query), bool)
        first[1:] = query[1:] != query[:-1]
        place = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0)) if len(query) else query
        keep = order[place < self.k]
        self.query, self.score, self.id, self.unnamed = query[place < self.k], score[keep], id[keep], unnamed[keep]
        last = place[place < self.k] == self.k - 1
        self.floor[self.query[last]] = self.score[last]


class _Slice:
    """Some index rows: their sketches for bounds, their terms for exact scores."""

    def __init__(self, rows: pa.RecordBatch, n_docs: int, n_all: int):
        n = rows.column(1).to_numpy(zero_copy_only=False)
        self.m = 100 - B + (B * n * n_docs) // n_all
        self.terms, self.begins = _flat(rows.column(2), np.uint64)
        self.counts, _ = _flat(rows.column(3), np.int32)
        self.sketch, self.ends = _flat(rows.column(4), np.uint8)

    def bounds(self, batch: _Batch, matrix: np.ndarray) -> np.ndarray:
        """(document, query) upper bounds of the scores; sums of whole numbers below 2^53, so exact."""
        mask = (np.diff(self.ends) - 1).astype(np.uint64)
        held = self.sketch[self.ends[:-1, None] + (batch.terms[None, :] & mask[:, None]).astype(np.int64)]
        levels = np.arange(FULL + 1, dtype=np.int64)[None, :]
        table = impact(levels, self.m[:, None]).astype(np.float64)
        table[:, FULL] = 1_000_000                       # no impact is larger
        return np.take_along_axis(table, held.astype(np.int64), axis=1) @ matrix

    def exact(self, doc: np.ndarray, query: np.ndarray, batch: _Batch, weights: np.ndarray) -> np.ndarray:
        """Scores of (document, query) pairs: each query term is looked up in the document's sorted terms."""
        size = np.diff(batch.begins)[query]
        pair = np.repeat(np.arange(len(doc)), size)
        place = np.repeat(batch.begins[query], size) + np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        asked, owner = batch.terms[batch.term[place]], doc[pair]
        low, high = self.begins[owner].copy(), self.begins[owner + 1].copy()
        stop = high.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            less = (self.terms[np.minimum(middle, len(self.terms) - 1)] < asked) & (low < high)
            low, high = np.where(less, middle + 1, low), np.where(less, high, np.minimum(middle, high))
        spot = np.minimum(low, len(self.terms) - 1)
        hit = (low < stop) & (self.terms[spot] == asked)
        owner, place = owner[hit], place[hit]
        part = weights[batch.term[place]] * batch.repeats[place] * impact(self.counts[spot[hit]].astype(np.int64), self.m[owner])
        out = np.zeros(len(doc), np.int64)
        np.add.at(out, pair[hit], part)
        return out


def _search_task(batch: _Batch, weights: np.ndarray, n_docs: int, n_all: int, k: int):
    """Best ``k`` per query among the documents of a task."""
    matrix = batch.matrix(weights)
    n_queries = len(batch.begins) - 1
    step = max(1, CELLS // max(1, len(batch.terms) + n_queries))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, looked, scored = _Best(n_queries, k), 0, 0
        for rows in batches:
            for part in (rows.slice(i, step) for i in range(0, rows.num_rows, step)):
                docs = _Slice(part, n_docs, n_all)
                ids, unnamed = part.column(0).fill_null(0).to_numpy(zero_copy_only=False), part.column(0).is_null().to_numpy(zero_copy_only=False)
                bound = docs.bounds(batch, matrix)
                looked += bound.size
                doc, query = np.nonzero(bound >= best.floor[None, :])
                value = bound[doc, query]
                order = np.lexsort((-value, query))
                doc, query, value = doc[order], query[order], value[order]
                take = k
                while len(doc):
                    first = np.ones(len(query), bool)
                    first[1:] = query[1:] != query[:-1]
                    place = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
                    now = place < take
                    best.offer(query[now], docs.exact(doc[now], query[now], batch, weights), ids[doc[now]], unnamed[doc[now]])
                    scored += int(now.sum())
                    rest = ~now & (value >= best.floor[query])
                    doc, query, value, take = doc[rest], query[rest], value[rest], 2 * take
        counted = pa.array([looked] + [0] * (len(best.query) - 1), pa.int64()) if len(best.query) else pa.array([], pa.int64())
        exact = pa.array([scored] + [0] * (len(best.query) - 1), pa.int64()) if len(best.query) else pa.array([], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(best.query.astype(np.int32)), pa.array(best.id, mask=best.unnamed), pa.array(best.score), counted, exact],
                                         ["query", "doc_id", "score", "looked", "scored"])

    return search


def _blocks(queries: DataFrame, id_col: str, text_col: str, query_bytes: int) -> Iterator[DataFrame]:
    """The queries in blocks of about ``query_bytes``, each collected and sent out on its own."""
    asked = queries.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint") + 64), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-size // query_bytes))
    for i in range(n):
        yield asked if n == 1 else asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)


def ranked_search(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text",
                  query_bytes: int = QUERY_BYTES, with_work: bool = False) -> DataFrame:
    """(item_id, rank, doc_id, score): the best ``k`` documents of each query row with a score above 0, equal scores by ascending doc_id.

    The score is the integer BM25 of the contract: weight floor(1000 ln((2N+2)/(2df+1))) times (10^9 tf) div (1000 tf + 8 m), summed over the query's
    terms with their repeats. Queries that are NULL or hold no term, and an empty index, give no rows. Rows with a NULL doc_id rank after others
    of their score; repeated documents and repeated queries count each on their own. ``index`` is a written ``build_index``; it is read once
    for its sizes, and twice per block of queries. ``with_work`` adds how many pairs had their bound looked up and how many were scored exactly.
    """
    spark = index.sparkSession
    totals = index.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    kind, out = queries.schema[id_col].dataType, []
    for block in _blocks(queries, id_col, text_col, query_bytes):
        rows = block.collect()                                  # about ``query_bytes``
        batch = _Batch.of([r["text"] for r in rows])
        if not len(batch.terms) or not totals["n"]:
            continue
        weights = term_weights(document_frequencies(index, batch.terms), totals["n"])
        task = _search_task(batch, weights, totals["n"], totals["l"], k)
        found, _ = staged(index.mapInArrow(task, "query int, doc_id bigint, score bigint, looked bigint, scored bigint"), "lexical-hits")
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"query int, item_id {kind.simpleString()}")
        best = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())))
        work: list[Column] = []
        if with_work:
            done = found.agg(F.sum("looked").alias("a"), F.sum("scored").alias("b")).first()
            work = [F.lit(done["a"]).alias("looked"), F.lit(done["b"]).alias("scored")]
        out.append(best.filter(F.col("rank") <= k).join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score", *work))
    if not out:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint" + ", looked bigint, scored bigint" * with_work)
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def lexical_search(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Index ``docs`` (doc_id, text), search it, and drop the index."""
    index, path = staged(build_index(docs), "lexical-index")
    found, _ = staged(ranked_search(index, queries, k), "lexical-best")
    drop_folder(docs.sparkSession, path)
    return found
