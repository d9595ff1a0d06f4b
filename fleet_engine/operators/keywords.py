"""Keyword search: substrings and BM25."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleet_engine.functions.text import explode_each, tokens
from fleet_engine.operators.blocks import BLOCK_ROWS, BROADCAST_BYTES, SubstringKernel, block_search
from fleet_engine.operators.skew import frequent_join, hot_keys, salted_join, topk
from fleet_engine.workspace import stage

K1, B = 1.2, 0.75
SLACK = 1e-5          # scores are compared after rounding to 6 decimals
SEED_SHARE = 0.1
DIRECT_HITS = 1_000_000_000
SLICE_WORDS = 1 << 18 # words counted at once: what a task holds beside its batch does not grow with the texts in it


def keyword_search(queries: DataFrame, logs: DataFrame, key: str | None, k: int = 1, query_id: str = "query_id",
                   item_id: str = "item_id", pattern: str = "pattern", text: str = "text",
                   broadcast_bytes: int = BROADCAST_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The first ``k`` rows per query whose text contains the pattern, whatever the case, within the query's key.

    The pattern is plain text: ``%`` and ``_`` mean themselves. All patterns of a block are looked for in one pass over a text.
    """
    block = F.lit(0) if key is None else F.col(key)
    asked = queries.select(F.col(query_id).alias("query_id"), block.alias("block_key"), F.lower(pattern).alias("pattern"))
    asked, distinct = _once(asked.filter(F.col("pattern").isNotNull() & F.col("block_key").isNotNull()), ["block_key", "pattern"])
    rows = logs.select(F.col(item_id).alias("item_id"), block.alias("block_key"), F.lower(text).alias("text"))
    found = block_search(distinct, rows.filter(F.col("text").isNotNull()), partial(SubstringKernel, k=k), k,
                         4 * F.octet_length("pattern"), key is not None, broadcast_bytes=broadcast_bytes, block_rows=block_rows)
    return _for_all(asked, distinct, found.select("query_id", "item_id", "rank"))


def _once(queries: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Queries with the hash of what they ask, and each question once under its smallest query id: copies are not searched
    again."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    marked = queries.withColumn("_asks", F.sha2(F.concat_ws("\u0001", *parts), 256))
    distinct = marked.groupBy("_asks").agg(F.min("query_id").alias("query_id"), *[F.first(c).alias(c) for c in columns])
    return marked.select("query_id", "_asks"), distinct


def _for_all(asked: DataFrame, distinct: DataFrame, found: DataFrame) -> DataFrame:
    """Give the hits of a question to every query that asks it."""
    hits = found.join(distinct.select("query_id", "_asks"), "query_id").drop("query_id")
    return salted_join(asked, hits, "_asks", "query_id").select("query_id", *[c for c in found.columns if c != "query_id"])


def word_slices(batches: Iterator[pa.RecordBatch], words: int = SLICE_WORDS) -> Iterator[pa.RecordBatch]:
    """The batches, whose last column lists words, in slices of at most ``words`` words; a row with more is a slice of its own."""
    for batch in batches:
        before = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(before, before[start] + words, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def term_counts(docs: DataFrame, id: str, text: str, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Words per document (doc_id, term, tf, doc_len, attributes, lead), counted in the task that holds the document: no shuffle.

    ``doc_id`` is unique in ``docs``. ``lead`` marks one row per document, so lengths need no second pass over the texts.
    """
    words = docs.select(F.col(id).alias("doc_id"), *attributes, tokens(text).alias("_w"))
    kinds = {f.name: f.dataType.simpleString() for f in words.schema.fields}
    names = ["doc_id", "term", "tf", "doc_len", *attributes, "lead"]
    types = {**kinds, "term": "string", "tf": "bigint", "doc_len": "int", "lead": "boolean"}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in word_slices(batches):
            lists = batch.column(batch.num_columns - 1)
            owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            coded = lists.flatten().dictionary_encode()
            n = max(1, len(coded.dictionary))
            pair, tf = np.unique(owner * n + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            row, term = pair // n, pair % n
            lengths = np.bincount(owner, minlength=batch.num_rows).astype(np.int32)
            lead = np.concatenate([np.ones(min(1, len(row)), bool), row[1:] != row[:-1]])
            kept = [batch.column(i).take(pa.array(row)) for i in range(1 + len(attributes))]
            yield pa.RecordBatch.from_arrays([kept[0], coded.dictionary.take(pa.array(term)), pa.array(tf.astype(np.int64)),
                                              pa.array(lengths[row]), *kept[1:], pa.array(lead)], names)

    return words.mapInArrow(count, ", ".join(f"`{c}` {types[c]}" for c in names))


def document_lengths(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("doc_id"), F.size(tokens(text)).alias("doc_len"))


def score_postings(counts: DataFrame, lengths: DataFrame, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Postings (term, doc_id, impact, df, attributes): the finished BM25 share of a term in a document."""
    n = F.count_if(F.col("doc_len") > 0)           # documents without a word are not part of the corpus
    stats = lengths.agg(F.struct(n.alias("n"), F.try_divide(F.sum("doc_len"), n).alias("avg_len"))).scalar()
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    joined = frequent_join(counts, frequency, "term", "df").withColumn("_s", stats)
    idf = F.log(1 + (F.col("_s.n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    share = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("doc_len") / F.col("_s.avg_len")))
    return joined.select("term", "doc_id", (idf * share).alias("impact"), "df", *attributes)


def bm25_index(docs: DataFrame, id: str, text: str, attributes: tuple[str, ...] = ()) -> DataFrame:
    """BM25 postings of a corpus, meant to be written once (``stage``, ``write_index``) and read by many searches. The
    counts are written first, in the one pass over the texts: lengths, document frequencies and the weighting join read them."""
    counts = stage(term_counts(docs, id, text, attributes), "term-counts")
    return score_postings(counts, counts.filter("lead").select("doc_id", "doc_len"), attributes)


def write_index(postings: DataFrame, path: str) -> None:
    """Postings sorted by term and document: a search reads the row groups of its terms, and the list of a frequent term
    spans several files."""
    postings.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id").write.mode("overwrite").parquet(path)


def index_terms(postings: DataFrame) -> DataFrame:
    """Per term: documents and the highest impact; combined before the shuffle."""
    return postings.groupBy("term").agg(F.first("df").alias("df"), F.max("impact").alias("peak"))


def _partial(postings: DataFrame, asked: DataFrame, hot: list) -> DataFrame:
    """Summed impacts per query and document over the query terms in ``asked``."""
    hits = salted_join(postings.select("term", "doc_id", "impact"), asked.select("term", "query_id"), "term", "doc_id", hot=hot)
    return hits.groupBy("query_id", "doc_id").agg(F.sum("impact").alias("score"))


def _kth(scores: DataFrame, k: int) -> DataFrame:
    """Score of the k-th document per query, where there are that many."""
    return (topk(scores, ["query_id"], [F.col("score").desc(), F.col("doc_id")], k, "_rank")
            .filter(F.col("_rank") == k).select("query_id", F.col("score").alias("_kth")))


def bm25_topk(postings: DataFrame, queries: DataFrame, k: int, query_id: str = "query_id", text: str = "text",
              direct_hits: int = DIRECT_HITS) -> DataFrame:
    """Best ``k`` documents per query by BM25 (6 decimals, ties by id); always exact.

    The (query, posting) hits are counted from the document frequencies first. Up to ``direct_hits`` they are simply summed.
    Beyond that the lists of frequent words are not expanded; see ``_pruned_scores``. ``postings`` is read several times and
    should be a written index.
    """
    everyone, distinct = _once(queries.select(F.col(query_id).alias("query_id"), F.col(text).alias("text")), ["text"])
    words = explode_each(distinct, ["query_id"], F.array_distinct(tokens("text")), "term")
    relevant = postings.select("term", "doc_id", "impact", "df").join(words.select("term").distinct(), "term", "left_semi")
    asked = stage(words.join(index_terms(relevant), "term"), "query-terms")      # as small as the queries
    hot = hot_keys(asked.select("term", "df").distinct(), "term", "df")
    hits = asked.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first()["n"]
    scores = _partial(postings, asked, hot) if hits <= direct_hits else _pruned_scores(relevant, asked, k, hot)
    total = scores.select("query_id", "doc_id", F.round("score", 6).alias("score"))
    return _for_all(everyone, distinct, topk(total, ["query_id"], [F.col("score").desc(), F.col("doc_id")], k))


def _pruned_scores(relevant: DataFrame, asked: DataFrame, k: int, hot: list) -> DataFrame:
    """Exact scores of every document that can be among the best ``k`` of its query.

    1. The query terms of highest peak, up to ``SEED_SHARE`` of the query's hits, give partial scores; the k-th of them is a
       floor for the final k-th score.
    2. The weakest terms whose peaks together stay below the floor cannot lift a document into the result on their own.
       Only the other, strong terms produce candidates.
    3. The k-th score over the strong terms is a higher floor. Candidates that cannot reach it even with all weak terms are
       dropped; for the rest the weak terms are looked up by document.
    """
    strongest = Window.partitionBy("query_id").orderBy(F.col("peak").desc(), "term").rowsBetween(Window.unboundedPreceding, 0)
    query_hits = F.sum("df").over(Window.partitionBy("query_id"))
    seeds = (asked.withColumn("_n", F.count(F.lit(1)).over(strongest)).withColumn("_hits", F.sum("df").over(strongest))
             .withColumn("_all", query_hits).filter((F.col("_n") <= 2) | (F.col("_hits") <= SEED_SHARE * F.col("_all"))))
    floor = _kth(_partial(relevant, seeds, hot), k)
    weakest = Window.partitionBy("query_id").orderBy("peak", F.col("term").desc()).rowsBetween(Window.unboundedPreceding, 0)
    placed = stage(asked.join(floor, "query_id", "left").withColumn("_below", F.sum("peak").over(weakest))
                   .withColumn("_weak", F.coalesce(F.col("_below") < F.col("_kth") - SLACK, F.lit(False)))
                   .select("query_id", "term", "peak", "_weak"), "query-terms")
    strong = stage(_partial(relevant, placed.filter(~F.col("_weak")), hot), "candidates")
    rest = placed.groupBy("query_id").agg(
        F.coalesce(F.sum(F.when(F.col("_weak"), F.col("peak"))), F.lit(0.0)).alias("_rest"),
        F.collect_list(F.when(F.col("_weak"), F.col("term"))).alias("_weak_terms"))
    reach = F.col("score") + F.col("_rest") >= F.col("_kth") - SLACK
    open_ = (strong.join(rest, "query_id").join(_kth(strong, k), "query_id", "left")
             .filter(F.coalesce(reach, F.lit(True))))
    lookups = open_.select("query_id", "doc_id", F.explode("_weak_terms").alias("term"))
    weak = lookups.join(relevant, ["doc_id", "term"]).select("query_id", "doc_id", F.col("impact").alias("score"))
    return (open_.select("query_id", "doc_id", "score").unionByName(weak)
            .groupBy("query_id", "doc_id").agg(F.sum("score").alias("score")))
