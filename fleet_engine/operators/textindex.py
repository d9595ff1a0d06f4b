"""Log-structured BM25 index: unweighted postings in small blocks, weighted when they are asked for.

Documents arrive in batches. A task cuts the documents that it holds into ranges of ``RANGE_DOCS`` (of one set of attribute values, of like length) and
writes a block per range and term: the counts, and beside them the largest count and the shortest document, from which the highest impact of
the block follows under any corpus statistics. Below the index path lie, all but the last in folders per hash slot and batch:

* ``blocks``: postings, sorted by term, so that a search reads the slots of its terms;
* ``terms``: by how many documents a batch changes a term's document frequency;
* ``docs``: length, range and words of each document, ``stored``: the columns that hits are returned with;
* ``gone``: documents of earlier batches that a batch replaces or deletes;
* ``totals``: documents and words that a batch adds. It is written last: a batch without it does not exist for readers.

A search bounds every (query, range) from the block maxima, scores the best ranges for a floor, and reads the postings of those ranges alone whose
bound reaches it. Where the bounds themselves would be too many rows, the postings of the asked terms are moved once, to a task per some ranges, that
scores them for all queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from fleet_engine.functions.text import explode_each, tokens
from fleet_engine.operators.blocks import Best, sortable
from fleet_engine.operators.keywords import K1, SLACK, B, _for_all, _kth, _once, word_slices
from fleet_engine.operators.skew import HOT_ROWS, hot_keys, salted_join, topk
from fleet_engine.workspace import broadcast_bounded, fits, folder_exists, stage, subfolders

RANGE_DOCS = 32        # documents whose maxima share a block
SLOTS = 16             # folders by hash of term or document
PAIR_ROWS = 2_000_000  # (query, block) pairs that are made into rows; with more, ranges meet all queries at once
ASKED_ROWS = 1_000_000 # (query, term) rows that are sent to every task for that
ADDS = 1 << 21         # shares of (query, posting) pairs added at once
SLOTTED = ("blocks", "terms", "docs", "stored", "gone")


@dataclass(frozen=True)
class TextIndex:
    """A place where an index lies, and what its documents carry: ``attributes`` to filter by, ``stored`` columns to return."""

    spark: SparkSession
    path: str
    attributes: tuple[str, ...] = ()
    stored: tuple[str, ...] = ()
    slots: int = SLOTS

    def batches(self, before: int | None = None) -> list[int]:
        """The whole batches (below ``before``)."""
        found = [int(name.partition("=")[2]) for name in subfolders(self.spark, f"{self.path}/totals") if folder_exists(self.spark, f"{self.path}/totals/{name}/_SUCCESS")]
        return sorted(b for b in found if before is None or b < before)

    def part(self, name: str, batches: list[int], slots: list[int] | None = None) -> DataFrame | None:
        """Rows of ``name`` that belong to whole batches, from the folders of the given slots alone; None where there are none."""
        wanted = range(self.slots) if slots is None else slots
        paths = [p for p in (f"{self.path}/{name}/slot={s}" for s in wanted) if folder_exists(self.spark, p)]
        if not paths or not batches:
            return None
        rows = self.spark.read.option("basePath", f"{self.path}/{name}").parquet(*paths).filter(F.col("batch_id").isin(batches))
        return rows if slots is None else rows.filter(F.col("slot").isin(list(slots)))


def _slot(of: str | Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(of), F.lit(slots)).cast("int")


def range_blocks(docs: DataFrame, id: str, text: str, attributes: tuple[str, ...] = (), range_docs: int = RANGE_DOCS) -> DataFrame:
    """Per range and term a block, and per document a row with a NULL term; made in the task that holds the documents, from one tokenisation.

    Blocks: (term, range, *attributes, max_tf, min_len, docs, tfs, lens). Documents: (range, *attributes, docs of one, lens of one, words).
    A NULL text has no words. ``range`` is unique in ``docs``; ids need not be.
    """
    source = docs.select(F.col(id).alias("doc_id"), *attributes, F.coalesce(tokens(text), F.array().cast("array<string>")).alias("_w"))
    schema = T.StructType([
        T.StructField("term", T.StringType()), T.StructField("range", T.LongType()), *(source.schema[a] for a in attributes),
        T.StructField("max_tf", T.IntegerType()), T.StructField("min_len", T.IntegerType()), T.StructField("docs", T.ArrayType(source.schema["doc_id"].dataType)),
        T.StructField("tfs", T.ArrayType(T.IntegerType())), T.StructField("lens", T.ArrayType(T.IntegerType())), T.StructField("words", T.ArrayType(T.StringType()))])
    names = schema.fieldNames()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get(), 0
        base = (task.partitionId() if task else 0) << 36
        for batch in word_slices(batches):
            n, lists = batch.num_rows, batch.column(batch.num_columns - 1)
            if not n:
                continue
            owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            coded = lists.flatten().dictionary_encode()
            size = max(1, len(coded.dictionary))
            lengths = np.bincount(owner, minlength=n)
            pair, tf = np.unique(owner * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            row, term = pair // size, pair % size
            # documents of one set of attribute values stand together, in the order of their most frequent word (so of language and subject) and length:
            # then a range lacks many words, and its maxima lie near the impacts
            common = np.full(n, -1)
            by = np.lexsort((-term, tf, row))
            common[row[by]] = term[by]
            kinds = np.zeros(n, np.int64)
            for i in range(len(attributes)):
                values = batch.column(1 + i).dictionary_encode(null_encoding="encode")
                kinds = np.unique(kinds * (len(values.dictionary) + 1) + values.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1].astype(np.int64)
            order = np.lexsort((lengths, common, kinds))
            first = np.ones(n, bool)
            first[1:] = np.diff(kinds[order]) != 0
            place = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
            starts = first | (place % range_docs == 0)
            rank = np.empty(n, np.int64)                       # position in the new order
            rank[order] = np.arange(n)
            range_at = np.cumsum(starts) - 1                   # range of a position
            word_ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(word_ends), coded.dictionary.take(pa.array(term)).cast(pa.string()))
            by = np.lexsort((rank[row], term, range_at[rank[row]]))
            row, term, tf = row[by], term[by], tf[by].astype(np.int32)
            where = range_at[rank[row]]
            new = np.ones(len(row), bool)
            new[1:] = (where[1:] != where[:-1]) | (term[1:] != term[:-1])
            begin = np.flatnonzero(new)
            lens = lengths[row].astype(np.int32)
            ends = pa.array(np.append(begin, len(row)).astype(np.int32))
            lead = pa.array(row[begin])
            if len(begin):
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary.take(pa.array(term[begin])).cast(pa.string()), pa.array(base + number + where[begin]), *(batch.column(1 + i).take(lead) for i in range(len(attributes))),
                     pa.array(np.maximum.reduceat(tf, begin)), pa.array(np.minimum.reduceat(lens, begin)), pa.ListArray.from_arrays(ends, batch.column(0).take(pa.array(row))),
                     pa.ListArray.from_arrays(ends, pa.array(tf)), pa.ListArray.from_arrays(ends, pa.array(lens)), pa.nulls(len(begin), pa.list_(pa.string()))], names)
            one = pa.array(np.arange(n + 1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.string()), pa.array(base + number + range_at[rank]), *(batch.column(1 + i) for i in range(len(attributes))), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
                 pa.ListArray.from_arrays(one, batch.column(0)), pa.nulls(n, pa.list_(pa.int32())), pa.ListArray.from_arrays(one, pa.array(lengths.astype(np.int32))), words], names)
            number += int(range_at[-1]) + 1

    return source.mapInArrow(cut, schema)


def _put(df: DataFrame, index: TextIndex, name: str, batch_id: int, order: tuple[str, ...]) -> None:
    """Put rows with a ``slot`` into the folders of the batch, replacing what an earlier try left there. A large slot becomes several files, each sorted."""
    (df.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", "slot").sortWithinPartitions("slot", *order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch_id").parquet(f"{index.path}/{name}"))


def add_documents(index: TextIndex, docs: DataFrame, id: str, text: str, batch_id: int, newest: str | None = None) -> None:
    """Add a batch. A document that is there already is replaced, one with a NULL text is deleted; of several rows of an id in the batch the one with
    the largest ``newest`` counts (without it, or among equal ones, the one with the largest hash, so that a replay chooses alike).
    Rows with a NULL id are left out. The cost follows the batch and the ids in its slots, not the size of the index."""
    docs = docs.filter(F.col(id).isNotNull())
    latest = [*([F.col(newest).desc_nulls_last()] if newest else []), F.xxhash64(*docs.columns).desc()]
    docs = docs.withColumn("_rn", F.row_number().over(Window.partitionBy(id).orderBy(*latest))).filter("_rn = 1").drop("_rn")
    if index.stored:
        docs = stage(docs.select(*dict.fromkeys([id, text, *index.attributes, *index.stored])), "index-batch")
        _put(docs.select(_slot(id, index.slots).alias("slot"), F.col(id).alias("doc_id"), *index.stored), index, "stored", batch_id, ("doc_id",))
    made = stage(range_blocks(docs, id, text, index.attributes), "index-blocks")
    new = made.filter("term IS NULL").select(_slot(F.col("docs")[0], index.slots).alias("slot"), F.col("docs")[0].alias("doc_id"), F.col("lens")[0].alias("doc_len"), "range", "words")
    old = _replaced(index, new, batch_id)
    _put(made.filter("term IS NOT NULL").drop("words").withColumn("slot", _slot("term", index.slots)), index, "blocks", batch_id, ("term", "range"))
    _put(new, index, "docs", batch_id, ("doc_id",))
    changes = explode_each(new.withColumn("s", F.lit(1)), ["s"], F.col("words"), "term")
    n, length = F.count_if(F.col("doc_len") > 0), F.coalesce(F.sum(F.col("doc_len").cast("bigint")), F.lit(0))
    totals = new.agg(n.alias("n"), length.alias("length"))
    if old is not None:
        _put(old.select("slot", "doc_id", F.col("batch_id").alias("of_batch"), "range"), index, "gone", batch_id, ("doc_id",))
        changes = changes.unionByName(explode_each(old.withColumn("s", F.lit(-1)), ["s"], F.col("words"), "term"))
        less = old.agg((-n).alias("n"), (-length).alias("length"))
        totals = totals.unionByName(less).agg(F.sum("n").alias("n"), F.sum("length").alias("length"))
    df = changes.groupBy("term").agg(F.sum("s").alias("df")).filter("df <> 0")
    _put(df.withColumn("slot", _slot("term", index.slots)), index, "terms", batch_id, ("term",))
    totals.write.mode("overwrite").parquet(f"{index.path}/totals/batch_id={batch_id}")


def _replaced(index: TextIndex, new: DataFrame, batch_id: int) -> DataFrame | None:
    """(slot, doc_id, batch_id, range, doc_len, words) of earlier versions that are still in force. Ids are compared first; words are read only of batches with a hit."""
    earlier = index.batches(batch_id)
    ids = new.select("slot", "doc_id")
    slots = [r["slot"] for r in ids.select("slot").distinct().collect()]
    known = index.part("docs", earlier, slots)
    if known is None:
        return None
    found = known.select("slot", "doc_id", "batch_id").join(broadcast_bounded(ids, 1_000_000), ["slot", "doc_id"], "left_semi")
    found = stage(without_gone(index, found, earlier), "index-replaced")
    hit = [r["batch_id"] for r in found.select("batch_id").distinct().collect()]
    if not hit:
        return None
    in_slots = [r["slot"] for r in found.select("slot").distinct().collect()]
    full = index.part("docs", hit, in_slots).select("slot", "doc_id", "batch_id", "range", "doc_len", "words")
    return stage(full.join(broadcast_bounded(found, 1_000_000), ["slot", "doc_id", "batch_id"], "left_semi"), "index-old")


def without_gone(index: TextIndex, rows: DataFrame, batches: list[int]) -> DataFrame:
    """Rows of (doc_id, batch_id) whose document no later batch of ``batches`` has replaced."""
    gone = index.part("gone", batches)
    if gone is None:
        return rows
    gone = broadcast_bounded(gone.select("doc_id", F.col("of_batch").alias("batch_id")), 1_000_000)
    return rows.join(gone, ["doc_id", "batch_id"], "left_anti")


def corpus_totals(index: TextIndex, batches: list[int]) -> tuple[int, float]:
    """Documents with a word, and their mean length."""
    if not batches:
        return 0, 0.0
    row = index.spark.read.parquet(*[f"{index.path}/totals/batch_id={b}" for b in batches]).agg(F.sum("n").alias("n"), F.sum("length").alias("length")).first()
    return row["n"], (row["length"] / row["n"] if row["n"] else 0.0)


def asked_blocks(index: TextIndex, words: DataFrame, batches: list[int]) -> tuple[DataFrame | None, DataFrame | None]:
    """(blocks, document frequencies) of the slots of ``words`` (term, slot); what lies in other slots is neither listed nor read."""
    slots = sorted(r["slot"] for r in words.select("slot").distinct().collect())       # at most ``slots`` numbers
    blocks, counts = index.part("blocks", batches, slots), index.part("terms", batches, slots)
    if blocks is None or counts is None:
        return None, None
    frequency = counts.join(words, ["slot", "term"], "left_semi").groupBy("slot", "term").agg(F.sum("df").alias("df")).filter("df > 0")
    return blocks, frequency


def _share(tf: Column, length: Column, mean: float) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def _idf(n: int) -> Column:
    return F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))


def index_postings(index: TextIndex, words: DataFrame | None = None) -> DataFrame:
    """(term, doc_id, impact, df, *attributes) as of now, of the terms in ``words`` or of all."""
    batches = index.batches()
    n, mean = corpus_totals(index, batches)
    counts = index.part("terms", batches).select("slot", "term").distinct() if words is None else words.select("term").distinct().withColumn("slot", _slot("term", index.slots))
    blocks, frequency = asked_blocks(index, counts, batches)
    rows = _postings(index, blocks.join(frequency, ["slot", "term"]), batches, ("term", "df", *index.attributes))
    return rows.select("term", "doc_id", (_idf(n) * _share(F.col("tf"), F.col("len"), mean)).alias("impact"), "df", *index.attributes)


def _postings(index: TextIndex, blocks: DataFrame, batches: list[int], keep: tuple[str, ...]) -> DataFrame:
    """One row per posting of documents in force: (*keep, doc_id, tf, len)."""
    entries = explode_each(blocks, [*keep, "batch_id"], F.arrays_zip("docs", "tfs", "lens"), "e")
    return without_gone(index, entries.select(*keep, "batch_id", F.col("e.docs").alias("doc_id"), F.col("e.tfs").alias("tf"), F.col("e.lens").alias("len")), batches)


def _sum_blocks(held: DataFrame, mean: float) -> DataFrame:
    """(query_id, batch_id, doc_id, score) of rows (query_id, batch_id, _kth, blocks of one range), where a score reaches ``_kth``."""
    doc_type = held.schema["blocks"].dataType.elementType["docs"].dataType.elementType

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            group = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            idf, docs, tfs, lens = lists.flatten().flatten()
            owner = pc.list_parent_indices(docs).to_numpy(zero_copy_only=False)
            tf, length = (x.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for x in (tfs, lens))
            part = idf.to_numpy(zero_copy_only=False)[owner] * (tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean)))
            coded = docs.flatten().dictionary_encode()
            size = max(1, len(coded.dictionary))
            key, place = np.unique(group[owner] * size + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_inverse=True)
            score = np.bincount(place, part, len(key))
            row = key // size
            least = batch.column(2).fill_null(-np.inf).to_numpy(zero_copy_only=False)[row]
            good = np.flatnonzero(score >= least - SLACK)
            at = pa.array(row[good])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), coded.dictionary.take(pa.array(key[good] % size)), pa.array(score[good])],
                                             ["query_id", "batch_id", "doc_id", "score"])

    schema = T.StructType([held.schema["query_id"], held.schema["batch_id"], T.StructField("doc_id", doc_type), T.StructField("score", T.DoubleType())])
    return held.mapInArrow(add, schema)


def _score_ranges(index: TextIndex, blocks: DataFrame, asked: DataFrame, filters: tuple[str, ...], mean: float, k: int, batches: list[int]) -> DataFrame:
    """(query_id, batch_id, doc_id, score): the best ``k`` documents per query of each task, with all postings of the asked terms moved once, to the task of their range.

    ``asked`` (query_id, term, idf, *filters) has been measured and goes to every task. Documents that were replaced come along with their range.
    """
    spark, doc_type = index.spark, blocks.schema["docs"].dataType.elementType
    rows = asked.select("query_id", "term", "idf", *[F.col(f).cast("string").alias(f) for f in filters]).collect()
    queries = {r["query_id"]: tuple(r[f] for f in filters) for r in rows}
    place, terms = {q: i for i, q in enumerate(queries)}, {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
    at = np.array([terms[r["term"]] for r in rows])
    by = np.argsort(at, kind="stable")
    first = np.searchsorted(at[by], np.arange(len(terms) + 1))
    holds, weight = np.array([place[r["query_id"]] for r in rows])[by], np.array([r["idf"] for r in rows])[by]
    shared = spark.sparkContext.broadcast((list(queries), list(queries.values()), first, holds, weight))
    numbered = F.broadcast(spark.createDataFrame(list(terms.items()), "term string, _t int"))
    columns = ["batch_id", "range", "_t", "docs", "tfs", "lens", *[f"_{f}" for f in filters]]
    moved = blocks.join(numbered, "term").withColumns({f"_{f}": F.col(f).cast("string") for f in filters}).select(*columns)
    gone = index.part("gone", batches)
    if gone is not None:
        none = F.array(F.lit(0))
        moved = moved.unionByName(gone.select(F.col("of_batch").alias("batch_id"), "range", F.lit(-1).alias("_t"), F.array("doc_id").alias("docs"), none.alias("tfs"), none.alias("lens"),
                                              *[F.lit(None).cast("string").alias(f"_{f}") for f in filters]))
    moved = moved.select(F.col("batch_id").cast("bigint").alias("batch_id"), *columns[1:]).repartition("batch_id", "range").sortWithinPartitions("batch_id", "range")
    schema = T.StructType([asked.schema["query_id"], T.StructField("batch_id", T.LongType()), T.StructField("doc_id", doc_type), T.StructField("score", T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted, first, holds, weight = shared.value
        allowed, best, now = {}, None, None

        def hits() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([ids[q] for q in best.query], arrow[0]), pa.array(np.full(len(best.query), now)), pa.array(best.id.tolist(), arrow[2]), pa.array(-best.score)], names)

        for part in _whole_ranges(batches, np.diff(first)):
            if part.column("batch_id")[0].as_py() != now:
                if best is not None and len(best.query):
                    yield hits()
                limit = None if best is None else best.limit
                now, best = part.column("batch_id")[0].as_py(), Best(len(ids), k)
                if limit is not None:
                    best.limit = limit                # of another batch: still ``k`` documents as good
            docs = part.column("docs")
            owner = pc.list_parent_indices(docs).to_numpy(zero_copy_only=False)
            coded = docs.flatten().dictionary_encode()
            doc, n_docs = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
            term = part.column("_t").to_numpy(zero_copy_only=False)[owner]
            tf, length = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in ("tfs", "lens"))
            real = term >= 0
            kept = np.ones(n_docs, bool)
            kept[doc[~real]] = False
            if not real.any():
                continue
            doc, term, tf, length, owner = doc[real], term[real], tf[real], length[real], owner[real]
            share = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
            n = first[term + 1] - first[term]
            entry = np.repeat(first[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            score = np.bincount(np.repeat(doc, n) * len(ids) + holds[entry], np.repeat(share, n) * weight[entry], n_docs * len(ids)).reshape(n_docs, len(ids))
            score[~kept] = 0.0
            if filters:
                values = list(zip(*(part.column(f"_{f}").to_pylist() for f in filters)))
                lead = np.zeros(n_docs, np.int64)
                lead[doc] = owner
                for i in range(n_docs):
                    value = values[lead[i]]
                    if value not in allowed:
                        allowed[value] = np.array([all(w is None or w == v for w, v in zip(ask, value)) for ask in wanted])
                    score[i, ~allowed[value]] = 0.0
            low = -np.round(score, 6)
            at, query = np.nonzero((score > 0) & (low <= best.limit[None, :]))
            best.offer(query, low[at, query], sortable(coded.dictionary.to_pandas())[at])
        if best is not None and len(best.query):
            yield hits()

    names = schema.fieldNames()
    arrow = [to_arrow_type(f.dataType) for f in schema.fields]
    return moved.mapInArrow(add, schema)


def _whole_ranges(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows sorted by batch and range, as pieces of whole ranges of one batch, of about ``ADDS`` (query, posting) pairs; a range has ``RANGE_DOCS`` documents."""
    held = None
    for batch in batches:
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        of, range_ = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("batch_id", "range"))
        new = np.append(True, (of[1:] != of[:-1]) | (range_[1:] != range_[:-1]))
        starts = np.flatnonzero(new)
        yield from _pieces(rows, starts[:-1], starts[-1], weights)
        held = rows.slice(starts[-1])
    if held is not None:
        yield from _pieces(held, np.array([0]), held.num_rows, weights)


def _pieces(rows: pa.RecordBatch, starts: np.ndarray, end: int, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(starts):
        return
    term = rows.column("_t").to_numpy(zero_copy_only=False)
    work = np.where(term >= 0, weights[np.maximum(term, 0)], 1) * pc.list_value_length(rows.column("docs")).to_numpy(zero_copy_only=False)
    of = rows.column("batch_id").to_numpy(zero_copy_only=False)
    cost = np.add.reduceat(work[:end], starts)
    begin, total = starts[0], 0
    for i, start in enumerate(starts):
        if start > begin and (total + cost[i] > ADDS or of[start] != of[begin]):
            yield rows.slice(begin, start - begin)
            begin, total = start, 0
        total += cost[i]
    yield rows.slice(begin, end - begin)


# Types of attributes that equal each other where their texts do.
PLAIN_TYPES = ("string", "tinyint", "smallint", "int", "bigint", "boolean", "date")


def search_index(index: TextIndex, queries: DataFrame, k: int, query_id: str = "query_id", text: str = "text", fields: tuple[str, ...] = (),
                 filters: tuple[str, ...] = (), work: dict[str, int] | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank, *fields): best ``k`` documents per query by BM25 (6 decimals, ties by id), exact.

    ``filters`` names columns of ``queries`` that are attributes of the index: a query meets only documents with its values, NULL meets all; weights
    stay those of the whole corpus. ``fields`` are stored columns, read for the hits alone. ``work`` receives how many (query, block) pairs
    there were and how many were read.
    """
    unknown = [f for f in filters if f not in index.attributes] + [f for f in fields if f not in index.stored]
    if unknown:
        raise ValueError(f"not in this index: {', '.join(unknown)}")
    batches = index.batches()
    everyone, distinct = _once(queries.select(F.col(query_id).alias("query_id"), F.col(text).alias("text"), *filters), ["text", *filters])
    distinct = stage(distinct, "index-queries")
    asked = explode_each(distinct, ["query_id", *filters], F.array_distinct(tokens("text")), "term").withColumn("slot", _slot("term", index.slots))
    blocks, frequency = asked_blocks(index, asked.select("slot", "term").distinct(), batches)
    n, mean = corpus_totals(index, batches)
    if blocks is None or not n:
        total = distinct.limit(0).select("query_id", F.lit(None).alias("doc_id"), F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
        return _for_all(everyone, distinct, total)
    asked = stage(asked.join(frequency, ["slot", "term"]).withColumn("idf", _idf(n)), "index-asked")
    plain = all(blocks.schema[f].dataType == asked.schema[f].dataType and blocks.schema[f].dataType.simpleString() in PLAIN_TYPES for f in filters)
    n_pairs = asked.agg(F.coalesce(F.sum(F.least(F.col("df"), F.lit(n // RANGE_DOCS + 1))), F.lit(0)).alias("n")).first()["n"]
    if n_pairs > PAIR_ROWS and plain and fits(asked, ASKED_ROWS) and (not filters or distinct.select("query_id", *filters).distinct().groupBy("query_id").count().filter("count > 1").isEmpty()):
        total = _score_ranges(index, blocks, asked, filters, mean, k, batches)
        if work is not None:
            met = blocks.select("term").join(asked.select("term"), "term").count()
            work |= {"pairs": met, "read": met}
        return _best(index, everyone, distinct, total, k, fields, batches)
    # a frequent term has a block in nearly every range: its blocks are dealt out over many tasks
    hot = hot_keys(asked.select("term", (F.col("df") / RANGE_DOCS).alias("n_blocks")).distinct(), "term", "n_blocks", HOT_ROWS)
    wanted = [F.col(f"_{f}").isNull() | F.col(f"_{f}").eqNullSafe(F.col(f)) for f in filters]
    maxima = blocks.select("term", "batch_id", "range", "max_tf", "min_len", *filters)
    pairs = salted_join(maxima, asked.select("term", "query_id", "idf", *[F.col(f).alias(f"_{f}") for f in filters]), "term", ["batch_id", "range"], hot=hot)
    for condition in wanted:
        pairs = pairs.filter(condition)
    bound = F.col("idf") * _share(F.col("max_tf"), F.col("min_len"), mean)
    pairs = stage(pairs.select("query_id", "term", "batch_id", "range", "idf", bound.alias("bound")), "index-bounds")
    ranges = stage(pairs.groupBy("query_id", "batch_id", "range").agg(F.sum("bound").alias("reach")), "index-ranges")

    def scores(some: DataFrame, floor: DataFrame | None) -> DataFrame:
        """Exact scores of the documents in (query_id, batch_id, range) that reach the query's floor."""
        blocks_of = pairs.drop("bound").join(some, ["query_id", "batch_id", "range"], "left_semi")
        read = blocks.select("term", "batch_id", "range", "docs", "tfs", "lens").join(blocks_of, ["term", "batch_id", "range"])
        held = read.groupBy("query_id", "batch_id", "range").agg(F.collect_list(F.struct("idf", "docs", "tfs", "lens")).alias("blocks"))   # the query's terms, ``RANGE_DOCS`` entries each
        least = F.lit(None).cast("double").alias("_kth")
        held = held.withColumn("_kth", least) if floor is None else held.join(floor, "query_id", "left")
        return without_gone(index, _sum_blocks(held.select("query_id", "batch_id", "_kth", "blocks"), mean), batches)

    seeds = topk(ranges, ["query_id"], [F.col("reach").desc(), F.col("batch_id"), F.col("range")], k, "_rank")    # the best ``k`` may lie in as many ranges
    floor = stage(_kth(scores(seeds, None), k), "index-floor")              # a row per query at most
    open_ = stage(ranges.join(floor, "query_id", "left").filter(F.coalesce(F.col("reach") >= F.col("_kth") - SLACK, F.lit(True))).select("query_id", "batch_id", "range"), "index-open")
    if work is not None:
        work |= {"pairs": pairs.count(), "read": pairs.join(open_, ["query_id", "batch_id", "range"], "left_semi").count()}
    return _best(index, everyone, distinct, scores(open_, floor), k, fields, batches)


def _best(index: TextIndex, everyone: DataFrame, distinct: DataFrame, total: DataFrame, k: int, fields: tuple[str, ...], batches: list[int]) -> DataFrame:
    """The best ``k`` of the scored documents, with their stored ``fields``, for every query that asks the same."""
    best = topk(total.withColumn("score", F.round("score", 6)), ["query_id"], [F.col("score").desc(), F.col("doc_id")], k)
    if fields:
        best = stage(best.withColumn("slot", _slot("doc_id", index.slots)), "index-hits")
        kept = index.part("stored", batches, [r["slot"] for r in best.select("slot").distinct().collect()])
        hits = broadcast_bounded(best.select("slot", "doc_id", "batch_id").distinct(), 1_000_000)
        found = stage(kept.join(hits, ["slot", "doc_id", "batch_id"], "left_semi"), "index-fields")
        best = best.join(found, ["slot", "doc_id", "batch_id"])
    return _for_all(everyone, distinct, best.select("query_id", "doc_id", "score", "rank", *fields))


def compact(index: TextIndex, to: str) -> TextIndex:
    """The index at ``to`` as two batches: all but the last merged as batch -1 without what they replaced, and the last as it is, since a restarted
    stream may replay it. A range keeps its documents; only ranges that lost some are written anew."""
    batches, target = index.batches(), TextIndex(index.spark, to, index.attributes, index.stored, index.slots)
    last, merged = batches[-1], batches[:-1]
    totals = {b: index.spark.read.parquet(f"{index.path}/totals/batch_id={b}") for b in batches}
    renamed = F.xxhash64("batch_id", "range")
    if merged:
        lost = index.part("gone", merged)
        docs = without_gone(index, index.part("docs", merged), merged)
        _put(docs.withColumn("range", renamed), target, "docs", -1, ("doc_id",))
        blocks = index.part("blocks", merged)
        if lost is not None:
            touched = broadcast_bounded(lost.select(F.col("of_batch").alias("batch_id"), "range").distinct(), 1_000_000)
            key = ["slot", "term", "batch_id", "range", *index.attributes]
            entries = explode_each(blocks.join(touched, ["batch_id", "range"], "left_semi"), key, F.arrays_zip("docs", "tfs", "lens"), "e")
            entries = without_gone(index, entries.withColumn("doc_id", F.col("e.docs")), merged)
            again = (entries.groupBy(*key).agg(F.collect_list("e").alias("e"))        # at most ``RANGE_DOCS`` entries
                     .select(*key, F.array_max("e.tfs").alias("max_tf"), F.array_min("e.lens").alias("min_len"), F.col("e.docs").alias("docs"), F.col("e.tfs").alias("tfs"), F.col("e.lens").alias("lens")))
            blocks = blocks.join(touched, ["batch_id", "range"], "left_anti").unionByName(again)
        _put(blocks.withColumn("range", renamed), target, "blocks", -1, ("term", "range"))
        if index.stored:
            _put(without_gone(index, index.part("stored", merged), merged), target, "stored", -1, ("doc_id",))
        df = index.part("terms", merged).groupBy("slot", "term").agg(F.sum("df").alias("df")).filter("df <> 0")
        _put(df, target, "terms", -1, ("term",))
        all_totals = [totals[b] for b in merged]
        one = all_totals[0]
        for more in all_totals[1:]:
            one = one.unionByName(more)
        one.agg(F.sum("n").alias("n"), F.sum("length").alias("length")).write.mode("overwrite").parquet(f"{to}/totals/batch_id=-1")
    for name in SLOTTED:
        rows = index.part(name, [last])
        if rows is not None:
            order = ("term", "range") if name == "blocks" else ("term",) if name == "terms" else ("doc_id",)
            if name == "gone":
                rows = rows.withColumn("range", F.xxhash64(F.col("of_batch").alias("batch_id"), "range")).withColumn("of_batch", F.lit(-1))
            _put(rows, target, name, last, order)
    totals[last].write.mode("overwrite").parquet(f"{to}/totals/batch_id={last}")
    return target
