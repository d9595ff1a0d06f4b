"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.llm.common import KeyFilter, free_name, gram_hashes, joined, text_chunks
from fleet_engine.llm.components import components
from fleet_engine.llm.quality_rules import word_hashes
from fleet_engine.workspace import stage

WORDS = 5               # words per n-gram
SIMILARITY = 0.8
RECALL = 0.9999         # chance that a pair of exactly that similarity shares a band
MOST_HASHES = 300       # MinHash values per text
BLOCK_DOCS = 2_048      # texts of one group that are compared at once; a larger group is cut into blocks and every two blocks meet in one task
BLOCK_GRAMS = 2_000_000
PACK_DOCS = 2_000       # texts of small groups that share a task


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, hence the fewest false candidates, with which ``recall`` is reached within ``most`` hashes."""
    for rows in range(32, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-similarity ** rows))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no bands reach this recall")


def gram_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the different n-grams of each text. Words are lower-cased and cut at ``[\\x20\\x09-\\x0D]``; a text of fewer
    words than an n-gram has is one n-gram, a text without words none."""
    points, starts = joined([(t or "").lower() for t in texts])
    hashes, begins = word_hashes(points, starts)
    counts = np.diff(begins)
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    for owner, h in gram_hashes(hashes, begins, (words,)):
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
        owner, h = owner[new], h[new]
        at = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i in np.flatnonzero(np.diff(at)):
            out[i] = h[at[i]:at[i + 1]]
    for i in np.flatnonzero((counts > 0) & (counts < words)):
        value = 0
        for h in hashes[begins[i]:begins[i + 1]]:
            value = (value * 0x100000001B3 + int(h) + 1) % (1 << 64)
        out[i] = np.array([value], np.uint64)
    return out


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """A 64-bit hash per band for each non-empty set. The n-gram hashes are permuted by random linear maps modulo 2^32."""
    rng = np.random.default_rng(20240101)
    a = (rng.integers(0, 1 << 31, bands * rows, np.uint32) << np.uint32(1)) | np.uint32(1)
    b = rng.integers(0, 1 << 32, bands * rows, np.uint32)
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.zeros((len(sets), bands), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(bands):
            h = np.full(len(sets), 0x9E3779B97F4A7C15 * (band + 1) % (1 << 64), np.uint64)
            for i in range(band * rows, (band + 1) * rows):
                h = (h ^ np.minimum.reduceat(a[i] * x + b[i], starts)) * np.uint64(0xBF58476D1CE4E5B9)
                h ^= h >> np.uint64(29)
            out[:, band] = h
    return out.view(np.int64)


def _links(a: list[np.ndarray], b: list[np.ndarray] | None, similarity: float) -> np.ndarray:
    """Which sets of ``a`` and ``b`` (``a`` itself if None) are similar, by exact intersections: products of 0/1 matrices over the n-grams
    that more than one set holds, a few thousand n-grams at a time."""
    sets = a if b is None else a + b
    sizes = np.array([len(s) for s in sets], np.float64)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(int))
    _, gram, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df[gram] > 1
    owner, gram = owner[shared], gram[shared]
    _, gram = np.unique(gram, return_inverse=True)
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    n_a, n_grams = len(a), int(gram[-1]) + 1 if len(gram) else 0
    common = np.zeros((n_a, n_a if b is None else len(b)))
    for low in range(0, n_grams, 4096):
        i, j = np.searchsorted(gram, [low, low + 4096])
        m = np.zeros((len(sets), min(4096, n_grams - low)), np.float32)
        m[owner[i:j], gram[i:j] - low] = 1
        common += m[:n_a] @ (m[:n_a] if b is None else m[n_a:]).T
    union = sizes[:n_a, None] + (sizes[:n_a] if b is None else sizes[n_a:])[None, :] - common
    links = common >= similarity * union - 1e-9
    if b is None:
        np.fill_diagonal(links, False)
    return links


def _roots(links: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each row of a symmetric matrix."""
    root = np.arange(len(links))
    while True:
        new = np.minimum(root, np.where(links, root[None, :], len(root)).min(axis=1, initial=len(root)))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def compare(pdf: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """(v, root, n_texts, n_rows) for one task: for each text its links to others and one vertex it is connected to."""
    out = []
    for _, group in pdf.groupby("unit", sort=False):
        group = group.sort_values(["side", "v"])
        sets = [np.frombuffer(x, np.uint64) for x in group["grams"]]
        v, copies, n_a = group["v"].to_numpy(), group["copies"].to_numpy(np.float64), int((group["side"] == 0).sum())
        if group["within"].iloc[0]:
            links = _links(sets, None, similarity)
            root, n_texts, n_rows = _roots(links), links.sum(1), links @ copies
        else:
            half = _links(sets[:n_a], sets[n_a:], similarity) if 0 < n_a < len(sets) else np.zeros((n_a, len(sets) - n_a), bool)
            links = np.zeros((len(sets), len(sets)), bool)
            links[:n_a, n_a:], links[n_a:, :n_a] = half, half.T
            root, n_texts, n_rows = _roots(links), links.sum(1), links @ copies
        out.append(pd.DataFrame({"v": v, "root": v[root], "n_texts": n_texts.astype(np.int64), "n_rows": n_rows.astype(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({"v": [], "root": [], "n_texts": [], "n_rows": []}).astype("int64")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, recall: float = RECALL,
                 words: int = WORDS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(id, class_id, text_class, n_links, n_text_links), one row per row of ``docs``.

    Two rows are linked if the Jaccard similarity of their sets of n-grams of ``words`` words is at least ``similarity``. ``n_links`` counts the other rows that
    a row is linked to, ``n_text_links`` the other different sets; ``class_id`` is the smallest id that links connect it to, ``text_class`` the
    smallest id with an equal set. Rows without words, or with a NULL id, have no link; their classes are their own id. Repeated rows are copies.

    Equal sets become one vertex first. Vertices that share a band are linked to the first of the band, not to each other, and the components of these
    links are the only places where similar texts can be. In them every two different sets are compared exactly, small components many to a task, large
    ones block against block; a task hands on one row per text. The pairs are never made into rows.
    """
    bands, rows_per_band = bands_for(similarity, recall)
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, "_text"):
            sets = gram_sets(texts, words)
            full = [i for i, s in enumerate(sets) if len(s)]
            found = iter(band_hashes([sets[i] for i in full], bands, rows_per_band).tolist() if full else [])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([next(found) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                ["_id", "_digest", "_size", "_bands"])

    given = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    signed = stage(given.mapInArrow(sign, f"_id {kind}, _digest binary, _size bigint, _bands array<bigint>"), "signatures")
    valid = signed.filter(F.col("_digest").isNotNull() & F.col("_id").isNotNull())
    vertices = stage(valid.groupBy("_digest").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("copies"), F.first("_size").alias("_size"),
                                                  F.first("_bands").alias("_bands")).withColumn("v", F.monotonically_increasing_id()), "vertices")

    keys = vertices.select("v", F.posexplode("_bands").alias("_band", "_hash")).select("v", F.xxhash64("_band", "_hash").alias("_key"))
    shared = stage(keys.groupBy("_key").agg(F.min("v").alias("_hub"), F.max("v").alias("_other")).filter("_hub < _other").select("_key", "_hub"), "bands")
    rough = stage(components(keys.join(shared, "_key").select(F.col("v").alias("a"), F.col("_hub").alias("b"))), "rough")

    sizes = rough.join(vertices.select("v", "_size"), "v").groupBy("root").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_grams"))
    blocks = F.ceil(F.greatest(F.col("_n") / block_docs, F.col("_grams") / BLOCK_GRAMS)).cast("int")
    sizes = stage(sizes.select("root", "_n", blocks.alias("_blocks")), "rough-sizes")
    packs = max(1, -(-(sizes.filter("_blocks = 1").agg(F.sum("_n").alias("n")).first()["n"] or 0) // PACK_DOCS))
    block = F.pmod(F.xxhash64("v"), F.col("_blocks")).cast("int")
    tasks = F.when(F.col("_blocks") == 1, F.array(F.struct(F.pmod(F.xxhash64("root"), F.lit(packs)).alias("task"), F.col("root").alias("unit"), F.lit(0).alias("side"), F.lit(True).alias("within")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda j: F.struct(
            F.xxhash64("root", F.least(block, j), F.greatest(block, j), F.lit("block")).alias("task"),
            F.xxhash64(F.least(block, j), F.greatest(block, j)).alias("unit"), (block > j).cast("int").alias("side"), (block == j).alias("within"))))
    wanted = stage(rough.join(sizes, "root").select("v", tasks.alias("tasks")).join(vertices.select("v", "_first", "_digest", "copies"), "v")
                   .select("_first", "_digest", "v", "copies", "tasks"), "to-compare")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, "_text"):
            sets = gram_sets(texts, words)
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2), part.column(3), part.column(4), pa.array([s.tobytes() for s in sets], pa.binary()),
                 pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary())], ["_digest", "v", "copies", "tasks", "grams", "_own"])

    # an id that stands in several rows may have several texts: only the one with the vertex's digest counts, once
    asked = KeyFilter(wanted.select(F.xxhash64("_first").alias("_k")), "_k").keep(given.withColumn("_k", F.xxhash64("_id")), "_k")
    texts = asked.hint("merge").join(wanted, F.col("_id") == F.col("_first")).select("_text", "_digest", "v", "copies", "tasks")
    task_type = "array<struct<task:bigint,unit:bigint,side:int,within:boolean>>"
    sets = (texts.mapInArrow(sets_of, f"_digest binary, v bigint, copies bigint, tasks {task_type}, grams binary, _own binary")
            .filter("_own = _digest").select("v", "copies", "grams", F.explode("tasks").alias("t")).select("v", "copies", "grams", "t.task", "t.unit", "t.side", "t.within"))
    compared = stage(sets.groupBy("task").applyInPandas(lambda pdf: compare(pdf.drop_duplicates(["unit", "side", "v"]), similarity),
                                                        "v bigint, root bigint, n_texts bigint, n_rows bigint"), "compared")

    final = components(compared.select(F.col("v").alias("a"), F.col("root").alias("b")))
    linked = stage(compared.groupBy("v").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_rows").alias("n_rows")).join(final, "v", "left")
                   .select("v", F.coalesce("root", "v").alias("root"), "n_texts", "n_rows"), "linked")
    classes = stage(linked.join(vertices.select("v", "_first"), "v").groupBy("root").agg(F.min("_first").alias("_class")), "classes")
    known = (vertices.select("v", "_digest", "_first", "copies").join(linked.join(classes, "root").drop("root"), "v", "left")
             .select("_digest", F.col("_first").alias("_text_class"), F.coalesce("_class", "_first").alias("_class"),
                     (F.col("copies") - 1 + F.coalesce("n_rows", F.lit(0))).alias("_links"), F.coalesce("n_texts", F.lit(0)).alias("_texts")))
    known = stage(known, "known")
    rows = signed.select("_id", F.when(F.col("_id").isNotNull(), F.col("_digest")).alias("_digest")).join(known, "_digest", "left")
    return rows.select(F.col("_id").alias(id_col), F.coalesce("_class", "_id").alias("class_id"), F.coalesce("_text_class", "_id").alias("text_class"),
                       F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("_texts", F.lit(0)).cast("bigint").alias("n_text_links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class of similar texts, that of the smallest id (of equal ids, the smallest digest of the text).

    A row is known by its id and the digest of its text, so an id that stands in several rows with different texts loses only those that have a similar
    text elsewhere; of rows alike in both one stays. Rows with a NULL id stay. NULL and empty texts are alike, and similar to no other row's.
    """
    key, out = free_name(docs, "_row_key"), free_name(docs, "_row_out")
    known = F.struct(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    keyed = docs.withColumn(key, F.when(F.col(id_col).isNotNull(), known))
    found = stage(jaccard_join(keyed, key, text_col, **options).select(key, "class_id"), "near-copies")
    drop = stage(found.filter(F.col(key) != F.col("class_id")).select(F.col(key).alias(out)).distinct(), "near-copies-out")
    kept = keyed.join(drop, F.col(key) == F.col(out), "left_anti")
    repeated = stage(found.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(out)).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(out), "repeated")
    if repeated.isEmpty():
        return kept.drop(key)
    same = F.col(key) == F.col(out)
    twice = kept.join(repeated, same, "left_semi").dropDuplicates([key])
    return kept.join(repeated, same, "left_anti").unionByName(twice).drop(key)
