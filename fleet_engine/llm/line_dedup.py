"""Line dedup: lines that many documents share are dropped everywhere but in one of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleet_engine.llm.common import free_name
from fleet_engine.workspace import stage

SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit digest of a line stripped of ASCII white space and with A-Z lower-cased; None if it is too short to count."""
    key = line.strip(SPACE).lower()      # bytes.lower() changes A-Z only
    if len(key) < min_chars or sum(1 for b in key if b & 0xC0 != 0x80) < min_chars:
        return None
    return hashlib.md5(key).digest()


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def _which(id_col: str, text_col: str) -> Column:
    """Tells rows without an id apart by their text, so that each looks up its own keys and not those of all of them; NULL where there is an id."""
    return F.when(F.col(id_col).isNull(), F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def shared_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """(_id, _which, _keys): for each document the keys it has to drop.

    Lines become (key, id) rows. Grouping by both spreads a line that every document holds over all tasks; counting by key then
    combines before its shuffle. Back to the documents it is a plain join of two written tables, whose heavy keys Spark splits.
    """
    kind = docs.schema[id_col].dataType

    def found_rows(batch: pa.RecordBatch, at: list[int], keys: list[bytes]) -> pa.RecordBatch:
        rows = pa.array(at)
        return pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(keys, pa.binary())], ["_id", "_which", "_key"])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys = [], []
            for i, text in enumerate(batch.column(2)):
                found = {k for k in (line_key(line, min_chars) for line in _lines(text.as_py())) if k}
                at += [i] * len(found)
                keys += found
                if len(keys) > 50_000:
                    yield found_rows(batch, at, keys)
                    at, keys = [], []
            if keys:
                yield found_rows(batch, at, keys)

    schema = f"_id {kind.simpleString()}, _which string, _key binary"
    lines = stage(docs.select(F.col(id_col).alias("_id"), _which(id_col, text_col).alias("_which"), F.col(text_col).alias("_text")).mapInArrow(explode, schema)
                  .groupBy("_key", "_id", "_which").agg(F.lit(1).alias("_one")).drop("_one"), "lines")
    n_docs = F.count("_id") + F.max(F.col("_id").isNull().cast("int"))       # all rows without an id are one document
    shared = stage(lines.groupBy("_key").agg(n_docs.alias("_n"), F.max("_id").alias("_keeper"))
                   .filter(F.col("_n") >= min_docs).select("_key", "_keeper"), "shared-lines")
    hits = lines.join(shared, "_key").filter(~F.col("_id").eqNullSafe(F.col("_keeper")))
    return hits.groupBy("_id", "_which").agg(F.collect_list("_key").alias("_keys"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5,
               digest_only: bool = False) -> DataFrame:
    """``docs`` with shared lines dropped from ``text_col``, plus ``n_lines`` (before) and ``n_dropped``.

    A line counts by its key: white space ``[\\x20\\x09-\\x0D]`` stripped, A-Z lower-cased. Keys of at least ``min_chars`` code
    points found in at least ``min_docs`` documents (ids) lose all their lines except in the largest id that holds them; the other
    lines stay in order, joined by a newline. NULL or empty text: one empty line, kept as it is (NULL stays NULL). Repeated rows of
    one id count as one document and get the same treatment. A NULL id counts as one more document and never keeps a line that a real id also
    holds. Other columns pass through; an input column named ``n_lines`` or ``n_dropped`` is replaced. With ``digest_only`` the result is
    (id, n_lines, n_dropped, kept_sha256) and no text leaves the task.
    """
    drop_id, drop_which = free_name(docs, "_drop_id"), free_name(docs, "_drop_which")
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    if digest_only:
        kept = [id_col, text_col]
    keys = free_name(docs, "_keys")
    drops = shared_lines(docs, id_col, text_col, min_chars, min_docs).select(F.col("_id").alias(drop_id), F.col("_which").alias(drop_which), F.col("_keys").alias(keys))
    same = F.col(id_col).eqNullSafe(F.col(drop_id)) & _which(id_col, text_col).eqNullSafe(F.col(drop_which))
    rows = docs.select(*kept).join(drops, same, "left")
    rows = rows.select(*kept, keys)
    text_at, id_at = kept.index(text_col), kept.index(id_col)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped, digests = [], [], [], []
            for text, dropped in zip(batch.column(text_at), batch.column(len(kept))):
                lines, gone = _lines(text.as_py()), set(dropped.as_py() or ())
                left = [line for line in lines if line_key(line, min_chars) not in gone] if gone else lines
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                if digest_only:
                    digests.append(hashlib.sha256(b"\n".join(left)).hexdigest())
                else:
                    texts.append(text.as_py() if len(left) == len(lines) else b"\n".join(left).decode("utf-8", "surrogatepass"))
            counts = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            if digest_only:
                yield pa.RecordBatch.from_arrays([batch.column(id_at), *counts, pa.array(digests, pa.string())],
                                                 [id_col, "n_lines", "n_dropped", "kept_sha256"])
            else:
                columns = [pa.array(texts, pa.string()) if i == text_at else batch.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, *counts], [*kept, "n_lines", "n_dropped"])

    if digest_only:
        schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_lines bigint, n_dropped bigint, kept_sha256 string"
    else:
        schema = docs.select(*kept).withColumns({"n_lines": F.lit(0).cast("bigint"), "n_dropped": F.lit(0).cast("bigint")}).schema
    return rows.mapInArrow(rebuild, schema)
