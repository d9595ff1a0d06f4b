"""Helpers shared by the corpus operators: tables, Arrow row streams, hashed n-grams over many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_CHARS = 1 << 20   # characters handled by one vectorised step
FILTER_BITS = 26       # a key filter is a bitmap of 2^26 bits, 8 MB at any size of the data


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted`` or a variant of it that no column of ``df`` has, compared without case as Spark does."""
    taken, name = {c.lower() for c in df.columns}, wanted
    while name.lower() in taken:
        name += "_"
    return name


def text_chunks(batches: Iterable[pa.RecordBatch], column: str, chars: int = TASK_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with their texts as a list (None stays None); a slice holds about ``chars`` characters, or one text."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > chars:
                yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start), texts.slice(start).to_pylist()


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after the other, and where each text begins (one more entry for the end)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return points, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)


def mix(h: np.ndarray, bits: int) -> np.ndarray:
    """The upper ``bits`` of a multiplicative hash of 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def gram_hashes(points: np.ndarray, starts: np.ndarray, orders: Iterable[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, (text number, 64-bit hash) of every n-gram of consecutive values inside one text."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    wanted, h = set(orders), points
    with np.errstate(over="ignore"):
        for n in range(1, max(wanted) + 1):
            if n > len(points):
                return
            if n > 1:
                h = h[:-1] * np.uint64(0x100000001B3) + points[n - 1:]
            if n in wanted:
                inside = owner[:len(h)] == owner[n - 1:]
                yield owner[:len(h)][inside], h[inside] + np.uint64(n * 0x51ED2701)


def segment_sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n) if len(values) else np.zeros(n)


class KeyFilter:
    """Which 64-bit hashes are worth a shuffle: a bitmap of fixed size by their upper bits, sent to all tasks before a join.

    It never misses a key. Where the keys are so many that most bits are set, it stops sparing rows and the join alone decides, as it does anyway.
    """

    def __init__(self, rows: DataFrame, key: str):
        bit = F.shiftrightunsigned(key, 64 - FILTER_BITS)
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit").bitwiseAND(63).cast("int"))
        words = (rows.select(bit.alias("_bit")).groupBy(F.shiftrightunsigned("_bit", 6).cast("int").alias("w")).agg(F.bit_or(one).alias("b"))).toPandas()
        bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)     # at most 2^20 words reach the driver
        bits[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64)
        self.bits = rows.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    def has(self, keys: np.ndarray) -> np.ndarray:
        bit = keys.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
        return ((self.bits.value[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)

    def keep(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of ``df`` whose long column ``key`` may be among the keys."""
        at, has = df.columns.index(key), self.has

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(has(batch.column(at).to_numpy(zero_copy_only=False))))

        return df.mapInArrow(pick, df.schema)
