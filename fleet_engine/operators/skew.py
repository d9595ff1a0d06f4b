"""Joins and groupings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleet_engine.workspace import BROADCAST_BYTES, fits, stage

HOT_ROWS = 200_000     # a key with fewer rows than this never needs splitting
HOT_KEYS = 1_000       # the most frequent keys; any other key holds under 1/1000 of the rows
SALTS = 64
FREQUENT_SHARE = 1e-5  # at most 100,000 keys can each hold this share


def key_counts(df: DataFrame, key: str, name: str = "n_rows") -> DataFrame:
    """Rows per key; combined before the shuffle, so a hot key costs one row per input partition."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def hot_keys(counts: DataFrame, key: str, weight: str = "n_rows", min_rows: int = HOT_ROWS) -> list:
    """The at most ``HOT_KEYS`` heaviest keys, as values: their number does not grow with the data."""
    rows = counts.filter(F.col(weight) >= min_rows).orderBy(F.col(weight).desc(), F.col(key)).limit(HOT_KEYS)
    return [r[0] for r in rows.select(key).collect()]


def salted_join(facts: DataFrame, dim: DataFrame, key: str, spread: str | list[str], counts: DataFrame | None = None,
                weight: str = "n_rows", how: str = "inner", min_rows: int = HOT_ROWS, salts: int = SALTS,
                hot: list | None = None) -> DataFrame:
    """Join many ``facts`` rows to the ``dim`` rows of their key, splitting the hot keys over ``salts`` tasks.

    ``how`` is ``inner`` or ``left`` (facts kept). The keys are counted first. Rows of a hot or NULL key are then spread by a
    hash of ``spread`` and only the dim rows of hot keys are repeated; without hot keys the join is an ordinary one.
    ``counts`` names the rows per key, or ``hot`` the keys to split, where the caller already has them.
    """
    if hot is None:
        hot = hot_keys(counts if counts is not None else key_counts(facts, key), key, weight, min_rows)
    if not hot and how == "inner":
        return facts.join(dim, key)
    spread = [spread] if isinstance(spread, str) else spread
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    slots = F.array([F.lit(i) for i in range(salts)]) if hot else F.array(F.lit(0))
    split = F.col(key).isin(hot) if hot else F.lit(False)
    left = facts.withColumn("_salt", F.when(F.col(key).isNull() | split, salt).otherwise(F.lit(0)))
    right = dim.withColumn("_salt", F.explode(F.when(split, slots).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def dim_join(facts: DataFrame, dim: DataFrame, key: str, spread: str | list[str], how: str = "inner",
             max_rows: int = 10_000) -> DataFrame:
    """Join ``facts`` to a dimension: by broadcast when its measured rows and bytes are few, else by a salted shuffle join."""
    if fits(dim, max_rows):
        return facts.join(F.broadcast(dim), key, how)
    return salted_join(facts, dim, key, spread, how=how)


def frequent_join(facts: DataFrame, dim: DataFrame, key: str, weight: str, share: float = FREQUENT_SHARE,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join of very many ``facts`` rows (words of texts) to one ``dim`` row per key, mostly without a shuffle.

    ``dim`` is written once and measured. Up to ``broadcast_bytes`` it is broadcast. A larger one is split: the keys with at
    least ``share`` of the total of ``weight`` (rows or texts that hold the key) cover nearly all facts and are broadcast, at
    most 1 / ``share`` keys however large the data; only facts of rarer keys are shuffled, and none of those keys is hot.
    """
    dim = stage(dim, "keys")
    size = dim.agg(F.sum(F.octet_length(F.col(key).cast("string")) + 8 * len(dim.columns)).alias("bytes"),
                   F.sum(weight).alias("weight")).first()
    if (size["bytes"] or 0) <= broadcast_bytes:
        return facts.join(F.broadcast(dim), key)
    frequent = F.broadcast(dim.filter(F.col(weight) >= size["weight"] * share))
    rare = dim.filter(F.col(weight) < size["weight"] * share)
    direct = facts.join(frequent, key)
    shuffled = facts.join(F.broadcast(frequent.select(key)), key, "left_anti").join(rare, key)
    return direct.unionByName(shuffled)


def with_page(df: DataFrame, key: str, order: str, page_rows: int, page: str = "page", seq: str = "seq") -> DataFrame:
    """Number the rows of each key from 0 in ``order`` (``seq``) and cut them into contiguous pages of ``page_rows`` rows.

    No key is gathered in one task: rows are ranged by key and order, numbered inside each range, and a key that goes on in the next
    range continues its numbers there. Equal values of ``order`` follow a hash of the row; NULL is a key of its own. ``df`` is sampled
    for the ranges and should be a written table.
    """
    ranged = df.withColumn("_tie", F.xxhash64(*df.columns)).repartitionByRange(key, order, "_tie")
    parts = stage(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    goes_on = (parts.groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_off", F.sum("_n").over(before)).filter("_off > 0").drop("_n"))
    inside = Window.partitionBy("_part", key).orderBy(order, "_tie")
    # a range has one key at most that began in an earlier one: a row per shuffle partition
    return (parts.join(F.broadcast(goes_on), (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k")), "left")
            .withColumn(seq, F.row_number().over(inside) - 1 + F.coalesce("_off", F.lit(0)))
            .withColumn(page, F.floor(F.col(seq) / page_rows).cast("int")).select(*df.columns, seq, page))


def topk(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key. Spark cuts each partition to ``k`` rows per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
