"""Logistic regression on sparse hashed features: a bounded labelled sample, one training task, scoring wherever the rows are."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Triples = tuple[np.ndarray, np.ndarray, np.ndarray]   # owner (text number), bucket, value


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit_logistic(owner: np.ndarray, bucket: np.ndarray, value: np.ndarray, y: np.ndarray, size: int, l2: float, rounds: int,
                 rate: float, balance: bool = True) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise log loss plus ``l2`` |w|^2 / 2, by full-batch gradient steps with per-weight step sizes."""
    n = len(y)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, n - y.sum())) if balance else np.full(n, 1.0 / max(1, n))
    w, m, v, b, mb, vb = np.zeros(size), np.zeros(size), np.zeros(size), 0.0, 0.0, 0.0
    for t in range(1, rounds + 1):
        miss = (sigmoid(np.bincount(owner, w[bucket] * value, n) + b) - y) * share
        g, gb = np.bincount(bucket, miss[owner] * value, size) + l2 * w, miss.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = rate / (1 + 2 * t / rounds)
        w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        b -= step * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.99 ** t)) + 1e-9)
    return w, float(b)


def fit_platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn a margin into a probability, from rows the weights were not fitted on (Newton steps, smoothed targets)."""
    pos, neg = y.sum(), len(y) - y.sum()
    if not pos or not neg:
        return 1.0, 0.0
    target, a, b = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2)), 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * margin + b)
        q, d = np.maximum(p * (1 - p), 1e-9), p - target
        h = np.array([[np.sum(q * margin * margin) + 1e-6, np.sum(q * margin)], [np.sum(q * margin), np.sum(q) + 1e-6]])
        da, db = np.linalg.solve(h, [np.sum(d * margin) + 1e-6 * (a - 1), np.sum(d)])
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int) -> DataFrame:
    """(id, text, label): at most ``per_class`` labelled documents of each class, picked by a hash of their id.

    An id with several labels takes the largest, with several texts the largest. The picks are at most 2 * ``per_class`` ids, so they
    are broadcast and the texts are not shuffled, except those of the picks.
    """
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label")))
    picks = None
    for value in (0, 1):
        some = known.filter(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picks = some if picks is None else picks.unionByName(some)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull())
    return texts.join(F.broadcast(picks), "_id").groupBy("_id").agg(F.max("_text").alias("_text"), F.max("_label").alias("_label"))


def fit_in_one_task(sample: DataFrame, features: Callable[[list[str]], Triples], fit: Callable[[Triples, np.ndarray, np.ndarray], bytes],
                    ) -> bytes:
    """Features are computed where the sample's rows are; one task fits the model and hands back its bytes."""
    def extract(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at:at + 256]
                owner, bucket, value = features(part["_text"].tolist())
                ends = np.searchsorted(owner, np.arange(len(part) + 1))
                yield pd.DataFrame({
                    "_id": part["_id"].astype(str).tolist(), "_label": part["_label"].tolist(),
                    "_bucket": [bucket[i:j].astype(np.int32).tobytes() for i, j in zip(ends, ends[1:])],
                    "_value": [value[i:j].astype(np.float32).tobytes() for i, j in zip(ends, ends[1:])]})

    def train(batches):
        ids, labels, buckets, values = [], [], [], []
        for pdf in batches:
            ids += pdf["_id"].tolist()
            labels += pdf["_label"].tolist()
            buckets += [np.frombuffer(x, np.int32) for x in pdf["_bucket"]]
            values += [np.frombuffer(x, np.float32) for x in pdf["_value"]]
        order = sorted(range(len(ids)), key=ids.__getitem__)     # the same model whatever order the rows arrive in
        if order:
            owner = np.repeat(np.arange(len(order)), [len(buckets[i]) for i in order])
            triples = (owner, np.concatenate([buckets[i] for i in order]), np.concatenate([values[i] for i in order]))
        else:
            triples = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32))
        yield pd.DataFrame({"model": [fit(triples, np.array([labels[i] for i in order], float), np.array([ids[i] for i in order]))]})

    rows = sample.select(F.col("_id").cast("string").alias("_id"), "_text", "_label").mapInPandas(
        extract, "_id string, _label int, _bucket binary, _value binary")
    found = rows.repartition(1).mapInPandas(train, "model binary").first()
    return bytes(found["model"]) if found else fit((np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)),
                                                   np.zeros(0), np.zeros(0, str))
