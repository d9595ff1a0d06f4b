"""Toxicity: a linear classifier on character n-grams, each scaled by its naive Bayes log-count ratio."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.llm.common import gram_hashes, joined, mix, text_chunks
from fleet_engine.llm.linear import fit_in_one_task, fit_logistic, labelled_sample, sigmoid

BITS = 20              # hashed feature space
ORDERS = (4, 5)        # characters per n-gram
PER_CLASS = 2_500      # labelled documents of each class that the classifier is fitted on, at most
ALPHA = 0.5            # added to the counts of naive Bayes
LEAST_WEIGHT = 0.05     # n-grams with less than this share of the largest weight are left out
LEAST_DOCS = 3         # an n-gram of fewer labelled documents has no weight


def normal(text: str | None) -> str:
    """Lower case, one blank between words and at both ends; nothing for NULL, empty or blank texts."""
    words = (text or "").lower().split()
    return f" {' '.join(words)} " if words else ""


def grams(texts: list[str | None], live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of the different n-grams of each text; with ``live``, of buckets that it marks."""
    points, starts = joined([normal(t) for t in texts])
    keys = []
    for owner, h in gram_hashes(points, starts, ORDERS):
        bucket = mix(h, BITS)
        if live is not None:
            kept = live[bucket]
            owner, bucket = owner[kept], bucket[kept]
        keys.append((owner << BITS) | bucket)
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _features(texts):
    owner, bucket = grams(texts)
    return owner, bucket, np.ones(len(owner), np.float32)


def _fit(triples, y, ids) -> bytes:
    """Weights per bucket: log-count ratio times fitted weight. Without both classes all weights are 0 and the bias is the class."""
    owner, bucket, _ = triples
    size = 1 << BITS
    if not len(y) or y.min() == y.max():
        return pickle.dumps((np.zeros(size, np.float32), 6.0 if len(y) and y[0] == 1 else -6.0))
    toxic = y[owner] == 1
    p, q = np.bincount(bucket[toxic], minlength=size) + ALPHA, np.bincount(bucket[~toxic], minlength=size) + ALPHA
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[p + q - 2 * ALPHA < min(LEAST_DOCS, max(1, len(y) // 20))] = 0.0
    for rounds in (40, 80):      # all n-grams first, then those whose weight is worth keeping
        used = np.flatnonzero(ratio[bucket])
        owner, bucket = owner[used], bucket[used]
        w, b = fit_logistic(owner, bucket, ratio[bucket], y, size, l2=1e-3, rounds=rounds, rate=0.02)
        weights = w * ratio
        ratio[np.abs(weights) < LEAST_WEIGHT * np.abs(weights).max()] = 0.0
    weights = (w * ratio).astype(np.float32)
    return pickle.dumps((weights, b))


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   per_class: int = PER_CLASS) -> bytes:
    """A model from the labelled documents: at most ``per_class`` of each class, picked by a hash of the id, whole texts."""
    return fit_in_one_task(labelled_sample(docs, labels, id_col, text_col, label_col, per_class), _features, _fit)


def score_toxicity(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, score): the probability of label 1 for each row, from its whole text.

    NULL, empty and blank texts have no n-gram and get the score of the bias alone. Repeated rows get equal scores; very long texts are one
    vector each. Rows pass through a task in slices of a bounded number of characters; there is no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [id_col, *keep]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = pickle.loads(shared.value)
        live = weights != 0
        for part, texts in text_chunks(batches, text_col):
            owner, bucket = grams(texts, live)
            margin = np.bincount(owner, weights[bucket], len(texts)) + bias
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(columns))), pa.array(sigmoid(margin))], [*columns, "score"])

    schema = docs.select(*columns).withColumn("score", F.lit(0.0)).schema
    return docs.select(*columns, text_col).mapInArrow(score, schema)
