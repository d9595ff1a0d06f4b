"""Quality rules: plain counts with fixed limits, and a calibrated logistic regression on hashed word and character n-grams."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.llm.common import gram_hashes, joined, mix, text_chunks
from fleet_engine.llm.linear import fit_in_one_task, fit_logistic, fit_platt, labelled_sample, sigmoid

BITS = 18
PER_CLASS = 4_000       # labelled documents of each class that the classifier is fitted on, at most
KEEP_FROM = 0.35        # a document stays if its probability of quality 1 is at least this
LEAST_WORDS = 50        # fixed limits of the plain rules
MOST_REPEATED = 50      # per cent of words in repeated windows
SCALE = 40.0            # share of n-grams -> feature value
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text; all 0 for NULL and empty texts."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()        # bytes.split() cuts at [\x20\x09-\x0D] only
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        found, until = Counter(windows), 0
        for i, window in enumerate(windows):
            if found[window] > 1:
                repeated += i + 3 - max(i, until)
                until = i + 3
    lines, dup = text.split("\n"), 0
    if len(set(lines)) < len(lines):
        seen = set()
        for line in lines:
            if line in seen:
                dup += 1
            elif line.strip(SPACES):
                seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup, repeated)


def word_hashes(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word, and the word number at which each text begins."""
    space = (points == 32) | ((points >= 9) & (points <= 13))
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    word = np.flatnonzero(~space)
    if not len(word):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    first = np.ones(len(word), bool)
    first[1:] = (np.diff(word) > 1) | (np.diff(owner[word]) > 0)
    begin = np.flatnonzero(first)
    place = np.arange(len(word)) - np.repeat(begin, np.diff(np.append(begin, len(word))))
    with np.errstate(over="ignore"):
        code = (points[word] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ (place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        code = (code ^ (code >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        hashes = np.add.reduceat(code ^ (code >> np.uint64(32)), begin)
    return hashes, np.searchsorted(owner[word[begin]], np.arange(len(starts)))


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all n-grams, one pair of arrays for each kind: 1 to 3 characters, 1 and 2 words.

    A pair of equal words counts as one and the same word pair whatever the word, so that runs of a word are seen.
    """
    points, starts = joined([t or "" for t in texts])
    for owner, h in gram_hashes(points, starts, (1, 2, 3)):
        yield owner, mix(h, BITS)
    words, begins = word_hashes(points, starts)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    yield owner, mix(words + np.uint64(11), BITS)
    if len(words) > 1:
        inside = owner[1:] == owner[:-1]
        with np.errstate(over="ignore"):
            pair = np.where(words[1:] == words[:-1], np.uint64(77), words[:-1] * np.uint64(0x100000001B3) + words[1:])
        yield owner[1:][inside], mix(pair[inside] + np.uint64(13), BITS)


def _features(texts):
    """Share of each bucket among the text's n-grams of its kind."""
    keys, values = [], []
    for owner, bucket in grams(texts):
        key, n = np.unique((owner << BITS) | bucket, return_counts=True)
        keys.append(key)
        values.append(n * SCALE / np.maximum(1, np.bincount(owner, minlength=len(texts)))[key >> BITS])
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    return key[order] >> BITS, key[order] & ((1 << BITS) - 1), value[order].astype(np.float32)


def margins(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    """The linear score without bias. It is linear in the shares, so no text's n-grams need to be sorted or counted."""
    out = np.zeros(len(texts))
    for owner, bucket in grams(texts):
        out += np.bincount(owner, weights[bucket], len(texts)) * SCALE / np.maximum(1, np.bincount(owner, minlength=len(texts)))
    return out


def _fit(triples, y, ids) -> bytes:
    """Weights from four fifths of the sample, calibration from the rest. Without both classes every probability is 1 (no verdict)."""
    owner, bucket, value = triples
    size = 1 << BITS
    if not len(y) or y.min() == y.max():
        return pickle.dumps((np.zeros(size, np.float32), 0.0, 1.0, 50.0))
    fold = (mix(np.array([int.from_bytes(i.encode()[-8:], "little") for i in ids], np.uint64), 16) % 5 == 0) if len(y) >= 100 else np.zeros(len(y), bool)
    if fold.any() and (y[~fold].min() == y[~fold].max() or y[fold].min() == y[fold].max()):
        fold[:] = False
    train = ~fold[owner]
    number = np.cumsum(~fold) - 1
    w, b = fit_logistic(number[owner[train]], bucket[train], value[train], y[~fold], size, l2=1e-5, rounds=100, rate=0.05)
    margin = np.bincount(owner, w[bucket] * value, len(y)) + b
    slope, shift = fit_platt(margin[fold], y[fold]) if fold.any() else (1.0, 0.0)
    return pickle.dumps((w.astype(np.float32), b, slope, shift))


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  per_class: int = PER_CLASS) -> bytes:
    """A model from the labelled documents: at most ``per_class`` of each class, picked by a hash of the id, whole texts."""
    return fit_in_one_task(labelled_sample(docs, labels, id_col, text_col, label_col, per_class), _features, _fit)


COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def quality_rules(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                  keep_from: float = KEEP_FROM) -> DataFrame:
    """(id, *keep, the five counts, base_failed, probability, kept) for each row, from its whole text, without a shuffle.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``base_failed``: fewer than 50 words, or more than half of them in three-word windows found twice or
    more. ``kept``: not base_failed and probability >= ``keep_from``. NULL and empty texts have no words and fail. Repeated rows get equal results.
    ``keep`` names further columns of ``docs``; one that is named like a result must be renamed by the caller.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = list(dict.fromkeys([id_col, *keep]))
    carried = list(dict.fromkeys([*columns, text_col]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, slope, shift = pickle.loads(shared.value)
        for part, texts in text_chunks(batches, text_col):
            plain = np.array([counts(t) for t in texts], np.int64).reshape(-1, 5)
            probability = sigmoid(slope * (margins(texts, weights) + bias) + shift)
            failed = (plain[:, 0] < LEAST_WORDS) | (100 * plain[:, 4] > MOST_REPEATED * plain[:, 0])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(carried.index(c)) for c in columns), *(pa.array(plain[:, i]) for i in range(5)),
                 pa.array(failed), pa.array(probability), pa.array(~failed & (probability >= keep_from))],
                [*columns, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept"])

    zero = F.lit(0).cast("bigint")
    schema = docs.select(*columns).withColumns({
        **{c.split()[0]: zero for c in COUNTS.split(", ")}, "base_failed": F.lit(True), "probability": F.lit(0.0), "kept": F.lit(True)}).schema
    return docs.select(*carried).mapInArrow(judge, schema)
