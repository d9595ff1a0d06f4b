"""URL filters: fixed host and path rules, and for the other URLs the ratio of two character language models.

URLs that a rule accepts and URLs that a rule rejects each train a variable-order Markov model over UTF-8 bytes. All counts of all such URLs are
gathered by Spark into one table of 2^20 hashed grams, so what a task and the driver hold is bounded while the counts grow with the input.
A URL's score is the difference of the two log-likelihoods per byte; smoothing and the limit between accepted and rejected come from hosts held out of
the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleet_engine.llm.common import gram_hashes, mix, text_chunks

ALLOW, BLOCK = "allow", "block"
# fixed values: the rules of the registered query, as host and path
RULES = ((ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/"))
ORDER = 6              # longest gram, so contexts of up to 5 bytes
BITS = 20              # hashed grams: 2^20 counts for each class and fold
PRIORS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)   # weights of the next shorter context; the one that foretells held-out URLs best is used
FOLDS = 5              # one host in 5 is held out to calibrate
BINS = 64              # score bins per nat
FAR = 16               # scores beyond this many nats per byte share the outermost bin
START, END = 2, 3      # marks around a URL


@dataclass
class UrlModel:
    """Gram counts of the accepted (0) and the rejected (1) URLs, their symbols, the smoothing, and the least score of an accepted URL."""

    counts: np.ndarray
    symbols: tuple[int, int]
    prior: float
    limit: float

    @property
    def usable(self) -> bool:
        return min(self.symbols) > 0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for NULL and for a URL without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both NULL where none does. A rule fits its host and all subdomains where the path starts with
    the rule's; of equal rules with both verdicts the rejecting one counts."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0] == BLOCK)):
        at = rule.index("/")
        own, start = rule[:at], rule[at:]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(kind)).otherwise(verdict)
    return found, verdict


def _points(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all URLs, each between its marks, and where each begins."""
    coded = [bytes([START]) + (u or "").encode("utf-8", "surrogatepass") + bytes([END]) for u in urls]
    return np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64), np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)


def _grams(points: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order from 1, (URL number, bucket) of every gram by the place of its first byte."""
    return [(owner, mix(h, BITS)) for owner, h in gram_hashes(points, starts, range(1, ORDER + 1))]


def _held_out(host: Column) -> Column:
    return F.crc32(host) % FOLDS == 0


def count_grams(urls: DataFrame) -> DataFrame:
    """(bucket, side, n) over rows (url, side): each task counts in arrays of fixed size, and sends a row for each gram that it has met."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, np.ndarray] = {}
        for part, texts in text_chunks(batches, "url"):
            side = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in np.unique(side):
                total = sides.setdefault(int(s), np.zeros(1 << BITS, np.int64))
                for _, bucket in _grams(*_points([texts[i] for i in np.flatnonzero(side == s)])):
                    total += np.bincount(bucket, minlength=1 << BITS)
        for s, total in sides.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.full(len(at), s, np.int32)), pa.array(total[at])], ["bucket", "side", "n"])

    return urls.select("url", "side").mapInArrow(count, "bucket int, side int, n bigint").groupBy("bucket", "side").agg(F.sum("n").alias("n"))


def log_likelihoods(urls: list[str | None], counts: np.ndarray, symbols: tuple[int, int], priors: tuple[float, ...]) -> np.ndarray:
    """(prior, class, URL): the log-likelihood per byte.

    The chance of a byte after a context is (count + prior * chance after the context without its first byte) / (count of the context + prior);
    a context that a class has not seen leaves the shorter one's chance as it is, so each class uses contexts as long as it knows.
    """
    out = np.zeros((len(priors), 2, len(urls)))
    if not urls:
        return out
    points, starts = _points(urls)
    n, owner = len(points), np.repeat(np.arange(len(urls)), np.diff(starts))
    buckets = [b for _, b in _grams(points, starts)]
    places = [np.flatnonzero(owner[:n - k] == owner[k:]) for k in range(len(buckets))]    # first bytes of the grams of order k + 1
    for side in (0, 1):
        chances = np.full((len(priors), n), 1.0 / 256)          # by the place of the byte that is foretold
        seen = np.full(n, float(symbols[side]))
        for k, (bucket, first) in enumerate(zip(buckets, places)):
            own = np.zeros(n)
            own[first] = counts[side][bucket]
            context = seen[first]
            held = np.minimum(own[first], context)              # grams that share a bucket could count more than their context
            for chance, prior in zip(chances, priors):
                chance[first + k] = (held + prior * chance[first + k]) / (context + prior)
            seen = own
        for i, chance in enumerate(chances):
            value = np.log(chance)
            value[starts[:-1]] = 0.0                            # the mark at the start is given
            out[i, side] = np.bincount(owner, value, len(urls))
    return out / (np.diff(starts) - 1)


def best_limit(bins: np.ndarray, accepted: np.ndarray, rejected: np.ndarray) -> float:
    """The bin edge with the smallest sum of both classes' error shares; of equal ones the nearest to 0, then the smaller."""
    edges = np.arange(bins[0], bins[-1] + 2)                    # also those between bins without a URL
    below = lambda n: np.concatenate([[0], np.cumsum(np.bincount(bins - bins[0], n))])
    lost, passed = below(accepted) / accepted.sum(), 1 - below(rejected) / rejected.sum()
    order = np.lexsort((edges, np.abs(edges), np.round(lost + passed, 12)))
    return float(edges[order[0]]) / BINS


def train_urls(judged: DataFrame) -> UrlModel:
    """A model from all rows of (url, host, accepted). Rows with a NULL ``accepted`` are not used; without both classes the model is not usable.

    Smoothing and limit are found on the hosts that are held out, by a model of the others; then the counts of both are put together. Where a
    class has no host in one of the two parts the limit is 0 and the smoothing is the middle one.
    """
    side = F.when(F.col("accepted"), 0).otherwise(1) + F.when(_held_out(F.col("host")), 2).otherwise(0)
    known = judged.filter("accepted IS NOT NULL").select("url", side.cast("int").alias("side"))
    found = count_grams(known).toPandas()                     # at most 4 * 2^20 rows, whatever the input
    counts = np.zeros((4, 1 << BITS), np.int64)
    counts[found["side"].to_numpy(np.int64), found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    size = {r["side"]: r["n"] for r in known.groupBy("side").agg(F.sum(F.coalesce(F.octet_length("url"), F.lit(0)).cast("bigint") + 1).alias("n")).collect()}
    symbols = [size.get(s, 0) for s in range(4)]
    prior, limit = PRIORS[len(PRIORS) // 2], 0.0
    if min(symbols) > 0:
        prior, limit = _calibrate(known.filter("side >= 2"), counts[:2], (symbols[0], symbols[1]))
    return UrlModel(counts[:2] + counts[2:], (symbols[0] + symbols[2], symbols[1] + symbols[3]), prior, limit)


def _calibrate(held_out: DataFrame, counts: np.ndarray, symbols: tuple[int, int]) -> tuple[float, float]:
    """The smoothing that gives held-out URLs the largest likelihood under their own class, and the limit that parts the classes best with it."""
    shared = held_out.sparkSession.sparkContext.broadcast((counts, symbols))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, "url"):
            side = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64) - 2
            value = log_likelihoods(texts, *shared.value, PRIORS)
            bins = np.floor(np.clip(value[:, 0] - value[:, 1], -FAR, FAR) * BINS).astype(np.int32)
            own = np.take_along_axis(value, side[None, None, :], axis=1)[:, 0]
            for i in range(len(PRIORS)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(texts), i, np.int32)), pa.array(bins[i]), pa.array(side), pa.array(own[i])], ["prior", "bin", "side", "own"])

    scored = held_out.select("url", "side").mapInArrow(score, "prior int, bin int, side bigint, own double")
    bins = scored.groupBy("prior", "bin").agg(F.sum("own").alias("own"), F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("r")).toPandas()
    best = int(bins.groupby("prior")["own"].sum().idxmax())     # at most 7 * 2049 rows
    bins = bins[bins["prior"] == best].sort_values("bin")
    return PRIORS[best], best_limit(bins["bin"].to_numpy(np.int64), bins["a"].to_numpy(np.int64), bins["r"].to_numpy(np.int64))


def score_urls(urls: DataFrame, model: UrlModel, keep: tuple[str, ...], url_col: str = "url") -> DataFrame:
    """(*keep, score) per row, in the task that holds it; a NULL URL is read as an empty one."""
    shared = urls.sparkSession.sparkContext.broadcast((model.counts, model.symbols, (model.prior,)))    # 16 MB at any size of the data

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, "_url"):
            value = log_likelihoods(texts, *shared.value)[0]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(value[0] - value[1])], [*keep, "score"])

    source = urls.select(F.col(url_col).alias("_url"), *keep)
    return source.mapInArrow(score, urls.select(*keep).withColumn("score", F.lit(0.0)).schema)


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """(id, host, path, rule, verdict, score, threshold) of every row.

    ``rule`` is the longest rule that fits, else NULL, and its verdict holds. Otherwise the verdict is ``allow`` where ``score`` is at least
    ``threshold``; without accepted or without rejected URLs to learn from it is ``allow`` and both are NULL. NULL URLs and those without ``://``
    have an empty host and path, fit no rule and are scored as they stand. Repeated rows get equal results; an empty table gives none.
    """
    host, path = url_parts(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = parsed.withColumns({"rule": rule, "judged": verdict})
    model = train_urls(judged.select("url", "host", (F.col("judged") == ALLOW).alias("accepted")))
    kept = ("_id", "host", "path", "rule", "judged")
    if model.usable:
        scored = score_urls(judged, model, kept).withColumn("threshold", F.lit(model.limit))
    else:
        scored = judged.select(*kept, *(F.lit(None).cast("double").alias(c) for c in ("score", "threshold")))
    learnt = F.when(F.col("score") < F.col("threshold"), BLOCK).otherwise(ALLOW)
    return scored.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("judged", learnt).alias("verdict"), "score", "threshold")
