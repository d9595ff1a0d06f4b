"""Suffix dedup: fingerprints of sampled suffixes find long repeats, which are then cut to the byte.

No suffix arrays are kept: a logarithmic family of levels (fingerprint, count) tells which suffixes repeat at all and spares the others a shuffle; the repeats come from
grouping the sampled suffixes by fingerprint and context.

Suffixes are sampled by content, so that a string of ``WINDOW`` bytes has a sampled suffix at the same place wherever it stands: among the
``PREFIX``-byte strings inside it the one with the smallest hash. A level counts the fingerprints of that prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleet_engine.llm.common import KeyFilter
from fleet_engine.workspace import drop_folder, run_dir, staged

WINDOW = 200                 # bytes; a string of this length that starts anywhere else too is removed
PREFIX = 64                  # bytes by which suffixes are sampled and sorted
BACK = WINDOW - PREFIX       # a window begins at most so many bytes before its sampled suffix
BATCHES = 2                  # batches in which a table enters the family
SLICE = 1 << 20              # bytes handled by one vectorised step; longer texts are cut into overlapping slices
HOT = 16_000                 # contexts of one prefix that a task compares; with more, their windows are counted by Spark instead
PACK = 4_000                 # contexts per task, about
NONE = np.uint64(2 ** 64 - 1)
LOW = 1 << 32                # a span is one number, its first byte times LOW plus the byte behind it; a text has fewer than 2^31 bytes


_POWERS: list = []           # filled by each Python worker for itself


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random odd value per byte, and the powers of an odd base and of its inverse modulo 2^64."""
    if not _POWERS:
        base, size = 0x9E3779B97F4A7C15, SLICE + 8 * WINDOW
        with np.errstate(over="ignore"):
            up = np.cumprod(np.full(size, base, np.uint64))
            down = np.cumprod(np.full(size, pow(base, -1, 1 << 64), np.uint64))
        _POWERS.append((np.random.default_rng(20240102).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1), up, down))
    return _POWERS[0]


def _stir(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def _sliding(values: np.ndarray, width: int, fold) -> np.ndarray:
    """``fold`` (minimum or maximum) over every ``width`` consecutive values."""
    fill = NONE if fold is np.minimum else np.uint64(0)
    blocks = np.concatenate([values, np.full(-len(values) % width, fill, np.uint64)]).reshape(-1, width)
    ahead = fold.accumulate(blocks, 1).ravel()
    behind = fold.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return fold(behind[:n], ahead[width - 1:width - 1 + n])


def _sample(parts: list[bytes], bases: list[int], sizes: list[int], spans: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
    """(part, place in the text, fingerprint, context) of the sampled suffixes of texts or slices of texts.

    ``context`` stands for the bytes from ``BACK`` before to ``WINDOW`` after the place, as far as the text goes. A part is all there is to see of a text of
    ``sizes`` bytes from ``bases`` on; only places in ``spans`` are reported.
    """
    values, up, down = _powers()
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    raw = np.frombuffer(b"".join(parts), np.uint8)
    owner = np.repeat(np.arange(len(parts)), np.diff(starts))
    n = len(raw)
    if n < WINDOW:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[raw] * up[:n])])
        m = n - PREFIX + 1
        prints = _stir((sums[PREFIX:] - sums[:m]) * down[:m])
        prints[prints == NONE] = np.uint64(0)
        inside = owner[:m] == owner[PREFIX - 1:]
        key = np.where(inside, prints, NONE)
        smallest = _sliding(key, BACK + 1, np.minimum)
        whole = owner[:n - WINDOW + 1] == owner[WINDOW - 1:]
        # a place is sampled if some whole window around it has it as smallest: the largest of these minima is then its own value
        around = np.concatenate([np.zeros(BACK, np.uint64), np.where(whole, smallest, 0), np.zeros(BACK, np.uint64)])
        own = np.zeros(len(around), bool)
        own[BACK:BACK + len(whole)] = whole
        at = np.flatnonzero((_sliding(around, BACK + 1, np.maximum)[:m] == key) & inside)
        counts = np.concatenate([[0], np.cumsum(own)])
        at = at[counts[at + BACK + 1] > counts[at]]
        part = owner[at]
        place = at - starts[part] + np.array(bases)[part]
        span = np.array(spans)
        keep = (place >= span[part, 0]) & (place < span[part, 1])
        at, part, place = at[keep], part[keep], place[keep]
        low = np.maximum(place - BACK, 0) - place + at
        high = np.minimum(place + WINDOW, np.array(sizes)[part]) - place + at
        context = _stir(((sums[high] - sums[low]) * down[low]) ^ _stir((at - low).astype(np.uint64) * np.uint64(4099) + (high - at).astype(np.uint64)))
    return part, place, prints[at], context


def suffixes(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, place, fingerprint, context) of all sampled suffixes, some megabytes of text at a time."""
    margin = 2 * WINDOW
    parts, bases, sizes, spans, of, total = [], [], [], [], [], 0

    def flush():
        part, place, prints, context = _sample(parts, bases, sizes, spans)
        return np.array(of, np.int64)[part], place, prints, context

    for i, text in enumerate(texts):
        if len(text) < WINDOW:
            continue
        for low in range(0, len(text), SLICE):
            high = min(len(text), low + SLICE)
            piece = text[max(0, low - margin):high + margin]
            if parts and total + len(piece) > SLICE + 2 * margin:
                yield flush()
                parts, bases, sizes, spans, of, total = [], [], [], [], [], 0
            parts.append(piece)
            bases.append(max(0, low - margin))
            sizes.append(len(text))
            spans.append((low, high))
            of.append(i)
            total += len(piece)
    if parts:
        yield flush()


def _bytes(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) of slices of a column, about ``SLICE`` bytes each."""
    out, first, total = [], 0, 0
    for i, text in enumerate(column):
        value = (text.as_py() or "").encode("utf-8", "surrogatepass")
        if out and total + len(value) > SLICE:
            yield first, out
            out, first, total = [], i, 0
        out.append(value)
        total += len(value)
    if out:
        yield first, out


class SuffixLevels:
    """Levels of sampled suffixes (fingerprint, n) without places or text. A batch enters as a level of rank 0, is joined to
    the levels that exist, and two levels of one rank become one of the next: after b batches there are at most log2(b) + 1 levels, and each suffix
    was written as often at most."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, str]] = []
        self.scratch: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        path = run_dir(self.spark, "suffix-level")
        rows.groupBy("print").agg(F.sum("n").alias("n")).sortWithinPartitions("print").write.parquet(path)
        return path

    def add(self, batch: DataFrame) -> DataFrame:
        """Add the fingerprints (print) of a batch; returns the prints it shares with earlier batches or holds twice, once each."""
        path = self._write(batch.select("print", F.lit(1).cast("bigint").alias("n")))
        run = self.spark.read.parquet(path)
        found = run.filter("n > 1").select("print")
        for _, level in self.levels:
            found = found.unionByName(run.join(self.spark.read.parquet(level), "print", "left_semi").select("print"))
        found, folder = staged(found.distinct(), "suffix-matches")
        self.scratch.append(folder)
        self.levels.append((0, path))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((rank + 1, self._write(self.spark.read.parquet(a).unionByName(self.spark.read.parquet(b)))))
            drop_folder(self.spark, a)
            drop_folder(self.spark, b)
        return found

    def close(self) -> None:
        """Delete all levels and matches."""
        for path in [*(path for _, path in self.levels), *self.scratch]:
            drop_folder(self.spark, path)
        self.levels, self.scratch = [], []


def _windows_of(contexts: pd.Series, back: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bytes from window start to suffix, hash) of all whole windows of the contexts that hold their suffix's prefix."""
    values, up, down = _powers()
    sizes = contexts.map(len).to_numpy(np.int64)
    out, first = [], 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(np.cumsum(sizes[first:]), SLICE, "right")) + first)
        raw = np.frombuffer(b"".join(contexts.iloc[first:last]), np.uint8)
        starts = np.concatenate([[0], np.cumsum(sizes[first:last])[:-1]])
        n = np.maximum(0, np.minimum(sizes[first:last] - WINDOW, back[first:last]) + 1)      # windows begin at 0 .. back
        row = np.repeat(np.arange(last - first), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = starts[row] + step
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[raw] * up[:len(raw)])])
            out.append((row + first, back[first:last][row] - step, _stir((sums[at + WINDOW] - sums[at]) * down[at])))
        first = last
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, hot: int = HOT) -> DataFrame:
    """(_key, spans): for each text with repeated windows, the byte spans around its sampled suffixes that they cover, see ``LOW``. ``_key`` is a hash of id and text.

    The family of levels tells which prefixes repeat. Their suffixes are grouped by prefix and context: two equal contexts settle all windows around them at once,
    counted without the texts. Only where a prefix has several contexts, one of them single (the ends of a repeat), the bytes themselves are compared, one
    text place per different context. Prefixes with more than ``hot`` contexts do not meet in one task: their windows become rows that Spark counts.
    Each intermediate table is deleted when all that was computed from it is written.
    """
    spark, scratch = docs.sparkSession, []

    def stage(df: DataFrame, name: str) -> DataFrame:
        table, path = staged(df, name)
        scratch.append(path)
        return table

    def drop(first: int = 0) -> None:
        while len(scratch) > first:
            drop_folder(spark, scratch.pop())

    given = docs.select(_key(id_col, text_col), F.col(text_col).alias("_text"))
    family, found = SuffixLevels(spark), None

    def prints(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for _, texts in _bytes(batch.column(0)):
                for _, _, p, _ in suffixes(texts):
                    yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64))], ["print"])

    for i in range(batches):
        part = given.filter(F.pmod(F.xxhash64("_key"), F.lit(batches)) == i).select("_text").mapInArrow(prints, "print bigint")
        more = family.add(part)
        found = more if found is None else found.unionByName(more)
    has = KeyFilter(found, "print").has
    family.close()

    def entries(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, texts in _bytes(batch.column(1)):
                for of, place, p, context in suffixes(texts):
                    hit = np.flatnonzero(has(p))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(of[hit] + first)), pa.array(place[hit]), pa.array(p[hit].view(np.int64)), pa.array(context[hit].view(np.int64))],
                        ["_key", "place", "print", "context"])

    known = stage(given.mapInArrow(entries, "_key bigint, place bigint, print bigint, context bigint"), "suffixes")
    # the first key and the first place come from one row: both are taken or left together
    contexts = stage(known.groupBy("print", "context").agg(F.count(F.lit(1)).alias("n"), F.first("_key").alias("_key"), F.first("place").alias("place")), "contexts")
    groups = stage(contexts.groupBy("print").agg(F.count(F.lit(1)).alias("n_contexts"), F.min("n").alias("least"))
                   .filter("n_contexts > 1 and least = 1").select("print", "n_contexts"), "context-groups")
    asked = stage(contexts.join(groups, "print").groupBy("_key").agg(F.collect_list(F.struct("place", "print", "context", "n", "n_contexts")).alias("asks")), "context-asks")
    some = KeyFilter(asked, "_key").keep(given.filter(F.col("_text").isNotNull()), "_key")
    columns = ["print", "context", "n", "n_contexts", "back", "bytes"]

    def cut_contexts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for i, (text, asks) in enumerate(zip(batch.column(0), batch.column(1))):
                value = text.as_py().encode("utf-8", "surrogatepass")
                for a in asks.as_py():
                    low, high = max(0, a["place"] - BACK), min(len(value), a["place"] + WINDOW)
                    out.append((a["print"], a["context"], a["n"], a["n_contexts"], a["place"] - low, value[low:high]))
                if len(out) > 10_000 or (out and i == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*out))[:4]), pa.array([x[4] for x in out], pa.int32()),
                                                      pa.array([x[5] for x in out], pa.binary())], columns)
                    out = []

    # rows alike in id and text give the same bytes; settling counts a context once
    pieces = (some.hint("merge").join(asked, "_key").select("_text", "asks")
              .mapInArrow(cut_contexts, "print bigint, context bigint, n bigint, n_contexts bigint, back int, bytes binary"))
    size = groups.agg(F.sum("n_contexts").alias("n"), F.max("n_contexts").alias("most")).first()
    if size["most"] is None:
        ends = None
    else:
        small = pieces if size["most"] <= hot else stage(pieces, "context-bytes")
        packs = max(1, size["n"] // PACK)
        ends = (small.filter(F.col("n_contexts") <= hot).groupBy(F.pmod(F.xxhash64("print"), F.lit(packs)).alias("pack"))
                .applyInPandas(_settle, "print bigint, context bigint, least int, most int"))
        if size["most"] > hot:
            shared = stage(_shared_windows(small.filter(F.col("n_contexts") > hot)), "shared-windows")
            ends = ends.unionByName(_settle_hot(small.filter(F.col("n_contexts") > hot), shared))
    full = contexts.filter("n > 1").select("print", "context", F.lit(0).alias("least"), F.lit(BACK).alias("most"))
    marks, marks_at = staged(full if ends is None else ends.unionByName(full), "marks")
    drop(1)                         # all but the sampled suffixes
    scratch.append(marks_at)
    low, high = F.greatest(F.lit(0), F.col("place") - F.col("most")), F.col("place") - F.col("least") + WINDOW
    spans = known.join(marks, ["print", "context"]).select("_key", (low * LOW + high).alias("span"))
    found, _ = staged(spans.groupBy("_key").agg(F.collect_list("span").alias("spans")), "spans")
    drop()
    return found


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(id_col, text_col).alias("_key")


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """(print, context, least, most): for single contexts, how far before the suffix windows begin that another context of the same prefix has too."""
    pdf = pdf.drop_duplicates(["print", "context"]).reset_index(drop=True)
    row, d, h = _windows_of(pdf["bytes"], pdf["back"].to_numpy(np.int64))
    with np.errstate(over="ignore"):
        # equal windows at equal distance from equal prefixes
        key = _stir(h + _stir(pdf["print"].to_numpy(np.int64).view(np.uint64))[row] + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    low, high = np.full(len(pdf), 1 << 30), np.full(len(pdf), -1)
    np.minimum.at(low, row[twice], d[twice])
    np.maximum.at(high, row[twice], d[twice])
    kept = (high >= 0) & (pdf["n"].to_numpy() == 1)
    return pd.DataFrame({"print": pdf["print"][kept], "context": pdf["context"][kept], "least": low[kept].astype(np.int32), "most": high[kept].astype(np.int32)})


def _window_rows(pieces: DataFrame) -> DataFrame:
    """A row per window of the contexts."""
    def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                row, d, h = _windows_of(part.column(4).to_pandas(), part.column(3).to_numpy(zero_copy_only=False).astype(np.int64))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(take) for i in range(3)), pa.array(d.astype(np.int32)), pa.array(h.view(np.int64))],
                                                 ["print", "context", "n", "d", "window"])

    return (pieces.dropDuplicates(["print", "context"]).select("print", "context", "n", "back", "bytes")
            .mapInArrow(window_rows, "print bigint, context bigint, n bigint, d int, window bigint"))


def _shared_windows(pieces: DataFrame) -> DataFrame:
    """Windows that several contexts of a prefix have at one distance; combined in each task before the shuffle."""
    return (_window_rows(pieces).groupBy("print", "d", "window").agg(F.count(F.lit(1)).alias("m"))
            .filter("m > 1").select("print", "d", "window"))


def _settle_hot(pieces: DataFrame, shared: DataFrame) -> DataFrame:
    """The same as ``_settle`` for prefixes of very many contexts, by the windows that they share."""
    return (_window_rows(pieces).filter("n = 1").join(shared, ["print", "d", "window"]).groupBy("print", "context")
            .agg(F.min("d").alias("least"), F.max("d").alias("most")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, hot: int = HOT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row of ``docs``.

    Every byte is removed that a string of ``WINDOW`` bytes covers which also starts anywhere else, in the same text or another; strings are judged on the input.
    ``kept`` are the remaining bytes (a cut may fall inside a character). NULL and empty texts have no bytes. Repeated rows are repeats of each other.
    """
    spans = repeats(docs, id_col, text_col, batches, hot)
    given = docs.select(_key(id_col, text_col), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    marked = KeyFilter(spans, "_key")
    has = marked.has

    def result(ids, numbers, kept):
        digests = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
        return pa.RecordBatch.from_arrays([ids, *(pa.array([x[i] for x in numbers], pa.int64()) for i in range(3)), digests, pa.array(kept, pa.binary())], names)

    def whole(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            left = batch.filter(pa.array(~has(batch.column(0).to_numpy(zero_copy_only=False))))
            for first, texts in _bytes(left.column(2)):
                yield result(left.column(1).slice(first, len(texts)), [(len(t), 0, 0) for t in texts], texts)

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, texts in _bytes(batch.column(1)):
                numbers, kept = [], []
                for text, found in zip(texts, batch.column(2).slice(first, len(texts))):
                    runs = []
                    for low, high in (divmod(span, LOW) for span in sorted(found.as_py() or ())):
                        high = min(len(text), high)
                        if runs and low <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], high)
                        else:
                            runs.append([low, high])
                    edges = [0, *(x for run in runs for x in run), len(text)]
                    kept.append(b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2])))
                    numbers.append((len(text), len(text) - len(kept[-1]), len(runs)))
                yield result(batch.column(0).slice(first, len(texts)), numbers, kept)

    joined = marked.keep(given, "_key").hint("merge").join(spans, "_key", "left").select("_id", "_text", "spans")
    return given.mapInArrow(whole, schema).unionByName(joined.mapInArrow(cut, schema))
