"""Benchmark decontamination: windows of a canonical template are hash-joined, then slots are checked for consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleet_engine.llm.common import free_name
from fleet_engine.workspace import fits, stage

WINDOW = 5               # template words per window
LEAST_WORDS = 3          # words of a window that must not be placeholders
COVERAGE = 0.5           # share of an item's windows that a document must hold
SLOT_CONFLICTS = 0.2     # share of an item's different slot values that may stand for more than one value
BAND = 16                # matches whose distance from the item's start differs by less than this belong to one passage
BROADCAST_WINDOWS = 1_000_000   # windows (hash, item, place, 5 words: under 150 bytes each) up to which the benchmark is broadcast

# Units that are slots after a number.
UNITS = ("kg g mg lb lbs oz ounces pounds grams kilograms km m cm mm mi miles meters metres kilometers kilometres feet ft inches yards s sec seconds min minutes "
         "h hours days weeks months years mph kmh percent dollars euros cents usd eur l ml liters litres gallons degrees celsius fahrenheit hz khz mhz ghz kb mb gb tb "
         "w kw volts amps joules kcal calories").split()


def tagged(text: Column) -> Column:
    """The text as words joined by blanks; slots keep their value behind a tag: ``n#`` numbers, ``u#`` units after a number, ``p#`` names.

    A name is a capitalised word that follows a lower-case word or a comma. Other capitalised words, as at the start of a sentence, may be names or not and have the
    tag ``s#``; words in capitals are plain words.
    """
    t = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("#"), F.lit(" ")), F.lit("_"), F.lit(" "))
    t = F.regexp_replace(t, r"\p{Lu}(?<=[\p{Ll},;] \p{Lu})\p{Ll}+", "p#$0")
    t = F.regexp_replace(t, r"\p{Lu}(?<![\p{L}0-9#]\p{Lu})\p{Ll}+", "s#$0")
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    digits = F.regexp_replace(t, r"(?<=[0-9])[.,](?=[0-9])", "_")
    digits = F.regexp_replace(digits, r"[0-9](?<![\p{L}0-9#_][0-9])[0-9_]*", "n#$0")
    digits = F.regexp_replace(digits, rf"(n#[0-9_]+) ?({units})(?![\p{{L}}0-9_])", "$1 u#$2")
    t = F.when(t.rlike("[0-9]"), digits).otherwise(t)
    return F.trim(F.regexp_replace(F.lower(t), r"[\x00-\x22\x24-\x2F\x3A-\x5E\x60\x7B-\x7F -⁯]+", " "))


def _reading(words: Column, names: bool) -> Column:
    """Tagged words with the capitalised words that may be names read as names, or as plain words."""
    return F.replace(words, F.lit("s#"), F.lit("p#" if names else ""))


def template(words: Column) -> Column:
    """Tagged words with the values of their slots taken out."""
    return F.when(F.contains(words, F.lit("#")), F.regexp_replace(words, "(?<![^ ])([npu])#[^ ]+", "#$1")).otherwise(words)


def _untagged(words: Column) -> Column:
    """Tagged words without their tags: the words as they stand in the text."""
    return F.when(F.contains(words, F.lit("#")), F.regexp_replace(words, "(?<![^ ])[npsu]#", "")).otherwise(words)


def _windows(n: Column, size: int | Column = WINDOW) -> Column:
    """Places of the windows of ``size`` words in ``n`` words; none below ``size`` words."""
    last = n - size
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _hashes(words: Column) -> Column:
    """One hash per word of a text."""
    return F.transform(F.split(words, " "), lambda w: F.xxhash64(w))


def _key(hashes: Column, n: int = WINDOW, start: Column | int = 0) -> Column:
    """Key of ``n`` word hashes from ``start`` on; places beyond the end are left out of it."""
    return F.xxhash64(*(F.get(hashes, start + F.lit(k)) for k in range(n)))


def _literal(hashes: Column, n: int = WINDOW, start: Column | int = 0) -> Column:
    """Key of a window of words with their values; never meant to equal that of a template."""
    return F.xxhash64(F.lit("words"), _key(hashes, n, start))


def item_templates(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(reading, item_id, literal, same, usable, values): one row per item and reading, under the smallest id of its template.

    Reading 0 takes capitalised words at the start of sentences for plain words, reading 1 for names. An item without a window of enough plain words has
    windows of its words with their values instead (``literal`` words each, else 0), one of all its
    words if they are fewer than ``WINDOW``. ``values`` has for each word the place (from 1) where the item has its slot's value first, 0 for a plain word: what
    a document must agree with is which slots are equal, not their values.
    """
    rows = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), tagged(F.col(text_col)).alias("_tagged")).filter("_tagged <> ''")
    both = F.array(*(F.struct(F.lit(i).alias("reading"), _reading(F.col("_tagged"), bool(i)).alias("words")) for i in (0, 1)))
    rows = rows.withColumn("_plain", template(_reading(F.col("_tagged"), False))).select("_id", "_plain", F.explode(both).alias("r"))
    rows = rows.select("_id", "_plain", "r.reading", F.col("r.words").alias("_words")).withColumn("_template", template(F.col("_words")))
    plain, first, raw = F.split("_template", " "), F.split("_plain", " "), F.split("_words", " ")
    at = F.transform(_windows(F.size(plain)), lambda i: F.struct(i.alias("pos"), F.slice(plain, i + 1, WINDOW).alias("w"), F.slice(first, i + 1, WINDOW).alias("first")))
    usable = F.filter(at, lambda x: F.size(F.filter(x["w"], lambda t: ~t.startswith("#"))) >= LEAST_WORDS)
    slots = lambda w: F.filter(F.transform(w, lambda t, k: F.when(t.startswith("#"), k)), lambda k: k.isNotNull())
    key = lambda w: _key(F.transform(w, lambda t: F.xxhash64(t)))
    keys = lambda x: F.array_distinct(F.array(key(x["w"]), key(x["first"])))
    rows = rows.withColumn("usable", F.transform(usable, lambda x: F.struct(x["pos"].alias("pos"), keys(x).alias("keys"), slots(x["w"]).alias("slots"))))
    rows = rows.filter("reading = 0 or size(usable) > 0")
    literal = F.when(F.size("usable") == 0, F.least(F.size(plain), F.lit(WINDOW))).otherwise(F.lit(0))
    values = F.transform(raw, lambda w: F.when(F.contains(w, F.lit("#")), F.array_position(raw, w).cast("int")).otherwise(F.lit(0)))
    rows = rows.withColumn("literal", literal).withColumn("same", F.when(F.col("literal") > 0, _untagged(F.col("_words"))).otherwise(F.col("_template")))
    rows = rows.withColumn("values", F.when(F.col("literal") == 0, values).otherwise(F.array().cast("array<int>")))
    return rows.select("reading", F.min("_id").over(Window.partitionBy("reading", "literal", "same")).alias("item_id"), "literal", "same", "usable", "values")


def item_windows(templates: DataFrame) -> DataFrame:
    """(h, reading, item_id, item_pos, n_windows, slots, literal) of items with different templates; ``slots`` are the places of slots in a window.

    A window of reading 1 also has the keys of its plain reading, since a document may have the words in other letters.
    """
    size, same = F.col("literal"), _hashes(F.col("same"))
    literal = F.transform(_windows(F.size(same), size), lambda i: F.struct(i.alias("pos"), F.array(_literal(F.slice(same, i + 1, size))).alias("keys"),
                                                                           F.array().cast("array<int>").alias("slots")))
    rows = templates.select("reading", "item_id", "literal", F.when(size > 0, literal).otherwise(F.col("usable")).alias("_at"))
    return (rows.select("reading", "item_id", "literal", F.explode("_at").alias("x"), F.size("_at").alias("n_windows"))
            .select(F.explode("x.keys").alias("h"), "reading", "item_id", F.col("x.pos").alias("item_pos"), "n_windows", "x.slots", "literal").distinct())


def _nearest(found: DataFrame, coverage: float) -> DataFrame:
    """``found`` with ``pairs`` (place in the item, word of the document) in place of ``hits``, one row per shift that a passage may have.

    An item that repeats a window meets other places of its own text within a band. The shift with most hits leads, and each that covers enough by itself; of each
    window of the item the hit nearest to it counts, so a copy is compared word for word.
    """
    shifts = F.array_distinct(F.col("hits.shift"))
    weights = F.transform(shifts, lambda s: F.struct(F.size(F.filter("hits", lambda h: h["shift"] == s)).alias("n"), s.alias("shift")))
    found = found.withColumn("_weights", F.when(F.size("hits") > F.col("n_matched"), weights))
    leading = F.filter("_weights", lambda w: (w["n"] == F.array_max("_weights")["n"]) | (w["n"] >= coverage * F.col("n_windows")))
    centres = F.when(F.col("_weights").isNull(), F.slice("hits.shift", 1, 1)).otherwise(F.transform(leading, lambda w: w["shift"]))
    keys = ["_doc", "reading", "item_id", "band", "centre"]
    same = ["n_windows", "n_matched", "coverage"]
    each = found.select(*keys[:-1], *same, "hits", F.explode_outer(centres).alias("centre")).select(*keys, *same, F.explode_outer("hits").alias("h"))
    near = F.struct(F.abs(F.col("h.shift") - F.col("centre")), "h.shift", "h.pairs")
    picked = each.groupBy(*keys, *same, F.col("h.item_pos").alias("item_pos")).agg(F.min(near)["pairs"].alias("pairs"))
    return picked.groupBy(*keys, *same).agg(F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", coverage: float = COVERAGE, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(id, item_id, n_windows, n_matched, n_slots, n_conflicts, coverage): documents that hold an item, as it is or with other values in its slots.

    A document holds an item if at least ``coverage`` of the item's windows stand in it at about the same distance from the item's start, and
    slot values agree: wherever the item repeats a value the document repeats one too, but for a share of ``SLOT_CONFLICTS``. Items of
    equal templates are reported under the smallest id, if the values agree with any of them. Capitalised words at the start of sentences are read twice, as
    plain words and as names; one reading that agrees is enough. Items of fewer than ``WINDOW`` words, or whose windows are mostly slots, are matched by their
    words with their values, in any case of letters: a short one must stand in the document whole. NULL and empty texts
    neither hold anything nor are held; NULL ids never appear. Repeated rows of an id count as one document.

    First every window of each whole text meets the windows of the items, by hash and without moving texts (a shuffle join where the items are many). Then
    only documents with a hit are read again, with their words. Counting is per document, item and place, so an item that a third of the documents
    hold is spread like the documents.
    """
    templates = stage(item_templates(items, item_id_col, item_text_col), "item-templates")
    bench, variants = stage(item_windows(templates), "item-windows"), stage(templates.select("reading", "item_id", "values").distinct(), "item-values")
    small = bench.limit(broadcast_windows + 1).count() <= broadcast_windows
    side = F.broadcast if small else (lambda df: df)
    words = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_doc"), tagged(F.col(text_col)).alias("_words"))

    lengths = sorted(r["literal"] for r in bench.filter("literal > 0").select("literal").distinct().collect())      # 1 to WINDOW at most

    def hashed(df: DataFrame, *keep: Column) -> DataFrame:
        """Each word is hashed once per reading; five neighbours make a key. Texts without a word that may be a name have one reading."""
        names = F.when(F.contains("_words", F.lit("s#")), _hashes(template(_reading(F.col("_words"), True)))).otherwise(F.array().cast("array<bigint>"))
        return df.select("_doc", _hashes(template(_reading(F.col("_words"), False))).alias("_plain"), names.alias("_names"),
                         *([_hashes(_untagged(F.col("_words"))).alias("_same")] if lengths else []), *keep)

    def windows(make) -> Column:
        """What ``make`` makes of the place, key, size and reading of every window: templates in both readings, then words where items need them."""
        def of(words: str, key, n: int, reading: int) -> Column:
            return F.transform(_windows(F.size(words), n), lambda i: make(i, key(F.col(words), n, i), n, reading))

        return F.concat(of("_plain", _key, WINDOW, 0), of("_names", _key, WINDOW, 1), *(of("_same", _literal, n, 0) for n in lengths))

    # the outer form keeps Spark from computing the array a second time for a filter below the explode
    keys = windows(lambda i, h, n, reading: h)
    seeds = hashed(words).select("_doc", F.explode_outer(keys if small else F.array_distinct(keys)).alias("h")).join(side(bench.select("h").distinct()), "h", "left_semi")
    found = stage(seeds.select("_doc").distinct(), "leak-candidates")

    again = hashed(words.join(found, "_doc", "left_semi"), F.split(_untagged(F.col("_words")), " ").alias("_all"))
    every = windows(lambda i, h, n, reading: F.struct(i.alias("pos"), h.alias("h"), F.lit(reading).alias("read"), F.slice("_all", i + 1, n).alias("doc_words")))
    every = again.select("_doc", F.explode_outer(every).alias("x")).select("_doc", "x.pos", "x.h", "x.read", "x.doc_words")
    hits = every.join(side(bench), "h").filter("reading >= read")
    pairs = F.transform("slots", lambda k: F.struct((F.col("item_pos") + k).alias("place"), F.get("doc_words", k).alias("value")))
    shift = F.col("pos") - F.col("item_pos")
    bands = F.array(F.floor(shift / BAND) * 2, F.floor((shift + BAND // 2) / BAND) * 2 + 1)
    grouped = (hits.select("_doc", "reading", "item_id", "n_windows", F.struct("item_pos", shift.alias("shift"), pairs.alias("pairs")).alias("hit"), F.explode(bands).alias("band"))
               .groupBy("_doc", "reading", "item_id", "band").agg(F.max("n_windows").alias("n_windows"), F.count_distinct("hit.item_pos").alias("n_matched"), F.collect_set("hit").alias("hits")))
    enough = grouped.withColumn("coverage", F.col("n_matched") / F.col("n_windows")).filter(F.col("coverage") >= coverage).transform(_nearest, coverage)
    # items of one template differ in which of their slots are equal: a document that agrees with any of them holds it
    tried = enough.join(F.broadcast(variants) if small and fits(variants, broadcast_windows) else variants, ["reading", "item_id"])
    tried = tried.withColumn("pairs", F.array_distinct(F.transform("pairs", lambda p: F.struct(F.get("values", p["place"]).alias("item"), p["value"].alias("doc")))))
    values = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    scored = tried.select("_doc", "item_id", F.col("n_windows").cast("bigint").alias("n_windows"), "n_matched", values.cast("bigint").alias("n_slots"),
                          (F.size("pairs") - values).cast("bigint").alias("n_conflicts"), "coverage")
    sure = scored.filter(F.col("n_conflicts") <= SLOT_CONFLICTS * F.col("n_slots"))
    best = F.max(F.struct("coverage", "n_matched", -F.col("n_conflicts"), "n_windows", "n_slots", "n_conflicts")).alias("b")
    return sure.groupBy("_doc", "item_id").agg(best).select(F.col("_doc").alias(id_col), "item_id", "b.n_windows", "b.n_matched", "b.n_slots", "b.n_conflicts", "b.coverage")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold an item; rows with a NULL id stay."""
    leak = free_name(docs, "_leak_id")
    dirty = stage(leaks(docs, items, id_col, text_col, **options).select(F.col(id_col).alias(leak)).distinct(), "leaks")
    return docs.join(dirty, F.col(id_col) == F.col(leak), "left_anti")
