"""Scoring of free text: summary, sentiment, class, answer, embedding.

The defaults are deterministic and run inside the JVM. They have the inputs, outputs and ranges of a model-backed score;
``operators.inference.complete_batch`` is where a real model is attached.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, IDFModel, Normalizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleet_engine.functions.text import explode_each, sentences, tokens
from fleet_engine.operators.skew import frequent_join, topk

# Words of the default lexicon.
POSITIVE_WORDS = ["good", "great", "excellent", "happy", "normal", "resolved", "fixed", "smooth", "quiet", "stable",
                  "reliable", "safe", "satisfied", "thanks", "improved", "clean"]
NEGATIVE_WORDS = ["bad", "poor", "angry", "failure", "failed", "fault", "broken", "misfire", "overheat", "leak",
                  "noise", "squealing", "vibrating", "unsafe", "worn", "stalled", "complains", "frustrated", "warning",
                  "critical"]

# Closed label set of fault categories with the words that vote for them; other notes are OTHER.
FAULT_RULES = {
    "ENGINE": ["engine", "misfire", "cylinder", "spark", "coolant", "overheat", "oil", "fuel", "injector", "piston"],
    "ELECTRICAL": ["battery", "alternator", "wiring", "fuse", "sensor", "voltage", "starter", "electrical"],
    "BRAKES": ["brake", "brakes", "braking", "pad", "pads", "rotor", "caliper", "abs"],
    "TRANSMISSION": ["transmission", "gear", "gearbox", "clutch", "shift", "torque"],
}


def document_frequency(df: DataFrame, text: str) -> DataFrame:
    """Documents per term. Each document contributes a term once, so counts combine before the shuffle."""
    return (explode_each(df, [], F.array_distinct(tokens(text)), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df")))


def with_idf(frequency: DataFrame, n_docs: Column) -> DataFrame:
    return frequency.withColumn("idf", F.log((n_docs + 1) / (F.col("df") + 1)))


def summarize(df: DataFrame, id: str, text: str, k: int = 1) -> DataFrame:
    """The ``k`` sentences whose words are rarest in the corpus on average, in text order; ties go to the earliest.

    Only (document, sentence, word) rows meet the term table; the texts themselves are read again by position.
    """
    docs = df.select(id, F.col(text).alias("_text")).filter(F.col("_text").isNotNull())
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    terms = with_idf(document_frequency(docs, "_text"), n_docs)
    words = explode_each(explode_each(docs, [id], sentences("_text"), "_sentence", "_pos"),
                         [id, "_pos"], tokens("_sentence"), "term")
    scored = (frequent_join(words, terms, "term", "df")
              .groupBy(id, "_pos").agg(F.round(F.avg("idf"), 6).alias("_score")))
    best = topk(scored, [id], [F.col("_score").desc(), F.col("_pos")], k, "_rank")
    picks = best.groupBy(id).agg(F.array_sort(F.collect_list("_pos")).alias("_picks"), F.max("_score").alias("score"))
    chosen = F.transform("_picks", lambda p: F.get(F.col("_sentences"), p))
    return (docs.join(picks, id, "left").withColumn("_sentences", sentences("_text"))
            .select(id, F.coalesce(F.array_join(chosen, ". "), F.lit("")).alias("summary"), "score"))


def _count_in(words: Column, listed: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*listed)))


def _polarity(pos: Column, neg: Column) -> Column:
    return F.when(pos + neg > 0, (pos - neg) / (pos + neg)).otherwise(F.lit(0.0))


def sentiment_column(words: Column) -> Column:
    """Sentiment of a word list by the built-in lexicon."""
    score = _polarity(_count_in(words, POSITIVE_WORDS), _count_in(words, NEGATIVE_WORDS))
    return F.round(F.coalesce(score, F.lit(0.0)), 6)


def sentiment(df: DataFrame, id: str, text: str, lexicon: DataFrame | None = None) -> DataFrame:
    """Score in [-1, 1]: (positive - negative) / (positive + negative), 0 without a listed word.

    The built-in word lists are evaluated row by row without a shuffle. A learned ``lexicon`` (term, weight, docs) joins the
    words of the texts; ``docs`` tells which terms are frequent.
    """
    if lexicon is None:
        return df.select(id, tokens(text).alias("_w")).select(id, sentiment_column(F.col("_w")).alias("sentiment"))
    words = explode_each(df, [id], tokens(text), "term")
    hits = frequent_join(words, lexicon, "term", "docs").select(id, "weight")
    every = df.select(id, F.lit(0.0).alias("weight"))          # texts without a listed word count as 0
    weight = F.col("weight")
    sums = hits.unionByName(every).groupBy(id).agg(F.sum(F.greatest(weight, F.lit(0.0))).alias("pos"),
                                                   F.sum(F.greatest(-weight, F.lit(0.0))).alias("neg"))
    return sums.select(id, F.round(_polarity(F.col("pos"), F.col("neg")), 6).alias("sentiment"))


def fit_lexicon(labelled: DataFrame, text: str, positive: str, clip: float = 3.0) -> DataFrame:
    """Term weights from texts with a boolean ``positive`` column: smoothed log-odds, clipped."""
    flags = labelled.agg(F.struct(F.count_if(positive).alias("p"), F.count_if(~F.col(positive)).alias("n"))).scalar()
    terms = (explode_each(labelled, [positive], F.array_distinct(tokens(text)), "term").groupBy("term")
             .agg(F.count_if(positive).alias("_in"), F.count_if(~F.col(positive)).alias("_out")))
    odds = F.log(((F.col("_in") + 1) / (F.col("_totals.p") + 2)) / ((F.col("_out") + 1) / (F.col("_totals.n") + 2)))
    return (terms.withColumn("_totals", flags)
            .select("term", F.round(F.greatest(F.lit(-clip), F.least(F.lit(clip), odds)), 6).alias("weight"),
                    (F.col("_in") + F.col("_out")).alias("docs")))


def category_votes(words: Column, rules: dict[str, list[str]], default: str = "OTHER") -> Column:
    """The label with most votes, first listed on a tie, ``default`` without a vote."""
    votes = F.array(*[F.struct(_count_in(words, listed).alias("n"), F.lit(-i).alias("order"), F.lit(label).alias("label"))
                      for i, (label, listed) in enumerate(rules.items())])
    top = F.array_max(votes)
    return F.when(top["n"] > 0, top["label"]).otherwise(F.lit(default))


def classify_keywords(df: DataFrame, id: str, text: str, rules: dict[str, list[str]] | None = None,
                      default: str = "OTHER") -> DataFrame:
    """Exactly one label of a closed set per text; evaluated row by row without a shuffle."""
    words = df.select(id, tokens(text).alias("_w"))
    return words.select(id, category_votes(F.col("_w"), rules or FAULT_RULES, default).alias("category"))


def _hashed(df: DataFrame, text: str, dim: int, out: str) -> DataFrame:
    words = df.withColumn("_words", F.coalesce(tokens(text), F.array().cast("array<string>")))
    return HashingTF(inputCol="_words", outputCol=out, numFeatures=dim).transform(words).drop("_words")


def fit_text_classifier(df: DataFrame, text: str, label: str, features: int = 1 << 14) -> PipelineModel:
    """Multinomial classifier over hashed words. Training passes hold class totals only."""
    data = _hashed(df, text, features, "_tf")
    index = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(data)
    bayes = NaiveBayes(featuresCol="_tf", labelCol="_label", predictionCol="prediction").fit(index.transform(data))
    return PipelineModel([index, bayes])


def apply_text_classifier(model: PipelineModel, df: DataFrame, id: str, text: str) -> DataFrame:
    """Predicted label per text; no label column is needed."""
    index, bayes = model.stages
    labels = F.array(*[F.lit(v) for v in index.labels])
    scored = bayes.transform(_hashed(df.select(id, text), text, bayes.numFeatures, "_tf"))
    return scored.select(id, F.get(labels, F.col("prediction").cast("int")).alias("predicted_label"))


def answer_column(text: str | Column, question: str | Column) -> Column:
    """``array<struct<answer,score>>``: the sentence that holds most of the question's words, empty without overlap."""
    asked = F.array_distinct(tokens(F.lit(question) if isinstance(question, str) else question))
    options = F.transform(sentences(text), lambda s, i: F.struct(
        F.size(F.array_intersect(asked, tokens(s))).alias("hits"), (-i).alias("order"), s.alias("answer")))
    empty = F.array().cast("array<struct<answer:string,score:double>>")

    def shown(best: Column) -> Column:
        score = F.round(best["hits"] / F.size(asked), 6)
        return F.when(best["hits"] > 0, F.array(F.struct(best["answer"].alias("answer"), score.alias("score")))).otherwise(empty)

    # as the one element of an array, so that each sentence is cut into words once and not at every mention of the best one
    return F.flatten(F.transform(F.array(F.array_max(options)), shown))


def extract_answer(df: DataFrame, id: str, text: str, question: str | Column) -> DataFrame:
    """Best answer per text; evaluated row by row without a shuffle."""
    return df.select(id, answer_column(text, question).alias("answers"))


def fit_embedding(df: DataFrame, text: str, dim: int = 768) -> IDFModel:
    """Corpus weights of the hashed words: one pass, ``dim`` numbers."""
    return IDF(inputCol="_tf", outputCol="_tfidf").fit(_hashed(df, text, dim, "_tf").select("_tf"))


def _unit_array(model: IDFModel, df: DataFrame) -> DataFrame:
    unit = Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0).transform(model.transform(df))
    return unit.withColumn("embedding", vector_to_array("_unit", "float32")).drop("_tf", "_tfidf", "_unit")


def embed_text(df: DataFrame, id: str, text: str, dim: int = 768, model: IDFModel | None = None,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Unit vector per text (hashed TF-IDF); texts without a word get zeros. Use one ``model`` for queries and corpus."""
    model = model or fit_embedding(df, text, dim)
    return _unit_array(model, _hashed(df.select(id, text, *keep), text, model.idf.size, "_tf")).select(id, *keep, "embedding")


def embed_groups(df: DataFrame, key: str, text: str, dim: int = 768, model: IDFModel | None = None) -> DataFrame:
    """Unit vector of all texts of a key together. Word counts add up, so the joined text is never built: every partition
    sends one vector per key, however many texts a key has."""
    model = model or fit_embedding(df, text, dim)
    hashed = _hashed(df.select(key, text), text, model.idf.size, "_tf")
    return _unit_array(model, hashed.groupBy(key).agg(Summarizer.sum(F.col("_tf")).alias("_tf"))).select(key, "embedding")
