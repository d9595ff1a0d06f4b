"""Metrics layer: named dimensions and metrics over a table, business terms, stored questions."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleet_engine.functions.text import tokens
from fleet_engine.operators.skew import dim_join
from fleet_engine.workspace import stage


@dataclass(frozen=True)
class Dimension:
    expr: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Metric:
    expr: str
    where: str | None = None
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class StoredQuery:
    """A question with the SQL that answers it: tables as ``{name}``, parameters as ``:name``."""

    question: str
    sql: str
    tables: tuple[str, ...]
    args: dict[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Model:
    dimensions: dict[str, Dimension] = field(default_factory=dict)
    metrics: dict[str, Metric] = field(default_factory=dict)


# The two tables of the metrics layer and the stored questions.
FAULT_MODEL = Model(
    {"vehicle_vin": Dimension("vin_masked", ("car", "vehicle", "truck")),
     "component_issue": Dimension("target_component_extracted", ("broken part", "faulty component", "issue")),
     "fault_summary": Dimension("concise_fault_summary")},
    {"total_faults": Metric("count(fault_id)"),
     "high_frustration_faults": Metric("count(fault_id)", "driver_frustration_score < -0.5",
                                       ("angry customers", "critical complaints"))})
GOLD_MODEL = Model(
    {"vin": Dimension("vin_reference")},
    {"total_critical_errors": Metric("sum(total_critical_errors)", synonyms=("critical failures", "major errors")),
     "max_temperature": Metric("max(max_engine_temp_recorded)")})
VERIFIED_QUERIES = {
    "Most Frustrated Customers": "What are the summaries of the most frustrating vehicle faults?",
    "Critical Dealership Issues": "Which vehicles have the highest number of critical errors?",
}


def metric_query(model: Model, table: DataFrame, metrics: list[str], dims: list[str] = (), where: str | None = None,
                 order: list[Column] = (), limit: int | None = None) -> DataFrame:
    """Metrics by dimensions, both by name. A metric's own condition narrows that metric only."""
    unknown = [n for n in metrics if n not in model.metrics] + [n for n in dims if n not in model.dimensions]
    if unknown:
        raise ValueError(f"not in the model: {', '.join(unknown)}")
    rows = table.filter(where) if where else table
    wanted = []
    for name in metrics:
        m = model.metrics[name]
        wanted.append(F.expr(f"{m.expr} FILTER (WHERE {m.where})" if m.where else m.expr).alias(name))
    out = rows.groupBy(*[F.expr(model.dimensions[d].expr).alias(d) for d in dims]).agg(*wanted)
    if order:
        out = out.orderBy(*order)
    return out.limit(limit) if limit is not None else out


def _names(model: Model) -> dict[str, tuple[str, str]]:
    found = {}
    for kind, members in (("dimension", model.dimensions), ("metric", model.metrics)):
        for name, member in members.items():
            for term in (name, name.replace("_", " "), *member.synonyms):
                found.setdefault(term.lower(), (kind, name))
    return found


def resolve_terms(terms: DataFrame, model: Model, term: str = "term") -> DataFrame:
    """Business terms to (kind, name) of the model, NULL for unknown terms. The vocabulary is a literal map: no join."""
    pairs = [x for t, (kind, name) in _names(model).items()
             for x in (F.lit(t), F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name")))]
    found = F.try_element_at(F.create_map(*pairs), F.lower(F.trim(term)))
    return terms.withColumn("_m", found).select(*terms.columns, "_m.kind", "_m.name")


def match_verified(requests: DataFrame, verified: dict[str, str] | None = None, id: str = "request_id",
                   text: str = "question") -> DataFrame:
    """The stored question nearest to each request by word overlap (Jaccard), first name on a tie, NULL without overlap."""
    asked = F.array_distinct(F.col("_w"))
    options = []
    for i, (name, question) in enumerate(sorted((verified or VERIFIED_QUERIES).items())):
        known = F.array_distinct(tokens(F.lit(question)))
        share = F.size(F.array_intersect(asked, known)) / F.size(F.array_union(asked, known))
        options.append(F.struct(F.round(share, 6).alias("similarity"), F.lit(-i).alias("o"), F.lit(name).alias("name")))
    best = F.array_max(F.array(*options))
    rows = requests.select(id, tokens(text).alias("_w")).withColumn("_b", best)
    return rows.select(id, F.when(F.col("_b.similarity") > 0, F.col("_b.name")).alias("verified_query"),
                       F.coalesce("_b.similarity", F.lit(0.0)).alias("similarity"))


def run_verified(requests: DataFrame, stored: dict[str, StoredQuery], tables: dict[str, DataFrame], id: str = "request_id",
                 text: str = "question") -> DataFrame:
    """Requests with the rows of the stored query that matches them, each row as JSON in ``answer``.

    ``tables`` are those that the asking role may read (see ``role_views``). A stored query over a table that is not among them does not run: its requests, those
    without a match, and those whose query finds nothing keep one row with NULL. Each stored query runs once, however many ask it.
    """
    matched = match_verified(requests, {name: q.question for name, q in stored.items()}, id, text)
    spark, whole = requests.sparkSession, {"ignoreNullFields": "false"}
    results = []
    for name, q in sorted(stored.items()):
        if set(q.tables) <= set(tables):
            result = spark.sql(q.sql, args=q.args or None, **{t: tables[t] for t in q.tables})
            results.append(result.select(F.lit(name).alias("verified_query"), F.to_json(F.struct("*"), whole).alias("answer")))
    if not results:
        return matched.withColumn("answer", F.lit(None).cast("string"))
    answers = stage(reduce(DataFrame.unionByName, results), "verified-answers")
    return dim_join(matched, answers, "verified_query", id, how="left").select(id, "verified_query", "similarity", "answer")


def keyword_coverage(answers: DataFrame, cases: DataFrame, answer: str = "answer", keywords: str = "expected_keywords") -> DataFrame:
    """Share of a case's expected keywords that its answer mentions, whatever the case."""
    held = F.size(F.filter(keywords, lambda w: F.contains(F.lower(F.coalesce(F.col(answer), F.lit(""))), F.lower(w))))
    share = F.when(F.size(keywords) > 0, held / F.size(keywords))
    return (dim_join(answers, cases, "case_id", answers.columns)
            .select("case_id", held.alias("found"), F.size(keywords).alias("expected"), F.round(share, 6).alias("coverage")))
