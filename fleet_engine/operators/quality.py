"""Data-quality checks, suites and text rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleet_engine.functions.text import _col, explode_each
from fleet_engine.operators.clean import STAMP


@dataclass(frozen=True)
class Check:
    """A named check: ``failures`` builds an aggregate over the table, or ``keys`` must be unique."""

    name: str
    failures: Callable[[], Column] | None = None
    keys: tuple[str, ...] = ()


def expect_not_null(col: str) -> Check:
    return Check(f"not_null({col})", lambda: F.count_if(F.col(col).isNull()))


def expect_between(col: str, lo: float, hi: float) -> Check:
    """Values in [lo, hi]; NULL passes."""
    return Check(f"between({col},{lo:g},{hi:g})", lambda: F.count_if(~F.col(col).between(lo, hi)))


def expect_row_count(lo: int, hi: int) -> Check:
    return Check(f"row_count({lo},{hi})", lambda: F.when(F.count(F.lit(1)).between(lo, hi), 0).otherwise(1).cast("long"))


def expect_unique(*cols: str) -> Check:
    return Check(f"unique({','.join(cols)})", keys=cols)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, NULL keys left out."""
    present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check (check, failures, passed). All aggregate checks share one pass over the table; a uniqueness check
    adds a grouping of its own."""
    parts = []
    simple = [c for c in checks if c.failures is not None]
    if simple:
        row = df.agg(*[c.failures().alias(f"c{i}") for i, c in enumerate(simple)])
        parts.append(row.select(F.inline(F.array(*[
            F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").cast("long").alias("failures"))
            for i, c in enumerate(simple)]))))
    for c in checks:
        if c.failures is None:
            parts.append(duplicates(df, list(c.keys)).agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(c.name).alias("check"), "failures"))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def suite_gate(report: DataFrame) -> DataFrame:
    """One row: failed checks and whether the suite passed."""
    return report.agg(F.count_if(~F.col("passed")).alias("failed_checks"),
                      F.bool_and("passed").alias("passed"))


def expect_schema(df: DataFrame, types: dict[str, str] | None = None, ordered: list[str] | None = None,
                  names: set[str] | None = None) -> DataFrame:
    """Schema violations (check, column, expected, actual), from metadata without a job."""
    actual = dict(df.dtypes)
    found = []
    for col, kind in (types or {}).items():
        if actual.get(col) != kind:
            found.append(("type", col, kind, actual.get(col)))
    if ordered is not None and df.columns != list(ordered):
        found.append(("ordered_columns", None, ",".join(ordered), ",".join(df.columns)))
    for col in sorted((names or set()) ^ set(df.columns)) if names is not None else []:
        found.append(("column_set", col, "present" if col in names else "absent", "present" if col in actual else "absent"))
    return df.sparkSession.createDataFrame(found, "check string, column string, expected string, actual string")


def null_metric(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_if(F.col(col).isNull()).alias("null_count"), F.count(F.lit(1)).alias("n_rows"))


def freshness(df: DataFrame, ts: str, max_age: str, as_of: str) -> DataFrame:
    """Newest row and whether it is younger than ``max_age`` at ``as_of``; an empty table is stale."""
    bound = F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL {max_age}")
    return df.agg(F.date_format(F.max(ts), STAMP).alias("newest"),
                  F.coalesce(F.max(ts) >= bound, F.lit(False)).alias("fresh"))


def _searched(line: Column, comment: str | None) -> Column:
    return F.regexp_replace(line, f"{comment}.*$", "") if comment else line


def scan_rules(docs: DataFrame, rules: dict[str, str], id: str = "doc_id", text: str = "text",
               comment: str | None = None) -> DataFrame:
    """Lines that break a rule (id, line_no, rule, line). ``rules`` maps names to patterns, matched in any case;
    ``comment`` is a pattern whose match starts a comment. Rules are literals: one pass over the lines, no join."""
    lines = explode_each(docs, [id], F.split(_col(text), "\\r?\\n"), "_line", "_pos")
    body = _searched(F.col("_line"), comment)
    broken = F.array_compact(F.array(*[F.when(F.rlike(body, F.lit(f"(?i){pattern}")), F.lit(name))
                                       for name, pattern in rules.items()]))
    found = explode_each(lines, [id, "_pos", "_line"], broken, "rule")
    return found.select(id, (F.col("_pos") + 1).alias("line_no"), "rule", F.trim("_line").alias("line"))


def require_rules(docs: DataFrame, rules: dict[str, str], id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that lack a required pattern (id, rule)."""
    absent = F.array_compact(F.array(*[F.when(~F.coalesce(F.rlike(_col(text), F.lit(f"(?i){pattern}")), F.lit(False)), F.lit(name))
                                       for name, pattern in rules.items()]))
    return explode_each(docs, [id], absent, "rule")
