"""Masking, privacy tags and role views."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tag name, its levels, the roles that see vehicle numbers and what others see.
TAG = "data_privacy_level"
LEVELS = ("SENSITIVE", "CONFIDENTIAL", "PUBLIC")
PRIVILEGED_ROLES = ("ACCOUNTADMIN", "CORTEX_DEV_ROLE")
MASK = "***-MASKED-VIN-***"


@dataclass(frozen=True)
class Policy:
    """Who sees the value of a column, and the constant that everyone else sees."""

    roles: tuple[str, ...] = PRIVILEGED_ROLES
    mask: str = MASK

    def column(self, col: Column, role: str) -> Column:
        return F.when(F.lit(role).isin(*self.roles), col).otherwise(F.lit(self.mask))


def apply_masks(df: DataFrame, policies: dict[str, Policy], role: str) -> DataFrame:
    """The table as ``role`` sees it. The role is a literal, so the plan holds either the column or the mask."""
    return df.withColumns({c: p.column(F.col(c).cast("string"), role) for c, p in policies.items()})


def tag(df: DataFrame, col: str, level: str) -> DataFrame:
    """Mark a column with a privacy level, kept in the schema."""
    if level not in LEVELS:
        raise ValueError(f"unknown privacy level: {level}")
    return df.withMetadata(col, {**df.schema[col].metadata, TAG: level})


def tagged_columns(df: DataFrame, level: str | None = None) -> dict[str, str]:
    found = {f.name: f.metadata[TAG] for f in df.schema if TAG in f.metadata}
    return {c: v for c, v in found.items() if level in (None, v)}


def mask_tagged(df: DataFrame, role: str, policy: Policy = Policy()) -> DataFrame:
    """Mask every SENSITIVE column."""
    return apply_masks(df, {c: policy for c in tagged_columns(df, "SENSITIVE")}, role)


def tag_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Tagged columns of all tables with their non-NULL counts; one aggregate per table."""
    parts = []
    for name, df in tables.items():
        marks = tagged_columns(df)
        if marks:
            counts = df.agg(*[F.count(c).alias(c) for c in marks])
            parts.append(counts.select(F.inline(F.array(*[
                F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(level).alias("level"),
                         F.col(c).alias("non_null")) for c, level in marks.items()]))))
    if not parts:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "table_name string, column_name string, level string, non_null long")
    return reduce(DataFrame.unionByName, parts)


def role_views(tables: dict[str, DataFrame], grants: dict[str, list[str]], policies: dict[str, dict[str, Policy]],
               role: str, publish: bool = True) -> dict[str, DataFrame]:
    """The tables granted to ``role``, masked for it, as temp views ``<role>__<table>``. Others do not exist for the role."""
    views = {}
    for name in grants.get(role, []):
        seen = mask_tagged(apply_masks(tables[name], policies.get(name, {}), role), role)
        if publish:
            seen.createOrReplaceTempView(f"{role.lower()}__{name}")
        views[name] = seen
    return views
