"""Typed, trimmed, deduplicated tables from raw ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.functions.columns import apply_rule, standardize_columns
from panelmill.schema import ENTITIES, EntitySpec


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "columns") -> DataFrame:
    """Pass the frame on, or name everything that is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required {what}: {missing}")
    return df


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def dedupe(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by all remaining columns, NULL lowest.

    The choice is a total order, so every run keeps the same row. It is written
    as ``min(struct)`` rather than as a ranking window because an aggregate
    combines before the shuffle: a key that repeats in a third of all rows sends
    one row per input partition instead of landing whole in one task.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*[c if c in key else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def clean(raw: DataFrame, entity: str | EntitySpec) -> DataFrame:
    """Apply an entity's recipe: names, casts, required keys, one row per key."""
    spec = ENTITIES[entity] if isinstance(entity, str) else entity
    df = require_columns(standardize_columns(raw), list(spec.columns), f"{spec.name} columns")
    df = df.select(*[apply_rule(c, rule).alias(c) for c, rule in spec.columns.items()])
    df = not_null(df, spec.required)
    return dedupe(df, spec.key) if spec.key else df
