"""Lookup, enrichment and key-based inclusion or exclusion."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin


def lookup(
    df: DataFrame,
    dim: DataFrame,
    left_key: str,
    right_key: str | None = None,
    cols: Sequence[str] | None = None,
    how: str = "left",
) -> DataFrame:
    """Add ``cols`` of ``dim`` to ``df``; the right key is not kept."""
    right_key = right_key or left_key
    cols = list(cols) if cols is not None else [c for c in dim.columns if c != right_key]
    side = dim.select(F.col(right_key).alias(left_key), *cols)
    return keyed_join(df, side, [left_key], how)


def enrich(base: DataFrame, lookups: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """A chain of left lookups, each given as (dimension, left key, right key)."""
    return reduce(lambda df, step: lookup(df, step[0], step[1], step[2]), lookups, base)


def exclude(df: DataFrame, bad: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``bad``; null keys stay."""
    on = [on] if isinstance(on, str) else list(on)
    return keyed_join(df, pin(bad.select(*on).distinct(), "keys"), on, "left_anti")


def restrict(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``."""
    on = [on] if isinstance(on, str) else list(on)
    return keyed_join(df, pin(keys.select(*on).distinct(), "keys"), on, "left_semi")


def missing_from(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``right`` with no partner in ``left``."""
    right_key = right_key or key
    return exclude(right, left.select(F.col(key).alias(right_key)), right_key)


def orphans(df: DataFrame, dim: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct keys of ``df`` that ``dim`` does not hold; both sides are reduced first."""
    known = dim.select(F.col(right_key).alias(left_key)).distinct()
    return df.select(left_key).distinct().join(known, left_key, "left_anti")


def suffix_columns(df: DataFrame, suffix: str) -> DataFrame:
    """Append ``suffix`` to every column name."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns})


def membership_count(df: DataFrame, flags: dict[str, Column], total: str = "memberships") -> DataFrame:
    """One 0/1 column per flag plus their sum."""
    df = df.withColumns({name: F.when(cond, 1).otherwise(0) for name, cond in flags.items()})
    return df.withColumn(total, sum((F.col(name) for name in flags), F.lit(0)))
