"""Splits and resampling that give the same rows on any cluster.

Every draw is a hash of the row's key and a seed. Sizes come from aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import hash_uniform
from tallyfield.operators.running import number_rows
from tallyfield.operators.scale import keyed_join, null_safe_key
from tallyfield.session import pin


def keep_fraction(df: DataFrame, p: float, seed: int, key: Sequence[str]) -> DataFrame:
    """Rows whose draw is below ``p``."""
    return df.filter(hash_uniform(*key, seed=seed) < p)


def random_split(
    df: DataFrame, weights: Sequence[float], seed: int, key: Sequence[str]
) -> list[DataFrame]:
    """Disjoint parts that together hold every row, in the proportion of ``weights``."""
    total = float(sum(weights))
    edges, run = [0.0], 0.0
    for w in weights:
        run += w / total
        edges.append(run)
    edges[-1] = 1.0
    draw = hash_uniform(*key, seed=seed)
    return [df.filter((draw >= lo) & (draw < hi)) for lo, hi in zip(edges, edges[1:])]


def stratified_split(
    df: DataFrame,
    cls: str,
    fraction: float | dict,
    key: Sequence[str],
    seed: int,
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(chosen, rest) by class.

    Approximate: a row is chosen by its own draw, so the rest needs no join.
    Exact: rows of a class are numbered in draw order and those with a number
    below ``class rows x fraction`` are chosen.
    """
    share = _share(cls, fraction)
    if not exact:
        draw = hash_uniform(cls, *key, seed=seed)
        return df.filter(draw < share), df.filter(draw >= share)
    # A null class is a class like any other.
    same = null_safe_key(df, [cls])
    sizes = df.groupBy(same.alias("_key")).agg(F.count(F.lit(1)).alias("_size"))
    numbered = number_rows(
        df.withColumn("_draw", hash_uniform(*key, seed=seed)), [cls], ["_draw", *key], "_row"
    ).withColumn("_key", same)
    marked = keyed_join(numbered, pin(sizes, "sizes"), ["_key"], "left")
    chosen = F.coalesce(F.col("_row") < F.col("_size") * share, F.lit(False))
    extra = ["_draw", "_row", "_size", "_key"]
    return marked.filter(chosen).drop(*extra), marked.filter(~chosen).drop(*extra)


def _share(cls: str, fraction: float | dict) -> Column:
    if not isinstance(fraction, dict):
        return F.lit(float(fraction))
    share = F.lit(0.0)
    for value, f in fraction.items():
        share = F.when(F.col(cls) == F.lit(value), float(f)).otherwise(share)
    return share


def downsample(
    df: DataFrame, cls: str, majority, ratio: float, key: Sequence[str], seed: int
) -> DataFrame:
    """Keep majority rows with probability ``min(1, ratio x others / majority)``."""
    is_major = F.col(cls).eqNullSafe(F.lit(majority))
    sizes = df.agg(
        F.least(
            F.lit(1.0), F.try_divide(F.lit(float(ratio)) * F.count_if(~is_major), F.count_if(is_major))
        ).alias("p")
    )
    return df.filter(~is_major | (hash_uniform(*key, seed=seed) < sizes.scalar()))


def upsample(
    df: DataFrame, cls: str, minority, n: int, p: float, key: Sequence[str], seed: int
) -> DataFrame:
    """Repeat minority rows: ``n`` draws per row, one copy for each draw above ``p``."""
    is_minor = F.col(cls).eqNullSafe(F.lit(minority))
    tries = F.when(is_minor, F.sequence(F.lit(1), F.lit(n))).otherwise(F.array(F.lit(0)))
    copies = df.withColumn("_try", F.explode(tries))
    kept = ~is_minor | (hash_uniform(*key, "_try", seed=seed) > p)
    return copies.filter(kept).drop("_try")


def class_weights(df: DataFrame, cls: str, weights: dict, out: str = "weight") -> DataFrame:
    """A weight per row looked up by class; null for a class without one."""
    weight = F.lit(None).cast("double")
    for value, w in weights.items():
        weight = F.when(F.col(cls) == F.lit(value), float(w)).otherwise(weight)
    return df.withColumn(out, weight)


def per_group_split(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    every: int = 5,
    remainder: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """(train, test): every ``every``-th row of each group goes to the test part.

    ``remainder=1`` tests rows 1, 6, 11 … and so at least one row in ``every``;
    a group with one row stays in train. ``remainder=0`` tests rows 5, 10 …
    """
    numbered = number_rows(df, group, order, "row_num")
    test = F.col("row_num") % every == remainder
    if remainder == 1:
        same = null_safe_key(df, group)
        sizes = df.groupBy(same.alias("_key")).agg(F.count(F.lit(1)).alias("_size"))
        lone = sizes.filter(F.col("_size") == 1).select("_key", F.lit(True).alias("_lone"))
        numbered = keyed_join(numbered.withColumn("_key", same), pin(lone, "lone"), ["_key"], "left")
        test = test & F.col("_lone").isNull()
        extra = ["_lone", "_key"]
        return numbered.filter(~test).drop(*extra), numbered.filter(test).drop(*extra)
    return numbered.filter(~test), numbered.filter(test)


def cold_keys(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Keys found in only one part, with a ``missing_from`` column naming the other."""
    a, b = train.select(key).distinct(), test.select(key).distinct()
    return (
        b.join(a, key, "left_anti")
        .withColumn("missing_from", F.lit("train"))
        .unionByName(a.join(b, key, "left_anti").withColumn("missing_from", F.lit("test")))
    )
