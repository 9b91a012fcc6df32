"""Ordered operators: numbering, running totals, shares and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.operators.scale import keyed_join, null_safe_key, prefix_sums
from tallyfield.session import pin


def number_rows(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[Column | str],
    out: str = "row_num",
    max_group: int | None = None,
) -> DataFrame:
    """1, 2, 3 … within each partition; a large partition is spread over many tasks.

    With an empty ``part`` all rows are numbered in one sequence.
    """
    return prefix_sums(df, part, order, {out: F.lit(1).cast("bigint")}, max_group)


def running_sum(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[Column | str],
    cols: dict[str, str],
    bounded: bool = False,
    max_group: int | None = None,
) -> DataFrame:
    """Running sums, ``cols`` maps new name to summed column.

    ``bounded`` is for tables already aggregated to a few rows per partition
    (such as one per year), which need no measuring.
    """
    if not bounded:
        return prefix_sums(df, part, order, {out: F.col(c) for out, c in cols.items()}, max_group)
    frame = (
        Window.partitionBy(*part)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumns({out: F.sum(c).over(frame) for out, c in cols.items()})


def histogram(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Rows per value of ``col``, written once as several steps read it."""
    return pin(df.groupBy(col).agg(F.count(F.lit(1)).alias(out)), "histogram")


def cumulative_share(
    df: DataFrame, count_col: str, total: Column | float, out: str = "cumulative_share"
) -> DataFrame:
    """Running share of ``total``, largest counts first; equal counts share one value.

    The running sum is taken over the histogram of ``count_col`` and joined
    back, so rows are never sorted in one place. The sum runs over rows of
    ``df``; it exceeds 1 when ``total`` is smaller than the sum of the counts.
    """
    steps = histogram(df, count_col, "_n")
    steps = prefix_sums(
        steps, [], [F.desc(count_col)], {"_sum": F.col(count_col) * F.col("_n")}
    ).select(count_col, (F.col("_sum") / total).alias(out))
    return keyed_join(df, steps, [count_col], "left")


def ecdf(df: DataFrame, col: str) -> DataFrame:
    """(value, n, ecdf): share of rows at or below each value."""
    steps = histogram(df.select(F.col(col).alias("value")), "value")
    total = steps.agg(F.sum("n").alias("t")).scalar()
    steps = prefix_sums(steps, [], ["value"], {"_upto": F.col("n")})
    return steps.select("value", "n", (F.col("_upto") / total).alias("ecdf"))


def rank_size(df: DataFrame, col: str) -> DataFrame:
    """(value, n, first_rank, last_rank): places taken by each value, largest first."""
    steps = histogram(df.select(F.col(col).alias("value")), "value")
    steps = prefix_sums(steps, [], [F.desc("value")], {"last_rank": F.col("n")})
    first = (F.col("last_rank") - F.col("n") + 1).alias("first_rank")
    return steps.select("value", "n", first, "last_rank")


def top_k_per_group(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[Column | str],
    k: int,
    out: str = "rank",
    ties: str = "row_number",
) -> DataFrame:
    """The first ``k`` rows of each group.

    ``ties='row_number'`` keeps exactly ``k`` (give a total order): the limit is
    applied on the map side, so at most ``k`` rows per group and task move; a
    ``k`` too large for that is cut from the sliced numbering.
    ``ties='rank'`` keeps every row tied with the k-th; ranks are worked out on
    the distinct order values, ``k`` at most per group, and joined back.
    """
    part = list(part)
    if ties == "row_number":
        if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
            return number_rows(df, part, order, out).filter(F.col(out) <= k)
        w = Window.partitionBy(*part).orderBy(*order)
        return df.withColumn(out, F.row_number().over(w).cast("bigint")).filter(F.col(out) <= k)
    column, descending = _order_name(order)
    values = df.groupBy(*part, column).agg(F.count(F.lit(1)).alias("_n"))
    key = F.desc_nulls_last(column) if descending else F.asc_nulls_first(column)
    w = Window.partitionBy(*part).orderBy("_place")
    before = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1))
    ranks = (
        top_k_per_group(values, part, [key], k, "_place")
        .withColumn(out, F.coalesce(before, F.lit(0)) + 1)
        .filter(F.col(out) <= k)
        .drop("_place", "_n")
    )
    # Written once: the join measures the ranks before it reads them.
    ranks = pin(ranks, "ranks")
    same = null_safe_key(df, [*part, column])
    found = keyed_join(df.withColumn("_key", same), ranks.select(same.alias("_key"), out), ["_key"], "inner")
    return found.select(*df.columns, out)


def _order_name(order: Sequence[Column | str | tuple[str, bool]]) -> tuple[str, bool]:
    """The single order column of a rank as (name, descending)."""
    if len(order) != 1 or isinstance(order[0], Column):
        raise ValueError("ties='rank' takes one order column, as name or (name, descending)")
    return order[0] if isinstance(order[0], tuple) else (order[0], False)


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of the whole table; give a total order."""
    return df.orderBy(*order).limit(n)


def arg_max(df: DataFrame, by: str, part: Sequence[str] = (), tie_break: Sequence[str] = ()) -> DataFrame:
    """The row with the largest ``by``, overall or per group; ties go to the smallest ``tie_break``."""
    rows = df.filter(F.col(by).isNotNull())
    order = [F.desc(by), *tie_break]
    if not part:
        return rows.orderBy(*order).limit(1)
    return top_k_per_group(rows, part, order, 1, "_place").select(*df.columns)
