"""Grouped and whole-table summaries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import is_blank, ratio
from tallyfield.operators.tiles import correlation_tiles

WIDE = 100


def distinct_per_group(df: DataFrame, group: Sequence[str], value: str, out: str = "n") -> DataFrame:
    """Distinct values per group; pairs are reduced before they are counted."""
    return df.groupBy(*group).agg(F.count_distinct(value).alias(out))


def share_of_total(df: DataFrame, by: Sequence[str], out: str = "share") -> DataFrame:
    """Rows per group and their share of all rows."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn(out, ratio("n", counts.agg(F.sum("n").alias("t")).scalar()))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows per category, in no order."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def flag_counts(df: DataFrame, flag: str, out: str = "n") -> DataFrame:
    """Rows per flag value, flagged rows only."""
    return df.filter(~is_blank(flag)).groupBy(flag).agg(F.count(F.lit(1)).alias(out))


def quality_profile(df: DataFrame, key: Sequence[str], bad_flag: str) -> DataFrame:
    """Good, bad and all rows per key with both shares, in one pass."""
    good = F.count_if(is_blank(bad_flag))
    total = F.count(F.lit(1))
    return (
        df.groupBy(*key)
        .agg(good.alias("good"), (total - good).alias("bad"), total.alias("all_rows"))
        .withColumn("good_share", ratio("good", "all_rows"))
        .withColumn("bad_share", ratio("bad", "all_rows"))
    )


def presence(df: DataFrame, keys: Sequence[str], element: str, wanted: Sequence[str]) -> DataFrame:
    """One row per key with a ``has_<element>`` flag per wanted element.

    The state per key is one boolean per element, however many rows the key has.
    """
    rows = df.filter(F.col(element).isin(list(wanted)))
    flags = [F.max(F.col(element) == w).alias(f"has_{w}") for w in wanted]
    return rows.groupBy(*keys).agg(*flags)


def active_span(df: DataFrame, keys: Sequence[str], first: str, last: str) -> DataFrame:
    """Earliest ``first`` and latest ``last`` per key."""
    return df.groupBy(*keys).agg(F.min(first).alias("first"), F.max(last).alias("last"))


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max), one row per column.

    Few columns become one wide aggregate. A wide table is turned to (position,
    value) rows, which combine on the map side, as thousands of aggregate
    expressions would not compile.
    """
    cols = list(cols)
    if len(cols) > WIDE:
        values = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])))
        names = df.sparkSession.createDataFrame(list(enumerate(cols)), "pos int, column string")
        # From the names, so that a table without rows still has a row per column.
        return names.join(values.groupBy("pos").agg(*_moments(F.col("col"))), "pos", "left").select(
            "column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "stddev", "min", "max"
        )
    row = df.agg(*[F.struct(*_moments(F.col(c).cast("double"))).alias(c) for c in cols])
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(c)[m].alias(m) for m in ("count", "mean", "stddev", "min", "max")],
        )
        for c in cols
    ]
    return row.select(F.inline(F.array(*lines)))


def _moments(c: Column) -> list[Column]:
    return [
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    ]


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col_1, col_2, r) for every pair of columns; rows with a missing value are left out.

    The matrix of few columns is summed by MLlib and listed here; that of more than ``WIDE`` is
    summed in tiles, and its pairs stay rows (``correlation_tiles``).
    """
    cols = list(cols)
    if len(cols) > WIDE:
        return correlation_tiles(df, cols)
    assembler = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="skip")
    matrix = Correlation.corr(assembler.transform(df.select(*cols)), "_v").first()[0].toArray()
    rows = [
        (cols[i], cols[j], float(matrix[i, j])) for i, j in combinations(range(len(cols)), 2)
    ]
    return df.sparkSession.createDataFrame(rows, "col_1 string, col_2 string, r double")


def correlation_pairs(
    df: DataFrame, cols: Sequence[str], min_abs: float = 0.7, absolute: bool = True
) -> DataFrame:
    """Column pairs whose correlation is above a threshold, in absolute value by default."""
    r = F.abs("r") if absolute else F.col("r")
    return correlations(df, cols).filter(~F.isnan("r") & (r > min_abs))


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, columns, rows) for each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.lit(len(df.columns)).alias("columns"), "rows"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
