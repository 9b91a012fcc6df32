"""De-duplication and differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import row_key

COPIES_PER_CHUNK = 100_000


def dedupe_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` values.

    ``min`` of a struct combines on the map side, so a key with many copies
    never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    lead = [c for c in order if c not in keys]
    packed = F.min(F.struct(*lead, *rest)).alias("_row")
    return df.groupBy(*keys).agg(packed).select(*keys, "_row.*").select(*df.columns)


def multiset_difference(
    a: DataFrame, b: DataFrame, copies_per_chunk: int = COPIES_PER_CHUNK
) -> DataFrame:
    """Rows of ``a`` minus rows of ``b``, counting copies.

    Counts are combined before the shuffle. The copies left over are emitted in
    chunks that are spread over tasks, as one row may be left millions of times.
    """
    cols = a.columns
    signed = a.withColumn("_n", F.lit(1)).unionByName(b.select(*cols).withColumn("_n", F.lit(-1)))
    left_over = signed.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n > 0")
    chunks = left_over.withColumn(
        "_chunk",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / copies_per_chunk))),
    )
    spread = chunks.repartition(*cols, "_chunk")
    size = F.least(F.lit(copies_per_chunk), F.col("_n") - F.col("_chunk") * copies_per_chunk)
    return spread.select(
        *cols, F.explode(F.sequence(F.lit(1).cast("bigint"), size.cast("bigint"))).alias("_copy")
    ).select(*cols)


def count_distinct(df: DataFrame, cols: Sequence[str], rsd: float | None = None) -> DataFrame:
    """Number of distinct rows over ``cols``, nulls counted as values; approximate when ``rsd`` is given."""
    if rsd is not None:
        return df.agg(F.approx_count_distinct(row_key(df, cols), rsd).alias("n"))
    return df.agg(F.count_distinct(F.struct(*cols)).alias("n"))
