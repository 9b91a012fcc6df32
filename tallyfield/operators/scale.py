"""Joins and numbering that hold when one key owns a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.functions.columns import row_key
from tallyfield.session import pin

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 1_000_000
WINDOW_ROWS = 1_000_000
NULL_SALTS = 1024
#: Keys that are salted at most, and keys the sketch of hot keys remembers.
HOT_KEYS = 10_000
SKETCH_KEYS = 100_000


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df``: true only when its rows and bytes are within the limits."""
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        elif isinstance(field.dataType, T.BinaryType):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        elif isinstance(field.dataType, T.UserDefinedType):
            # A vector: its text form is at least as long as half its bytes.
            width = width + 2 * F.octet_length(F.col(field.name).cast("string")) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(field.name))) + 16
        else:
            width = width + 8
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def null_safe_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """One never-null key for columns that may hold nulls; 0.0 and -0.0 are equal, microseconds count."""
    return row_key(df, cols)


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Equi-join in which no (key, salt) group holds many more than ``hot_rows`` left rows.

    Keys with more left rows are spread over ``ceil(rows / hot_rows)`` salts and
    the right rows of just those keys are repeated once per salt. ``hot_keys``
    finds them in one pass without a shuffle of the rows; its table is bounded.
    ``how`` may be inner, left, left_semi or left_anti.
    """
    on = list(on)
    right = _same_types(left, right, on)
    # A join column or a carried one may have any name, so names in use are passed by.
    key, salts, salt, spreads = (_unused(n, left, right) for n in ("_key", "_salts", "_salt", "_spread"))
    hot = hot_keys(left, on, hot_rows).withColumnsRenamed({"_key": key, "_salts": salts})
    # Row content spreads the rows of one partition, the partition id spreads
    # identical copies over the cluster; both are the same on a retry.
    spread = F.xxhash64(*left.columns) + F.spark_partition_id()
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | F.col(name).isNull()
    salted_left = (
        left.withColumns({spreads: spread, key: F.xxhash64(*on)})
        .join(F.broadcast(hot), key, "left")
        .withColumn(
            salt,
            F.when(no_key, F.pmod(spreads, F.lit(NULL_SALTS)))
            .when(F.col(salts).isNull(), F.lit(0))
            .otherwise(F.pmod(spreads, F.col(salts)))
            .cast("int"),
        )
        .drop(spreads, salts, key)
    )
    salted_right = (
        right.withColumn(key, F.xxhash64(*on))
        .join(F.broadcast(hot), key, "left")
        .withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1)))
        .drop(salts, key)
    )
    joined = salted_left.join(salted_right, [*on, salt], how)
    return joined.select(*_result_columns(left, right, on, how))


def _unused(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores behind it until no frame has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name += "_"
    return name


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(_key, _salts): the hashed keys with more than ``hot_rows`` rows, at most ``HOT_KEYS`` of them.

    A frequent-items sketch of ``SKETCH_KEYS`` keys is built per partition and
    merged, so nothing is grouped by key. A key is missed only below some
    7 / ``SKETCH_KEYS`` of all rows. The limit is therefore raised to a
    ``HOT_KEYS``-th of the rows, which no more than ``HOT_KEYS`` keys can pass; the
    keys below it are small beside any partition. Two keys with one hash share their salts.
    """
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | F.col(name).isNull()
    keys = df.filter(~no_key).select(F.xxhash64(*on).alias("_key"))
    rows, top = keys.agg(
        F.count(F.lit(1)), F.expr(f"approx_top_k(_key, {HOT_KEYS}, {SKETCH_KEYS})")
    ).first()
    limit = max(hot_rows, -(-rows // HOT_KEYS))
    found = [(t["item"], -(-t["count"] // limit)) for t in top or [] if t["count"] > limit]
    return df.sparkSession.createDataFrame(found, "_key bigint, _salts int")


def _same_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``right`` with keys of the left types, as equal values of two types have two hashes.

    A right value that the left type cannot hold has no partner there and becomes null.
    """
    casts = {}
    for name in on:
        want, have = left.schema[name].dataType, right.schema[name].dataType
        if want != have:
            back = F.col(name).try_cast(want)
            casts[name] = F.when(back.cast(have) == F.col(name), back)
    return right.withColumns(casts) if casts else right


def _result_columns(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> list[str]:
    """Left columns in their order, then what the right side adds."""
    if how in ("left_semi", "left_anti"):
        return left.columns
    return left.columns + [c for c in right.columns if c not in on]


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Broadcast ``right`` when it is measured to be small, salt the join otherwise.

    Joins that keep unmatched right rows are refused: salting would repeat those rows.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} is not supported")
    if fits_broadcast(right, max_rows):
        joined = left.join(F.broadcast(right), list(on), how)
        return joined.select(*_result_columns(left, right, on, how))
    return salted_join(left, right, on, how, hot_rows)


def prefix_sums(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column | str],
    measures: dict[str, Column],
    max_group: int | None = None,
) -> DataFrame:
    """Running totals per partition, or over all rows when ``partition_by`` is empty.

    The largest group is measured first. Up to ``max_group`` rows (by default
    ``WINDOW_ROWS``) one window does the work in a single shuffle; beyond that
    the groups are cut into slices.
    """
    limit = WINDOW_ROWS if max_group is None else max_group
    sizes = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_rows"))
    largest = sizes.agg(F.max("_rows")).first()[0] or 0
    if largest > limit:
        return _sliced_sums(df, partition_by, order_by, measures)
    frame = (
        Window.partitionBy(*partition_by)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.select("*", *[F.sum(expr).over(frame).alias(name) for name, expr in measures.items()])


def _sliced_sums(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column | str],
    measures: dict[str, Column],
) -> DataFrame:
    """Running totals with no task bound to one group.

    Rows are range-partitioned by (partition, order), so a large group is cut
    into slices. Each slice is summed on its own and then lifted by the total of
    the earlier slices of its group. Only a group that starts in an earlier
    slice needs lifting, so the lift table has at most one row per slice. The
    slices are written first: both passes must see the very same cut.
    """
    partition_by = list(partition_by)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    terms = {f"_m{i}": expr for i, expr in enumerate(measures.values())}
    sliced = pin(
        df.withColumns({**terms, "_src": F.spark_partition_id()})
        .repartitionByRange(*[F.col(c) for c in partition_by], *order, F.col("_src"))
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    within = (
        Window.partitionBy("_slice", *partition_by)
        .orderBy(*order, F.col("_src"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy(*partition_by)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lifts = (
        sliced.groupBy("_slice", *partition_by)
        .agg(*[F.sum(m).alias(m) for m in terms])
        .select(
            F.col("_slice").alias("_at"),
            *[F.col(c).alias(f"_p{i}") for i, c in enumerate(partition_by)],
            F.count(F.lit(1)).over(earlier).alias("_before"),
            *[F.sum(m).over(earlier).alias(f"_lift{m}") for m in terms],
        )
        .filter(F.col("_before") > 0)
    )
    match = F.col("_slice") == F.col("_at")
    for i, name in enumerate(partition_by):
        match = match & F.col(name).eqNullSafe(F.col(f"_p{i}"))
    local = sliced.withColumns({f"_run{m}": F.sum(m).over(within) for m in terms})
    out = local.join(F.broadcast(lifts), match, "left")
    totals = {
        name: F.when(F.col(f"_run{m}").isNull(), F.col(f"_lift{m}")).otherwise(
            F.col(f"_run{m}") + F.coalesce(F.col(f"_lift{m}"), F.lit(0))
        )
        for name, m in zip(measures, terms)
    }
    return out.select(*df.columns, *[expr.alias(name) for name, expr in totals.items()])
