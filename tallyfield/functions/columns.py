from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: mean Earth radius in kilometres used by both distance formulas.
EARTH_RADIUS_KM = 6371.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Null for an empty or all-space string, the value itself otherwise."""
    c = _col(c)
    return F.when(F.trim(c) != "", c)


def is_blank(c: Column | str) -> Column:
    """True for null, ``''`` and all spaces, on a column of any type."""
    c = _col(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def strip_quotes(c: Column | str) -> Column:
    """Trim, then remove single quotes; applied to every row whatever its length."""
    return F.translate(F.trim(_col(c)), "'", "")


def year_of(c: Column | str) -> Column:
    """Year of a ``yyyyMMdd`` text as an integer, null when it is not a number."""
    return F.substring(_col(c), 1, 4).try_cast("int")


def month_of(c: Column | str) -> Column:
    """Month of a ``yyyyMMdd`` text as an integer, null when it is not a number."""
    return F.substring(_col(c), 5, 2).try_cast("int")


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` as a double; null when ``b`` is 0."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def active_in(first: Column | str, last: Column | str, year: int) -> Column:
    """True when ``first <= year <= last``."""
    return F.lit(year).between(_col(first), _col(last))


def code_where(code: Column | str, cond: Column) -> Column:
    """``code`` where ``cond`` holds, null elsewhere."""
    return F.when(cond, _col(code))


def binary_label(c: Column | str, positive) -> Column:
    """1 for the positive category, 0 for every other one."""
    return F.when(_col(c) == F.lit(positive), 1).otherwise(0)


def great_circle_km(lat1, lon1, lat2, lon2) -> Column:
    """Spherical law of cosines; the cosine is clamped so rounding cannot leave [-1, 1]."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    cosine = F.sin(lat1) * F.sin(lat2) + F.cos(lat1) * F.cos(lat2) * F.cos(lon1 - lon2)
    return F.lit(EARTH_RADIUS_KM) * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance; stays exact for points close together."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), 2
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(half)))


def overlap_size(a: Column | str, b: Column | str) -> Column:
    """Number of distinct values found in both arrays."""
    return F.size(F.array_intersect(_col(a), _col(b)))


def extra_size(a: Column | str, b: Column | str) -> Column:
    """Number of distinct values of ``b`` that ``a`` does not hold."""
    return F.size(F.array_except(_col(b), _col(a)))


def over_threshold(probability: Column | str, threshold: float, index: int = 1) -> Column:
    """1 when one element of a probability vector is above ``threshold``, else 0."""
    return (vector_to_array(_col(probability))[index] > threshold).cast("int")


def key_text(c: Column | str) -> Column:
    """A value led by its length, or a mark for null: joined texts of different keys never agree."""
    text = _col(c).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.length(text), F.lit(":"), text))


def hash_uniform(*keys: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) fixed by the key values and the seed.

    Unlike ``rand`` it does not depend on partitioning or row order, so a retry
    or a different cluster draws the same sample; and being built on MD5 it can
    be recomputed by any other engine. 13 hex digits fill a double exactly.
    Nulls and separators in the keys matter: different keys draw apart.
    """
    text = F.concat(F.lit(f"{seed}|"), *[key_text(k) for k in keys])
    digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return digits / F.lit(float(1 << 52))


def typed_key(c: Column, kind: T.DataType) -> Column:
    """Text that is the same for equal values of one type only, never null.

    Instants count in microseconds, -0.0 is 0.0, nested values go element by element, texts and elements
    are led by their length or number, and a null is marked.
    """
    if isinstance(kind, T.TimestampType):
        text = F.unix_micros(c).cast("string")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = (c + F.lit(0.0).cast(kind)).cast("string")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(c)
    elif isinstance(kind, T.ArrayType):
        parts = F.array_join(F.transform(c, lambda x: typed_key(x, kind.elementType)), "")
        text = F.concat(F.size(c).cast("string"), F.lit("["), parts)
    elif isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        parts = F.array_sort(F.transform(F.map_entries(c), lambda e: typed_key(e, entry)))
        text = F.concat(F.size(c).cast("string"), F.lit("{"), F.array_join(parts, ""))
    elif isinstance(kind, T.StructType):
        fields = [typed_key(c[f.name], f.dataType) for f in kind.fields]
        text = F.when(c.isNotNull(), F.concat(F.lit("("), *fields))
    else:
        text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.length(text), F.lit(":"), text))


def row_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """One never-null text key of several columns: equal for rows with the same values, nulls included, only."""
    return F.concat(F.lit(""), *[typed_key(F.col(c), df.schema[c].dataType) for c in cols])


def row_hash(*cols: Column | str) -> Column:
    """A 64-bit hash of the row's values with nulls marked, to spread rows; for an id take :func:`row_id`."""
    return F.xxhash64(*[key_text(c) for c in cols])


def row_id(df: DataFrame, cols: Sequence[str]) -> Column:
    """SHA-256 of the row's key, in hex: a repeatable id that different rows do not share."""
    return F.sha2(row_key(df, cols), 256)
