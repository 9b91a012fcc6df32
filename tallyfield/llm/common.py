"""Small helpers that several text operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the text operators define it: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for ids kept out of all training: crc32 of the id as text leaves 0. A null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % folds) == 0


def words(text: Column) -> Column:
    """The words of a text in order; no words for a null, empty or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, GAP))).cast("bigint")


def null_safe_key(*columns: str) -> Column:
    """One never-null text key for equi-joins on columns that may hold nulls.

    A value is led by its length and a null is marked, so different tuples never share a key.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.length(text), F.lit(":"), text)))
    return F.concat(*parts)


#: Bytes of one Arrow batch. A batch of texts is held by the JVM and twice by its Python worker.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches within ``BATCH_BYTES``: 10,000 long texts, Spark's own limit, hold tens of MB.

    A lower setting stays. Rows are the same, whatever the batches.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([a-z]?).*", spark.conf.get(key).lower()).groups()
    if int(number) << {"k": 10, "m": 20, "g": 30}.get(unit, 0) > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def require(df: DataFrame, *columns: str) -> None:
    """Raise when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
