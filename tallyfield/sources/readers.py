"""Typed reads of delimited, text and columnar files. Every path may be a glob or a list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tallyfield.functions import blank_to_null

Paths = str | Sequence[str]


def _paths(path: Paths) -> str | list[str]:
    return path if isinstance(path, str) else list(path)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Null instead of blank in every string column."""
    return df.select(
        *[
            blank_to_null(f.name).alias(f.name) if isinstance(f.dataType, StringType) else f.name
            for f in df.schema.fields
        ]
    )


def read_delimited(spark: SparkSession, path: Paths, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Headerless CSV or TSV, plain or gzip, with a declared schema and no inference.

    A field that does not fit its type reads as null. One gzip file is one task
    however large it is; ``sources.writers.save`` as Parquet before repeated use.
    """
    raw = spark.read.schema(schema).csv(_paths(path), sep=sep, header=False, mode="PERMISSIVE")
    return blanks_to_null(raw)


def read_many(spark: SparkSession, paths: Sequence[str], schema: StructType | str, sep: str = ",") -> DataFrame:
    """Many files as one scan; an empty list gives an empty typed table."""
    if not paths:
        return spark.createDataFrame([], schema)
    return read_delimited(spark, paths, schema, sep)


def read_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """Text lines in a single ``value`` column."""
    return spark.read.text(_paths(path))


def parse_csv_lines(lines: DataFrame, schema: str, sep: str = ",") -> DataFrame:
    """Parse a ``value`` column of CSV text with a DDL schema."""
    row = F.from_csv("value", schema, {"sep": sep}).alias("_row")
    return blanks_to_null(lines.select(row).select("_row.*"))


def read_table(spark: SparkSession, path: Paths, fmt: str = "parquet") -> DataFrame:
    """A saved ORC or Parquet table; filters and column choices reach the scan."""
    paths = _paths(path)
    return spark.read.format(fmt).load(paths)
