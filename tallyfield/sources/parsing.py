"""Fixed-width lines, log-like lines and schemas described by files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyfield.functions import strip_quotes
from tallyfield.sources.readers import Paths, read_delimited

Field = tuple[str, int, int, str]

# 1-based start and length of each field in the station files.
STATION_LAYOUT: list[Field] = [
    ("station_id", 1, 11, "string"),
    ("latitude", 13, 8, "double"),
    ("longitude", 22, 9, "double"),
    ("elevation", 32, 6, "double"),
    ("state_code", 39, 2, "string"),
    ("station_name", 42, 30, "string"),
    ("gsn_flag", 73, 3, "string"),
    ("hcn_crn_flag", 77, 3, "string"),
    ("wmo_id", 81, 5, "string"),
]
CODE_NAME_LAYOUT: list[Field] = [("code", 1, 2, "string"), ("name", 4, 47, "string")]
INVENTORY_LAYOUT: list[Field] = [
    ("station_id", 1, 11, "string"),
    ("latitude", 13, 8, "double"),
    ("longitude", 22, 9, "double"),
    ("element", 32, 4, "string"),
    ("first_year", 37, 4, "int"),
    ("last_year", 42, 4, "int"),
]
# Type words used by attribute files.
TYPE_WORDS = {"NUMERIC": "double", "real": "double", "string": "string", "STRING": "string"}
MAX_ATTRIBUTES = 20_000


def parse_fixed_width(df: DataFrame, layout: Sequence[Field], blank_as_null: bool = True) -> DataFrame:
    """Cut ``value`` into trimmed, typed fields in one projection.

    A field past the end of a short line, or one that is not of its type, is null.
    """
    out = []
    for name, start, length, kind in layout:
        text = F.trim(F.substring("value", start, length))
        if blank_as_null or kind != "string":
            text = F.nullif(text, F.lit(""))
        out.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    return df.select(*out)


def extract_pairs(df: DataFrame, pattern: str, names: Sequence[str]) -> DataFrame:
    """Distinct pattern groups of the lines that match; other lines (headers) are skipped."""
    hits = df.filter(F.col("value").rlike(pattern))
    return hits.select(
        *[F.regexp_extract("value", pattern, i + 1).alias(n) for i, n in enumerate(names)]
    ).distinct()


def read_attributes(spark: SparkSession, path: Paths) -> DataFrame:
    """(attribute, type_word) rows of headerless attribute files."""
    return read_delimited(spark, path, "attribute string, type_word string")


def attribute_types(df: DataFrame) -> DataFrame:
    """Distinct type words."""
    return df.select("type_word").distinct()


def schema_from_attributes(
    rows: Iterable[tuple[str, str]], type_words: dict[str, str] = TYPE_WORDS, prefix: str = ""
) -> StructType:
    """A schema with one field per (attribute, type word) row, names prefixed."""
    types = {"double": DoubleType(), "string": StringType()}
    return StructType([StructField(prefix + name, types[type_words[word]]) for name, word in rows])


def read_feature_set(
    spark: SparkSession,
    attribute_path: str,
    data_path: Paths,
    prefix: str = "",
    id_name: str = "track_id",
    as_array: bool = False,
) -> DataFrame:
    """A data file whose columns are described by an attribute file.

    The last column becomes the ID with any wrapping quotes removed. Column
    order is the line order of the attribute file, which must be one small file:
    it is read as a whole-file value and checked against ``MAX_ATTRIBUTES``.
    ``as_array`` packs the numbers into one ``features`` array, the form to use
    for sets of a thousand columns and more.
    """
    files = spark.read.text(attribute_path, wholetext=True).limit(2).collect()
    if len(files) != 1:
        raise ValueError(f"{attribute_path} must name exactly one attribute file")
    text = files[0][0]
    rows = [tuple(p.strip() for p in line.split(",")) for line in text.splitlines() if line.strip()]
    if len(rows) > MAX_ATTRIBUTES:
        raise ValueError(f"{len(rows)} attributes in {attribute_path}")
    schema = schema_from_attributes(rows, prefix=prefix)
    df = rename_last(read_delimited(spark, data_path, schema), id_name)
    df = df.withColumn(id_name, strip_quotes(id_name))
    if as_array:
        return df.select(id_name, F.array(*df.columns[:-1]).alias("features"))
    return df


def rename_last(df: DataFrame, name: str) -> DataFrame:
    """Rename the last column."""
    return df.withColumnRenamed(df.columns[-1], name)


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Column names that start with ``prefix``."""
    return [c for c in df.columns if c.startswith(prefix)]
