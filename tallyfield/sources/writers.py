"""Saved results and file listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfield.sources.readers import Paths, read_delimited

SINGLE_FILE_ROWS = 1_000_000


def save(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    single_file: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Write as ORC, Parquet or CSV (with header).

    ``single_file`` is for aggregated results: the rows are counted first and a
    table beyond ``SINGLE_FILE_ROWS`` is refused.
    """
    if single_file:
        rows = df.count()
        if rows > SINGLE_FILE_ROWS:
            raise ValueError(f"{rows} rows are too many for a single file")
        df = df.repartition(1)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def land(
    spark: SparkSession,
    path: Paths,
    schema: StructType | str,
    dest: str,
    sep: str = ",",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Rewrite raw delimited files as a Parquet table and return it.

    A gzip file is read by one task whatever its size. The rows are rebalanced
    before the write, which cuts the share of a large file or a large partition
    value into files of even size, so every later read is parallel.
    """
    rows = read_delimited(spark, path, schema, sep)
    save(rows.hint("rebalance", *partition_by), dest, "parquet", partition_by=partition_by)
    # With the declared types: a partition value such as 00701 stays text.
    return spark.read.schema(rows.schema).parquet(dest).select(*rows.columns)


def save_all(tables: dict[str, DataFrame], base: str, fmt: str = "orc") -> dict[str, str]:
    """Write each table below ``base`` under its name; returns name to path."""
    paths = {name: f"{base}/{name}" for name in tables}
    for name, df in tables.items():
        save(df, paths[name], fmt)
    return paths


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of every file below ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", "modificationTime")


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per source file of a file-based table."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n")
    )
