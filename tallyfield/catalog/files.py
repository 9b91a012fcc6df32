"""Reads, writes and listings, on files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.catalog.registry import query
from tallyfield.catalog.views import FEATURES, Tables
from tallyfield.operators.aggregates import profile_tables
from tallyfield.plans.genres import load_feature_sets
from tallyfield.session import scratch_path
from tallyfield.sources.parsing import (
    attribute_types,
    columns_with_prefix,
    extract_pairs,
    parse_fixed_width,
    read_attributes,
    read_feature_set,
    rename_last,
)
from tallyfield.sources.readers import (
    parse_csv_lines,
    read_delimited,
    read_lines,
    read_many,
    read_table,
)
from tallyfield.sources.writers import file_inventory, land, rows_per_file, save, save_all

OBS_SCHEMA = "station_id string, obs_date string, element string, value bigint, quality_flag string"
RAIN_SCHEMA = "station_id bigint, rain_year int, value bigint, quality_flag string"
RAIN_SUMS = """
    SELECT year, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM rain {where} GROUP BY year"""


def _write(t: Tables, df: DataFrame, name: str, sep: str = ",", by: str | None = None) -> str:
    """Write headerless gzip text files to the shared folder."""
    path = scratch_path(t.spark, name)
    writer = df.write.option("compression", "gzip").option("sep", sep)
    if by:
        writer = writer.partitionBy(by)
    writer.csv(path)
    return path


def _year_files(t: Tables) -> str:
    """One folder of gzip CSV files per year."""
    rows = t.rain.select("station_id", F.col("year").alias("rain_year"), "value", "quality_flag", "year")
    return _write(t, rows, "years", by="year")


def _sums(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("rain_year").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )


@query("read_gzip_csv", "SELECT * FROM obs")
def _(t: Tables):
    return read_delimited(t.spark, _write(t, t.obs, "obs"), OBS_SCHEMA)


@query("read_glob", RAIN_SUMS.format(where="WHERE year BETWEEN 1996 AND 1998 OR year IN (2000, 2001)"))
def _(t: Tables):
    base = _year_files(t)
    return _sums(read_delimited(t.spark, f"{base}/year={{199[6-8],200[01]}}/*.*", RAIN_SCHEMA))


@query(
    "land_as_parquet",
    "SELECT year, quality_flag, CAST(sum(value) AS BIGINT) AS total FROM rain GROUP BY year, quality_flag",
)
def _(t: Tables):
    dest = scratch_path(t.spark, "landed")
    table = land(t.spark, f"{_year_files(t)}/*", RAIN_SCHEMA, dest, partition_by=["rain_year"])
    return table.groupBy(F.col("rain_year").alias("year"), "quality_flag").agg(F.sum("value").alias("total"))


@query("read_tab_separated", "SELECT * FROM plays")
def _(t: Tables):
    path = _write(t, t.plays, "plays", sep="\t")
    return read_delimited(t.spark, path, "user_id bigint, item_id bigint, play_count bigint", sep="\t")


STATION_LINE = [
    ("station_id", 1, 11, "string"),
    ("latitude", 13, 8, "double"),
    ("longitude", 22, 9, "double"),
    ("country_code", 32, 6, "int"),
    ("gsn_flag", 73, 3, "string"),
    ("hcn_crn_flag", 77, 3, "string"),
]


def _station_lines(t: Tables) -> DataFrame:
    """Stations as fixed-width text; a null flag is a blank field."""

    def cell(c: str, width: int, left: bool = False):
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        return F.rpad(text, width, " ") if left else F.lpad(text, width, " ")

    gap = F.lit(" ")
    line = F.concat(
        cell("station_id", 11, True), gap, cell("lat", 8), gap, cell("lon", 9), gap,
        cell("country_code", 6), F.lit(" " * 35), cell("gsn_flag", 3, True), gap,
        cell("hcn_crn_flag", 3, True),
    )
    return t.station.select(line.alias("value"))


def _write_lines(t: Tables, lines: DataFrame, name: str) -> str:
    path = scratch_path(t.spark, name)
    lines.write.text(path)
    return path


@query(
    "read_text_lines",
    "SELECT count(*) AS lines, CAST(sum(79) AS BIGINT) AS characters FROM station",
)
def _(t: Tables):
    lines = read_lines(t.spark, _write_lines(t, _station_lines(t), "lines"))
    return lines.agg(F.count("value").alias("lines"), F.sum(F.length("value")).alias("characters"))


@query(
    "parse_fixed_width",
    """SELECT station_id, lat AS latitude, lon AS longitude, country_code, gsn_flag, hcn_crn_flag
       FROM station""",
)
def _(t: Tables):
    lines = read_lines(t.spark, _write_lines(t, _station_lines(t), "lines"))
    return parse_fixed_width(lines, STATION_LINE)


@query(
    "extract_pairs_from_log",
    """SELECT DISTINCT 'IT' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') AS item_code,
              'TR' || lpad(CAST(p_size AS VARCHAR), 16, '0') AS track_code
       FROM part WHERE p_brand = 'Brand#13'""",
)
def _(t: Tables):
    part = t("part")
    pair = F.concat(
        F.lit("ERROR: <IT"), F.lpad(F.col("p_partkey").cast("string"), 16, "0"), F.lit(" TR"),
        F.lpad(F.col("p_size").cast("string"), 16, "0"), F.lit("> "), F.col("p_name"), F.lit(" != "),
        F.col("p_type"),
    )
    # A brand without mismatches has only a header line.
    line = F.when(F.col("p_brand") == "Brand#13", pair).otherwise(
        F.concat(F.lit("## "), F.col("p_brand"), F.lit(" no mismatch"))
    )
    lines = read_lines(t.spark, _write_lines(t, part.select(line.alias("value")), "log"))
    return extract_pairs(lines, r"<(\w+) (\w+)>", ["item_code", "track_code"])


def _set_files(t: Tables, first: int, width: int, quoted: bool) -> tuple[str, str]:
    """(attribute file, data folder) for ``width`` numbers of each embedding and its id."""
    names = F.concat(
        F.concat_ws(
            "\n",
            F.transform(
                F.sequence(F.lit(first), F.lit(first + width - 1)),
                lambda i: F.concat(F.lit("v"), i.cast("string"), F.lit(",NUMERIC")),
            ),
        ),
        F.lit("\nid,STRING"),
    )
    # The attribute list is as long as the shortest vector allows.
    longest = t("embeddings").agg(F.min(F.size("embedding")).alias("d")).filter(F.col("d") >= first + width)
    attributes = _write_lines(t, longest.select(names.alias("value")), "attributes")
    vec_id = F.col("vec_id").cast("string")
    if quoted:
        vec_id = F.concat(F.lit("'"), vec_id, F.lit("'"))
    values = [F.col("embedding")[i].cast("double").alias(f"v{i}") for i in range(first, first + width)]
    return attributes, _write(t, t("embeddings").select(*values, vec_id.alias("id")), "set")


def _attribute_file(folder: str) -> str:
    return f"{folder}/part-*.txt"


@query(
    "read_feature_set",
    "SELECT CAST(vec_id AS VARCHAR) AS track_id, "
    + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 4) AS mfcc_v{i}" for i in range(64))
    + " FROM embeddings",
)
def _(t: Tables):
    attributes, data = _set_files(t, 0, 64, quoted=True)
    df = read_feature_set(t.spark, _attribute_file(attributes), data, prefix="mfcc_")
    names = columns_with_prefix(df, "mfcc_")
    return df.select("track_id", *[F.round(c, 4).alias(c) for c in names])


@query(
    "read_wide_feature_set",
    """SELECT CAST(vec_id AS VARCHAR) AS track_id, CAST(len(embedding) AS INTEGER) AS width,
              round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total, """
    + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 4) AS v{i}" for i in range(64))
    + " FROM embeddings",
)
def _(t: Tables):
    attributes, data = _set_files(t, 0, 64, quoted=False)
    df = read_feature_set(t.spark, _attribute_file(attributes), data, as_array=True)
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    rounded = [F.round(F.col("features")[i], 4).alias(f"v{i}") for i in range(64)]
    return df.select("track_id", F.size("features").alias("width"), F.round(total, 4).alias("total"), *rounded)


@query(
    "attribute_type_words",
    "SELECT DISTINCT p_type AS type_word FROM part",
)
def _(t: Tables):
    # Attribute files with a line per part, named by its key and size.
    name = F.concat_ws("_", F.lit("part"), "p_partkey", "p_size")
    lines = t("part").select(name.alias("attribute"), F.col("p_type").alias("type_word"))
    return attribute_types(read_attributes(t.spark, _write(t, lines, "attributes")))


@query("read_many_files", RAIN_SUMS.format(where="WHERE year IN (1995, 1999, 2001)"))
def _(t: Tables):
    base = _year_files(t)
    paths = [f"{base}/year={y}" for y in (1995, 1999, 2001)]
    return _sums(read_many(t.spark, paths, RAIN_SCHEMA))


@query("parse_csv_lines", "SELECT * FROM obs")
def _(t: Tables):
    return parse_csv_lines(read_lines(t.spark, _write(t, t.obs, "obs")), OBS_SCHEMA)


@query("read_saved_table", "SELECT station_id, value FROM obs WHERE element = 'click'")
def _(t: Tables):
    path = scratch_path(t.spark, "orc")
    save(t.obs, path, "orc")
    table = read_table(t.spark, path, "orc")
    return table.filter(F.col("element") == "click").select("station_id", "value")


def _round_trip(fmt: str):
    def run(t: Tables):
        path = scratch_path(t.spark, fmt)
        save(t.obs, path, fmt)
        if fmt == "csv":
            return t.spark.read.schema(OBS_SCHEMA).csv(path, header=True)
        return read_table(t.spark, path, fmt)

    return run


for _fmt in ("orc", "parquet", "csv"):
    query(f"save_{_fmt}", "SELECT * FROM obs")(_round_trip(_fmt))


@query(
    "save_single_file",
    "SELECT element, count(*) AS n, CAST(1 AS BIGINT) AS files FROM obs GROUP BY element",
)
def _(t: Tables):
    path = scratch_path(t.spark, "single")
    totals = t.obs.groupBy("element").agg(F.count(F.lit(1)).alias("n"))
    save(totals, path, "csv", single_file=True)
    files = file_inventory(t.spark, f"{path}/*.csv").agg(F.count(F.lit(1)).alias("files")).scalar()
    back = t.spark.read.schema("element string, n bigint").csv(path, header=True)
    return back.withColumn("files", files)


@query(
    "save_feature_sets",
    "SELECT set_name, CAST(vec_id AS VARCHAR) AS track_id, "
    + ", ".join(
        f"round(CAST(CASE set_name WHEN 'low' THEN embedding[{i + 1}] ELSE embedding[{i + 33}] END AS DOUBLE), 4) AS v{i}" for i in range(32)
    )
    + " FROM embeddings, (VALUES ('low'), ('high')) s(set_name)",
)
def _(t: Tables):
    spec = {}
    for name, first in (("low", 0), ("high", 32)):
        attributes, data = _set_files(t, first, 32, quoted=name == "high")
        spec[name] = (_attribute_file(attributes), data)
    sets = load_feature_sets(t.spark, spec, scratch_path(t.spark, "sets"))
    out = None
    for name, df in sets.items():
        values = [F.round(c, 4).alias(f"v{i}") for i, c in enumerate(c for c in df.columns if c != "track_id")]
        part = df.select(F.lit(name).alias("set_name"), "track_id", *values)
        out = part if out is None else out.unionByName(part)
    return out


@query("file_inventory")
def _(t: Tables):
    path = scratch_path(t.spark, "inventory")
    save_all({"obs": t.obs, "plays": t.plays}, path, "parquet")
    return file_inventory(t.spark, path).select(
        F.element_at(F.split("path", "/"), -2).alias("table"), "length", "modificationTime"
    )


@query("rows_per_file", "SELECT year, count(*) AS n FROM rain GROUP BY year")
def _(t: Tables):
    base = _year_files(t)
    per_file = rows_per_file(t.spark.read.schema(RAIN_SCHEMA).csv(f"{base}/*/*"))
    year = F.regexp_extract("file_path", r"year=(\d+)", 1).cast("int").alias("year")
    return per_file.groupBy(year).agg(F.sum("n").alias("n"))


@query(
    "profile_tables",
    """SELECT 'obs' AS "table", CAST(5 AS INTEGER) AS columns, count(*) AS rows FROM obs
       UNION ALL SELECT 'plays', CAST(3 AS INTEGER), count(*) FROM plays
       UNION ALL SELECT 'feat', CAST(66 AS INTEGER), count(*) FROM feat""",
)
def _(t: Tables):
    return profile_tables({"obs": t.obs, "plays": t.plays, "feat": t.feat})


@query(
    "rename_last_column",
    "SELECT vec_id, " + ", ".join(f"round({f}, 4) AS {f}" for f in FEATURES) + ", label AS genre_id FROM feat",
)
def _(t: Tables):
    df = rename_last(t.feat, "genre_id")
    return df.select("vec_id", *[F.round(f, 4).alias(f) for f in FEATURES], "genre_id")


@query(
    "select_by_prefix",
    "SELECT vec_id, " + ", ".join(f"round({f}, 4) AS {f}" for f in FEATURES) + " FROM feat",
)
def _(t: Tables):
    names = columns_with_prefix(t.feat, "f")
    return t.feat.select("vec_id", *[F.round(f, 4).alias(f) for f in names])
