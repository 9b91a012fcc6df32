"""The given tables seen as observations, stations, plays and features.

Each view exists twice: as a DataFrame and as SQL for the oracle.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin

#: Every position of an embedding is a column.
FEATURES = [f"f{i}" for i in range(64)]
CORE = ["1-URGENT", "2-HIGH", "3-MEDIUM"]

VIEWS = {
    "obs": """
        SELECT 'U' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS station_id,
               strftime(ts, '%Y%m%d') AS obs_date,
               event_type AS element,
               CAST(round(value * 10) AS BIGINT) AS value,
               CASE WHEN user_id = 7 THEN 'X' WHEN value > 200 THEN 'G' WHEN value < 0.5 THEN 'D' END AS quality_flag
        FROM events""",
    "station": """
        SELECT 'U' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS station_id,
               ((s_suppkey * 37) % 1800 - 900) / 10.0::DOUBLE AS lat,
               ((s_suppkey * 91) % 3600 - 1800) / 10.0::DOUBLE AS lon,
               s_nationkey AS country_code,
               CAST(1990 + s_suppkey % 10 AS INTEGER) AS first_year,
               CAST(1990 + s_suppkey % 10 + s_suppkey % 13 AS INTEGER) AS last_year,
               CASE WHEN s_suppkey % 9 = 0 THEN 'GSN' END AS gsn_flag,
               CASE WHEN s_suppkey % 10 = 0 THEN 'HCN' WHEN s_suppkey % 10 = 1 THEN 'CRN' END AS hcn_crn_flag
        FROM supplier""",
    "country": """
        SELECT n_nationkey AS code, n_name || ' [' || r_name || ']' AS name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "site": """
        SELECT c_custkey AS station_id, c_name AS station_name, c_nationkey AS country_code,
               substr(c_mktsegment, 1, 2) AS state_code
        FROM customer""",
    "state": """
        SELECT DISTINCT substr(c_mktsegment, 1, 2) AS code, c_mktsegment AS name FROM customer""",
    "inventory": """
        SELECT o_custkey AS station_id, o_orderpriority AS element,
               CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
               CAST(max(year(o_orderdate)) AS INTEGER) AS last_year
        FROM orders GROUP BY 1, 2""",
    "rain": """
        SELECT l_suppkey AS station_id, CAST(year(l_shipdate) AS INTEGER) AS year,
               CAST(l_quantity AS BIGINT) AS value,
               CASE WHEN l_returnflag = 'R' THEN 'R' END AS quality_flag
        FROM lineitem""",
    "gauge": """
        SELECT s_suppkey AS station_id, s_nationkey AS country_code FROM supplier""",
    "plays": """
        SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(sum(l_quantity) AS BIGINT) AS play_count
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""",
    "mismatched": """
        SELECT p_partkey AS item_id FROM part WHERE p_brand = 'Brand#13'""",
    "accepted": """
        SELECT p_partkey AS item_id FROM part WHERE p_type = 'PROMO'""",
    "feat": "SELECT vec_id, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64))
    + ", label FROM embeddings",
    "genre": """
        SELECT vec_id, 'genre ' || CAST(label AS VARCHAR) AS genre FROM embeddings""",
    "scored": """
        SELECT vec_id, CASE WHEN label = 3 THEN 1 ELSE 0 END AS y,
               round(CAST(embedding[1] AS DOUBLE), 2) AS score,
               CASE WHEN embedding[1] > 0.1 THEN 1 ELSE 0 END AS yhat,
               label AS cls,
               CAST(least(9, floor(abs(CAST(embedding[2] AS DOUBLE)) * 30)) AS INTEGER) AS cls_hat
        FROM embeddings""",
}


def with_views(sql: str) -> str:
    """Put the definitions of the views used by ``sql`` in front of it."""
    used = [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]
    if not used:
        return sql.strip()
    heads = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in used)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"


class Tables:
    """Lazy access to the given tables and the views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def obs(self) -> DataFrame:
        flag = (
            F.when(F.col("user_id") == 7, "X")
            .when(F.col("value") > 200, "G")
            .when(F.col("value") < 0.5, "D")
        )
        return self("events").select(
            _station_id("user_id"),
            F.date_format("ts", "yyyyMMdd").alias("obs_date"),
            F.col("event_type").alias("element"),
            F.round(F.col("value") * 10).cast("bigint").alias("value"),
            flag.alias("quality_flag"),
        )

    @cached_property
    def station(self) -> DataFrame:
        k = F.col("s_suppkey")
        first = 1990 + k % 10
        return self("supplier").select(
            _station_id("s_suppkey"),
            (((k * 37) % 1800 - 900) / 10.0).alias("lat"),
            (((k * 91) % 3600 - 1800) / 10.0).alias("lon"),
            F.col("s_nationkey").alias("country_code"),
            first.cast("int").alias("first_year"),
            (first + k % 13).cast("int").alias("last_year"),
            F.when(k % 9 == 0, "GSN").alias("gsn_flag"),
            F.when(k % 10 == 0, "HCN").when(k % 10 == 1, "CRN").alias("hcn_crn_flag"),
        )

    @cached_property
    def country(self) -> DataFrame:
        nation, region = self("nation"), self("region")
        name = F.concat("n_name", F.lit(" ["), "r_name", F.lit("]")).alias("name")
        joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(F.col("n_nationkey").alias("code"), name)

    @cached_property
    def site(self) -> DataFrame:
        return self("customer").select(
            F.col("c_custkey").alias("station_id"),
            F.col("c_name").alias("station_name"),
            F.col("c_nationkey").alias("country_code"),
            F.substring("c_mktsegment", 1, 2).alias("state_code"),
        )

    @cached_property
    def state(self) -> DataFrame:
        return (
            self("customer")
            .select(F.substring("c_mktsegment", 1, 2).alias("code"), F.col("c_mktsegment").alias("name"))
            .distinct()
        )

    @cached_property
    def inventory(self) -> DataFrame:
        year = F.year("o_orderdate")
        return (
            self("orders")
            .groupBy(F.col("o_custkey").alias("station_id"), F.col("o_orderpriority").alias("element"))
            .agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"))
        )

    @cached_property
    def rain(self) -> DataFrame:
        return self("lineitem").select(
            F.col("l_suppkey").alias("station_id"),
            F.year("l_shipdate").alias("year"),
            F.col("l_quantity").cast("bigint").alias("value"),
            F.when(F.col("l_returnflag") == "R", "R").alias("quality_flag"),
        )

    @cached_property
    def gauge(self) -> DataFrame:
        return self("supplier").select(
            F.col("s_suppkey").alias("station_id"), F.col("s_nationkey").alias("country_code")
        )

    @cached_property
    def plays(self) -> DataFrame:
        lines = self("lineitem").select("l_orderkey", F.col("l_partkey").alias("item_id"), "l_quantity")
        orders = self("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")
        )
        joined = keyed_join(lines, orders, ["l_orderkey"], "inner")
        return joined.groupBy("user_id", "item_id").agg(
            F.sum("l_quantity").cast("bigint").alias("play_count")
        )

    @cached_property
    def saved_plays(self) -> DataFrame:
        """The plays written once, for queries that read them several times."""
        return pin(self.plays, "plays")

    @cached_property
    def mismatched(self) -> DataFrame:
        return self("part").filter(F.col("p_brand") == "Brand#13").select(F.col("p_partkey").alias("item_id"))

    @cached_property
    def accepted(self) -> DataFrame:
        return self("part").filter(F.col("p_type") == "PROMO").select(F.col("p_partkey").alias("item_id"))

    @cached_property
    def feat(self) -> DataFrame:
        values = [F.col("embedding")[i].cast("double").alias(f) for i, f in enumerate(FEATURES)]
        return self("embeddings").select("vec_id", *values, "label")

    @cached_property
    def genre(self) -> DataFrame:
        return self("embeddings").select(
            "vec_id", F.concat(F.lit("genre "), F.col("label").cast("string")).alias("genre")
        )

    @cached_property
    def scored(self) -> DataFrame:
        first, second = F.col("embedding")[0], F.col("embedding")[1].cast("double")
        return self("embeddings").select(
            "vec_id",
            F.when(F.col("label") == 3, 1).otherwise(0).alias("y"),
            F.round(first.cast("double"), 2).alias("score"),
            F.when(first > 0.1, 1).otherwise(0).alias("yhat"),
            F.col("label").alias("cls"),
            F.least(F.lit(9), F.floor(F.abs(second) * 30)).cast("int").alias("cls_hat"),
        )


def _station_id(key: str):
    return F.concat(F.lit("U"), F.lpad(F.col(key).cast("string"), 6, "0")).alias("station_id")
