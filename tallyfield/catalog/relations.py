"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.catalog.columns import HAVERSINE
from tallyfield.catalog.registry import query
from tallyfield.catalog.views import Tables
from tallyfield.operators.geo import pairs_within
from tallyfield.operators.joins import enrich, exclude, lookup, missing_from, orphans, restrict
from tallyfield.operators.scale import keyed_join, salted_join
from tallyfield.operators.sets import count_distinct, dedupe_by, multiset_difference
from tallyfield.plans.stations import pair_distances


@query(
    "join_left_lookup",
    "SELECT o.*, s.country_code FROM obs o LEFT JOIN station s ON o.station_id = s.station_id",
)
def _(t: Tables):
    return lookup(t.obs, t.station, "station_id", "station_id", ["country_code"])


@query(
    "join_left_same_name",
    """SELECT s.station_id, i.n FROM station s
       LEFT JOIN (SELECT station_id, count(*) AS n FROM obs WHERE value > 500 GROUP BY 1) i ON s.station_id = i.station_id""",
)
def _(t: Tables):
    counts = t.obs.filter(F.col("value") > 500).groupBy("station_id").agg(F.count(F.lit(1)).alias("n"))
    return t.station.select("station_id").join(counts, "station_id", "left")


@query(
    "join_enrich_chain",
    """SELECT s.station_id, s.country_code, s.state_code, c.name AS country_name, st.name AS state_name
       FROM site s LEFT JOIN country c ON s.country_code = c.code LEFT JOIN state st ON s.state_code = st.code""",
)
def _(t: Tables):
    base = t.site.select("station_id", "country_code", "state_code")
    country = t.country.select("code", F.col("name").alias("country_name"))
    state = t.state.select("code", F.col("name").alias("state_name"))
    return enrich(base, [(country, "country_code", "code"), (state, "state_code", "code")])


@query(
    "join_inner",
    """SELECT o.o_custkey, count(*) AS lines, CAST(sum(l.l_quantity) AS BIGINT) AS quantity
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey""",
)
def _(t: Tables):
    lines = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    joined = keyed_join(lines, t("orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], "inner")
    return joined.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


@query(
    "join_salted",
    """SELECT l.l_suppkey, l.l_orderkey, l.l_linenumber, l.l_partkey, s.s_name
       FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
)
def _(t: Tables):
    lines = t("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    names = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    # The low limit makes every supplier a hot key at test scale.
    return salted_join(lines, names, ["l_suppkey"], "left", hot_rows=200)


@query(
    "join_right_unmatched",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def _(t: Tables):
    return missing_from(t("lineitem"), t("orders").select("o_orderkey"), "l_orderkey", "o_orderkey")


@query(
    "join_right_outer",
    """SELECT s.station_id, count(o.station_id) AS n FROM obs o RIGHT JOIN station s ON o.station_id = s.station_id
       GROUP BY s.station_id""",
)
def _(t: Tables):
    per = t.obs.groupBy("station_id").agg(F.count(F.lit(1)).alias("n"))
    return per.join(t.station.select("station_id"), "station_id", "right").fillna(0, "n")


@query(
    "join_left_anti",
    "SELECT * FROM plays WHERE item_id NOT IN (SELECT item_id FROM mismatched)",
)
def _(t: Tables):
    return exclude(t.plays, t.mismatched, "item_id")


@query(
    "join_left_semi",
    "SELECT * FROM plays WHERE item_id IN (SELECT item_id FROM accepted)",
)
def _(t: Tables):
    return restrict(t.plays, t.accepted, "item_id")


@query(
    "join_measured_broadcast",
    """SELECT o.station_id, o.obs_date, o.element, o.value, s.lat, s.lon
       FROM obs o JOIN station s ON o.station_id = s.station_id""",
)
def _(t: Tables):
    side = t.station.select("station_id", "lat", "lon")
    return keyed_join(t.obs.drop("quality_flag"), side, ["station_id"], "inner")


@query(
    "join_pairs_within_radius",
    f"""SELECT a.country_code, a.station_id AS id_1, b.station_id AS id_2,
               round({HAVERSINE.format(a='a.', b='b.', x='', y='')}, 3) AS distance_km
        FROM station a JOIN station b ON a.country_code = b.country_code AND a.station_id < b.station_id
        WHERE {HAVERSINE.format(a='a.', b='b.', x='', y='')} <= 6000""",
)
def _(t: Tables):
    pairs = pair_distances(t.station, max_km=6000)
    return pairs.withColumn("distance_km", F.round("distance_km", 3))


PART_PLACES = """(SELECT p_partkey AS id, ((p_partkey * 37) % 1800 - 900) / 10.0::DOUBLE AS lat,
                         ((p_partkey * 91) % 3600 - 1800) / 10.0::DOUBLE AS lon FROM part)"""


@query(
    "join_pairs_within_300_km",
    f"""SELECT a.id AS id_1, b.id AS id_2, round({HAVERSINE.format(a='a.', b='b.', x='', y='')}, 3) AS distance_km
        FROM {PART_PLACES} a JOIN {PART_PLACES} b ON a.id < b.id
        WHERE abs(a.lat - b.lat) <= 3 AND {HAVERSINE.format(a='a.', b='b.', x='', y='')} <= 300""",
)
def _(t: Tables):
    k = F.col("p_partkey")
    lat, lon = ((k * 37) % 1800 - 900) / 10.0, ((k * 91) % 3600 - 1800) / 10.0
    places = t("part").select(k.alias("id"), lat.alias("lat"), lon.alias("lon"))
    return pairs_within(places, "id", "lat", "lon", 300).withColumn("distance_km", F.round("distance_km", 3))


@query(
    "join_unmatched_audit",
    "SELECT DISTINCT station_id FROM obs WHERE station_id NOT IN (SELECT station_id FROM station)",
)
def _(t: Tables):
    return orphans(t.obs, t.station, "station_id", "station_id")


@query("distinct_rows", "SELECT DISTINCT station_id, element FROM obs")
def _(t: Tables):
    return t.obs.select("station_id", "element").distinct()


@query("drop_duplicates", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(t: Tables):
    return t("lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


@query(
    "dedupe_by_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
         SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS r
         FROM lineitem) WHERE r = 1""",
)
def _(t: Tables):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return dedupe_by(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"])


@query(
    "union_all",
    "SELECT l_orderkey AS k FROM lineitem UNION ALL SELECT o_orderkey FROM orders",
)
def _(t: Tables):
    lines = t("lineitem").select(F.col("l_orderkey").alias("k"))
    return lines.unionByName(t("orders").select(F.col("o_orderkey").alias("k")))


@query(
    "multiset_difference",
    "SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer",
)
def _(t: Tables):
    a = t("orders").select(F.col("o_custkey").alias("k"))
    return multiset_difference(a, t("customer").select(F.col("c_custkey").alias("k")))


@query(
    "set_difference",
    "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders",
)
def _(t: Tables):
    return t("customer").select(F.col("c_custkey").alias("k")).subtract(
        t("orders").select(F.col("o_custkey").alias("k"))
    )


@query(
    "count_distinct_pairs",
    "SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
)
def _(t: Tables):
    return count_distinct(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("approx_count_distinct")
def _(t: Tables):
    return count_distinct(t("lineitem"), ["l_orderkey"], rsd=0.02)


@query(
    "set_difference_of_buyers",
    "SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal < 5000",
)
def _(t: Tables):
    poor = t("customer").filter(F.col("c_acctbal") < 5000)
    return t("orders").select(F.col("o_custkey").alias("k")).subtract(poor.select(F.col("c_custkey").alias("k")))
