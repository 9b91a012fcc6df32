"""Projections, predicates and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.catalog.registry import query
from tallyfield.catalog.views import Tables
from tallyfield.functions import (
    active_in,
    binary_label,
    code_where,
    extra_size,
    great_circle_km,
    hash_uniform,
    haversine_km,
    is_blank,
    month_of,
    overlap_size,
    ratio,
    row_hash,
    strip_quotes,
    year_of,
)
from tallyfield.operators.evaluation import drop_nan
from tallyfield.operators.joins import membership_count, restrict, suffix_columns
from tallyfield.operators.models import apply_threshold
from tallyfield.operators.sampling import keep_fraction
from tallyfield.plans.stations import networks

# SQL for the draw of a key under a seed, equal to functions.hash_uniform.
_DRAW = "CAST(('0x' || substr(md5('{seed}|' || {key}), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE"


class Draw(str):
    """The draw in SQL; ``key`` lists texts, each led by its length."""

    def format(self, seed: int, key: str | tuple[str, ...]) -> str:
        parts = (key,) if isinstance(key, str) else key
        return super().format(seed=seed, key=" || ".join(f"length({p}) || ':' || {p}" for p in parts))


DRAW = Draw(_DRAW)


@query("select_columns", "SELECT station_id, element, value FROM obs")
def _(t: Tables):
    return t.obs.select("station_id", "element", "value")


@query("computed_column", "SELECT station_id, obs_date, value, value / 10.0::DOUBLE AS scaled FROM obs")
def _(t: Tables):
    return t.obs.withColumn("scaled", F.col("value") / 10.0).select("station_id", "obs_date", "value", "scaled")


@query("rename_column", "SELECT code, name AS country_name FROM country")
def _(t: Tables):
    return t.country.withColumnRenamed("name", "country_name")


@query("drop_columns", "SELECT station_id, obs_date, element, value FROM obs")
def _(t: Tables):
    return t.obs.drop("quality_flag", "no_such_column")


@query("suffix_columns", "SELECT station_id AS station_id_1, lat AS lat_1, lon AS lon_1 FROM station")
def _(t: Tables):
    return suffix_columns(t.station.select("station_id", "lat", "lon"), "_1")


@query(
    "cast_dirty_text",
    """SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
              TRY_CAST(event_type AS INTEGER) AS no_number FROM events""",
)
def _(t: Tables):
    digits = F.regexp_extract("props", "[0-9]+", 0)
    return t("events").select(
        "event_id", digits.try_cast("int").alias("k"), F.col("event_type").try_cast("int").alias("no_number")
    )


@query(
    "array_literal",
    "SELECT station_id, array_to_string(list_sort(['click', 'view', element]), ',') AS elements FROM obs",
)
def _(t: Tables):
    wanted = F.array(F.lit("click"), F.lit("view"), F.col("element"))
    return t.obs.select("station_id", F.array_join(F.array_sort(wanted), ",").alias("elements"))


@query(
    "conditional_column",
    "SELECT station_id, CASE WHEN lat > 0 THEN 'north' WHEN lat < 0 THEN 'south' ELSE 'equator' END AS side FROM station",
)
def _(t: Tables):
    side = F.when(F.col("lat") > 0, "north").when(F.col("lat") < 0, "south").otherwise("equator")
    return t.station.select("station_id", side.alias("side"))


@query(
    "code_for_one_country",
    "SELECT station_id, CASE WHEN country_code = 3 THEN state_code END AS state_code FROM site",
)
def _(t: Tables):
    code = code_where("state_code", F.col("country_code") == 3)
    return t.site.select("station_id", code.alias("state_code"))


@query(
    "network_memberships",
    """SELECT station_id, gsn, hcn, crn, gsn + hcn + crn AS memberships FROM (
         SELECT station_id, CASE WHEN gsn_flag = 'GSN' THEN 1 ELSE 0 END AS gsn,
                CASE WHEN hcn_crn_flag = 'HCN' THEN 1 ELSE 0 END AS hcn,
                CASE WHEN hcn_crn_flag = 'CRN' THEN 1 ELSE 0 END AS crn FROM station)""",
)
def _(t: Tables):
    return membership_count(t.station, networks()).select("station_id", "gsn", "hcn", "crn", "memberships")


@query("strip_quotes", "SELECT vec_id, CAST(vec_id AS VARCHAR) AS track_id FROM embeddings")
def _(t: Tables):
    text = F.col("vec_id").cast("string")
    quoted = F.when(F.col("label") > 4, F.concat(F.lit(" '"), text, F.lit("' "))).otherwise(text)
    return t("embeddings").select("vec_id", strip_quotes(quoted).alias("track_id"))


@query("binary_label", "SELECT vec_id, CASE WHEN genre = 'genre 3' THEN 1 ELSE 0 END AS class FROM genre")
def _(t: Tables):
    return t.genre.select("vec_id", binary_label("genre", "genre 3").alias("class"))


@query("filter_equal", "SELECT station_id, value FROM obs WHERE element = 'view' AND quality_flag <> 'X'")
def _(t: Tables):
    return t.obs.filter((F.col("element") == "view") & (F.col("quality_flag") != "X")).select("station_id", "value")


@query("filter_active_in_year", "SELECT station_id FROM station WHERE first_year <= 1995 AND last_year >= 1995")
def _(t: Tables):
    return t.station.filter(active_in("first_year", "last_year", 1995)).select("station_id")


@query(
    "filter_boolean_logic",
    """SELECT station_id, value FROM obs
       WHERE (element = 'click' OR value > 1000) AND NOT (station_id = 'U000007')""",
)
def _(t: Tables):
    keep = ((F.col("element") == "click") | (F.col("value") > 1000)) & ~(F.col("station_id") == "U000007")
    return t.obs.filter(keep).select("station_id", "value")


@query("filter_null", "SELECT station_id, gsn_flag FROM station WHERE gsn_flag IS NOT NULL AND hcn_crn_flag IS NULL")
def _(t: Tables):
    return t.station.filter(F.col("gsn_flag").isNotNull() & F.col("hcn_crn_flag").isNull()).select("station_id", "gsn_flag")


@query(
    "filter_blank",
    "SELECT station_id, obs_date, value FROM obs WHERE quality_flag IS NULL OR trim(quality_flag) = ''",
)
def _(t: Tables):
    return t.obs.filter(is_blank("quality_flag")).select("station_id", "obs_date", "value")


@query("filter_in_list", "SELECT station_id, element FROM obs WHERE element IN ('click', 'view')")
def _(t: Tables):
    return t.obs.filter(F.col("element").isin("click", "view")).select("station_id", "element")


@query(
    "filter_by_key_table",
    """SELECT station_id, value FROM obs
       WHERE station_id IN (SELECT station_id FROM station WHERE country_code = 3)""",
)
def _(t: Tables):
    keys = t.station.filter(F.col("country_code") == 3)
    return restrict(t.obs.select("station_id", "value"), keys, "station_id")


@query("filter_like", "SELECT code, name FROM country WHERE name LIKE '%ASIA%'")
def _(t: Tables):
    return t.country.filter(F.col("name").like("%ASIA%"))


@query("filter_starts_with", "SELECT doc_id, source FROM documents WHERE starts_with(source, 'w') OR starts_with(lang, 'e')")
def _(t: Tables):
    return t("documents").filter(F.col("source").startswith("w") | F.col("lang").startswith("e")).select("doc_id", "source")


@query(
    "filter_modulo",
    "SELECT user_id, item_id, play_count % 5 AS rest FROM plays WHERE play_count % 5 <> 0",
)
def _(t: Tables):
    rest = F.col("play_count") % 5
    return t.plays.filter(rest != 0).select("user_id", "item_id", rest.alias("rest"))


@query("filter_nan", "SELECT vec_id, score FROM scored WHERE score <> 0")
def _(t: Tables):
    score = F.when(F.col("score") == 0, F.lit(float("nan"))).otherwise(F.col("score"))
    return drop_nan(t.scored.select("vec_id", score.alias("score")), "score")


@query("filter_boolean_column", "SELECT station_id, obs_date FROM obs WHERE value > 500 AND element = 'error'")
def _(t: Tables):
    flags = t.obs.withColumn("high", F.col("value") > 500).withColumn("error", F.col("element") == "error")
    return flags.filter(F.col("high") & F.col("error")).select("station_id", "obs_date")


@query(
    "filter_array_size",
    "SELECT station_id FROM inventory GROUP BY station_id HAVING count(DISTINCT element) = 4",
)
def _(t: Tables):
    sets = t.inventory.groupBy("station_id").agg(F.collect_set("element").alias("elements"))
    return sets.filter(F.size("elements") == 4).select("station_id")


@query(
    "filter_random_fraction",
    f"SELECT event_id FROM events WHERE {DRAW.format(seed=1000, key='CAST(event_id AS VARCHAR)')} < 0.3",
)
def _(t: Tables):
    return keep_fraction(t("events").select("event_id"), 0.3, 1000, ["event_id"])


@query("trim_and_substring", "SELECT c_custkey, substr(trim(c_name), 1, 8) AS head, trim(c_mktsegment) AS segment FROM customer")
def _(t: Tables):
    return t("customer").select(
        "c_custkey", F.substring(F.trim("c_name"), 1, 8).alias("head"), F.trim("c_mktsegment").alias("segment")
    )


@query(
    "year_and_month",
    """SELECT obs_date, CAST(substr(obs_date, 1, 4) AS INTEGER) AS year,
              CAST(substr(obs_date, 5, 2) AS INTEGER) AS month, count(*) AS n FROM obs GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    return t.obs.groupBy("obs_date", year_of("obs_date").alias("year"), month_of("obs_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "ratio_and_scaling",
    """SELECT element, round(sum(value)::DOUBLE / count(*), 4) AS mean, round(sum(value)::DOUBLE / count(*) * 365, 4) AS yearly,
              CAST(NULL AS DOUBLE) AS over_zero FROM obs GROUP BY element""",
)
def _(t: Tables):
    sums = t.obs.groupBy("element").agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("n"))
    return sums.select(
        "element",
        F.round(ratio("s", "n"), 4).alias("mean"),
        F.round(ratio("s", "n") * 365, 4).alias("yearly"),
        ratio("s", F.col("n") - F.col("n")).alias("over_zero"),
    )


PLACES = """(SELECT c_custkey, ((c_custkey * 37) % 1800 - 900) / 10.0::DOUBLE AS lat1,
       ((c_custkey * 91) % 3600 - 1800) / 10.0::DOUBLE AS lon1,
       ((c_nationkey * 71) % 1800 - 900) / 10.0::DOUBLE AS lat2,
       ((c_nationkey * 139) % 3600 - 1800) / 10.0::DOUBLE AS lon2 FROM customer)"""


def _places(t: Tables):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return t("customer").select(
        "c_custkey",
        (((k * 37) % 1800 - 900) / 10.0).alias("lat1"),
        (((k * 91) % 3600 - 1800) / 10.0).alias("lon1"),
        (((n * 71) % 1800 - 900) / 10.0).alias("lat2"),
        (((n * 139) % 3600 - 1800) / 10.0).alias("lon2"),
    )


@query(
    "great_circle_distance",
    f"""SELECT c_custkey, round(6371 * acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE,
           sin(radians(lat1)) * sin(radians(lat2)) + cos(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon1) - radians(lon2))))), 3) AS km
        FROM {PLACES}""",
)
def _(t: Tables):
    km = great_circle_km("lat1", "lon1", "lat2", "lon2")
    return _places(t).select("c_custkey", F.round(km, 3).alias("km"))


HAVERSINE = """2 * 6371 * asin(least(1.0::DOUBLE, sqrt(pow(sin((radians({b}lat{y}) - radians({a}lat{x})) / 2), 2)
    + cos(radians({a}lat{x})) * cos(radians({b}lat{y})) * pow(sin((radians({b}lon{y}) - radians({a}lon{x})) / 2), 2))))"""


@query(
    "haversine_distance",
    f"SELECT c_custkey, round({HAVERSINE.format(a='', b='', x=1, y=2)}, 3) AS km FROM {PLACES}",
)
def _(t: Tables):
    km = haversine_km("lat1", "lon1", "lat2", "lon2")
    return _places(t).select("c_custkey", F.round(km, 3).alias("km"))


@query(
    "array_overlap_and_extra",
    """SELECT station_id, count(DISTINCT element) FILTER (element IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS core,
              count(DISTINCT element) FILTER (element NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS other,
              count(DISTINCT element) AS elements, bool_or(element = '5-LOW') AS has_low
       FROM inventory GROUP BY station_id""",
)
def _(t: Tables):
    wanted = F.array(F.lit("1-URGENT"), F.lit("2-HIGH"), F.lit("3-MEDIUM"))
    sets = t.inventory.groupBy("station_id").agg(F.collect_set("element").alias("e"))
    return sets.select(
        "station_id",
        overlap_size(wanted, "e").cast("bigint").alias("core"),
        extra_size(wanted, "e").cast("bigint").alias("other"),
        F.size("e").cast("bigint").alias("elements"),
        F.array_contains("e", "5-LOW").alias("has_low"),
    )


@query(
    "explode_array",
    "SELECT vec_id, CAST(unnest(generate_series(1, label)) AS INTEGER) AS copy FROM embeddings WHERE label > 0",
)
def _(t: Tables):
    rows = t("embeddings").filter(F.col("label") > 0)
    return rows.select("vec_id", F.explode(F.sequence(F.lit(1), F.col("label"))).alias("copy"))


@query(
    "project_array_of_structs",
    """SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY play_count DESC, item_id) AS items FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, item_id) AS r FROM plays)
       WHERE r <= 5 GROUP BY user_id""",
)
def _(t: Tables):
    from tallyfield.operators.running import top_k_per_group

    top = top_k_per_group(t.plays, ["user_id"], [F.desc("play_count"), F.asc("item_id")], 5, "r")
    lists = top.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("r", "item_id"))).alias("recs"))
    return lists.select("user_id", F.array_join(F.col("recs.item_id").cast("array<string>"), ",").alias("items"))


@query(
    "vector_over_threshold",
    "SELECT vec_id, CASE WHEN abs(score) > 0.3 THEN 1 ELSE 0 END AS custom_prediction FROM scored",
)
def _(t: Tables):
    from pyspark.ml.functions import array_to_vector

    p = F.abs("score")
    scored = t.scored.select("vec_id", array_to_vector(F.array(F.lit(1.0) - p, p)).alias("probability"))
    return apply_threshold(scored, 0.3).select("vec_id", "custom_prediction")


@query(
    "hash_uniform",
    f"SELECT event_id, round({DRAW.format(seed=7, key='CAST(event_id AS VARCHAR)')}, 9) AS draw FROM events",
)
def _(t: Tables):
    return t("events").select("event_id", F.round(hash_uniform("event_id", seed=7), 9).alias("draw"))


@query(
    "row_hash",
    "SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events",
)
def _(t: Tables):
    ids = t("events").select(row_hash("event_id", "ts", "user_id").alias("row_id"))
    return ids.groupBy("row_id").agg(F.count(F.lit(1)).alias("c")).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("ids")
    )
