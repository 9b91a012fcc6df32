"""The questions users of station, play and feature tables ask."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.catalog.columns import HAVERSINE
from tallyfield.catalog.registry import query
from tallyfield.catalog.views import CORE, FEATURES, Tables
from tallyfield.operators.aggregates import distribution
from tallyfield.operators.joins import lookup
from tallyfield.plans import genres, observations, plays, stations

ELEMENTS = ["click", "view", "purchase"]
IN_CORE = "element IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"


def _round(df: DataFrame, *cols: str, places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


ANNUAL = """
    annual AS (SELECT country_code, year, count(value) AS observations, CAST(sum(value) AS BIGINT) AS total,
                      sum(value) / count(value)::DOUBLE AS avg_value, sum(value) / count(value)::DOUBLE * 365 AS avg_x365
               FROM rain JOIN gauge ON rain.station_id = gauge.station_id {where} GROUP BY country_code, year)"""
ANNUAL_COLUMNS = """country_code, year, observations, total, round(avg_value, 4) AS avg_value, round(avg_x365, 4) AS avg_x365"""


def annual_by_country(t: Tables) -> DataFrame:
    """Yearly totals with running totals and country names."""
    annual = observations.annual_summary(t.rain, t.gauge)
    named = lookup(observations.cumulative_summary(annual), t.country, "country_code", "code", ["name"])
    return _round(named, "avg_value", "avg_x365", "cum_avg", "cum_avg_x365")


@query(
    "annual_rainfall_cumulative",
    "WITH " + ANNUAL.format(where="WHERE quality_flag IS NULL")
    + f""" SELECT {ANNUAL_COLUMNS}, name, round(sum(avg_value) OVER w, 4) AS cum_avg,
              round(sum(avg_x365) OVER w, 4) AS cum_avg_x365, CAST(sum(total) OVER w AS BIGINT) AS cum_total
       FROM annual JOIN country ON country_code = code
       WINDOW w AS (PARTITION BY country_code ORDER BY year ROWS UNBOUNDED PRECEDING)""",
)
def _(t: Tables):
    return annual_by_country(t)


@query(
    "annual_rainfall_good_rows",
    "WITH " + ANNUAL.format(where="WHERE quality_flag IS NULL") + f" SELECT {ANNUAL_COLUMNS} FROM annual",
)
def _(t: Tables):
    return _round(observations.annual_summary(t.rain, t.gauge), "avg_value", "avg_x365")


@query(
    "annual_rainfall_all_rows",
    "WITH " + ANNUAL.format(where="") + f" SELECT {ANNUAL_COLUMNS} FROM annual",
)
def _(t: Tables):
    return _round(observations.annual_summary(t.rain, t.gauge, good_only=False), "avg_value", "avg_x365")


@query(
    "station_enrichment",
    f"""SELECT s.station_id, s.station_name, s.country_code, CASE WHEN s.country_code = 3 THEN s.state_code END AS state_code,
               c.name AS country_name, CASE WHEN s.country_code = 3 THEN st.name END AS state_name,
               coalesce(i.elements, 0) AS elements, coalesce(i.core, 0) AS core_elements, coalesce(i.other, 0) AS other_elements,
               i.open_year, i.close_year
        FROM site s LEFT JOIN country c ON s.country_code = c.code LEFT JOIN state st ON s.state_code = st.code
        LEFT JOIN (SELECT station_id, count(DISTINCT element) AS elements, count(DISTINCT element) FILTER ({IN_CORE}) AS core,
                          count(DISTINCT element) FILTER (NOT {IN_CORE}) AS other, min(first_year) AS open_year,
                          max(last_year) AS close_year FROM inventory GROUP BY station_id) i ON s.station_id = i.station_id""",
)
def _(t: Tables):
    return stations.enrich_stations(t.site, t.country, t.state, t.inventory, CORE, state_country=3)


ELEMENT_COUNTS = f"""SELECT station_id, count(DISTINCT element) FILTER ({IN_CORE}) AS core_elements,
    count(DISTINCT element) FILTER (NOT {IN_CORE}) AS other_elements, count(DISTINCT element) AS elements
    FROM inventory GROUP BY station_id"""


@query("element_counts", ELEMENT_COUNTS)
def _(t: Tables):
    return stations.element_counts(t.inventory, CORE)


@query("element_counts_by_array", ELEMENT_COUNTS)
def _(t: Tables):
    return stations.element_counts_by_array(t.inventory, CORE)


@query(
    "stations_with_all_core",
    f"SELECT station_id FROM inventory WHERE {IN_CORE} GROUP BY station_id HAVING count(DISTINCT element) = 3",
)
def _(t: Tables):
    return stations.stations_with_all(t.inventory, CORE)


@query(
    "stations_with_core_only",
    f"SELECT station_id FROM inventory GROUP BY station_id HAVING bool_and({IN_CORE})",
)
def _(t: Tables):
    return stations.stations_with_only(t.inventory, CORE)


@query(
    "station_totals_by_country",
    """SELECT code, name, stations FROM country LEFT JOIN
       (SELECT country_code, count(*) AS stations FROM station GROUP BY country_code) s ON code = country_code""",
)
def _(t: Tables):
    return stations.add_station_totals(t.country, t.station, "country_code")


@query(
    "station_totals_by_state",
    """SELECT code, name, stations FROM state LEFT JOIN
       (SELECT state_code, count(*) AS stations FROM site WHERE country_code = 3 GROUP BY state_code) s ON code = state_code""",
)
def _(t: Tables):
    return stations.add_station_totals(t.state, t.site.filter(F.col("country_code") == 3), "state_code")


@query(
    "station_totals_by_network",
    """SELECT gsn_flag, hcn_crn_flag, count(station_id) AS stations FROM station
       WHERE gsn_flag IS NOT NULL AND hcn_crn_flag IS NOT NULL GROUP BY gsn_flag, hcn_crn_flag""",
)
def _(t: Tables):
    return stations.station_totals(t.station, ["gsn_flag", "hcn_crn_flag"])


@query(
    "network_overlap",
    """SELECT station_id, (gsn_flag = 'GSN')::INTEGER + (hcn_crn_flag IS NOT NULL)::INTEGER AS memberships
       FROM station WHERE gsn_flag = 'GSN' AND hcn_crn_flag IN ('HCN', 'CRN')""",
)
def _(t: Tables):
    return stations.network_overlap(t.station).select("station_id", "memberships")


@query(
    "stations_active_in_year",
    "SELECT country_code, count(*) AS stations FROM station WHERE 1995 BETWEEN first_year AND last_year GROUP BY country_code",
)
def _(t: Tables):
    active = stations.active_stations(t.station, 1995)
    return active.groupBy("country_code").agg(F.count(F.lit(1)).alias("stations"))


@query(
    "hemisphere_totals",
    """SELECT CASE WHEN lat > 0 THEN 'north' ELSE 'south' END AS hemisphere, count(DISTINCT station_id) AS stations
       FROM station WHERE lat <> 0 GROUP BY 1""",
)
def _(t: Tables):
    return stations.hemisphere_totals(t.station)


TERRITORY = """SELECT count(*) AS stations FROM station JOIN country ON country_code = code
    WHERE name LIKE '%[ASIA]%' AND code <> 2"""


@query("territory_total", TERRITORY)
def _(t: Tables):
    codes = stations.add_station_totals(t.country, t.station, "country_code")
    return stations.territory_total(codes, "%[ASIA]%", 2)


@query("territory_total_by_rows", TERRITORY)
def _(t: Tables):
    return stations.territory_total_by_rows(t.country, t.station, "%[ASIA]%", 2)


@query(
    "furthest_pair_per_country",
    f"""SELECT country_code, id_1, id_2, distance_km FROM (
          SELECT a.country_code, a.station_id AS id_1, b.station_id AS id_2,
                 round({HAVERSINE.format(a='a.', b='b.', x='', y='')}, 3) AS distance_km,
                 row_number() OVER (PARTITION BY a.country_code ORDER BY
                   {HAVERSINE.format(a='a.', b='b.', x='', y='')} DESC, a.station_id, b.station_id) AS r
          FROM station a JOIN station b ON a.country_code = b.country_code AND a.station_id < b.station_id) WHERE r = 1""",
)
def _(t: Tables):
    return _round(stations.furthest_stations(t.station), "distance_km", places=3)


@query(
    "element_coverage_observed",
    """SELECT element, count(*) AS observations, count(DISTINCT station_id) AS stations FROM obs
       WHERE element IN ('click', 'view', 'purchase') GROUP BY element""",
)
def _(t: Tables):
    return observations.element_coverage(t.obs, ELEMENTS)


@query(
    "element_coverage_inventory",
    f"""SELECT element, count(*) AS observations, count(DISTINCT station_id) AS stations FROM inventory
        WHERE {IN_CORE} GROUP BY element""",
)
def _(t: Tables):
    return observations.element_coverage(t.inventory, CORE)


FLAGS = """
    WITH flags AS (SELECT station_id, obs_date, bool_or(element = 'click') AS a, bool_or(element = 'view') AS b
                   FROM obs WHERE element IN ('click', 'view') GROUP BY 1, 2)"""


@query("presence_gaps", FLAGS + " SELECT station_id, obs_date FROM flags WHERE a AND NOT b")
def _(t: Tables):
    return observations.presence_gaps(t.obs, "click", "view")


@query(
    "presence_summary",
    FLAGS
    + """ SELECT count(*) AS pairs, count(*) FILTER (a AND b) AS both_pairs, count(*) FILTER (a AND NOT b) AS only_a_pairs,
            count(DISTINCT station_id) FILTER (a AND NOT b) AS only_a_stations, count(*) FILTER (a <> b) AS exactly_one_pairs,
            count(DISTINCT station_id) FILTER (a <> b) AS exactly_one_stations FROM flags""",
)
def _(t: Tables):
    return observations.presence_summary(t.obs, "click", "view")


EXTRACT = """
    WITH rows AS (SELECT obs.*, CAST(substr(obs_date, 1, 4) AS INTEGER) AS year, CAST(substr(obs_date, 5, 2) AS INTEGER) AS month
                  FROM obs WHERE element IN ('click', 'view')
                    AND station_id IN (SELECT station_id FROM station WHERE country_code = 3))"""


@query("extract_country_elements", EXTRACT + " SELECT * FROM rows")
def _(t: Tables):
    return observations.extract(t.obs, t.station, 3, ["click", "view"])


@query(
    "extract_coverage",
    EXTRACT
    + """ SELECT min(year) AS first_year, max(year) AS last_year,
            min(month) FILTER (year = (SELECT min(year) FROM rows)) AS first_month,
            max(month) FILTER (year = (SELECT max(year) FROM rows)) AS last_month FROM rows""",
)
def _(t: Tables):
    return observations.coverage(observations.extract(t.obs, t.station, 3, ["click", "view"]))


@query(
    "drill_down_country_year",
    """SELECT * FROM obs WHERE substr(obs_date, 1, 4) = '2024'
       AND station_id IN (SELECT station_id FROM station WHERE country_code = 5)""",
)
def _(t: Tables):
    return observations.drill_down(t.obs, t.station, 5, 2024)


@query(
    "countries_without_element",
    """WITH seen AS (SELECT country_code, coalesce(quality_flag, 'none') AS element, count(*) AS n
                     FROM obs o JOIN station s ON o.station_id = s.station_id GROUP BY 1, 2)
       SELECT code, name, element, n AS observations FROM country LEFT JOIN seen ON code = country_code
       WHERE code NOT IN (SELECT country_code FROM seen WHERE element = 'X')""",
)
def _(t: Tables):
    # All events count; the flags stand for elements, as every country with a station has all event types.
    flags = t.obs.withColumn("element", F.coalesce("quality_flag", F.lit("none")))
    return observations.missing_countries(flags, t.station, t.country, "X")


def _quality(key: str, names: str) -> str:
    return f"""SELECT {names}, count(*) FILTER (quality_flag IS NULL) AS good, count(quality_flag) AS bad, count(*) AS all_rows,
        round(count(*) FILTER (quality_flag IS NULL) / count(*)::DOUBLE, 9) AS good_share,
        round(count(quality_flag) / count(*)::DOUBLE, 9) AS bad_share FROM obs GROUP BY {key}"""


@query("quality_by_station", _quality("station_id", "station_id"))
def _(t: Tables):
    profile = observations.quality_profile(t.obs, ["station_id"], "quality_flag")
    return _round(profile, "good_share", "bad_share", places=9)


@query("quality_by_year", _quality("1", "CAST(substr(obs_date, 1, 4) AS INTEGER) AS year"))
def _(t: Tables):
    return _round(observations.quality_by_year(t.obs), "good_share", "bad_share", places=9)


@query(
    "quality_by_country",
    """SELECT c.name, count(*) FILTER (quality_flag IS NULL) AS good, count(*) AS all_rows,
              round(count(*) FILTER (quality_flag IS NULL) / count(*)::DOUBLE, 9) AS good_share
       FROM obs o LEFT JOIN station s ON o.station_id = s.station_id LEFT JOIN country c ON s.country_code = c.code GROUP BY c.name""",
)
def _(t: Tables):
    return _round(observations.quality_by_country(t.obs, t.station, t.country), "good_share", places=9)


@query(
    "fully_good_stations",
    """SELECT count(*) FILTER (bad = 0) AS good_stations, CAST(sum(n) FILTER (bad = 0) AS BIGINT) AS good_station_rows,
              count(*) FILTER (bad = n) AS stations_without_good
       FROM (SELECT station_id, count(quality_flag) AS bad, count(*) AS n FROM obs GROUP BY station_id)""",
)
def _(t: Tables):
    return observations.fully_good(t.obs)


@query(
    "reconcile_station_ids",
    """WITH only_obs AS (SELECT station_id FROM obs EXCEPT SELECT station_id FROM station),
            only_station AS (SELECT station_id FROM station EXCEPT SELECT station_id FROM obs),
            sides AS (SELECT 'observations_only' AS side, (SELECT count(*) FROM only_obs) AS n
                      UNION ALL SELECT 'stations_only', (SELECT count(*) FROM only_station))
       SELECT side, method, n FROM sides, (VALUES ('anti_join'), ('subtract'), ('multiset'), ('outer_null')) m(method)""",
)
def _(t: Tables):
    return observations.reconcile(t.obs, t.station)


@query(
    "unmatched_station_ids",
    """SELECT station_id AS id, 'observations_only' AS side FROM (SELECT station_id FROM obs EXCEPT SELECT station_id FROM station)
       UNION ALL SELECT station_id, 'stations_only' FROM (SELECT station_id FROM station EXCEPT SELECT station_id FROM obs)""",
)
def _(t: Tables):
    return observations.unmatched_ids(t.obs, t.station)


@query(
    "unmatched_station_counts",
    """SELECT 'observations_only' AS side, count(*) AS n FROM (SELECT station_id FROM obs EXCEPT SELECT station_id FROM station)
       UNION ALL SELECT 'stations_only', count(*) FROM (SELECT station_id FROM station EXCEPT SELECT station_id FROM obs)""",
)
def _(t: Tables):
    return observations.unmatched_counts(t.obs, t.station)


@query(
    "clean_plays",
    """SELECT * FROM plays WHERE item_id NOT IN (
         SELECT item_id FROM mismatched WHERE item_id NOT IN (SELECT item_id FROM accepted))""",
)
def _(t: Tables):
    return plays.clean_plays(t.plays, t.mismatched, t.accepted)


@query(
    "user_activity",
    """WITH total AS (SELECT count(DISTINCT item_id) AS n FROM plays),
            per AS (SELECT user_id, count(*) AS items, CAST(sum(play_count) AS BIGINT) AS plays FROM plays GROUP BY user_id)
       SELECT user_id, items, plays, round(items / n::DOUBLE, 9) AS share,
              round(sum(items) OVER (ORDER BY items DESC) / n::DOUBLE, 9) AS cumulative_share FROM per, total""",
)
def _(t: Tables):
    return _round(plays.user_activity(t.saved_plays), "share", "cumulative_share", places=9)


@query(
    "item_popularity",
    """SELECT item_id, count(*) AS users, CAST(sum(play_count) AS BIGINT) AS plays,
              round(count(*) / (SELECT count(DISTINCT user_id) FROM plays)::DOUBLE, 9) AS share FROM plays GROUP BY item_id""",
)
def _(t: Tables):
    return _round(plays.item_popularity(t.saved_plays), "share", places=9)


@query(
    "drop_heavy_repeaters",
    "SELECT * FROM plays WHERE user_id NOT IN (SELECT user_id FROM plays WHERE play_count > 50)",
)
def _(t: Tables):
    return plays.drop_heavy_repeaters(t.saved_plays, 50)


@query(
    "trim_sparse_users_and_items",
    """WITH u AS (SELECT user_id FROM plays GROUP BY user_id HAVING count(*) >= 30),
            i AS (SELECT item_id FROM plays GROUP BY item_id HAVING count(*) >= 20)
       SELECT * FROM plays WHERE user_id IN (SELECT user_id FROM u) AND item_id IN (SELECT item_id FROM i)""",
)
def _(t: Tables):
    return plays.trim_sparse(t.saved_plays, 30, 20)


@query(
    "trim_leftovers",
    """WITH u AS (SELECT user_id FROM plays GROUP BY user_id HAVING count(*) >= 30),
            i AS (SELECT item_id FROM plays GROUP BY item_id HAVING count(*) >= 30),
            kept AS (SELECT * FROM plays WHERE user_id IN (SELECT user_id FROM u) AND item_id IN (SELECT item_id FROM i))
       SELECT user_id, count(*) AS items, CAST(sum(play_count) AS BIGINT) AS plays FROM kept GROUP BY user_id HAVING count(*) < 30""",
)
def _(t: Tables):
    return plays.leftovers(plays.trim_sparse(t.saved_plays, 30, 30), 30)


@query("trim_sparse_to_fixed_point")
def _(t: Tables):
    return plays.trim_sparse(t.saved_plays, 25, 20, iterate=True)


@query(
    "label_features",
    """SELECT vec_id, genre, round(f0, 4) AS f0 FROM feat JOIN genre USING (vec_id)
       WHERE vec_id NOT IN (SELECT item_id FROM mismatched)""",
)
def _(t: Tables):
    bad = t.mismatched.withColumnRenamed("item_id", "vec_id")
    labelled = genres.label_features(t.feat, t.genre, bad, "vec_id", "genre")
    return labelled.select("vec_id", "genre", F.round("f0", 4).alias("f0"))


@query(
    "genre_distribution",
    """SELECT genre, count(*) AS n FROM genre WHERE vec_id NOT IN (SELECT item_id FROM mismatched) GROUP BY genre""",
)
def _(t: Tables):
    bad = t.mismatched.withColumnRenamed("item_id", "vec_id")
    return distribution(genres.label_features(t.feat.select("vec_id"), t.genre, bad, "vec_id", "genre"), "genre")


RELATED = " UNION ALL ".join(
    f"SELECT unnest(['{a}', '{b}']) AS c FROM feat HAVING abs(corr({a}, {b})) > 0.05"
    for a, b in combinations(FEATURES, 2)
)
STATS = " UNION ALL ".join(
    f"""SELECT '{f}' AS c, count({f}) AS count, round(avg({f}), 6) AS mean, round(stddev_samp({f}), 6) AS stddev,
               round(min({f}), 6) AS min, round(max({f}), 6) AS max FROM feat"""
    for f in FEATURES
)


@query(
    "feature_profile",
    f"""WITH related AS ({RELATED}), stats AS ({STATS})
        SELECT c AS "column", count, mean, stddev, min, max,
               (SELECT count(*) FROM related WHERE related.c = stats.c) AS related_columns FROM stats""",
)
def _(t: Tables):
    stats, pairs = genres.feature_profile(t.feat, FEATURES, min_abs=0.05)
    related = pairs.withColumn("c", F.explode(F.array("col_1", "col_2"))).groupBy("c").agg(
        F.count(F.lit(1)).alias("related_columns")
    )
    stats = _round(stats, "mean", "stddev", "min", "max", places=6)
    return stats.join(related.withColumnRenamed("c", "column"), "column", "left").fillna(0, "related_columns")
