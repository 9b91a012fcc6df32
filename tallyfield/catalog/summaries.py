"""Grouped and whole-table aggregates."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tallyfield.catalog.registry import query
from tallyfield.catalog.views import FEATURES, Tables
from tallyfield.operators.aggregates import (
    active_span,
    correlation_pairs,
    correlations,
    describe_columns,
    distinct_per_group,
    distribution,
    flag_counts,
    presence,
    quality_profile,
    share_of_total,
)
from tallyfield.operators.running import ecdf, rank_size, top_k_per_group
from tallyfield.operators.tiles import correlation_tiles


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def _(t: Tables):
    return t("lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("group_row_count", "SELECT element, count(*) AS n FROM obs GROUP BY element")
def _(t: Tables):
    return t.obs.groupBy("element").agg(F.count(F.lit(1)).alias("n"))


@query(
    "group_value_count",
    "SELECT station_id, count(quality_flag) AS flagged, count(station_id) AS n FROM obs GROUP BY station_id",
)
def _(t: Tables):
    return t.obs.groupBy("station_id").agg(
        F.count("quality_flag").alias("flagged"), F.count("station_id").alias("n")
    )


@query("global_sum", "SELECT CAST(sum(play_count) AS BIGINT) AS plays FROM plays")
def _(t: Tables):
    return t.plays.agg(F.sum("play_count").alias("plays"))


@query("group_min_max", "SELECT element, min(value) AS low, max(value) AS high FROM obs GROUP BY element")
def _(t: Tables):
    return t.obs.groupBy("element").agg(F.min("value").alias("low"), F.max("value").alias("high"))


@query("group_mean", "SELECT station_id, year, round(avg(value), 4) AS mean FROM rain GROUP BY station_id, year")
def _(t: Tables):
    return t.rain.groupBy("station_id", "year").agg(F.round(F.avg("value"), 4).alias("mean"))


@query(
    "several_aggregates",
    """SELECT user_id, count(item_id) AS items, CAST(sum(play_count) AS BIGINT) AS plays,
              max(play_count) AS most, round(avg(play_count), 4) AS mean FROM plays GROUP BY user_id""",
)
def _(t: Tables):
    return t.plays.groupBy("user_id").agg(
        F.count("item_id").alias("items"),
        F.sum("play_count").alias("plays"),
        F.max("play_count").alias("most"),
        F.round(F.avg("play_count"), 4).alias("mean"),
    )


@query(
    "collect_element_sets",
    "SELECT station_id, string_agg(DISTINCT element, ',' ORDER BY element) AS elements FROM inventory GROUP BY station_id",
)
def _(t: Tables):
    elements = F.array_sort(F.collect_set("element"))
    return t.inventory.groupBy("station_id").agg(F.array_join(elements, ",").alias("elements"))


@query(
    "collect_top_lists",
    """SELECT item_id, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY play_count DESC, user_id) AS users FROM (
         SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY play_count DESC, user_id) AS r FROM plays)
       WHERE r <= 10 GROUP BY item_id""",
)
def _(t: Tables):
    top = top_k_per_group(t.plays, ["item_id"], [F.desc("play_count"), F.asc("user_id")], 10, "r")
    users = F.sort_array(F.collect_list(F.struct("r", "user_id")))["user_id"].cast("array<string>")
    return top.groupBy("item_id").agg(F.array_join(users, ",").alias("users"))


@query("distinct_keys", "SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items FROM plays")
def _(t: Tables):
    users = t.saved_plays.agg(F.count_distinct("user_id").alias("users"))
    items = t.saved_plays.agg(F.count_distinct("item_id").alias("items"))
    return users.withColumn("items", items.scalar())


@query("distinct_per_group", "SELECT element, count(DISTINCT station_id) AS stations FROM obs GROUP BY element")
def _(t: Tables):
    return distinct_per_group(t.obs, ["element"], "station_id", "stations")


@query(
    "share_of_total",
    "SELECT genre, count(*) AS n, round(count(*) / (SELECT count(*) FROM genre)::DOUBLE, 6) AS share FROM genre GROUP BY genre",
)
def _(t: Tables):
    return share_of_total(t.genre, ["genre"]).withColumn("share", F.round("share", 6))


@query(
    "describe_columns",
    " UNION ALL ".join(
        f"""SELECT '{f}' AS "column", count({f}) AS count, round(avg({f}), 6) AS mean, round(stddev_samp({f}), 6) AS stddev,
                   round(min({f}), 6) AS min, round(max({f}), 6) AS max FROM feat"""
        for f in FEATURES
    ),
)
def _(t: Tables):
    stats = describe_columns(t.feat, FEATURES)
    return stats.select("column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "stddev", "min", "max")])


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_1, '{b}' AS col_2, round(corr({a}, {b}), 4) AS r FROM feat"
        for a, b in combinations(FEATURES, 2)
    ),
)
def _(t: Tables):
    return correlations(t.feat, FEATURES).withColumn("r", F.round("r", 4))


@query(
    "correlation_tiles",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_1, '{b}' AS col_2, round(corr({a}, {b}), 4) AS r FROM feat" for a, b in combinations(FEATURES, 2)
    ),
)
def _(t: Tables):
    return correlation_tiles(t.feat, FEATURES, 24).withColumn("r", F.round("r", 4))


@query(
    "correlated_pairs",
    """SELECT 'quantity' AS col_1, 'price' AS col_2, round(corr(l_quantity, l_extendedprice), 4) AS r FROM lineitem
       WHERE true HAVING abs(corr(l_quantity, l_extendedprice)) > 0.5
       UNION ALL SELECT 'quantity', 'net', round(corr(l_quantity, l_extendedprice * (1 - l_discount)), 4) FROM lineitem
       HAVING abs(corr(l_quantity, l_extendedprice * (1 - l_discount))) > 0.5
       UNION ALL SELECT 'price', 'net', round(corr(l_extendedprice, l_extendedprice * (1 - l_discount)), 4) FROM lineitem
       HAVING abs(corr(l_extendedprice, l_extendedprice * (1 - l_discount))) > 0.5""",
)
def _(t: Tables):
    rows = t("lineitem").select(
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
    )
    return correlation_pairs(rows, rows.columns, 0.5).withColumn("r", F.round("r", 4))


@query(
    "quality_by_key",
    """SELECT station_id, element, count(*) FILTER (quality_flag IS NULL) AS good, count(quality_flag) AS bad,
              count(*) AS all_rows, round(count(*) FILTER (quality_flag IS NULL) / count(*)::DOUBLE, 6) AS good_share,
              round(count(quality_flag) / count(*)::DOUBLE, 6) AS bad_share
       FROM obs GROUP BY station_id, element""",
)
def _(t: Tables):
    profile = quality_profile(t.obs, ["station_id", "element"], "quality_flag")
    return profile.withColumns({c: F.round(c, 6) for c in ("good_share", "bad_share")})


@query("flag_counts", "SELECT quality_flag, count(*) AS n FROM obs WHERE quality_flag IS NOT NULL GROUP BY quality_flag")
def _(t: Tables):
    return flag_counts(t.obs, "quality_flag")


@query(
    "presence_flags",
    """SELECT station_id, obs_date, bool_or(element = 'click') AS has_click, bool_or(element = 'view') AS has_view
       FROM obs WHERE element IN ('click', 'view') GROUP BY station_id, obs_date""",
)
def _(t: Tables):
    return presence(t.obs, ["station_id", "obs_date"], "element", ["click", "view"])


@query(
    "active_span",
    'SELECT station_id, min(first_year) AS "first", max(last_year) AS "last" FROM inventory GROUP BY station_id',
)
def _(t: Tables):
    return active_span(t.inventory, ["station_id"], "first_year", "last_year")


@query(
    "ecdf_of_activity",
    """WITH per AS (SELECT user_id, count(*) AS items FROM plays GROUP BY user_id)
       SELECT items AS value, count(*) AS n,
              round((SELECT count(*) FROM per q WHERE q.items <= per.items) / (SELECT count(*) FROM per)::DOUBLE, 6) AS ecdf
       FROM per GROUP BY items""",
)
def _(t: Tables):
    per = t.plays.groupBy("user_id").agg(F.count(F.lit(1)).alias("items"))
    return ecdf(per, "items").withColumn("ecdf", F.round("ecdf", 6))


@query(
    "rank_size_of_popularity",
    """WITH per AS (SELECT item_id, count(*) AS users FROM plays GROUP BY item_id),
            ranked AS (SELECT users, row_number() OVER (ORDER BY users DESC, item_id) AS r FROM per)
       SELECT users AS value, count(*) AS n, min(r) AS first_rank, max(r) AS last_rank FROM ranked GROUP BY users""",
)
def _(t: Tables):
    per = t.plays.groupBy("item_id").agg(F.count(F.lit(1)).alias("users"))
    return rank_size(per, "users")


@query("category_distribution", "SELECT genre, count(*) AS n FROM genre GROUP BY genre")
def _(t: Tables):
    return distribution(t.genre, "genre")
