"""Running totals, numbering, ranks, sorts and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.catalog.registry import query
from tallyfield.catalog.views import Tables
from tallyfield.operators.running import (
    arg_max,
    cumulative_share,
    number_rows,
    running_sum,
    top_k_per_group,
    top_n,
)
from tallyfield.session import pin


@query(
    "running_sum",
    """SELECT station_id, year, total, n,
              CAST(sum(total) OVER w AS BIGINT) AS cum_total, CAST(sum(n) OVER w AS BIGINT) AS cum_n
       FROM (SELECT station_id, year, CAST(sum(value) AS BIGINT) AS total, count(*) AS n FROM rain GROUP BY 1, 2)
       WINDOW w AS (PARTITION BY station_id ORDER BY year ROWS UNBOUNDED PRECEDING)""",
)
def _(t: Tables):
    years = t.rain.groupBy("station_id", "year").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
    return running_sum(years, ["station_id"], ["year"], {"cum_total": "total", "cum_n": "n"}, bounded=True)


@query(
    "running_sum_sliced",
    """SELECT element, event_id, CAST(sum(value) OVER (PARTITION BY element ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_value
       FROM (SELECT event_id, event_type AS element, CAST(round(value * 10) AS BIGINT) AS value FROM events)""",
)
def _(t: Tables):
    rows = t("events").select(
        "event_id",
        F.col("event_type").alias("element"),
        F.round(F.col("value") * 10).cast("bigint").alias("value"),
    )
    # The low limit cuts every group into slices at test scale.
    sums = running_sum(rows, ["element"], ["event_id"], {"cum_value": "value"}, max_group=100)
    return sums.drop("value")


@query(
    "cumulative_share",
    """WITH per AS (SELECT user_id, count(*) AS items FROM plays GROUP BY user_id)
       SELECT user_id, items, round(sum(items) OVER (ORDER BY items DESC) / (SELECT sum(items) FROM per)::DOUBLE, 6) AS share
       FROM per""",
)
def _(t: Tables):
    per = pin(t.plays.groupBy("user_id").agg(F.count(F.lit(1)).alias("items")), "activity")
    total = per.agg(F.sum("items").cast("double").alias("t")).scalar()
    return cumulative_share(per, "items", total, "share").withColumn("share", F.round("share", 6))


@query(
    "number_rows_per_user",
    "SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS row_num FROM plays",
)
def _(t: Tables):
    return number_rows(t.saved_plays.select("user_id", "item_id"), ["user_id"], ["item_id"])


@query(
    "top_k_per_user",
    """SELECT * FROM (SELECT user_id, item_id, play_count,
                             row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, item_id) AS rank FROM plays)
       WHERE rank <= 10""",
)
def _(t: Tables):
    return top_k_per_group(t.plays, ["user_id"], [F.desc("play_count"), F.asc("item_id")], 10)


@query(
    "top_k_with_ties",
    """SELECT * FROM (SELECT user_id, item_id, play_count,
                             rank() OVER (PARTITION BY user_id ORDER BY play_count DESC) AS rank FROM plays)
       WHERE rank <= 10""",
)
def _(t: Tables):
    # The operator reads the plays once for the ranks and again for the rows.
    return top_k_per_group(t.saved_plays, ["user_id"], [("play_count", True)], 10, ties="rank")


@query(
    "sort_with_tie_break",
    "SELECT element, station_id, count(*) AS n FROM obs GROUP BY element, station_id ORDER BY n DESC, element, station_id",
)
def _(t: Tables):
    counts = t.obs.groupBy("element", "station_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "element", "station_id")


@query("limit_ordered_rows", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 1000")
def _(t: Tables):
    return t("events").select("event_id", "value").orderBy("event_id").limit(1000)


@query("preview_rows")
def _(t: Tables):
    return t.obs.limit(20)


@query(
    "top_n_by_value",
    "SELECT station_id, obs_date, element, value FROM obs ORDER BY value DESC, station_id, obs_date, element LIMIT 10",
)
def _(t: Tables):
    order = [F.desc("value"), "station_id", "obs_date", "element"]
    return top_n(t.obs.drop("quality_flag"), order, 10)


@query(
    "arg_max_row",
    """SELECT item_id, user_id, play_count FROM (
         SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY play_count DESC, user_id) AS r FROM plays) WHERE r = 1""",
)
def _(t: Tables):
    return arg_max(t.plays, "play_count", ["item_id"], ["user_id"])


@query("first_value", "SELECT event_type, min(event_id) AS first_id FROM events GROUP BY event_type")
def _(t: Tables):
    rows = t("events").select("event_type", "event_id")
    return rows.groupBy("event_type").agg(F.min_by("event_id", "event_id").alias("first_id"))
