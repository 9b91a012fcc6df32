"""Splits and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.catalog.columns import DRAW
from tallyfield.catalog.registry import query
from tallyfield.catalog.views import Tables
from tallyfield.operators.sampling import (
    class_weights,
    cold_keys,
    downsample,
    per_group_split,
    random_split,
    stratified_split,
    upsample,
)

EVENT = "CAST(event_id AS VARCHAR)"


def _events(t: Tables):
    return t("events").select("event_id", "event_type")


@query(
    "random_split",
    f"""SELECT event_id, CASE WHEN {DRAW.format(seed=1000, key=EVENT)} < 0.8 THEN 'train' ELSE 'test' END AS part FROM events""",
)
def _(t: Tables):
    train, test = random_split(t("events").select("event_id"), [0.8, 0.2], 1000, ["event_id"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "stratified_split",
    f"""SELECT event_id, event_type, {DRAW.format(seed=5, key=("event_type", EVENT))}
               < CASE event_type WHEN 'click' THEN 0.9 ELSE 0.5 END AS chosen FROM events""",
)
def _(t: Tables):
    shares = {"click": 0.9, "view": 0.5, "error": 0.5, "signup": 0.5, "purchase": 0.5}
    chosen, rest = stratified_split(_events(t), "event_type", shares, ["event_id"], 5)
    return chosen.withColumn("chosen", F.lit(True)).unionByName(rest.withColumn("chosen", F.lit(False)))


@query(
    "stratified_split_exact",
    f"""SELECT event_id, event_type,
               row_number() OVER (PARTITION BY event_type ORDER BY {DRAW.format(seed=1000, key=EVENT)}, event_id)
               < count(*) OVER (PARTITION BY event_type) * 0.8::DOUBLE AS chosen FROM events""",
)
def _(t: Tables):
    chosen, rest = stratified_split(_events(t), "event_type", 0.8, ["event_id"], 1000, exact=True)
    return chosen.withColumn("chosen", F.lit(True)).unionByName(rest.withColumn("chosen", F.lit(False)))


@query(
    "downsample_majority",
    f"""WITH rows AS (SELECT event_id, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS class FROM events),
             p AS (SELECT least(1.0::DOUBLE, 2.0::DOUBLE * count(*) FILTER (class = 1) / count(*) FILTER (class = 0)) AS p FROM rows)
        SELECT event_id, class FROM rows, p WHERE class = 1 OR {DRAW.format(seed=1000, key=EVENT)} < p""",
)
def _(t: Tables):
    rows = t("events").select("event_id", F.when(F.col("event_type") == "click", 1).otherwise(0).alias("class"))
    return downsample(rows, "class", 0, 2.0, ["event_id"], 1000)


@query(
    "upsample_minority",
    f"""SELECT event_id, event_type, count(*) AS copies FROM (
          SELECT event_id, event_type, unnest(CASE WHEN event_type = 'click' THEN range(1, 21) ELSE [0] END) AS try FROM events)
        WHERE event_type <> 'click' OR {DRAW.format(seed=1000, key=(EVENT, "CAST(try AS VARCHAR)"))} > 0.5
        GROUP BY event_id, event_type""",
)
def _(t: Tables):
    more = upsample(_events(t), "event_type", "click", 20, 0.5, ["event_id"], 1000)
    return more.groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("copies"))


@query("class_weights", "SELECT vec_id, CASE WHEN y = 0 THEN 1.0::DOUBLE ELSE 10.0::DOUBLE END AS weight FROM scored")
def _(t: Tables):
    return class_weights(t.scored.select("vec_id", "y"), "y", {0: 1.0, 1: 10.0}).drop("y")


SPLIT = """
    WITH numbered AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS r,
                             count(*) OVER (PARTITION BY user_id) AS size FROM plays)"""


@query(
    "per_user_split",
    SPLIT + " SELECT user_id, item_id, r % 5 = 1 AND size > 1 AS in_test FROM numbered",
)
def _(t: Tables):
    train, test = per_group_split(t.saved_plays.select("user_id", "item_id"), ["user_id"], ["item_id"])
    return (
        train.withColumn("in_test", F.lit(False))
        .unionByName(test.withColumn("in_test", F.lit(True)))
        .drop("row_num")
    )


@query(
    "per_user_split_fifth",
    SPLIT + " SELECT user_id, count(*) FILTER (r % 5 = 0) AS test_rows, count(*) AS all_rows FROM numbered GROUP BY user_id",
)
def _(t: Tables):
    train, test = per_group_split(t.saved_plays.select("user_id", "item_id"), ["user_id"], ["item_id"], remainder=0)
    rows = train.withColumn("t", F.lit(0)).unionByName(test.withColumn("t", F.lit(1)))
    return rows.groupBy("user_id").agg(F.sum("t").alias("test_rows"), F.count(F.lit(1)).alias("all_rows"))


@query(
    "split_cold_items",
    SPLIT
    + """, train AS (SELECT item_id FROM numbered WHERE NOT (r % 5 = 1 AND size > 1)),
           test AS (SELECT item_id FROM numbered WHERE r % 5 = 1 AND size > 1)
       SELECT item_id, 'train' AS missing_from FROM (SELECT item_id FROM test EXCEPT SELECT item_id FROM train)
       UNION ALL SELECT item_id, 'test' FROM (SELECT item_id FROM train EXCEPT SELECT item_id FROM test)""",
)
def _(t: Tables):
    train, test = per_group_split(t.saved_plays.select("user_id", "item_id"), ["user_id"], ["item_id"])
    return cold_keys(train, test, "item_id")
