"""(user, item, play count) tables: cleaning, activity, trimming, recommendation."""

from __future__ import annotations

import itertools

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.operators.evaluation import hit_average_precision, hit_ndcg, hit_precision, ranking_rows
from tallyfield.operators.features import index_strings
from tallyfield.operators.joins import exclude
from tallyfield.operators.recommend import als_fit, als_score, recommend
from tallyfield.operators.running import cumulative_share
from tallyfield.operators.sampling import per_group_split
from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin, scratch_path

#: Folders of a bucketed copy.
BUCKETS = 64


def clean_plays(
    plays: DataFrame, mismatched: DataFrame, accepted: DataFrame, item: str = "item_id"
) -> DataFrame:
    """Remove mismatched items, keeping those accepted by hand."""
    return exclude(plays, exclude(mismatched.select(item).distinct(), accepted, item), item)


def user_activity(plays: DataFrame) -> DataFrame:
    """(user, items, plays, share, cumulative_share); share is of all distinct items.

    The cumulative share adds overlapping item sets and so can exceed 1.
    """
    per_user = plays.groupBy("user_id").agg(
        F.count("item_id").alias("items"), F.sum("play_count").alias("plays")
    )
    per_user = pin(per_user, "activity")
    all_items = plays.agg(F.count_distinct("item_id").alias("n")).first()[0]
    shared = per_user.withColumn("share", F.col("items") / F.lit(float(all_items)))
    return cumulative_share(shared, "items", F.lit(float(all_items)))


def item_popularity(plays: DataFrame) -> DataFrame:
    """(item, users, plays, share); share is of all distinct users."""
    per_item = plays.groupBy("item_id").agg(
        F.count("user_id").alias("users"), F.sum("play_count").alias("plays")
    )
    all_users = plays.agg(F.count_distinct("user_id").alias("n")).scalar()
    return per_item.withColumn("share", F.col("users") / all_users)


def heavy_repeaters(plays: DataFrame, threshold: int) -> DataFrame:
    """Users with any single count above ``threshold``."""
    return plays.filter(F.col("play_count") > threshold).select("user_id").distinct()


def drop_heavy_repeaters(plays: DataFrame, threshold: int) -> DataFrame:
    """Plays of the other users, without repeated rows."""
    return exclude(plays, heavy_repeaters(plays, threshold), "user_id").distinct()


def trim_sparse(
    plays: DataFrame,
    min_items: int,
    min_users: int,
    iterate: bool = False,
    measure: str = "users",
    max_rounds: int | None = None,
) -> DataFrame:
    """Drop users with few items and items with few users.

    Both tests use the counts before the step. ``iterate`` repeats the step
    until nothing more is dropped (see ``peel``), or raises after ``max_rounds`` when that is given.
    ``measure='plays'`` tests an item's plays.
    """
    if iterate:
        return peel(plays, min_items, min_users, measure, max_rounds)[0]
    quiet = plays.groupBy("user_id").agg(F.count("item_id").alias("n")).filter(F.col("n") < min_items)
    size = F.count("user_id") if measure == "users" else F.sum("play_count")
    rare = plays.groupBy("item_id").agg(size.alias("n")).filter(F.col("n") < min_users)
    return exclude(exclude(plays, quiet, "user_id"), rare, "item_id")


def peel(
    plays: DataFrame,
    min_items: int,
    min_users: int,
    measure: str = "users",
    max_rounds: int | None = None,
    buckets: int = BUCKETS,
) -> tuple[DataFrame, list[dict[str, int]]]:
    """The rows left when sparse users and items are dropped until none is left, and what each round read.

    The rows are counted once. They are kept in two copies, bucketed by user and by
    item; a round reads only the buckets of the ids dropped just before, subtracts
    the rows that went with them, and looks again at the users and items of those rows
    alone. Tests of a round use the counts before it. Null users and items are never dropped.
    The log has (users, items, buckets, rows) of each round: ids dropped, buckets read, rows removed.
    """
    spark = plays.sparkSession
    limits = {"user_id": min_items, "item_id": min_users}
    measures = {
        "user_id": (F.count("item_id"), F.count("item_id")),
        "item_id": (F.count("user_id"),) * 2 if measure == "users" else (F.sum("play_count"), F.count("play_count")),
    }
    edges = plays.select("user_id", "item_id", "play_count")
    copies, counts, gone, fresh = {}, {}, {}, {}
    for key in limits:
        copies[key] = scratch_path(spark, f"by-{key}")
        _bucketed(edges, key, buckets).write.partitionBy("_bucket").parquet(copies[key])
        counts[key], gone[key] = scratch_path(spark, f"counts-{key}"), scratch_path(spark, f"gone-{key}")
        total, present = measures[key]
        base = edges.groupBy(key).agg(total.alias("n"), present.alias("present"))
        base = base.filter(F.col(key).isNotNull()).withColumn("round", F.lit(0))
        base.write.parquet(counts[key])
        fresh[key] = spark.read.parquet(counts[key]).filter(_sparse(key, limits[key], measure)).select(key)
    layout = T.StructType([*edges.schema.fields, T.StructField("_bucket", T.IntegerType())])
    log = []
    for at in itertools.count():
        if max_rounds is not None and at >= max_rounds:
            raise RuntimeError(f"trimming did not settle in {max_rounds} rounds")
        fresh = {key: pin(ids, "fresh") for key, ids in fresh.items()}
        dropped = {key: ids.count() for key, ids in fresh.items()}
        if not any(dropped.values()):
            break
        users, items = (spark.read.schema(layout).parquet(copies[k]) for k in limits)
        near_users, read_users = _beside(users, fresh["user_id"], "user_id", buckets)
        near_items, read_items = _beside(items, fresh["item_id"], "item_id", buckets)
        # A row of a dropped user and a dropped item goes once; rows that went in earlier rounds are not met again.
        lost = near_users.unionByName(keyed_join(near_items, fresh["user_id"], ["user_id"], "left_anti"))
        if at:
            for key in limits:
                lost = keyed_join(lost, spark.read.parquet(gone[key]), [key], "left_anti")
        lost = pin(lost, "lost")
        log.append({"users": dropped["user_id"], "items": dropped["item_id"], "buckets": read_users + read_items, "rows": lost.count()})
        for key in limits:
            fresh[key].write.mode("append").parquet(gone[key])
        for key, limit in limits.items():
            total, present = measures[key]
            taken = lost.filter(F.col(key).isNotNull()).groupBy(key).agg(total.alias("_n"), present.alias("_present"))
            taken = pin(keyed_join(taken, spark.read.parquet(gone[key]), [key], "left_anti"), "taken")
            states = keyed_join(spark.read.parquet(counts[key]), taken.select(key), [key], "left_semi")
            latest = states.groupBy(key).agg(F.max_by(F.struct("n", "present"), "round").alias("_was"))
            now = latest.join(taken, key).select(
                key,
                (F.col("_was.n") - F.coalesce("_n", F.lit(0))).alias("n"),
                (F.col("_was.present") - F.col("_present")).alias("present"),
                F.lit(at + 1).alias("round"),
            )
            now = pin(now, "now")
            now.write.mode("append").parquet(counts[key])
            fresh[key] = now.filter(_sparse(key, limit, measure)).select(key)
    out = plays
    if log:
        for key in limits:
            out = keyed_join(out, spark.read.parquet(gone[key]), [key], "left_anti")
    return out, log


def _sparse(key: str, limit: int, measure: str) -> Column:
    """Below the limit; a sum over no play count at all is unknown and stays."""
    known = F.lit(True) if key == "user_id" or measure == "users" else F.col("present") > 0
    return (F.col("n") < limit) & known


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _bucketed(edges: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows gathered by bucket, each bucket in up to eight files so that a hot id is not one task's work."""
    part = F.pmod(F.xxhash64("user_id", "item_id", "play_count") + F.spark_partition_id(), F.lit(8))
    return edges.withColumns({"_bucket": _bucket(key, buckets), "_part": part}).repartition("_bucket", "_part").drop("_part")


def _beside(copy: DataFrame, ids: DataFrame, key: str, buckets: int) -> tuple[DataFrame, int]:
    """The rows of ``ids`` from the buckets that hold them, and the number of those buckets (a fixed bound)."""
    wanted = [r[0] for r in ids.select(_bucket(key, buckets).alias("b")).distinct().collect()]
    return keyed_join(copy.filter(F.col("_bucket").isin(wanted)).drop("_bucket"), ids, [key], "left_semi"), len(wanted)


def leftovers(plays: DataFrame, min_items: int) -> DataFrame:
    """Users that a single trimming pass left below the limit."""
    per_user = plays.groupBy("user_id").agg(
        F.count("item_id").alias("items"), F.sum("play_count").alias("plays")
    )
    return per_user.filter(F.col("items") < min_items)


def indexed(plays: DataFrame) -> DataFrame:
    """Plays with dense integer ``user`` and ``item`` columns and a ``rating``."""
    ids = index_strings(plays, {"user_id": "user", "item_id": "item"})
    return ids.withColumn("rating", F.col("play_count").cast("float"))


def recommendation_run(
    plays: DataFrame,
    k: int = 10,
    every: int = 5,
    precision_k: int = 5,
    order: Sequence[str] = ("item_id",),
    exclude_seen: bool = False,
    truth_items: int | None = None,
    **als,
) -> DataFrame:
    """Split, fit, recommend and measure: (method, precision_at, ndcg_at, map, users).

    ``all_items`` ranks every item for each user. ``rerank_test_items`` ranks
    only the items of the user's own test rows, which flatters the model. A user's
    whole test rows are the truth; ``truth_items`` cuts them to the most played.
    """
    train, test = per_group_split(indexed(plays), ["user_id"], list(order), every)
    train, test = pin(train, "train"), pin(test, "test")
    model = als_fit(train, **als)
    found = {
        "all_items": recommend(model, k, train if exclude_seen else None),
        "rerank_test_items": als_score(model, test).withColumnRenamed("prediction", "score"),
    }
    out = None
    for method, recs in found.items():
        places = pin(ranking_rows(recs, test, k, "user", "item", "score", "rating", truth_items), "places")
        row = places.agg(F.count_if(F.col("rank") == 1).alias("users")).select(
            F.lit(method).alias("method"),
            hit_precision(places, precision_k).scalar().alias("precision_at"),
            hit_ndcg(places, k).scalar().alias("ndcg_at"),
            hit_average_precision(places, "user").scalar().alias("map"),
            "users",
        )
        out = row if out is None else out.unionByName(row)
    return out
