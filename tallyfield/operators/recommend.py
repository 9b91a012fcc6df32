"""Implicit-feedback recommendation with alternating least squares."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.functions import ratio
from tallyfield.operators.joins import restrict
from tallyfield.operators.running import number_rows, top_k_per_group
from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin, shared_dir

# Training settings used by default.
MAX_ITER, REG_PARAM, SEED = 5, 0.01, 1000
# MLlib's own number of blocks holds up to 40 million ratings; beyond, blocks are added to keep their size.
BLOCKS, RATINGS_PER_BLOCK = 10, 4_000_000
# With more blocks, factors are checkpointed every second iteration, so that older shuffle files can go.
CHECKPOINT_EVERY = 2
# Up to this many pairs MLlib's blocked products score them all.
ALL_PAIRS = 1_000_000_000
# Items of the first round, and of a block, and how much each later round grows.
FIRST_ITEMS, GROWTH = 4096, 8
MAX_BLOCKS = 10_000
# Items of one round travel to all executors, so a round holds at most this many bytes, or one block.
ROUND_BYTES = 32 << 20
USERS_PER_TASK = 2048
# Users and items multiplied at once, and bytes of an Arrow batch: the memory of one Python worker.
USERS_AT_ONCE, ITEMS_AT_ONCE, BATCH_BYTES = 512, 4096, 4 << 20
# Rounding of a product of norms; a block is skipped only when it is this clearly out of reach.
SLACK = 1e-9
# Rounding of a matrix product in single precision, as a share of the product of both lengths and per factor.
PRODUCT_SLACK, TINY = 2.0**-22, 1e-30
# Stretches of a block whose best scores tell how good a user's best must be.
STRETCHES = 128


def als_fit(
    df: DataFrame,
    user: str = "user",
    item: str = "item",
    rating: str = "rating",
    max_iter: int = MAX_ITER,
    reg: float = REG_PARAM,
    seed: int = SEED,
    implicit: bool = True,
    **params,
) -> ALSModel:
    """Fit on integer user and item ids; factor lineage is cut in the shared folder.

    Ratings are counted first: a task holds one block of them, so their number grows with the table. Give
    ``numUserBlocks`` and ``numItemBlocks`` to fix it.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    blocks = max(BLOCKS, -(-df.count() // RATINGS_PER_BLOCK))
    settings = {"numUserBlocks": blocks, "numItemBlocks": blocks}
    if blocks > BLOCKS:
        settings["checkpointInterval"] = CHECKPOINT_EVERY
    als = ALS(
        maxIter=max_iter,
        regParam=reg,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        seed=seed,
        implicitPrefs=implicit,
        coldStartStrategy="drop",
        **{**settings, **params},
    )
    return als.fit(df)


def als_score(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Add ``prediction``; pairs with an unknown user or item are dropped."""
    return model.transform(pairs)


def recommend(
    model: ALSModel, k: int, exclude_seen: DataFrame | None = None, users: DataFrame | None = None
) -> DataFrame:
    """(user, item, score, rank): the ``k`` best items of every user over all items.

    With ``exclude_seen`` (rows of user and item) no seen item is returned, and every user still gets the
    best ``k`` of the others. With ``users`` only these users are served. :func:`best_items` does the work,
    or MLlib's blocked products when nothing is excluded and there are at most ``ALL_PAIRS`` pairs.
    """
    user, item = model._java_obj.getUserCol(), model._java_obj.getItemCol()
    people = model.userFactors.select(F.col("id").alias(user), "features")
    if users is not None:
        people = restrict(people, users, user)
    if exclude_seen is None and people.count() * model.itemFactors.count() <= ALL_PAIRS:
        found = model.recommendForAllUsers(k) if users is None else model.recommendForUserSubset(users, k)
        rows = found.select(user, F.posexplode("recommendations").alias("_pos", "_rec"))
        return rows.select(
            user,
            F.col(f"_rec.{item}").alias(item),
            F.col("_rec.rating").alias("score"),
            (F.col("_pos") + 1).cast("bigint").alias("rank"),
        )
    return best_items(people, model.itemFactors.select(F.col("id").alias(item), "features"), k, exclude_seen)


def best_items(
    users: DataFrame,
    items: DataFrame,
    k: int,
    exclude_seen: DataFrame | None = None,
    first_items: int = FIRST_ITEMS,
    growth: int = GROWTH,
) -> DataFrame:
    """(user, item, score, rank): the ``k`` best unseen items, from (user, features) and (item, features).

    Exact. Items are numbered by falling length of their factors. A round scores the next blocks of items,
    ``growth`` times as many as before, for the users they can still matter to: a score is at most the
    product of both lengths, so a block is skipped when that falls short of the ``k``-th score so far of
    all users of a pack; users in need of about the same length share packs. A pack meets a block in one
    matrix product, which only sorts out: scores are then summed in the order of the factors. Of a block
    go on the user's best ``k`` items and one more per seen item of the round, so a user who has seen nearly
    everything still gets what is left; seen pairs are dealt to the rounds of their items once. Nothing is
    gathered per user: candidates and results are rows. Equal scores go to the smaller item.
    """
    if growth < 2 or first_items < 1:
        raise ValueError("rounds must grow: growth at least 2, first_items at least 1")
    user, item = users.columns[0], items.columns[0]
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((users, user), (items, item))}
    _bound_batches(users.sparkSession)
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    people = pin(users.select(user, F.col("features").alias("_u"), length.alias("_len")), "users")
    placed = items.select(item, F.col("features").alias("_v"), length.alias("_norm"))
    placed = pin(placed, "items")
    numbered = number_rows(placed, [], [F.desc("_norm"), F.asc(item)], "_place")
    total = placed.count()
    size = max(first_items, -(-total // MAX_BLOCKS))
    placed = pin(numbered.withColumn("_block", F.floor((F.col("_place") - 1) / size)), "placed")
    # At most MAX_BLOCKS rows: the longest factor of each block, falling.
    reach = [r[1] for r in sorted(placed.groupBy("_block").agg(F.max("_norm")).collect())]
    rank = len(placed.select("_v").first()[0]) if reach else 0
    # Inside a block items go by id, so that of equal scores the first is the smaller item.
    rows = F.sort_array(F.collect_list(F.struct(F.col(item).alias("item"), F.col("_v").alias("v"))))
    packs = placed.groupBy("_block").agg(rows.alias("_rows"))
    packs = pin(packs.select("_block", F.col("_rows.item").alias("_items"), F.flatten("_rows.v").alias("_vs")), "packs")
    most, bounds, end = max(1, ROUND_BYTES // (size * (4 * rank + 8))), [], 0
    while end < len(reach):
        begin, end = end, min(len(reach), max(1, end * growth), end + most)
        bounds.append((begin, end))
    seen = None
    if exclude_seen is not None:
        pairs = exclude_seen.select(user, item).dropna().distinct()
        seen = pin(keyed_join(pairs, placed.select(item, "_block"), [item], "inner"), "seen")
    best = users.sparkSession.createDataFrame([], f"{user} {kinds[user]}, {item} {kinds[item]}, score double, rank int")
    packed = f"_users array<{kinds[user]}>, _us array<float>, _kths array<double>, _rooms array<bigint>, _blocks array<bigint>"
    for begin, end in bounds:
        # The user's k-th score so far; null while there are fewer than k items.
        kth = best.groupBy(user).agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("_kth")
        )
        open_users = people.join(kth, user, "left") if begin else people.withColumn("_kth", F.lit(None).cast("double"))
        bound = F.col("_kth") - SLACK * F.abs("_kth")
        open_users = open_users.filter(F.col("_kth").isNull() | (F.col("_len") * reach[begin] >= bound))
        open_users = open_users.withColumn("_room", F.lit(k).cast("bigint"))
        if seen is not None:
            known = seen.filter((F.col("_block") >= begin) & (F.col("_block") < end)).select(user, item)
            counts = known.groupBy(user).agg(F.count(F.lit(1)).alias("_seen"))
            open_users = open_users.join(counts, user, "left").withColumn("_room", F.col("_room") + F.coalesce("_seen", F.lit(0)))
        # Few bytes but much work: users are spread by number, those in need of a like length together.
        asked = pin(open_users.select(user, F.col("_u").cast("array<float>").alias("_u"), "_len", "_kth", "_room"), "asked")
        need = ratio("_kth", "_len")
        tasks = max(1, -(-asked.count() // USERS_PER_TASK))
        asked = asked.repartitionByRange(tasks, need.desc(), F.col(user)).sortWithinPartitions(need.desc(), user)
        asked = asked.mapInArrow(_packer(np.array(reach[begin:end]), begin), packed).withColumn("_block", F.explode("_blocks")).drop("_blocks")
        mine = packs.filter((F.col("_block") >= begin) & (F.col("_block") < end))
        met = asked.join(F.broadcast(mine), "_block").select("_users", "_us", "_kths", "_rooms", "_items", F.col("_vs").cast("array<float>"))
        fresh = met.mapInArrow(_scorer(rank), f"{user} {kinds[user]}, {item} {kinds[item]}, score double")
        if seen is not None:
            fresh = fresh.join(known, [user, item], "left_anti")
        found = best.select(user, item, "score").unionByName(fresh)
        best = pin(top_k_per_group(found, [user], [F.desc("score"), F.asc(item)], k, "rank"), "best")
    return best.select(user, item, F.col("score").cast("float").alias("score"), F.col("rank").cast("bigint").alias("rank"))


def _bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches within ``BATCH_BYTES``: a row here holds a pack of users and a block of items."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()) > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def _packer(reach: np.ndarray, begin: int):
    """Batches of (user, factors, length, k-th score, room) to packs of users with the blocks in reach of any of them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, USERS_AT_ONCE):
                users, factors, length, kth, room = batch.slice(at, USERS_AT_ONCE).columns
                low = kth.to_numpy(zero_copy_only=False)
                low = np.where(np.isnan(low), -np.inf, low - SLACK * np.abs(low))
                # Lengths fall, so the blocks in reach are the first ones.
                products = length.to_numpy(zero_copy_only=False)[:, None] * reach
                depth = int((products >= low[:, None]).sum(axis=1).max())
                if depth:
                    blocks = pa.array(range(begin, begin + depth), pa.int64())
                    cells = [users, factors.flatten(), kth, room, blocks]
                    rows = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in cells]
                    yield pa.RecordBatch.from_arrays(rows, ["_users", "_us", "_kths", "_rooms", "_blocks"])

    return pack


def _scorer(rank: int):
    """Rows of a pack of users and a block of items to the candidates (user, item, score) among them."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                users, us, kths, rooms, items, vs = (column[row].values for column in batch.columns)
                u = us.to_numpy(zero_copy_only=False).astype(float).reshape(len(users), rank)
                v = vs.to_numpy(zero_copy_only=False).astype(float).reshape(len(items), rank)
                kth = kths.to_numpy(zero_copy_only=False).astype(float)
                room = rooms.to_numpy(zero_copy_only=False)
                for at in range(0, len(items), ITEMS_AT_ONCE):
                    who, what, scores = _candidates(u, v[at : at + ITEMS_AT_ONCE], kth, room)
                    if len(who):
                        cells = [users.take(pa.array(who)), items.take(pa.array(what + at)), pa.array(scores)]
                        yield pa.RecordBatch.from_arrays(cells, ["user", "item", "score"])

    return score


def _candidates(u: np.ndarray, v: np.ndarray, kth: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``u``, row of ``v``, score) of each user's best ``room`` items, without those below ``kth`` (NaN: none)."""
    # Single precision only sorts out, with a margin for its rounding.
    near = u.astype(np.float32) @ v.astype(np.float32).T
    slack = PRODUCT_SLACK * (u.shape[1] + 4) * np.sqrt((u * u).sum(axis=1)) * np.sqrt((v * v).sum(axis=1).max()) + TINY
    floor = np.where(np.isnan(kth), -np.inf, kth) - slack
    # The best of each stretch of items: as many places down as a user has room for, none of the best lies below.
    parts = min(STRETCHES, len(v))
    tops = near[:, : len(v) // parts * parts].reshape(len(u), parts, -1).max(axis=2)
    tops.sort(axis=1)
    some = room <= parts
    last = tops[np.arange(len(u)), parts - np.where(some, room, 1)]
    floor = np.where(some, np.maximum(floor, last - 2 * slack), floor)
    within = near >= _below(floor)[:, None]
    who, what = np.nonzero(within)
    scores = np.zeros(len(who))
    for i in range(u.shape[1]):
        scores += u[who, i] * v[what, i]
    good = ~(scores < kth[who])
    who, what, scores = who[good], what[good], scores[good]
    order = np.lexsort((what, -scores, who))
    who, what, scores = who[order], what[order], scores[order]
    kept = np.arange(len(who)) - np.searchsorted(who, who) < room[who]
    return who[kept], what[kept], scores[kept]


def _below(x: np.ndarray) -> np.ndarray:
    """The nearest single-precision numbers that are not above ``x``."""
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


def compare_for_users(
    recs: DataFrame,
    plays: DataFrame,
    users: DataFrame,
    k: int,
    user: str = "user",
    item: str = "item",
    rating: str = "rating",
) -> DataFrame:
    """(user, recommended, played, overlap) for chosen users, ``k`` items on each side."""
    chosen = restrict(recs.filter(F.col("rank") <= k), users, user)
    top = top_k_per_group(restrict(plays, users, user), [user], [F.desc(rating), F.asc(item)], k, "_rank")
    recommended = chosen.groupBy(user).agg(_ordered("rank", item).alias("recommended"))
    played = top.groupBy(user).agg(_ordered("_rank", item).alias("played"))
    both = recommended.join(played, user)
    return both.withColumn("overlap", F.size(F.array_intersect("recommended", "played")))


def _ordered(rank: str, item: str):
    return F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(item).alias("item"))))["item"]

