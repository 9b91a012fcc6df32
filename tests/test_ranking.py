"""Recommendations by factor blocks and ranking metrics from hit rows, against plain Python."""

import math

import numpy as np
import pytest

from tallyfield.operators import evaluation
from tallyfield.operators import recommend as recommending
from tallyfield.operators.recommend import als_fit, best_items, recommend

RATING = "user int, item int, score double"


def _factors(spark, seed, users, items, rank=4):
    rng = np.random.default_rng(seed)
    u = rng.normal(0, 1, (users, rank)).astype(np.float32)
    v = (rng.normal(0, 1, (items, rank)) * rng.exponential(1, (items, 1))).astype(np.float32)
    v[5] = v[9]  # equal scores
    u[3] = 0.0
    frame = lambda m, name: spark.createDataFrame(
        [(i, [float(x) for x in row]) for i, row in enumerate(m)], f"{name} int, features array<float>"
    )
    return u.astype(float), v.astype(float), frame(u, "user"), frame(v, "item")


def _best(u, v, k, seen=()):
    out = set()
    for i, row in enumerate(u):
        scores = sorted((-float(sum(a * b for a, b in zip(row, other))), j) for j, other in enumerate(v) if (i, j) not in seen)
        out |= {(i, j, r + 1) for r, (_, j) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("first,growth", [(4, 2), (16, 8), (1000, 2)])
def test_best_items_equal_brute_force(spark, first, growth):
    u, v, users, items = _factors(spark, 1, 12, 70)
    rows = best_items(users, items, 5, None, first, growth).collect()
    assert {(r.user, r.item, r["rank"]) for r in rows} == _best(u, v, 5)
    assert all(r.score == pytest.approx(float(u[r.user] @ v[r.item]), rel=1e-5, abs=1e-6) for r in rows)


def test_best_items_leave_out_what_was_seen(spark):
    u, v, users, items = _factors(spark, 2, 8, 40)
    # One user has seen all but three items, one everything, one nothing.
    seen = {(0, j) for j in range(37)} | {(1, j) for j in range(40)} | {(i, (7 * i + j) % 40) for i in range(2, 7) for j in range(9)}
    pairs = spark.createDataFrame([(i, j, 1.0) for i, j in sorted(seen)] * 2 + [(None, 4, 1.0), (5, 999, 1.0)], RATING)
    rows = best_items(users, items, 3, pairs, 4, 3).collect()
    found = {(r.user, r.item, r["rank"]) for r in rows}
    assert found == _best(u, v, 3, seen)
    assert {j for i, j, _ in found if i == 0} == {37, 38, 39} and not any(i == 1 for i, _, _ in found)


def test_best_items_of_few_or_no_items(spark):
    u, v, users, items = _factors(spark, 3, 5, 12)
    assert len(best_items(users, items, 50).collect()) == 5 * 12
    assert best_items(users, items.limit(0), 3).collect() == []
    assert best_items(users.limit(0), items, 3).collect() == []
    with pytest.raises(ValueError):
        best_items(users, items, 3, None, 4, 1)


def _metrics(recs, truth, k, cut=None):
    found = []
    for user in sorted({u for u, _, _ in recs} & {u for u, _, _ in truth}):
        ranked = [i for _, i, _ in sorted((r for r in recs if r[0] == user), key=lambda r: (-r[2], r[1]))][:k]
        best = {}
        for u, i, s in truth:
            if u == user:
                best[i] = max(s, best.get(i, s))
        used = sorted(best, key=lambda i: (-best[i], i))[:cut]
        hits = [int(i in used) for i in ranked]
        ideal = sum(1 / math.log2(p + 2) for p in range(min(len(used), k)))
        gain = sum(h / math.log2(p + 2) for p, h in enumerate(hits))
        average = sum(sum(hits[: p + 1]) / (p + 1) for p, h in enumerate(hits) if h) / len(used)
        found.append((sum(hits) / k, gain / ideal, average))
    return tuple(np.mean(found, axis=0))


@pytest.mark.parametrize("cut", [None, 2])
def test_ranking_rows_equal_plain_python(spark, cut):
    rng = np.random.default_rng(7)
    recs = [(int(u), int(i), float(rng.integers(5))) for u in range(9) for i in rng.choice(30, 8, replace=False)]
    truth = [(int(u), int(i), float(rng.integers(4))) for u in range(2, 12) for i in rng.choice(30, int(rng.integers(1, 20)))]
    frames = [spark.createDataFrame(x, RATING) for x in (recs, truth)]
    rows = evaluation.ranking_rows(*frames, 5, "user", "item", "score", "score", cut)
    want = _metrics(recs, truth, 5, cut)
    assert evaluation.hit_precision(rows, 5).first()[0] == pytest.approx(want[0])
    assert evaluation.hit_ndcg(rows, 5).first()[0] == pytest.approx(want[1])
    assert evaluation.hit_average_precision(rows, "user").first()[0] == pytest.approx(want[2])


def test_ranking_rows_need_a_rating_for_a_cut_and_may_be_empty(spark):
    none = spark.createDataFrame([], RATING)
    with pytest.raises(ValueError):
        evaluation.ranking_rows(none, none, 5, "user", "item", "score", None, 3)
    rows = evaluation.ranking_rows(none, none, 5, "user", "item", "score")
    assert rows.collect() == [] and evaluation.hit_ndcg(rows, 5).first()[0] is None


def _ratings(spark):
    rows = [(i % 13, (i * 7 + i // 13) % 29, float(1 + i % 5)) for i in range(150)]
    return spark.createDataFrame(rows, RATING).withColumnRenamed("score", "rating")


def test_als_blocks_grow_with_the_ratings(spark, monkeypatch):
    given = []
    als = recommending.ALS
    monkeypatch.setattr(recommending, "ALS", lambda **params: given.append(params) or als(**params))
    ratings = _ratings(spark)
    als_fit(ratings, max_iter=1)
    monkeypatch.setattr(recommending, "RATINGS_PER_BLOCK", 11)
    model = als_fit(ratings, max_iter=2)
    als_fit(ratings, max_iter=1, numUserBlocks=2)
    assert [(p["numUserBlocks"], p["numItemBlocks"], p.get("checkpointInterval")) for p in given] == [(10, 10, None), (14, 14, 2), (2, 14, 2)]
    assert model.userFactors.count() == 13 and model.itemFactors.count() == 29


def test_recommend_beyond_the_pairs_limit_equals_blocked_products(spark, monkeypatch):
    model = als_fit(_ratings(spark))
    blocked = {(r.user, r["rank"]): r for r in recommend(model, 4).collect()}
    monkeypatch.setattr(recommending, "ALL_PAIRS", 0)
    monkeypatch.setattr(recommending.ALSModel, "recommendForAllUsers", None)
    rows = recommend(model, 4).collect()
    assert len(rows) == len(blocked) == 13 * 4
    assert all(r.score == pytest.approx(blocked[r.user, r["rank"]].score, rel=1e-5, abs=1e-6) for r in rows)


@pytest.mark.parametrize("rooms", [(3, 3), (1, 400)])
def test_candidates_hold_the_best_of_a_block(rooms):
    rng = np.random.default_rng(4)
    u = rng.normal(0, 1, (40, 5)).astype(np.float32).astype(float)
    v = rng.normal(0, 1, (333, 5)).astype(np.float32).astype(float)
    u[7] = 0.0
    v[100:120] = v[5]  # equal scores
    kth = np.where(np.arange(40) % 3 == 0, np.nan, 1.5)
    room = rng.integers(rooms[0], rooms[1] + 1, 40)
    who, what, scores = recommending._candidates(u, v, kth, room)
    for i in range(40):
        s = [float(sum((a * b for a, b in zip(u[i], other)), 0.0)) for other in v]
        want = [j for j in sorted(range(333), key=lambda j: (-s[j], j)) if not s[j] < kth[i]][: room[i]]
        assert list(what[who == i]) == want and list(scores[who == i]) == [s[j] for j in want]


def test_recommend_for_some_users_serves_only_them(spark, monkeypatch):
    ratings = _ratings(spark)
    model = als_fit(ratings)
    some = spark.createDataFrame([(3,), (8,), (3,), (99,)], "user int")
    want = {tuple(r) for r in recommend(model, 4).filter("user IN (3, 8)").collect()}
    unseen = {tuple(r) for r in recommend(model, 4, ratings).filter("user IN (3, 8)").collect()}
    assert {tuple(r) for r in recommend(model, 4, ratings, some).collect()} == unseen
    monkeypatch.setattr(recommending.ALSModel, "recommendForAllUsers", None)
    rows = recommend(model, 4, users=some).collect()
    assert len(rows) == 8 and {tuple(r) for r in rows} == want
