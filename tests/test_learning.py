"""Feature preparation, models, tuning and recommendation."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tallyfield.catalog.views import FEATURES, Tables
from tallyfield.functions import binary_label
from tallyfield.operators import features, models, recommend
from tallyfield.operators.aggregates import correlation_pairs, describe_columns
from tallyfield.operators.sampling import random_split
from tallyfield.plans import genres, plays
from tallyfield.session import pin


@pytest.fixture(scope="module")
def table(spark, folder):
    return pin(Tables(spark, folder).feat.withColumn("y", binary_label("label", 3)), "feat")


@pytest.fixture(scope="module")
def vectors(table):
    return pin(features.assemble(table, FEATURES).select("vec_id", F.col("y").alias("label"), "features"), "v")


def test_assemble_array_and_columns_agree(table):
    packed = table.withColumn("arr", F.array(*FEATURES))
    a = features.assemble(packed, ["arr"], "v").select("vec_id", "v")
    b = features.assemble(packed, FEATURES, "w").select("vec_id", "w")
    assert a.join(b, "vec_id").filter("v = w").count() == table.count()


def test_scaler_and_components_match_numpy(table):
    data = np.array([r[1:] for r in table.select("vec_id", *FEATURES).orderBy("vec_id").collect()])
    scaled = data / data.std(axis=0, ddof=1)
    values, _ = np.linalg.eigh(np.cov(scaled, rowvar=False))
    share = np.sort(values)[::-1] / values.sum()
    out, model = genres.scaled_components(table, FEATURES, 4)
    got = [r.share for r in features.explained_variance(table, model).orderBy("component").collect()]
    assert got == pytest.approx(list(share[:4]), abs=1e-9)
    assert out.count() == table.count() and "components" in out.columns


def test_scaler_is_fitted_on_train_only(table):
    vec = features.assemble(table, FEATURES)
    train, test = random_split(vec, [0.5, 0.5], 1, ["vec_id"])
    a, b, model = features.fit_apply(Pipeline(stages=[features.scaler()]), train, test, ["vec_id", "scaled"])
    assert a.count() + b.count() == table.count()
    sd = train.agg(F.stddev_samp("f0")).first()[0]
    assert model.stages[0].std[0] == pytest.approx(sd)


def test_index_is_dense_and_ordered(spark, many_slices):
    df = spark.createDataFrame([(x,) for x in "bbbaaacdd"] + [(None,)], "s string")
    out = sorted(map(tuple, features.index_map(df, "s", "i").collect()), key=lambda r: r[1])
    assert out == [("a", 0), ("b", 1), ("d", 2), ("c", 3)]


@pytest.mark.parametrize("name", ["lr", "svm", "rf", "gbt"])
def test_models_learn(vectors, name):
    params = {"maxIter": 10} if name in ("lr", "svm") else {"maxDepth": 3}
    if name == "gbt":
        params["maxIter"] = 3
    scored = models.train(name, vectors, **params).transform(vectors)
    assert ("probability" in scored.columns) == (name != "svm")
    assert scored.filter("prediction in (0, 1)").count() == vectors.count()


def test_weights_move_the_boundary(vectors):
    weighted = vectors.withColumn("w", F.when(F.col("label") == 1, 50.0).otherwise(1.0))
    plain = models.train("lr", vectors, maxIter=20).transform(vectors).filter("prediction = 1").count()
    heavy = models.train("lr", weighted, weight="w", maxIter=20).transform(weighted).filter("prediction = 1").count()
    assert heavy > plain


def test_thresholds_nest(vectors):
    scored = models.train("lr", vectors, maxIter=20).transform(vectors)
    for t in (0.1, 0.5):
        scored = models.apply_threshold(scored, t, out=f"p{int(t * 10)}")
    assert scored.filter("p5 > p1").isEmpty() and not scored.filter("p1 = 1").isEmpty()


def test_grids_have_the_stated_sizes():
    assert {n: models.grid_size(n) for n in models.GRIDS} == {"lr": 6, "svm": 3, "rf": 27, "gbt": 18}


def test_tuning_returns_a_row_per_setting(vectors):
    grid = {"regParam": [0.01, 0.1], "elasticNetParam": [0.0]}
    model, rows = models.tune("lr", vectors, grid, folds=2, maxIter=5)
    out = rows.collect()
    assert [r.params for r in out] == ["elasticNetParam=0.0, regParam=0.01", "elasticNetParam=0.0, regParam=0.1"]
    assert all(0 <= r.metric <= 1 for r in out)
    assert model.bestModel.getRegParam() in (0.01, 0.1)


def test_multinomial_summary_goes_down(spark, table):
    df = features.assemble(table, FEATURES)
    history = [r.objective for r in models.training_summary(df, models.train("multinomial", df, maxIter=5)).collect()]
    assert history == sorted(history, reverse=True)


def test_profile_of_columns_two_ways(table):
    narrow = describe_columns(table, FEATURES)
    wide_names = [f"c{i}" for i in range(120)]
    wide = table.select(*[F.col(FEATURES[i % 10]).alias(n) for i, n in enumerate(wide_names)])
    a = {r.column: r for r in narrow.collect()}
    for r in describe_columns(wide, wide_names).collect():
        b = a[FEATURES[int(r.column[1:]) % 10]]
        assert tuple(r)[1:] == pytest.approx(tuple(b)[1:])


def test_correlated_pairs_in_both_directions(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("a"),
        (-F.col("id")).cast("double").alias("b"),
        (F.col("id") % 7).cast("double").alias("c"),
    )
    assert [(r.col_1, r.col_2) for r in correlation_pairs(df, ["a", "b", "c"]).collect()] == [("a", "b")]
    assert correlation_pairs(df, ["a", "b", "c"], absolute=False).isEmpty()


@pytest.fixture(scope="module")
def ratings(spark, folder):
    return pin(plays.indexed(Tables(spark, folder).plays), "ratings")


def test_recommendations_against_brute_force(ratings):
    model = recommend.als_fit(ratings, max_iter=2, rank=4)
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    seen = {}
    for r in ratings.select("user", "item").collect():
        seen.setdefault(r.user, set()).add(r.item)
    got, fresh = {}, {}
    for r in recommend.recommend(model, 5).collect():
        got.setdefault(r.user, {})[r["rank"]] = r.item
    for r in recommend.recommend(model, 5, exclude_seen=ratings).collect():
        fresh.setdefault(r.user, {})[r["rank"]] = r.item
    assert set(got) == set(fresh) == set(users)
    for user, vector in users.items():
        scores = {i: float(vector @ f) for i, f in items.items()}
        best = sorted(scores.values(), reverse=True)[:5]
        assert [scores[got[user][k]] for k in range(1, 6)] == pytest.approx(best, abs=1e-5)
        unseen = sorted((s for i, s in scores.items() if i not in seen[user]), reverse=True)[:5]
        assert [scores[fresh[user][k]] for k in range(1, 6)] == pytest.approx(unseen, abs=1e-5)
        assert not seen[user] & set(fresh[user].values())


def test_recommendation_run(spark, folder):
    out = {r.method: r for r in plays.recommendation_run(Tables(spark, folder).plays, k=5, max_iter=2, rank=4).collect()}
    assert set(out) == {"all_items", "rerank_test_items"}
    for r in out.values():
        assert r.users > 0 and all(0 <= v <= 1 for v in (r.precision_at, r.ndcg_at, r["map"]))
    assert out["rerank_test_items"].precision_at >= out["all_items"].precision_at


def test_binary_and_multiclass_runs(table):
    df = table.withColumnRenamed("label", "genre").drop("y")
    binary = genres.binary_classification_run(df, FEATURES, "genre", 3, ["vec_id"], models=("lr", "rf")).collect()
    assert [r.model for r in binary] == ["lr", "rf"]
    assert all(r.tp + r.fn == r.positive and r.total == r.positive + r.negative for r in binary)
    (multi,) = genres.multiclass_run(df, FEATURES, "genre", ["vec_id"], models=("rf",)).collect()
    assert 0 <= multi.accuracy <= 1


def test_samplings_share_the_test_part(table):
    parts = genres.samplings(table.select("vec_id", "y"), "y", ["vec_id"])
    assert set(parts) == {"random", "stratified", "stratified_exact", "downsampled", "upsampled", "weighted"}
    train, test = parts["random"]
    for name in ("downsampled", "upsampled", "weighted"):
        assert parts[name][1] is test
    assert parts["downsampled"][0].count() < train.count() < parts["upsampled"][0].count()
