"""Feature preparation, models and recommendation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfield.catalog.columns import DRAW
from tallyfield.catalog.registry import query
from tallyfield.catalog.views import FEATURES, Tables
from tallyfield.functions import binary_label
from tallyfield.operators.evaluation import auroc, confusion
from tallyfield.operators.features import (
    assemble,
    explained_variance,
    fit_apply,
    index_map,
    index_strings,
    scaler,
)
from tallyfield.operators.models import GRIDS, apply_threshold, train, training_summary, tune_all
from tallyfield.operators.recommend import als_fit, als_score, compare_for_users, recommend
from tallyfield.operators.running import top_n
from tallyfield.operators.sampling import class_weights, random_split
from tallyfield.plans.genres import (
    binary_classification_run,
    compare_binary_samplings,
    multiclass_run,
    scaled_components,
)
from tallyfield.plans.plays import indexed, recommendation_run
from tallyfield.session import pin


def _labelled(t: Tables):
    return assemble(t.feat.withColumn("label", binary_label("label", 3)), FEATURES).select(
        "vec_id", "label", "features"
    )


@query(
    "assemble_vector",
    "SELECT vec_id, " + ", ".join(f"round({f}, 4) AS {f}" for f in FEATURES) + " FROM feat",
)
def _(t: Tables):
    v = vector_to_array("features")
    df = assemble(t.feat, FEATURES)
    return df.select("vec_id", *[F.round(v[i], 4).alias(f) for i, f in enumerate(FEATURES)])


@query(
    "scale_to_unit_deviation",
    "SELECT vec_id, "
    + ", ".join(f"round({f} / (SELECT stddev_samp({f}) FROM feat), 4) AS {f}" for f in FEATURES)
    + " FROM feat",
)
def _(t: Tables):
    df = assemble(t.feat, FEATURES)
    out, _, _ = fit_apply(Pipeline(stages=[scaler()]), df, df, ["vec_id", "scaled"])
    v = vector_to_array("scaled")
    return out.select("vec_id", *[F.round(v[i], 4).alias(f) for i, f in enumerate(FEATURES)])


@query("principal_components")
def _(t: Tables):
    out, _ = scaled_components(t.feat, FEATURES, 5)
    v = vector_to_array("components")
    return out.select("vec_id", *[v[i].alias(f"pc{i + 1}") for i in range(5)])


@query("explained_variance")
def _(t: Tables):
    _, model = scaled_components(t.feat, FEATURES, 10)
    return explained_variance(t.feat, model)


@query(
    "explained_variance_totals",
    "SELECT max(len(embedding)) AS components, 1.0::DOUBLE AS total, true AS falls FROM embeddings",
)
def _(t: Tables):
    _, model = scaled_components(t.feat, FEATURES, len(FEATURES))
    # One row per component.
    shares = explained_variance(t.feat, model).withColumn("before", F.lag("share").over(Window.orderBy("component")))
    return shares.agg(
        F.count("share").alias("components"), F.round(F.sum("share"), 6).alias("total"),
        F.bool_and(F.col("share") <= F.coalesce("before", "share")).alias("falls"),
    )


@query(
    "index_strings",
    """SELECT s_name, CAST(row_number() OVER (ORDER BY n DESC, s_name) - 1 AS INTEGER) AS idx FROM (
         SELECT s_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name)""",
)
def _(t: Tables):
    names = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return index_map(t("lineitem").join(names, "l_suppkey"), "s_name", "idx")


@query(
    "index_users_and_items",
    """WITH u AS (SELECT user_id, CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS INTEGER) AS "user" FROM plays GROUP BY user_id),
            i AS (SELECT item_id, CAST(row_number() OVER (ORDER BY count(*) DESC, item_id) - 1 AS INTEGER) AS item FROM plays GROUP BY item_id)
       SELECT p.*, u."user", i.item FROM plays p JOIN u ON p.user_id = u.user_id JOIN i ON p.item_id = i.item_id""",
)
def _(t: Tables):
    return index_strings(t.saved_plays, {"user_id": "user", "item_id": "item"})


@query(
    "fit_on_train_only",
    f"""WITH parts AS (SELECT *, CASE WHEN {DRAW.format(seed=1000, key='CAST(vec_id AS VARCHAR)')} < 0.8 THEN 'train' ELSE 'test' END AS part FROM feat)
        SELECT vec_id, part, """
    + ", ".join(
        f"round({f} / (SELECT stddev_samp({f}) FROM parts WHERE part = 'train'), 4) AS {f}" for f in FEATURES
    )
    + " FROM parts",
)
def _(t: Tables):
    df = assemble(t.feat, FEATURES)
    train_part, test_part = random_split(df, [0.8, 0.2], 1000, ["vec_id"])
    a, b, _ = fit_apply(Pipeline(stages=[scaler()]), train_part, test_part, ["vec_id", "scaled"])
    rows = a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))
    v = vector_to_array("scaled")
    return rows.select("vec_id", "part", *[F.round(v[i], 4).alias(f) for i, f in enumerate(FEATURES)])


def _model_query(name: str, weight: bool = False):
    def run(t: Tables):
        base = pin(_labelled(t), "labelled")
        train_part, test_part = random_split(base, [0.8, 0.2], 1000, ["vec_id"])
        settings = {}
        if weight:
            train_part = class_weights(train_part, "label", {0: 1.0, 1: 10.0})
            settings["weight"] = "weight"
        scored = train(name, train_part, **settings).transform(test_part)
        score = vector_to_array("rawPrediction")[1].alias("score")
        scored = pin(scored.select("label", F.col("prediction").cast("int"), score), "scored")
        return confusion(scored, "label", "prediction").withColumn(
            "auroc", auroc(scored, "label", "score").scalar()
        )

    return run


for _name in ("lr", "svm", "rf", "gbt"):
    query(f"train_{_name}")(_model_query(_name))
query("train_lr_weighted")(_model_query("lr", weight=True))


@query("train_multinomial_summary")
def _(t: Tables):
    df = assemble(t.feat, FEATURES)
    return training_summary(df, train("multinomial", df))


@query("custom_thresholds")
def _(t: Tables):
    base = pin(_labelled(t), "labelled")
    scored = train("lr", base).transform(base)
    for threshold in (0.3, 0.5, 0.6):
        scored = apply_threshold(scored, threshold, out=f"over_{int(threshold * 100)}")
    return scored.select("vec_id", "label", "over_30", "over_50", "over_60")


@query("tune_linear_models")
def _(t: Tables):
    base = pin(_labelled(t), "labelled")
    # The full default grids, on fewer folds than tune() takes by default.
    return tune_all(base, {name: GRIDS[name] for name in ("lr", "svm")}, folds=3)


@query("tune_tree_models")
def _(t: Tables):
    base = pin(_labelled(t), "labelled")
    # A small part of the default grids; tune() searches them in full.
    grids = {
        "rf": {"numTrees": [20], "maxDepth": [2, 4], "maxBins": [16]},
        "gbt": {"maxDepth": [2], "maxBins": [16], "stepSize": [0.1]},
    }
    return tune_all(base, grids, folds=3)


@query("compare_samplings")
def _(t: Tables):
    df = t.feat.withColumn("class", binary_label("label", 3))
    return compare_binary_samplings(df, FEATURES, "class", ["vec_id"])


@query("binary_classification")
def _(t: Tables):
    return binary_classification_run(t.feat.withColumnRenamed("label", "genre"), FEATURES, "genre", 3, ["vec_id"])


@query("multiclass_classification")
def _(t: Tables):
    return multiclass_run(t.feat.withColumnRenamed("label", "genre"), FEATURES, "genre", ["vec_id"])


@query("als_scored_pairs")
def _(t: Tables):
    ratings = pin(indexed(t.saved_plays), "ratings")
    scored = als_score(als_fit(ratings), ratings)
    return scored.select("user_id", "item_id", "play_count", "prediction")


@query("als_recommend_all_users")
def _(t: Tables):
    ratings = pin(indexed(t.saved_plays), "ratings")
    return recommend(als_fit(ratings), 10)


@query("als_recommend_unseen")
def _(t: Tables):
    ratings = pin(indexed(t.saved_plays), "ratings")
    return recommend(als_fit(ratings), 10, exclude_seen=ratings)


@query("als_compare_for_users")
def _(t: Tables):
    ratings = pin(indexed(t.saved_plays), "ratings")
    busiest = ratings.groupBy("user").agg(F.sum("play_count").alias("plays"))
    users = pin(top_n(busiest, [F.desc("plays"), "user"], 3).select("user"), "busiest")
    recs = recommend(als_fit(ratings), 10, users=users)
    return compare_for_users(recs, ratings, users, 10)


@query("recommendation_metrics")
def _(t: Tables):
    return recommendation_run(t.saved_plays)
