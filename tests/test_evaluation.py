"""Metrics against hand examples and the evaluators of pyspark.ml."""

import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RankingEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from tallyfield.operators import evaluation as ev


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(600):
        y = rng.random() < 0.3
        score = round(rng.gauss(0.6 if y else 0.4, 0.3), 1) + 0.0
        rows.append((float(y), score, float(rng.randrange(4)), float(rng.randrange(5))))
    return spark.createDataFrame(rows, "y double, score double, a double, b double").cache()


def test_auroc_with_ties(scored, many_slices):
    ours = ev.auroc(scored, "y", "score").first()[0]
    theirs = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0).evaluate(scored)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_auroc_without_negatives_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert ev.auroc(df, "y", "s").first()[0] is None


def test_confusion_without_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "y int, p int")
    row = ev.confusion(df, "y", "p").first()
    assert (row.tp, row.fp, row.fn, row.tn) == (0, 0, 1, 2)
    assert row.precision is None and row.recall == 0.0 and row.accuracy == pytest.approx(2 / 3)


def test_multiclass(scored):
    ours = ev.multiclass_metrics(scored, "a", "b").first()
    judge = MulticlassClassificationEvaluator(labelCol="a", predictionCol="b")
    for name, metric in [
        ("accuracy", "accuracy"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
        ("f1", "f1"),
    ]:
        assert ours[name] == pytest.approx(judge.setMetricName(metric).evaluate(scored), abs=1e-12)


def test_per_class(scored):
    ours = {r["class"]: r for r in ev.per_class_metrics(scored, "a", "b").collect()}
    judge = MulticlassClassificationEvaluator(labelCol="a", predictionCol="b")
    for c in (0.0, 1.0, 2.0, 3.0):
        judge.setMetricLabel(c)
        assert ours[c].precision == pytest.approx(judge.setMetricName("precisionByLabel").evaluate(scored))
        assert ours[c].recall == pytest.approx(judge.setMetricName("recallByLabel").evaluate(scored))
        assert ours[c].f1 == pytest.approx(judge.setMetricName("fMeasureByLabel").evaluate(scored))
    assert ours[4.0].support == 0


def test_rmse_drops_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, float("nan")), (5.0, None)], "y double, p double")
    ours = ev.rmse(df, "y", "p").first()[0]
    clean = df.filter("p is not null and not isnan(p)")
    assert ours == pytest.approx(RegressionEvaluator(labelCol="y", predictionCol="p").evaluate(clean))


def lists(spark, rows):
    return spark.createDataFrame(rows, "predicted array<double>, actual array<double>")


def test_ranking_by_hand(spark):
    df = lists(spark, [([1.0, 2.0, 3.0], [1.0, 9.0]), ([4.0], [4.0])])
    assert ev.precision_at(df, 2).first()[0] == pytest.approx(0.5)
    assert ev.ndcg_at(df, 2).first()[0] == pytest.approx(0.80657, abs=1e-5)
    assert ev.mean_average_precision(df).first()[0] == pytest.approx(0.75)


def test_ranking_against_spark(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(200):
        pool = [float(i) for i in range(30)]
        rows.append((rng.sample(pool, rng.randrange(1, 12)), rng.sample(pool, rng.randrange(1, 12))))
    df = lists(spark, rows)
    judge = RankingEvaluator(predictionCol="predicted", labelCol="actual")
    for k in (1, 5, 10):
        judge.setK(k)
        assert ev.precision_at(df, k).first()[0] == pytest.approx(judge.setMetricName("precisionAtK").evaluate(df))
        assert ev.ndcg_at(df, k).first()[0] == pytest.approx(judge.setMetricName("ndcgAtK").evaluate(df))
    mean = judge.setMetricName("meanAveragePrecision").evaluate(df)
    assert ev.mean_average_precision(df).first()[0] == pytest.approx(mean)


def test_ranking_lists_are_ordered_and_cut(spark):
    recs = spark.createDataFrame([(1, i, float(i % 4)) for i in range(9)] + [(2, 1, 1.0)], "user int, item int, score double")
    truth = spark.createDataFrame([(1, i, 9 - i) for i in range(9)] + [(3, 1, 1)], "user int, item int, rating int")
    (row,) = ev.ranking_lists(recs, truth, 3, "user", "item", "score", "rating").collect()
    assert (row.user, row.predicted, row.actual) == (1, [3.0, 7.0, 2.0], [0.0, 1.0, 2.0])


def test_metrics_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "y int, p int, s double")
    assert ev.confusion(empty, "y", "p").first().total == 0
    assert ev.auroc(empty, "y", "s").first()[0] is None
    assert ev.multiclass_metrics(empty, "y", "p").first().accuracy is None
    assert ev.confusion_matrix(empty, "y", "p").count() == 0
    assert ev.rmse(empty.withColumn("s", F.col("s")), "y", "s").first()[0] is None
