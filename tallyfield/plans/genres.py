"""Feature tables with a category: profile, labels, binary and multiclass classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import binary_label
from tallyfield.operators.aggregates import correlation_pairs, describe_columns
from tallyfield.operators.evaluation import auroc, compare_samplings, confusion, multiclass_metrics
from tallyfield.operators.features import assemble, fit_apply, index_strings, pca, scaler
from tallyfield.operators.joins import exclude, lookup
from tallyfield.operators.models import apply_threshold, train
from tallyfield.operators.sampling import (
    class_weights,
    downsample,
    random_split,
    stratified_split,
    upsample,
)
from tallyfield.session import pin
from tallyfield.sources.parsing import read_feature_set
from tallyfield.sources.writers import save_all


def load_feature_sets(spark, spec: dict[str, tuple[str, str]], base: str | None = None, fmt: str = "orc"):
    """Read each (attribute file, data path) set; with ``base`` save them and read back."""
    tables = {
        name: read_feature_set(spark, attributes, data, prefix=f"{name}_")
        for name, (attributes, data) in spec.items()
    }
    if base is None:
        return tables
    paths = save_all(tables, base, fmt)
    return {name: spark.read.format(fmt).load(path) for name, path in paths.items()}


def feature_profile(df: DataFrame, cols: Sequence[str], min_abs: float = 0.7):
    """(column statistics, strongly correlated pairs)."""
    return describe_columns(df, cols), correlation_pairs(df, cols, min_abs)


def label_features(
    features: DataFrame, genres: DataFrame, bad: DataFrame, key: str, genre: str
) -> DataFrame:
    """Features of rows with a genre, without the mismatched ones."""
    return lookup(features, exclude(genres, bad, key), key, key, [genre], "inner")


def samplings(
    df: DataFrame, cls: str, key: Sequence[str], seed: int = 1000, fraction: float = 0.8
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Named (train, test) parts: random, stratified, exact, down-, up-sampled, weighted."""
    train_part, test_part = random_split(df, [fraction, 1 - fraction], seed, key)
    return {
        "random": (train_part, test_part),
        "stratified": stratified_split(df, cls, fraction, key, seed),
        "stratified_exact": stratified_split(df, cls, fraction, key, seed, exact=True),
        "downsampled": (downsample(train_part, cls, 0, 2.0, key, seed), test_part),
        "upsampled": (upsample(train_part, cls, 1, 20, 0.5, key, seed), test_part),
        "weighted": (class_weights(train_part, cls, {0: 1.0, 1: 10.0}), test_part),
    }


def compare_binary_samplings(
    df: DataFrame,
    cols: Sequence[str],
    cls: str,
    key: Sequence[str],
    threshold: float = 0.5,
    components: int = 5,
    seed: int = 1000,
) -> DataFrame:
    """Logistic regression on principal components under each sampling, one row each."""
    base = pin(assemble(df.select(*key, cls, *cols), cols, "raw").select(*key, cls, "raw"), "raw")

    def fit_predict(train_part: DataFrame, test_part: DataFrame) -> DataFrame:
        weight = "weight" if "weight" in train_part.columns else None
        stages = Pipeline(stages=[scaler("raw"), pca(components, out="features")])
        fitted = stages.fit(train_part)
        model = train("lr", fitted.transform(train_part), label=cls, weight=weight)
        return _scored(model.transform(fitted.transform(test_part)), cls, threshold)

    return compare_samplings(samplings(base, cls, key, seed), fit_predict, cls, "custom_prediction", "score")


def _scored(df: DataFrame, cls: str, threshold: float | None) -> DataFrame:
    """Scored rows, written once: (class, prediction, score)."""
    if "probability" in df.columns and threshold is not None:
        df = apply_threshold(df, threshold)
    else:
        df = df.withColumn("custom_prediction", F.col("prediction").cast("int"))
    score = vector_to_array("rawPrediction")[1].alias("score")
    return pin(df.select(F.col(cls), "custom_prediction", score), "scored")


def binary_classification_run(
    df: DataFrame,
    cols: Sequence[str],
    category: str,
    positive,
    key: Sequence[str],
    models: Sequence[str] = ("lr", "svm", "rf", "gbt"),
    seed: int = 1000,
    ratio: float = 2.0,
) -> DataFrame:
    """One-vs-rest classification on a down-sampled split: a row of metrics per model."""
    labelled = df.withColumn("label", binary_label(category, positive))
    base = assemble(labelled.select(*key, "label", *cols), cols).select(*key, "label", "features")
    train_part, test_part = random_split(pin(base, "binary"), [0.8, 0.2], seed, key)
    train_part = pin(downsample(train_part, "label", 0, ratio, key, seed), "train")
    out = None
    for name in models:
        scored = _scored(train(name, train_part, seed=seed).transform(test_part), "label", None)
        row = confusion(scored, "label", "custom_prediction").withColumn(
            "auroc", auroc(scored, "label", "score").scalar()
        )
        row = row.select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def multiclass_run(
    df: DataFrame,
    cols: Sequence[str],
    category: str,
    key: Sequence[str],
    models: Sequence[str] = ("multinomial", "rf"),
    seed: int = 1000,
) -> DataFrame:
    """Classification over all categories: a row of metrics per model."""
    indexed = index_strings(df, {category: "label"})
    base = assemble(indexed.select(*key, "label", *cols), cols).select(*key, "label", "features")
    train_part, test_part = random_split(pin(base, "multi"), [0.8, 0.2], seed, key)
    out = None
    for name in models:
        scored = train(name, train_part, seed=seed).transform(test_part)
        scored = pin(scored.select("label", F.col("prediction").cast("int")), "scored")
        row = multiclass_metrics(scored, "label", "prediction").select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def scaled_components(df: DataFrame, cols: Sequence[str], k: int):
    """(table with components, fitted model) after scaling to unit deviation."""
    stages = Pipeline(stages=[scaler("raw"), pca(k)])
    base = assemble(df, cols, "raw")
    out, _, model = fit_apply(stages, base, base, [*df.columns, "components"])
    return out, model.stages[-1]
