"""Classifiers, thresholds and tuning on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import hash_uniform, over_threshold

# Parameter grids searched by default.
GRIDS: dict[str, dict[str, list]] = {
    "lr": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 1.0]},
    "svm": {"regParam": [0.0, 0.01, 0.1]},
    "rf": {"numTrees": [20, 50, 100], "maxDepth": [2, 4, 8], "maxBins": [16, 32, 64]},
    "gbt": {"maxDepth": [2, 5, 8], "maxBins": [16, 32, 64], "stepSize": [0.01, 0.1]},
}
FOLDS = 10
PARALLELISM = 8
SEED = 1000


def estimator(
    name: str,
    features: str = "features",
    label: str = "label",
    weight: str | None = None,
    seed: int = SEED,
    **params,
) -> Estimator:
    """``lr``, ``multinomial``, ``svm``, ``rf`` or ``gbt`` with the given parameters."""
    kinds = {
        "lr": LogisticRegression,
        "multinomial": LogisticRegression,
        "svm": LinearSVC,
        "rf": RandomForestClassifier,
        "gbt": GBTClassifier,
    }
    settings = {"featuresCol": features, "labelCol": label, **params}
    if name == "multinomial":
        settings.setdefault("family", "multinomial")
    if name in ("rf", "gbt"):
        settings["seed"] = seed
    if weight:
        settings["weightCol"] = weight
    return kinds[name](**settings)


def train(name: str, df: DataFrame, **settings) -> Model:
    """Fit one classifier."""
    return estimator(name, **settings).fit(df)


def training_summary(df: DataFrame, model: Model) -> DataFrame:
    """(iteration, objective) of a fitted logistic regression."""
    history = enumerate(model.summary.objectiveHistory)
    rows = [(i, float(v)) for i, v in history]
    return df.sparkSession.createDataFrame(rows, "iteration int, objective double")


def apply_threshold(
    df: DataFrame, t: float, probability: str = "probability", out: str = "custom_prediction"
) -> DataFrame:
    """Predict 1 when the probability of class 1 is above ``t``."""
    return df.withColumn(out, over_threshold(probability, t))


def tune(
    name: str,
    df: DataFrame,
    grid: dict[str, Sequence] | None = None,
    evaluator: Evaluator | None = None,
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int = PARALLELISM,
    key: Sequence[str] | None = None,
    **settings,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Cross-validated grid search: the fitted model and one result row per setting.

    With ``key`` a row's fold is a hash of its key and the seed, the same however the table is
    partitioned; without it the validator draws folds by row order.
    """
    if key:
        df = df.withColumn("_fold", F.floor(hash_uniform(*key, seed=seed) * folds).cast("int"))
    base = estimator(name, seed=seed, **settings)
    grid = {k: list(v) for k, v in (grid or GRIDS[name]).items()}
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(base.getParam(param), values)
    maps = builder.build()
    search = CrossValidator(
        estimator=base,
        estimatorParamMaps=maps,
        evaluator=evaluator or BinaryClassificationEvaluator(labelCol=base.getLabelCol()),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
        **({"foldCol": "_fold"} if key else {}),
    )
    model = search.fit(df)
    rows = [
        (name, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda e: e[0].name)), float(s))
        for m, s in zip(maps, model.avgMetrics)
    ]
    table = df.sparkSession.createDataFrame(rows, "model string, params string, metric double")
    return model, table


def grid_size(name: str) -> int:
    """Settings in the default grid of a model."""
    return len(list(product(*GRIDS[name].values())))


def tune_all(df: DataFrame, grids: dict[str, dict] | None = None, **settings) -> DataFrame:
    """Search every model of ``grids`` (all by default) and stack the result rows."""
    tables = [tune(name, df, grid, **settings)[1] for name, grid in (grids or GRIDS).items()]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out.orderBy(F.desc("metric"), "model", "params")
