"""Feature preparation on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tallyfield.operators.running import number_rows
from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin


def assemble(
    df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    """Numeric columns, or one array column, as an ML vector."""
    if len(cols) == 1 and isinstance(df.schema[cols[0]].dataType, ArrayType):
        return df.withColumn(out, array_to_vector(F.col(cols[0]).cast("array<double>")))
    stage = VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)
    return stage.transform(df)


def scaler(inp: str = "features", out: str = "scaled") -> StandardScaler:
    """Scale to unit sample standard deviation without centring."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=False, withStd=True)


def pca(k: int, inp: str = "scaled", out: str = "components") -> PCA:
    """Projection onto the first ``k`` principal components."""
    return PCA(k=k, inputCol=inp, outputCol=out)


def explained_variance(df: DataFrame, model: PCAModel) -> DataFrame:
    """(component, share): variance explained by each component, from 1."""
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    return df.sparkSession.createDataFrame(rows, "component int, share double")


def index_map(df: DataFrame, col: str, out: str) -> DataFrame:
    """(value, index): dense numbers from 0, most frequent value first, ties by value.

    A table and not a fitted model: the values may be millions, and they never
    leave the executors.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    numbered = number_rows(pin(counts, "counts"), [], [F.desc("_n"), F.asc(col)], "_row")
    return numbered.select(col, (F.col("_row") - 1).cast("int").alias(out))


def index_strings(df: DataFrame, cols: dict[str, str], handle_invalid: str = "error") -> DataFrame:
    """Add a dense index column per entry of ``cols`` (column to index name).

    A null value has no index: ``error`` raises when the row is read, ``skip`` leaves the row out, and
    ``keep`` gives all nulls the index after the last.
    """
    if handle_invalid not in ("error", "keep", "skip"):
        raise ValueError(f"handle_invalid must be error, keep or skip, not {handle_invalid!r}")
    for col, out in cols.items():
        index = pin(index_map(df, col, out), "index")
        df = keyed_join(df, index, [col], "inner" if handle_invalid == "skip" else "left")
        if handle_invalid == "keep":
            last = index.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()
            df = df.withColumn(out, F.coalesce(out, last))
        elif handle_invalid == "error":
            raised = F.raise_error(F.lit(f"a null in {col} has no index")).cast("int")
            df = df.withColumn(out, F.when(F.col(col).isNull(), raised).otherwise(F.col(out)))
    return df


def fit_apply(
    stages: Pipeline, train: DataFrame, test: DataFrame, keep: Sequence[str]
) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Fit on train only, transform both parts, keep the listed columns."""
    model = stages.fit(train)
    return model.transform(train).select(*keep), model.transform(test).select(*keep), model
