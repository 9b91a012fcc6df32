"""Document quality: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.llm.common import bound_batches, held_out, require
from tallyfield.session import pin

#: Random features, kernel width in standard deviations, ridge weight, seed, and score bins for calibration.
FEATURES = 192
WIDTH = 3.0
RIDGE = 1e-3
SEED = 7
BINS = 2000
LOW, HIGH = -0.5, 1.5
#: A document is predicted good from this calibrated score on.
THRESHOLD = 0.3

_CLASS = np.zeros(256, np.int8)
for _chars, _kind in (
    (b"abcdefghijklmnopqrstuvwxyz", 1),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2),
    (b"0123456789", 3),
    (b"#*$%&|<>", 4),
    (b"!?", 5),
    (b".,;:'\"()-", 6),
    (b" \t\r\x0b\x0c", 7),
    (b"\n", 8),
):
    _CLASS[list(_chars)] = _kind
_CLASS[128:] = 9
STATISTICS = 19


def statistics(data: bytes) -> np.ndarray:
    """Shape of one UTF-8 text as ``STATISTICS`` numbers; an empty text gives zeros."""
    out = np.zeros(STATISTICS)
    if not data:
        return out
    kinds = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=10)
    letters = max(kinds[1] + kinds[2] + kinds[9], 1)
    tokens = data.split()
    out[0] = np.log1p(len(data))
    out[1] = np.log1p(len(tokens))
    out[2:9] = kinds[[2, 3, 4, 5, 6, 8, 0]] / [letters, *[len(data)] * 6]
    out[9] = kinds[9] / letters
    if tokens:
        n = len(tokens)
        sizes = np.fromiter(map(len, tokens), np.int64, n)
        out[10] = sizes.mean()
        out[11] = sizes.std()
        kept = len(set(tokens))
        out[12] = kept / n
        out[13] = kept / np.sqrt(n)
        out[14] = sum(map(bytes.__eq__, tokens, tokens[1:])) / n
        lines = [x for x in data.split(b"\n") if x.strip()]
        out[15] = 1 - len(set(lines)) / len(lines)
        out[16] = np.log1p(n / len(lines))
        pairs = set(zip(tokens, tokens[1:]))
        out[17] = 1 - len(pairs) / max(n - 1, 1)
        out[18] = max(sizes) / len(data)
    return out


def document_statistics(text: Column) -> Column:
    """``statistics`` of a text column; null counts as empty."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(b"" if x is None else x.encode()) for x in texts])

    return of(text)


@dataclass(frozen=True)
class QualityModel:
    """Fixed-size model: standardisation, random features, ridge weights, calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of a Gaussian kernel, with a constant."""
        z = (x - self.mean) / self.scale
        waves = np.cos(np.clip(z, -6, 6) @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.lift(x) @ self.weights, LOW, HIGH)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores in 0..1, rounded so that the order of sums cannot show."""
        return np.round(np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1), 6)


def isotonic(weight: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Non-decreasing least-squares fit to means ``value`` with weights (pool adjacent violators)."""
    level: list[list[float]] = []
    for w, v in zip(weight, value):
        level.append([v, w, 1])
        while len(level) > 1 and level[-2][0] >= level[-1][0]:
            v2, w2, n2 = level.pop()
            v1, w1, n1 = level.pop()
            level.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([x[0] for x in level], [int(x[2]) for x in level])


def _stack(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_list()) if len(column) else np.zeros((0, STATISTICS))


def _summed(rows: DataFrame, add, shape: tuple[int, int]) -> np.ndarray:
    """Sum ``add(batch)`` matrices over all partitions; a fixed number of cells reaches the driver."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for batch in batches:
            if len(batch):
                total += add(batch)
        if total.any():
            for i in range(shape[0]):
                yield pd.DataFrame({"i": i, "j": np.arange(shape[1]), "v": total[i]})

    cells = rows.mapInPandas(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros(shape)
    for i, j, v in cells.collect():
        out[i, j] = v
    return out


def fit(train: DataFrame, stats_col: str = "stats", label_col: str = "label") -> QualityModel | None:
    """Fit on all rows with a label of 0 or 1; None when there is no such row."""
    rows = train.select(F.col(stats_col).alias("stats"), F.col(label_col).cast("double").alias("label"))

    def moments(batch: pd.DataFrame) -> np.ndarray:
        x = _stack(batch["stats"])
        return np.vstack([x.sum(axis=0), (x**2).sum(axis=0), np.full(STATISTICS, len(x))])

    sums = _summed(rows, moments, (3, STATISTICS))
    n = sums[2, 0]
    if not n:
        return None
    mean = sums[0] / n
    scale = np.sqrt(np.maximum(sums[1] / n - mean**2, 0))
    scale[scale < 1e-9] = 1.0
    rng = np.random.default_rng(SEED)
    directions = rng.normal(size=(STATISTICS, FEATURES)) / WIDTH
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    model = QualityModel(mean, scale, directions, phases, np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))

    def normal_equations(batch: pd.DataFrame) -> np.ndarray:
        z = model.lift(_stack(batch["stats"]))
        return np.hstack([z.T @ z, (z.T @ batch["label"].to_numpy())[:, None]])

    sums = _summed(rows, normal_equations, (FEATURES + 1, FEATURES + 2))
    gram, target = sums[:, :-1], sums[:, -1]
    model = QualityModel(
        mean, scale, directions, phases, np.linalg.solve(gram + RIDGE * n / FEATURES * np.eye(FEATURES + 1), target),
        np.zeros(1), np.zeros(1),
    )

    def histogram(batch: pd.DataFrame) -> np.ndarray:
        at = ((model.raw(_stack(batch["stats"])) - LOW) / (HIGH - LOW) * (BINS - 1)).round().astype(int)
        good = np.bincount(at, weights=batch["label"].to_numpy(), minlength=BINS)
        return np.vstack([np.bincount(at, minlength=BINS), good])

    count, good = _summed(rows, histogram, (2, BINS))
    met = np.flatnonzero(count)
    knots = LOW + met * (HIGH - LOW) / (BINS - 1)
    levels = isotonic(count[met], good[met] / count[met])
    return QualityModel(mean, scale, directions, phases, model.weights, knots, levels)


def score(stats: Column, model: QualityModel | None) -> Column:
    """Calibrated score of document statistics; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf(T.DoubleType())
    def of(batch: pd.Series) -> pd.Series:
        return pd.Series(model.score(_stack(batch)))

    return of(stats)


def train_on_labels(
    stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality"
) -> QualityModel | None:
    """Fit on labelled documents outside the held-out fold. Null ids and labels teach nothing."""
    label = F.col(label_col).cast("double")
    taught = labels.filter(~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & label.isin(0.0, 1.0)).select(
        F.col(id_col).alias("id"), label.alias("label")
    )
    rows = pin(stats.join(taught, "id").select("stats", "label"), "taught")
    return fit(rows)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """Score every document: id, held_out, score, predicted.

    Only whole texts are used; a null text counts as empty. Every input row gives one row, in a fixed
    order of nothing; repeated texts get equal scores. Labels of held-out ids, null labels and labels
    other than 0 and 1 are not learned from. Without any usable label every score is 0.5.
    """
    require(docs, id_col, text_col)
    bound_batches(docs.sparkSession)
    stats = pin(
        docs.select(F.col(id_col).alias("id"), document_statistics(F.col(text_col)).alias("stats")), "statistics"
    )
    model = train_on_labels(stats, labels, id_col, label_col)
    found = stats.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), score(F.col("stats"), model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_rejected(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with the columns of ``docs``.

    A first pass keeps the statistics of labelled documents; the second scores every row in place.
    """
    require(docs, id_col, text_col)
    bound_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    stats = docs.select(F.col(id_col).alias("id"), document_statistics(F.col(text_col)).alias("stats"))
    model = train_on_labels(stats.join(known, "id", "left_semi"), labels, id_col, label_col)
    return docs.filter(score(document_statistics(F.col(text_col)), model) >= THRESHOLD)
