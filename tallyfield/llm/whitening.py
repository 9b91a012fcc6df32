"""Whitening of embeddings: a covariance of distinct vectors weighted by how often each occurs."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import require
from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin

COMPONENTS = 8
#: A vector entry c becomes the whole number floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: The covariance matrix is solved on the driver, so its width is bounded.
MAX_WIDTH = 4096
#: Eigenvalues up to this share of their sum count as no variation.
NO_VARIATION = 1e-12

RESULT = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double"
)
#: The type of deviations when one may not fit into a long.
WIDE = "decimal(38,0)"


def quantised(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x, key): usable vectors as whole numbers, and a SHA-256 key equal for equal vectors only.

    A vector that is null, empty, or holds a null or non-finite entry is left out. An entry of 2**43 or
    more in size raises, as its whole number would no longer be exact.
    """
    vec = F.col("vec")
    finite = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(vec.isNotNull() & (F.size(vec) > 0) & finite)
    x = F.transform(
        vec,
        lambda c: F.when(F.abs(c) < float(1 << 43), F.floor(c * SCALE) + OFFSET).otherwise(
            F.raise_error(F.lit("an embedding entry is too large")).cast("bigint")
        ),
    )
    return rows.select("id", x.alias("x")).withColumn("key", F.unhex(F.sha2(F.col("x").cast("string"), 256)))


def distinct_vectors(rows: DataFrame, weights: str = "counts") -> DataFrame:
    """(key, x, w): each distinct vector once; ``w`` is its number of rows, or one with ``weights="one"``.

    Counts combine before the shuffle, so a vector held by a third of all rows costs one row per task.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights must be counts or one, not {weights!r}")
    w = F.count(F.lit(1)) if weights == "counts" else F.max(F.lit(1).cast("bigint"))
    return rows.groupBy("key").agg(F.first("x").alias("x"), w.alias("w"))


def weighted_sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """Sum of weights and the weighted sum of each dimension, in whole numbers.

    Vectors of different lengths raise a ValueError.
    """
    shape = vectors.agg(F.sum("w"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if shape[0] is None:
        return 0, np.zeros(0, np.int64)
    if shape[1] != shape[2]:
        raise ValueError(f"vectors have {shape[1]} to {shape[2]} entries")
    if shape[2] > MAX_WIDTH:
        raise ValueError(f"vectors have {shape[2]} entries, more than {MAX_WIDTH}")
    sums = vectors.select("w", F.posexplode("x").alias("i", "v")).groupBy("i")
    cells = sums.agg(F.sum(F.col("w") * F.col("v")).alias("s")).collect()  # one row per dimension
    out = np.zeros(shape[2], np.int64)
    for cell in cells:
        out[cell["i"]] = cell["s"]
    return int(shape[0]), out


def _centred(batch: pd.DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S of each vector, exact, with a check that it fits."""
    x = np.stack(batch["x"].to_numpy()).astype(np.int64)
    largest = max(int(x.max()), -int(x.min()), 1) * n + int(np.abs(sums).max())
    if largest >= 1 << 62:
        raise OverflowError("the number of rows times a vector entry is too large")
    return n * x - sums


def largest_deviation(vectors: DataFrame, n: int, sums: np.ndarray) -> int:
    """A bound on the deviation of any vector, from the lowest and highest entry of each dimension."""
    cells = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    # One row per dimension, in Python's unbounded whole numbers.
    ends = [(n * c["lo"] - int(sums[c["i"]]), n * c["hi"] - int(sums[c["i"]])) for c in cells.collect()]
    return sum(max(-lo, hi, 0) ** 2 for lo, hi in ends)


def _squares(d: np.ndarray) -> np.ndarray:
    """The sum of squares of each row as Python's whole numbers, exact at any size.

    Entries are cut into two halves whose products still add up within 64 bits.
    """
    bits = (62 - int(d.shape[1]).bit_length()) // 2
    if int(np.abs(d).max()) >> (2 * bits):
        return (d.astype(object) ** 2).sum(axis=1)
    low = d & ((1 << bits) - 1)
    high = d >> bits
    parts = [(a * b).sum(axis=1).astype(object) for a, b in ((high, high), (high, low), (low, low))]
    return (parts[0] << (2 * bits)) + (parts[1] << (bits + 1)) + parts[2]


def covariance(vectors: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Weighted covariance of the vectors, divisor ``n``.

    Each task centres its vectors, multiplies batch by batch and hands on the upper half of one
    matrix; the cells are added up by Spark. The driver gets one value per pair of dimensions.
    """

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(sums), len(sums)))
        for batch in batches:
            if len(batch):
                d = _centred(batch, n, sums) / n
                total += (d * batch["w"].to_numpy()[:, None]).T @ d
        rows = [(i, total[i, i:].tolist()) for i in range(len(sums))]
        yield pd.DataFrame(rows, columns=["i", "cells"])

    cells = vectors.select("x", "w").mapInPandas(products, "i int, cells array<double>")
    added = cells.select("i", F.posexplode("cells").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((len(sums), len(sums)))
    for cell in added.collect():
        i, j = cell["i"], cell["i"] + cell["j"]
        out[i, j] = out[j, i] = cell["v"] / n
    return out


def principal_axes(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(axes as columns, eigenvalues, shares of the trace) of the ``k`` largest eigenvalues, falling."""
    values, axes = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:k]
    trace = float(np.trace(matrix))
    values = values[order]
    shares = values / trace if trace > 0 else np.zeros(len(values))
    return axes[:, order], values, np.where(shares > NO_VARIATION, shares, 0.0)


def _identity_error(white: DataFrame, n: int, used: list[int]) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over components that vary."""
    if not used:
        return 0.0
    y = {i: F.col("white")[i] for i in used}
    means = white.agg(*[(F.sum(F.col("w") * y[i]) / n).alias(f"m{i}") for i in used]).first()
    d = {i: y[i] - F.lit(means[f"m{i}"]) for i in used}
    pairs = [(i, j) for i in used for j in used if i <= j]
    sums = white.agg(*[(F.sum(F.col("w") * d[i] * d[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(sums[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    components: int = COMPONENTS,
    weights: str = "counts",
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    Identical vectors are grouped, the covariance is fitted on the groups with their counts (or one) as
    weights, each distinct vector is whitened once, and the rows are joined back to their group; the join
    broadcasts the groups only when they are measured to be small and spreads frequent vectors otherwise.
    Components are numbered from 1 by falling eigenvalue; there are at most as many as dimensions.

    A null, empty or non-finite vector has no row. Equal vectors and repeated ids keep a row each; a null
    id stays null. Deviations are long, or decimal(38,0) when one may pass 64 bits. A component without variation is null, explains 0 and stays out of the identity error.
    Vectors of different lengths raise a ValueError. An empty table gives no rows.
    """
    require(rows, id_col, vec_col)
    coded = quantised(rows, id_col, vec_col)
    vectors = pin(distinct_vectors(coded, weights), "vectors")
    n, sums = weighted_sums(vectors)
    if not n:
        return rows.select(F.col(id_col)).limit(0).select(
            id_col, *[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in RESULT.split(", "))]
        )
    bound = largest_deviation(vectors, n, sums)
    if bound >= 10**38:
        raise OverflowError("a deviation has more than 38 digits")
    wide = bound >= 1 << 63
    axes, values, shares = principal_axes(covariance(vectors, n, sums), components)
    used = [i for i, share in enumerate(shares) if share > 0]
    scales = np.array([1 / np.sqrt(values[i]) if i in used else np.nan for i in range(len(values))])

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            d = _centred(batch, n, sums)
            deviation = [Decimal(v) for v in _squares(d)] if wide else (d * d).sum(axis=1)
            white = (d / n) @ axes * scales
            yield pd.DataFrame(
                {"key": batch["key"], "w": batch["w"], "deviation": deviation, "white": list(white)}
            )

    kind = WIDE if wide else "long"
    white = vectors.mapInPandas(project, f"key binary, w long, deviation {kind}, white array<double>")
    white = pin(white, "whitened")
    error = _identity_error(white, n, used)
    joined = keyed_join(coded.select("id", "key"), white.drop("w"), ["key"], "inner")
    out = joined.select("id", "deviation", F.posexplode("white").alias("i", "v"))
    share_of = F.array(*[F.lit(float(s)) for s in shares])
    return out.select(
        F.col("id").alias(id_col),
        (F.col("i") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.when(~F.isnan("v"), F.col("v")).alias("whitened"),
        share_of[F.col("i")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
