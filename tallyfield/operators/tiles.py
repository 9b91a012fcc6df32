"""Products of many columns, summed in square tiles that stay rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.session import pin

#: Columns of a tile: 64 x 64 doubles are 32 kB.
TILE = 64
#: A task sums columns squared x 8 bytes, 134 MB for this many; more are refused.
MAX_COLUMNS = 4096
#: Partial sums are merged in this many groups first, so no task sees those of all partitions.
MERGE = 64
#: A spread below this share of the mean is rounding noise of a constant column.
NOISE = 1e-14

_STATE = "bi int, bj int, salt int, n double, mean_i array<double>, mean_j array<double>, tile array<double>"


def _join_moments(a: tuple, b: tuple) -> tuple:
    """Merge two (n, mean_i, mean_j, products about the means)."""
    n = a[0] + b[0]
    di, dj = b[1] - a[1], b[2] - a[2]
    share = b[0] / n
    return n, a[1] + di * share, a[2] + dj * share, a[3] + b[3] + np.outer(di, dj) * (a[0] * share)


def _batch_moments(x: np.ndarray) -> tuple:
    mean = x.mean(axis=0)
    centred = x - mean
    return float(len(x)), mean, mean, centred.T @ centred


def _partials(width: int, tile: int):
    """Arrow batches of (v, salt) to the tiles of one partition, salted by its number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, salt = None, 0
        for batch in batches:
            if batch.num_rows:
                salt = batch.column(1)[0].as_py()
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                one = _batch_moments(x)
                state = one if state is None else _join_moments(state, one)
        if state is None:
            return
        n, mean, _, products = state
        for i in range(0, width, tile):
            for j in range(i, width, tile):
                row = (i // tile, j // tile, salt, n, mean[i : i + tile], mean[j : j + tile], products[i : i + tile, j : j + tile].ravel())
                names = ("bi", "bj", "salt", "n", "mean_i", "mean_j", "tile")
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), *[pa.list_(pa.float64())] * 3)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=list(names))

    return run


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    total = None
    for r in rows.itertuples(index=False):
        i, j = np.asarray(r.mean_i), np.asarray(r.mean_j)
        one = (r.n, i, j, np.asarray(r.tile).reshape(len(i), len(j)))
        total = one if total is None else _join_moments(total, one)
    first = rows.iloc[0]
    values = (first.bi, first.bj, first.salt, total[0], total[1], total[2], total[3].ravel())
    return pd.DataFrame([values], columns=rows.columns)


def product_tiles(df: DataFrame, cols: Sequence[str], tile: int = TILE) -> DataFrame:
    """(bi, bj, n, mean_i, mean_j, tile): centred products of two blocks of columns, bi <= bj.

    Each partition sums its rows into one matrix about its own means; the tiles of the
    partitions are merged in two rounds. One pass over the data; what is shuffled is one set of
    tiles a partition. Rows with a missing value or NaN are left out; no rows give no tiles.
    """
    if len(cols) > MAX_COLUMNS:
        raise ValueError(f"{len(cols)} columns; at most {MAX_COLUMNS} fit the sums of a task")
    values = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("v"))
    whole = values.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)))
    salted = whole.withColumn("salt", F.spark_partition_id() % MERGE)
    partial = salted.mapInArrow(_partials(len(cols), tile), _STATE)
    some = partial.groupBy("bi", "bj", "salt").applyInPandas(_merged, _STATE)
    return some.groupBy("bi", "bj").applyInPandas(_merged, _STATE).drop("salt")


def correlation_tiles(df: DataFrame, cols: Sequence[str], tile: int = TILE) -> DataFrame:
    """(col_1, col_2, r) for every pair of columns, from product tiles; NaN where a column is constant.

    The pairs stay rows of the cluster; the only table joined to them has one row per column.
    """
    tiles = pin(product_tiles(df, cols, tile), "tiles")
    wide = F.size("mean_j")
    at = tiles.select("bi", "bj", "n", "mean_i", wide.alias("wide"), F.posexplode("tile").alias("pos", "c"))
    row = (F.col("pos") / F.col("wide")).cast("int")
    cells = at.select(
        (F.col("bi") * tile + row).alias("i"), (F.col("bj") * tile + F.col("pos") % F.col("wide")).alias("j"), "c", "n",
        F.get("mean_i", row).alias("mean"),
    )
    noise = F.col("n") * F.pow(F.abs("mean") * NOISE, 2)
    spread = F.sqrt(F.when(F.col("c") > noise, F.col("c")).otherwise(0.0))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, col string")
    # One row per column, at most MAX_COLUMNS.
    sides = names.join(cells.filter("i = j").select("i", spread.alias("s")), "i")
    first = F.broadcast(sides.select("i", F.col("col").alias("col_1"), F.col("s").alias("s_1")))
    second = F.broadcast(sides.select(F.col("i").alias("j"), F.col("col").alias("col_2"), F.col("s").alias("s_2")))
    size = F.col("s_1") * F.col("s_2")
    r = F.when(size > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("c") / size))).otherwise(float("nan"))
    return cells.filter("j > i").join(first, "i").join(second, "j").select("col_1", "col_2", r.alias("r"))
