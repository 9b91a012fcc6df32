import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.operators import tiles
from tallyfield.operators.aggregates import correlations
from tallyfield.session import pin


def draws(spark, rows, width, parts=7):
    cols = [((F.xxhash64("id", F.lit(k)) % 1000) / 10.0 + 1e6).alias(f"c{k}") for k in range(width)]
    return spark.range(0, rows, 1, parts).select(*cols)


def as_dict(df):
    return {(r.col_1, r.col_2): r.r for r in df.collect()}


@pytest.mark.parametrize("tile", [1, 4, 64])
def test_tiles_equal_brute_force(spark, tile):
    df = draws(spark, 200, 10)
    x = np.array(df.collect(), dtype=float)
    want = np.corrcoef(x.T)
    got = as_dict(tiles.correlation_tiles(df, df.columns, tile))
    assert len(got) == 45
    for (a, b), r in got.items():
        assert r == pytest.approx(want[int(a[1:]), int(b[1:])], abs=1e-9)


def test_products_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(tiles, "MERGE", 2)
    df = draws(spark, 90, 5)
    x = np.array(df.collect(), dtype=float)
    want = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    for parts in (1, 13):
        one = tiles.product_tiles(df.repartition(parts), df.columns).first()
        assert one.n == 90
        assert np.array(one.tile).reshape(5, 5) == pytest.approx(want, rel=1e-9)


def test_missing_values_constants_and_empty_tables(spark):
    rows = [(1.0, 2.0, 0.1), (2.0, 4.0, 0.1), (None, 9.0, 0.1), (float("nan"), 1.0, 0.1), (3.0, 6.0, 0.1)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = as_dict(tiles.correlation_tiles(df, ["a", "b", "c"], 2))
    assert got["a", "b"] == pytest.approx(1.0)
    assert np.isnan(got["a", "c"]) and np.isnan(got["b", "c"])
    assert tiles.correlation_tiles(df.limit(0), ["a", "b"]).count() == 0
    with pytest.raises(ValueError):
        tiles.product_tiles(df, ["a"] * (tiles.MAX_COLUMNS + 1))


def test_wide_tables_keep_their_pairs_as_rows(spark):
    width = 1440
    df = draws(spark, 40, width - 1, 3).withColumn("twin", 5 - F.col("c7"))
    pairs = pin(correlations(df, df.columns), "pairs")
    assert pairs.count() == width * (width - 1) // 2
    strong = {(r.col_1, r.col_2): r.r for r in pairs.filter(F.abs("r") > 0.999).collect()}
    assert strong == {("c7", "twin"): pytest.approx(-1.0)}
