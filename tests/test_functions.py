import math

import pytest
from pyspark.sql import functions as F

from tallyfield import functions as fn


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_blank_predicate_and_normalising(spark):
    rows = [(None, None), ("", 1), ("   ", 2), ("x ", 3)]
    out = one(spark, rows, "s string, i int", fn.is_blank("s"), fn.is_blank("i"), fn.blank_to_null("s"))
    assert out == [(True, True, None), (True, False, None), (True, False, None), (False, False, "x ")]


def test_quotes_are_stripped_from_every_row(spark):
    rows = [("TRAAA",), ("'TRBBB'",), (" 'C' ",)]
    assert one(spark, rows, "s string", fn.strip_quotes("s")) == [("TRAAA",), ("TRBBB",), ("C",)]


def test_year_and_month(spark):
    rows = [("20150630",), ("bad",), (None,)]
    out = one(spark, rows, "d string", fn.year_of("d"), fn.month_of("d"))
    assert out == [(2015, 6), (None, None), (None, None)]


def test_ratio_by_zero_is_null(spark):
    assert one(spark, [(1, 0), (1, 4)], "a int, b int", fn.ratio("a", "b")) == [(None,), (0.25,)]


def test_array_sizes(spark):
    rows = [(["a", "b"], ["b", "c", "c", "d"])]
    out = one(spark, rows, "a array<string>, b array<string>", fn.overlap_size("a", "b"), fn.extra_size("a", "b"))
    assert out == [(1, 2)]


@pytest.mark.parametrize(
    "place,km",
    [
        ((10.0, 20.0, 10.0, 20.0), 0.0),
        ((0.0, 0.0, 0.0, 180.0), math.pi * 6371),
        ((90.0, 0.0, -90.0, 77.0), math.pi * 6371),
        ((0.0, 179.5, 0.0, -179.5), math.radians(1) * 6371),
    ],
)
def test_distances(spark, place, km):
    args = ["a", "b", "c", "d"]
    ((h, g),) = one(
        spark, [place], "a double, b double, c double, d double", fn.haversine_km(*args), fn.great_circle_km(*args)
    )
    assert h == pytest.approx(km, abs=1e-6)
    assert g == pytest.approx(km, abs=1e-3)


def test_hash_uniform_is_uniform_and_repeatable(spark):
    df = spark.range(20000)
    draws = df.select("id", fn.hash_uniform("id", seed=3).alias("u"))
    low, high, mean = draws.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.01
    again = df.repartition(7).select("id", fn.hash_uniform("id", seed=3).alias("u"))
    assert draws.exceptAll(again).isEmpty()
    other = df.select("id", fn.hash_uniform("id", seed=4).alias("u"))
    assert draws.join(other, ["id", "u"]).isEmpty()
