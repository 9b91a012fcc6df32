"""Null classes, keys and values; both sides of limits; refused requests."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyfield.operators import aggregates, running, sampling, scale, sets
from tallyfield.sources import parsing, writers


@pytest.fixture(scope="module")
def classed(spark):
    kind = F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, "a").otherwise("b")
    return spark.range(1000).select("id", kind.alias("cls"))


@pytest.mark.parametrize("exact", [True, False])
def test_split_keeps_rows_of_a_null_class(classed, exact):
    chosen, rest = sampling.stratified_split(classed, "cls", 0.7, ["id"], 1, exact=exact)
    assert chosen.count() + rest.count() == 1000 and chosen.columns == classed.columns


def test_resampling_leaves_the_null_class_alone(classed):
    down = sampling.downsample(classed, "cls", "b", 0.5, ["id"], 1)
    up = sampling.upsample(classed, "cls", "a", 2, 0.5, ["id"], 1)
    assert down.filter("cls is null").count() == up.filter("cls is null").count() == 100


def test_single_row_of_a_null_group_stays_in_train(spark):
    df = spark.createDataFrame([(None, 1), ("u", 1), ("v", 1), ("v", 2)], "g string, n int")
    train, test = sampling.per_group_split(df, ["g"], ["n"])
    assert train.count() == 3 and [r.g for r in test.collect()] == ["v"]


def test_rank_keeps_null_groups_and_values(spark):
    df = spark.createDataFrame([("u", 5.0), ("u", None), (None, 7.0), (None, 6.0), ("z", -0.0)], "g string, v double")
    assert running.top_k_per_group(df, ["g"], ["v"], 10, ties="rank").count() == 5


def test_distinct_counts_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, None), (1, None)], "a int, b int")
    assert sets.count_distinct(df, ["a", "b"]).first()[0] == 3
    assert sets.count_distinct(df, ["a", "b"], 0.01).first()[0] == 3


def test_arg_max_of_text(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "c", 3), ("g", "c", 1), ("h", None, 1)], "g string, t string, n int")
    assert [tuple(r) for r in running.arg_max(df, "t", ["g"], ["n"]).collect()] == [("g", "c", 1)]
    assert running.arg_max(df, "t", tie_break=["n"]).first().n == 1


def test_wide_and_narrow_descriptions_agree_on_no_rows(spark, monkeypatch):
    df = spark.createDataFrame([], "a double, b double")
    narrow = sorted(map(tuple, aggregates.describe_columns(df, ["a", "b"]).collect()))
    monkeypatch.setattr(aggregates, "WIDE", 1)
    assert sorted(map(tuple, aggregates.describe_columns(df, ["a", "b"]).collect())) == narrow


def test_constant_column_correlates_with_nothing(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"))
    assert aggregates.correlation_pairs(df, ["a", "b"]).count() == 0


def test_refused_requests(spark, tmp_path, monkeypatch):
    df = spark.range(3)
    with pytest.raises(ValueError):
        scale.keyed_join(df, df, ["id"], "right")
    monkeypatch.setattr(writers, "SINGLE_FILE_ROWS", 2)
    with pytest.raises(ValueError):
        writers.save(df, str(tmp_path / "one"), single_file=True)
    for k in (0, 1):
        (tmp_path / f"part-{k}.txt").write_text("a,NUMERIC\n")
    with pytest.raises(ValueError):
        parsing.read_feature_set(spark, str(tmp_path / "part-*.txt"), str(tmp_path))


def test_landed_partition_values_stay_text(spark, tmp_path):
    (tmp_path / "in.csv").write_text("00701,5\n")
    out = writers.land(spark, str(tmp_path / "in.csv"), "station string, v int", str(tmp_path / "out"), partition_by=["station"])
    assert [tuple(r) for r in out.collect()] == [("00701", 5)]


def test_vectors_and_binaries_are_measured(spark):
    rows = spark.range(1000).select(F.array_repeat(F.lit(0.123456), 50).alias("v"))
    assert not scale.fits_broadcast(rows.select(array_to_vector("v").alias("v")), max_bytes=20_000)
    assert not scale.fits_broadcast(spark.range(1000).select(F.encode(F.repeat(F.lit("x"), 100), "utf-8").alias("b")), max_bytes=20_000)
