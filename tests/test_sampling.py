import pytest
from pyspark.sql import functions as F

from tallyfield.operators import sampling as s


@pytest.fixture
def rows(spark):
    return spark.range(4000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 20 == 0, 1).otherwise(0).alias("c")
    )


def keys(df):
    return sorted(r.k for r in df.select("k").collect())


def test_split_parts_are_disjoint_and_complete(rows):
    parts = s.random_split(rows, [0.7, 0.2, 0.1], 9, ["k"])
    got = [keys(p) for p in parts]
    assert sorted(sum(got, [])) == list(range(4000))
    assert [round(len(g) / 4000, 1) for g in got] == [0.7, 0.2, 0.1]


def test_split_is_the_same_on_other_partitions(rows):
    a, _ = s.random_split(rows.repartition(1), [0.8, 0.2], 1, ["k"])
    b, _ = s.random_split(rows.repartition(8), [0.8, 0.2], 1, ["k"])
    assert keys(a) == keys(b)
    c, _ = s.random_split(rows, [0.8, 0.2], 2, ["k"])
    assert keys(a) != keys(c)


@pytest.mark.parametrize("exact", [False, True])
def test_stratified_split(rows, exact, many_slices):
    chosen, rest = s.stratified_split(rows, "c", 0.8, ["k"], 3, exact)
    assert sorted(keys(chosen) + keys(rest)) == list(range(4000))
    sizes = dict(chosen.groupBy("c").count().collect())
    if exact:
        # Numbers below size x fraction: 159 of 200 and 3039 of 3800.
        assert sizes == {1: 159, 0: 3039}
    else:
        assert abs(sizes[1] / 200 - 0.8) < 0.1 and abs(sizes[0] / 3800 - 0.8) < 0.03
    again, _ = s.stratified_split(rows.repartition(3), "c", 0.8, ["k"], 3, exact)
    assert keys(again) == keys(chosen)


def test_fraction_per_class(rows):
    chosen, _ = s.stratified_split(rows, "c", {1: 1.0, 0: 0.0}, ["k"], 3)
    assert keys(chosen) == list(range(0, 4000, 20))


@pytest.mark.parametrize("ratio,low,high", [(2.0, 330, 470), (100.0, 3800, 3800)])
def test_downsample(rows, ratio, low, high):
    sizes = dict(s.downsample(rows, "c", 0, ratio, ["k"], 4).groupBy("c").count().collect())
    assert sizes[1] == 200 and low <= sizes[0] <= high


def test_downsample_without_minority_or_majority(rows):
    assert s.downsample(rows.filter("c = 1"), "c", 0, 2.0, ["k"], 4).count() == 200


def test_upsample(rows):
    out = s.upsample(rows, "c", 1, 20, 0.5, ["k"], 4).groupBy("c", "k").count()
    per = {r["k"]: r["count"] for r in out.filter("c = 1").collect()}
    assert max(per.values()) <= 20 and 1800 < sum(per.values()) < 2200
    assert out.filter("c = 0 and count <> 1").isEmpty()
    assert out.filter("c = 0").count() == 3800


def test_weights(rows):
    out = s.class_weights(rows, "c", {0: 1.0}).groupBy("c").agg(F.max("weight")).collect()
    assert dict(map(tuple, out)) == {0: 1.0, 1: None}


def test_per_group_split_of_small_groups(spark, many_slices):
    data = [(g, i) for g, n in (("one", 1), ("four", 4), ("five", 5), ("six", 6)) for i in range(n)]
    df = spark.createDataFrame(data, "g string, i int")
    train, test = s.per_group_split(df, ["g"], ["i"])
    assert {r.g: r["count"] for r in test.groupBy("g").count().collect()} == {"four": 1, "five": 1, "six": 2}
    assert train.count() + test.count() == 16
    _, fifth = s.per_group_split(df, ["g"], ["i"], remainder=0)
    assert sorted(map(tuple, fifth.select("g", "i").collect())) == [("five", 4), ("six", 4)]


def test_cold_keys(spark):
    a = spark.createDataFrame([("x",), ("y",)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    assert sorted(map(tuple, s.cold_keys(a, b, "k").collect())) == [("x", "test"), ("z", "train")]
