"""The skew-proof operators against plain ones, with hot keys, nulls and copies."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfield.operators import scale
from tallyfield.operators.joins import exclude, restrict
from tallyfield.operators.running import (
    cumulative_share,
    number_rows,
    rank_size,
    running_sum,
    top_k_per_group,
)
from tallyfield.operators.sets import dedupe_by, multiset_difference


def skewed(spark, n=3000):
    """A third of the rows on one key, many copies, some null keys."""
    rng = random.Random(1)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{rng.randrange(40)}")
        rows.append((key, rng.randrange(20), i % 7))
    return spark.createDataFrame(rows, "k string, v int, w int").repartition(5)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k3", 3), ("k9", 4), (None, 5), ("unused", 6)], "k string, r int"
    )
    salted = scale.salted_join(left, right, ["k"], how, hot_rows=50)
    assert salted.exceptAll(left.join(right, "k", how)).isEmpty()
    assert left.join(right, "k", how).exceptAll(salted).isEmpty()


def test_hot_keys_from_a_sketch(spark):
    left = skewed(spark)
    found = {r["_key"]: r["_salts"] for r in scale.hot_keys(left, ["k"], 500).collect()}
    key = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert found == {key: 2}
    assert scale.hot_keys(left.limit(0), ["k"], 1).isEmpty()
    # A limit lower than the share the sketch can tell is raised.
    assert scale.hot_keys(left, ["k"], 0).count() == left.filter("k is not null").select("k").distinct().count()


def test_salted_join_of_two_key_types(spark):
    left = spark.createDataFrame([(i % 3, i) for i in range(60)], "k int, v int")
    right = spark.createDataFrame([(0, 1), (1, 2), (5_000_000_000, 3)], "k bigint, r int")
    joined = scale.salted_join(left, right, ["k"], "left", hot_rows=5)
    assert joined.exceptAll(left.join(right.withColumn("k", F.col("k").try_cast("int")), "k", "left")).isEmpty()
    assert joined.count() == 60 and joined.filter("r = 2").count() == 20


def test_salted_join_on_columns_named_like_its_own(spark):
    left = spark.createDataFrame([(i % 3, i, "x") for i in range(60)], "_key int, _salts int, _Spread string")
    right = spark.createDataFrame([(0, 1), (1, 2)], "_key int, _salt int")
    joined = scale.salted_join(left, right, ["_key"], "inner", hot_rows=5)
    assert joined.columns == ["_key", "_salts", "_Spread", "_salt"]
    assert sorted(map(tuple, joined.collect())) == sorted((i % 3, i, "x", i % 3 + 1) for i in range(60) if i % 3 < 2)


def test_top_k_with_rank_ties_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(scale, "fits_broadcast", lambda *a: False)
    df = skewed(spark)
    out = top_k_per_group(df, ["k"], [("v", True)], 5, ties="rank")
    w = Window.partitionBy("k").orderBy(F.desc_nulls_last("v"))
    plain = df.withColumn("rank", F.rank().over(w).cast("bigint")).filter("rank <= 5")
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_salt_spreads_identical_rows(spark):
    copies = spark.createDataFrame([("hot", 1)] * 4000, "k string, v int").repartition(8)
    right = spark.createDataFrame([("hot", 9)], "k string, r int")
    joined = scale.salted_join(copies, right, ["k"], "left", hot_rows=500)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    assert joined.count() == 4000


def test_keyed_join_takes_the_other_way_beyond_the_limit(spark):
    left = skewed(spark)
    right = left.select("k").distinct().withColumn("r", F.lit(1))
    small = scale.keyed_join(left, right, ["k"], "left")
    large = scale.keyed_join(left, right, ["k"], "left", max_rows=3, hot_rows=100)
    assert "_salt" not in small._jdf.queryExecution().logical().toString()
    assert "_salt" in large._jdf.queryExecution().logical().toString()
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_hot_limit_rises_until_the_hot_table_fits(spark, monkeypatch):
    left = skewed(spark)
    right = left.select("k").distinct().withColumn("r", F.lit(1))
    fits = scale.fits_broadcast
    monkeypatch.setattr(scale, "fits_broadcast", lambda df, *a: fits(df, 1))
    joined = scale.salted_join(left, right, ["k"], "inner", hot_rows=5)
    assert joined.count() == left.join(right, "k").count()


def test_fits_broadcast_measures_rows_and_bytes(spark):
    df = spark.range(1000).withColumn("s", F.repeat(F.lit("x"), 1000))
    assert scale.fits_broadcast(df)
    assert not scale.fits_broadcast(df, max_rows=999)
    assert not scale.fits_broadcast(df, max_bytes=1_000_000)
    assert scale.fits_broadcast(df.limit(0))


@pytest.mark.parametrize("part", [[], ["k"]])
def test_prefix_sums_over_several_slices(spark, many_slices, part):
    df = skewed(spark).withColumn("id", F.xxhash64("k", "v", "w") % 100000)
    df = df.withColumn("id", F.row_number().over(Window.orderBy("k", "v", "w"))).repartition(6)
    out = scale.prefix_sums(df, part, [F.desc("id")], {"run": F.col("v"), "pos": F.lit(1)})
    w = Window.partitionBy(*part).orderBy(F.desc("id")).rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("run", F.sum("v").over(w)).withColumn("pos", F.sum(F.lit(1)).over(w))
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_small_groups_take_one_window(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    small = number_rows(df, ["k"], ["id"])
    large = number_rows(df, ["k"], ["id"], max_group=10)
    assert "_slice" not in small._jdf.queryExecution().logical().toString()
    assert "_slice" in large._jdf.queryExecution().logical().toString()
    assert small.exceptAll(large).isEmpty()


def test_prefix_sums_skip_nulls_like_a_window(spark, many_slices):
    rows = [("a", i, None if i % 3 else i) for i in range(60)] + [("b", i, None) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, i int, v bigint").repartition(4)
    out = scale.prefix_sums(df, ["k"], ["i"], {"run": F.col("v")})
    w = Window.partitionBy("k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    assert out.exceptAll(df.withColumn("run", F.sum("v").over(w))).isEmpty()


def test_a_hot_group_is_cut_into_slices(spark, many_slices):
    df = spark.range(8000).withColumn("k", F.lit("only"))
    numbered = number_rows(df, ["k"], ["id"])
    lo, hi, n = numbered.agg(F.min("row_num"), F.max("row_num"), F.count_distinct("row_num")).first()
    assert (lo, hi, n) == (1, 8000, 8000)
    assert numbered.filter(F.col("row_num") != F.col("id") + 1).isEmpty()


def test_numbering_of_identical_rows(spark, many_slices):
    df = spark.createDataFrame([("a", 1)] * 500 + [("b", 2)] * 3, "k string, v int").repartition(6)
    numbers = number_rows(df, ["k"], ["v"]).groupBy("k").agg(F.max("row_num"), F.count_distinct("row_num"))
    assert {tuple(r) for r in numbers.collect()} == {("a", 500, 500), ("b", 3, 3)}


def test_running_sum_two_ways(spark, many_slices):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id")
    a = running_sum(df, ["g"], ["id"], {"s": "id"}, bounded=True)
    b = running_sum(df, ["g"], ["id"], {"s": "id"})
    assert a.exceptAll(b).isEmpty()


def test_cumulative_share_gives_ties_one_value(spark, many_slices):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("c", 2), ("d", 1)], "u string, n int")
    out = {r.u: r.s for r in cumulative_share(df, "n", F.lit(1.0), "s").collect()}
    assert out == {"a": 3.0, "b": 7.0, "c": 7.0, "d": 8.0}


def test_cumulative_share_equals_range_window(spark, many_slices):
    df = skewed(spark).withColumn("n", F.col("v") + 1)
    out = cumulative_share(df, "n", F.lit(10.0), "s")
    plain = df.withColumn("s", F.sum("n").over(Window.orderBy(F.desc("n"))) / 10.0)
    assert out.select(*plain.columns).exceptAll(plain).isEmpty()


def test_rank_size(spark, many_slices):
    df = spark.createDataFrame([(5,), (2,), (2,), (1,)], "n int")
    out = sorted(tuple(r) for r in rank_size(df, "n").collect())
    assert out == [(1, 1, 4, 4), (2, 2, 2, 3), (5, 1, 1, 1)]


@pytest.mark.parametrize("desc", [True, False])
def test_top_k_with_rank_ties(spark, desc):
    df = skewed(spark)
    out = top_k_per_group(df, ["k"], [("v", desc)], 5, ties="rank")
    key = F.desc_nulls_last("v") if desc else F.asc_nulls_first("v")
    plain = df.withColumn("rank", F.rank().over(Window.partitionBy("k").orderBy(key))).filter("rank <= 5")
    out = out.select("k", "v", "w", F.col("rank").cast("int").alias("rank"))
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_top_k_limits_before_the_shuffle(spark):
    top = top_k_per_group(skewed(spark), ["k"], [F.desc("v"), "w"], 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_top_k_beyond_the_limit_threshold(spark, many_slices):
    df = spark.range(3000).withColumn("k", F.lit("hot"))
    top = top_k_per_group(df, ["k"], ["id"], 1500)
    assert top.agg(F.max("rank"), F.max("id")).first()[:] == (1500, 1499)


def test_exclude_and_restrict(spark):
    df = skewed(spark)
    bad = spark.createDataFrame([("hot",), ("hot",), (None,)], "k string")
    assert exclude(df, bad, "k").exceptAll(df.filter("k is null or k <> 'hot'")).isEmpty()
    assert restrict(df, bad, "k").count() == df.filter("k = 'hot'").count()


@pytest.mark.parametrize("chunk", [2, 1000])
def test_multiset_difference(spark, chunk):
    a = spark.createDataFrame([("x", 1)] * 11 + [("y", None)] * 3 + [("z", 2)], "a string, b int")
    b = spark.createDataFrame([("x", 1)] * 4 + [("y", None)] + [("z", 2)] * 5 + [("q", 0)], "a string, b int")
    out = multiset_difference(a, b, copies_per_chunk=chunk)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, a.exceptAll(b).collect()), key=str)


def test_dedupe_keeps_the_first_row(spark):
    df = spark.createDataFrame([(1, 5, "c"), (1, 2, "b"), (1, 2, "a"), (2, 9, "z")], "k int, o int, x string")
    assert sorted(map(tuple, dedupe_by(df, ["k"], ["o", "x"]).collect())) == [(1, 2, "a"), (2, 9, "z")]
