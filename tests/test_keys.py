"""Keys, draws and folds that tell apart what differs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import hash_uniform, row_id, row_key
from tallyfield.operators.features import index_strings
from tallyfield.operators.models import tune
from tallyfield.operators.running import top_k_per_group
from tallyfield.operators.sampling import per_group_split, stratified_split
from tallyfield.operators.sets import count_distinct
from tallyfield.operators.features import assemble


def _instants(spark, kind):
    base = dt.datetime(2020, 1, 1, 12)
    rows = [(base + dt.timedelta(microseconds=i), i) for i in range(3)]
    return spark.createDataFrame(rows, f"t {kind}, id int")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_microseconds_count(spark, kind):
    df = _instants(spark, kind)
    assert top_k_per_group(df, [], [("t", True)], 3, "r", ties="rank").count() == 3
    assert top_k_per_group(df.withColumn("g", F.lit(1)), ["g"], [("t", True)], 1, "r", ties="rank").count() == 1
    assert count_distinct(df, ["t"], rsd=0.01).first()[0] == 3
    chosen, rest = stratified_split(df, "t", 0.5, ["id"], 1, exact=True)
    assert (chosen.count(), rest.count()) == (0, 3)
    train, test = per_group_split(df, ["t"], ["id"])
    assert (train.count(), test.count()) == (3, 0)


def test_row_keys_are_injective(spark):
    kind = "a string, b string, d double, l array<string>, s struct<x:int,y:string>, m map<string,int>, y binary"
    rows = [
        ("a|b", "c", 0.0, ["a", "b"], (1, None), {"k": 1, "j": 2}, bytearray(b"\x01")),
        ("a", "b|c", 0.0, ["a", "b"], (1, None), {"k": 1, "j": 2}, bytearray(b"\x01")),
        (None, "x", 0.0, ["ab"], None, None, None),
        ("x", None, 0.0, ["a", "b"], (None, None), {}, bytearray(b"")),
        ("-", "x", 0.0, [], (None, "1:-"), {"k": None}, bytearray(b"1")),
        (None, "x", 1e-300, ["ab"], None, None, None),
        (None, "x", float("nan"), ["ab"], None, None, None),
        (None, "x", None, [None], None, None, None),
        (None, "x", None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, kind)
    assert df.select(row_key(df, df.columns)).distinct().count() == len(rows)
    assert df.select(row_id(df, df.columns)).distinct().count() == len(rows)
    signs = spark.createDataFrame([(0.0,), (-0.0,)], "d double")
    assert signs.select(row_key(signs, ["d"])).distinct().count() == 1
    same = spark.createDataFrame([({"a": 1, "b": 2},), ({"b": 2, "a": 1},)], "m map<string,int>")
    assert same.select(row_key(same, ["m"])).distinct().count() == 1


def test_draws_see_nulls_and_separators(spark):
    rows = [(None, "x"), ("x", None), ("a|b", "c"), ("a", "b|c"), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(hash_uniform("a", "b", seed=3)).distinct().count() == len(rows)


def test_folds_do_not_depend_on_partitions(spark):
    rows = [(i, float(i % 7), float((i * 5) % 11), int((i % 7) > 2)) for i in range(90)]
    df = assemble(spark.createDataFrame(rows, "id int, p double, q double, label int"), ["p", "q"])
    found = [
        sorted(map(tuple, tune("lr", df.repartition(n), {"regParam": [0.0, 0.5]}, folds=10, key=["id"], maxIter=3)[1].collect()))
        for n in (3, 11)
    ]
    assert [r[:2] for r in found[0]] == [r[:2] for r in found[1]]
    assert [r[2] for r in found[0]] == pytest.approx([r[2] for r in found[1]], abs=1e-6)


def test_index_of_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "v string, id int")

    def found(how):
        return {(r.id, r.i) for r in index_strings(df, {"v": "i"}, how).collect()}

    assert found("skip") == {(1, 0), (2, 1), (3, 0)}
    assert found("keep") == {(1, 0), (2, 1), (3, 0), (4, 2)}
    with pytest.raises(Exception, match="has no index"):
        found("error")
    with pytest.raises(ValueError):
        found("other")
