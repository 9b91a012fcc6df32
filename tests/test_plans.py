"""Whole analyses: two ways to the same answer, edge cases and plan shape."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyfield import session
from tallyfield.catalog.analyses import annual_by_country
from tallyfield.catalog.views import CORE, Tables
from tallyfield.operators.aggregates import presence, quality_profile
from tallyfield.plans import observations, plays, stations


@pytest.fixture(scope="module")
def t(spark, folder):
    return Tables(spark, folder)


def same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_element_counts_two_ways(t):
    assert same(stations.element_counts(t.inventory, CORE), stations.element_counts_by_array(t.inventory, CORE))


def test_station_without_core_elements_has_zero(spark):
    inv = spark.createDataFrame([("a", "SNOW"), ("b", "TMAX"), ("b", "SNOW"), ("b", "TMAX")], "station_id string, element string")
    out = {r.station_id: tuple(r)[1:] for r in stations.element_counts(inv, ["TMAX", "TMIN"]).collect()}
    assert out == {"a": (0, 1, 1), "b": (1, 1, 2)}
    assert [r[0] for r in stations.stations_with_only(inv, ["SNOW"]).collect()] == ["a"]
    assert stations.stations_with_all(inv, ["TMAX", "SNOW"]).first()[0] == "b"


def test_only_wanted_elements_needs_every_element(spark):
    inv = spark.createDataFrame([("a", "TMAX"), ("a", "SNOW"), ("b", "TMIN")], "station_id string, element string")
    assert [r[0] for r in stations.stations_with_only(inv, ["TMAX", "TMIN"]).collect()] == ["b"]


def test_presence_by_flags_and_by_sets(t):
    flags = presence(t.obs, ["station_id", "obs_date"], "element", ["click", "view"])
    rows = t.obs.filter(F.col("element").isin("click", "view"))
    sets = rows.groupBy("station_id", "obs_date").agg(F.collect_set("element").alias("e"))
    by_set = sets.select(
        "station_id", "obs_date",
        F.array_contains("e", "click").alias("has_click"), F.array_contains("e", "view").alias("has_view"),
    )
    assert same(flags, by_set)
    row = observations.presence_summary(t.obs, "click", "view").first()
    assert row.exactly_one_pairs == sets.filter(F.size("e") == 1).count()


def test_station_with_no_good_row(spark):
    obs = spark.createDataFrame([("a", "X"), ("a", "S"), ("b", None), ("b", "")], "id string, q string")
    out = {r.id: tuple(r)[1:] for r in quality_profile(obs, ["id"], "q").collect()}
    assert out == {"a": (0, 2, 2, 0.0, 1.0), "b": (2, 0, 2, 1.0, 0.0)}


def test_country_totals_add_up(t):
    total = t.obs.count()
    per = observations.quality_by_country(t.obs, t.station, t.country)
    assert per.agg(F.sum("all_rows")).first()[0] == total


def test_territories_two_ways(t):
    codes = stations.add_station_totals(t.country, t.station, "country_code")
    a = stations.territory_total(codes, "%[ASIA]%", 2).first()[0]
    assert a == stations.territory_total_by_rows(t.country, t.station, "%[ASIA]%", 2).first()[0]


def test_reconciliation_methods_agree(t):
    counts = {}
    for r in observations.reconcile(t.obs, t.station).collect():
        counts.setdefault(r.side, set()).add(r.n)
    assert all(len(v) == 1 for v in counts.values()) and len(counts) == 2


def test_annual_summary_scans_once_without_a_cartesian_product(t):
    df = annual_by_country(t)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)
    assert text.count("lineitem.parquet") <= 1
    scans = [line for line in plan(df).splitlines() if "FileScan" in line and "lineitem" in line]
    assert all("l_comment" not in s and "l_extendedprice" not in s for s in scans)


def test_wide_aggregation_happens_before_the_station_join(t):
    df = observations.annual_summary(t.rain, t.gauge)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate") == 2 and text.rindex("Aggregate") > text.index("Join")


def test_drop_heavy_repeaters_and_trim(spark):
    rows = [("u1", f"i{i}", 1) for i in range(5)] + [("u2", "i0", 99), ("u3", "i0", 1), ("u3", "i1", 1)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, play_count bigint")
    calm = plays.drop_heavy_repeaters(df, 50)
    assert {r[0] for r in calm.select("user_id").distinct().collect()} == {"u1", "u3"}
    once = plays.trim_sparse(calm, 2, 2)
    assert sorted(map(tuple, once.collect())) == [
        ("u1", "i0", 1), ("u1", "i1", 1), ("u3", "i0", 1), ("u3", "i1", 1),
    ]
    assert plays.trim_sparse(calm, 3, 2, iterate=True).count() == 0
    assert plays.trim_sparse(calm, 2, 2, measure="plays").count() == 4


def test_fixed_point_against_brute_force(spark):
    rng = random.Random(2)
    kept = {(rng.randrange(30), rng.randrange(25)) for _ in range(260)}
    df = spark.createDataFrame([(u, i, 1) for u, i in kept], "user_id int, item_id int, play_count bigint")
    while True:
        users, items = Counter(u for u, _ in kept), Counter(i for _, i in kept)
        left = {(u, i) for u, i in kept if users[u] >= 6 and items[i] >= 6}
        if left == kept:
            break
        kept = left
    out = plays.trim_sparse(df, 6, 6, iterate=True)
    assert {(r.user_id, r.item_id) for r in out.collect()} == kept and kept


@pytest.mark.parametrize("measure,least", [("users", 6), ("plays", 14)])
def test_peeling_against_brute_force(spark, measure, least):
    rng = random.Random(7)
    rows = [(rng.randrange(40) or None, rng.randrange(30) or None, rng.choice([1, 2, 3, None])) for _ in range(300)]
    rows += rows[:20] + [(None, None, 1), (99, 99, None)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, play_count bigint")
    kept = rows
    while True:
        users = Counter(u for u, i, _ in kept if i is not None)
        items = Counter(i for u, i, _ in kept if u is not None)
        if measure == "plays":
            items = {i: sum(known) for i in {r[1] for r in kept} if (known := [n for _, j, n in kept if j == i and n is not None])}
        poor = {u for u, _, _ in kept if users[u] < 6} - {None}
        rare = {i for _, i, _ in kept if i in items and items[i] < least or measure == "users" and items[i] < least} - {None}
        left = [r for r in kept if r[0] not in poor and r[1] not in rare]
        if len(left) == len(kept):
            break
        kept = left
    out, log = plays.peel(df, 6, least, measure, buckets=8)
    assert Counter(map(tuple, out.collect())) == Counter(kept) and kept
    assert sum(r["rows"] for r in log) == len(rows) - len(kept) and len(log) > 1


def test_peeling_a_chain_reads_less_each_round(spark):
    # A chain that comes apart from one end, beside a block that stays whole.
    chain = [(u, u + d, 1) for u in range(4) for d in (0, 1)][:-1]
    block = [(u, i, 1) for u in range(100, 110) for i in range(100, 110)]
    df = spark.createDataFrame(chain + block, "user_id int, item_id int, play_count bigint")
    out, log = plays.peel(df, 2, 2, buckets=16)
    assert out.count() == len(block)
    assert max(r["buckets"] for r in log[1:]) <= 4 and len(log) > 3
    with pytest.raises(RuntimeError):
        plays.peel(df, 2, 2, max_rounds=1, buckets=2)


def test_unmatched_ids_in_one_pass(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "station_id string")
    b = spark.createDataFrame([("y",), ("z",)], "station_id string")
    found = {tuple(r) for r in observations.unmatched_ids(a, b).collect()}
    assert found == {("x", "observations_only"), (None, "observations_only"), ("z", "stations_only")}
    assert [tuple(r) for r in observations.unmatched_counts(a, a).collect()] == [("observations_only", 0), ("stations_only", 0)]
    assert observations.unmatched_ids(a, b)._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_clean_plays_keeps_accepted_items(spark):
    df = spark.createDataFrame([("u", "a", 1), ("u", "b", 1), ("u", "c", 1)], "user_id string, item_id string, play_count int")
    bad = spark.createDataFrame([("a",), ("b",)], "item_id string")
    ok = spark.createDataFrame([("b",)], "item_id string")
    assert sorted(r.item_id for r in plays.clean_plays(df, bad, ok).collect()) == ["b", "c"]


@pytest.mark.parametrize("element", ["TMAX", "TMIN"])
def test_plans_on_empty_tables(spark, element):
    obs = spark.createDataFrame([], "station_id string, obs_date string, element string, value bigint, quality_flag string")
    st = spark.createDataFrame([], "station_id string, country_code int, lat double, lon double")
    assert observations.annual_summary(obs, st, element).count() == 0
    assert observations.presence_gaps(obs, "TMAX", "TMIN").count() == 0
    assert observations.element_coverage(obs, [element]).count() == 0
    assert stations.furthest_stations(st).count() == 0
    assert stations.pair_distances(st, max_km=20_100).count() == 0


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")

    class Unset:
        """A session that names no folder."""

        def __init__(self, master):
            self.conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})
            self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})

    assert session.shared_dir(Unset("local[2]")) == session.shared_dir(Unset("local[2]"))
    with pytest.raises(RuntimeError):
        session.shared_dir(Unset("spark://host:7077"))
