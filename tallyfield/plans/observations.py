"""Long (station, date, element, value) observations: coverage, gaps, quality, totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import is_blank, month_of, ratio, year_of
from tallyfield.operators.aggregates import presence, quality_profile
from tallyfield.operators.joins import exclude, lookup, orphans, restrict
from tallyfield.operators.running import running_sum
from tallyfield.operators.sets import multiset_difference
from tallyfield.plans.stations import observed_with_station
from tallyfield.session import pin


def element_coverage(rows: DataFrame, elements: Sequence[str]) -> DataFrame:
    """(element, observations, stations) for the chosen elements, in no order."""
    chosen = rows.filter(F.col("element").isin(list(elements)))
    # Rows are first counted per (element, station): one element may own most rows.
    pairs = chosen.groupBy("element", "station_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("element").agg(F.sum("n").alias("observations"), F.count("station_id").alias("stations"))


def presence_gaps(obs: DataFrame, a: str, b: str) -> DataFrame:
    """(station, date) pairs that have ``a`` but not ``b``."""
    flags = presence(obs, ["station_id", "obs_date"], "element", [a, b])
    return flags.filter(F.col(f"has_{a}") & ~F.col(f"has_{b}")).select("station_id", "obs_date")


def presence_summary(obs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: pairs and stations with only ``a``, and with exactly one of the two."""
    flags = presence(obs, ["station_id", "obs_date"], "element", [a, b])
    has_a, has_b = F.col(f"has_{a}"), F.col(f"has_{b}")
    per_station = flags.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(has_a & has_b).alias("both"),
        F.count_if(has_a & ~has_b).alias("only_a"),
        F.count_if(has_a != has_b).alias("one"),
    )
    return per_station.agg(
        F.sum("pairs").alias("pairs"),
        F.sum("both").alias("both_pairs"),
        F.sum("only_a").alias("only_a_pairs"),
        F.count_if(F.col("only_a") > 0).alias("only_a_stations"),
        F.sum("one").alias("exactly_one_pairs"),
        F.count_if(F.col("one") > 0).alias("exactly_one_stations"),
    )


def extract(obs: DataFrame, stations: DataFrame, country, elements: Sequence[str]) -> DataFrame:
    """Chosen elements of one country's stations with year and month."""
    ids = stations.filter(F.col("country_code") == F.lit(country)).select("station_id")
    rows = restrict(obs.filter(F.col("element").isin(list(elements))), ids, "station_id")
    return rows.withColumns({"year": year_of("obs_date"), "month": month_of("obs_date")})


def coverage(rows: DataFrame) -> DataFrame:
    """(first_year, last_year, first_month, last_month): months of the end years."""
    return rows.agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.min(F.struct("year", "month"))["month"].alias("first_month"),
        F.max(F.struct("year", "month"))["month"].alias("last_month"),
    )


def annual_summary(
    obs: DataFrame,
    stations: DataFrame,
    element: str | None = None,
    good_only: bool = True,
    flag: str = "quality_flag",
) -> DataFrame:
    """Average, count and sum per country and year, plus the average times 365; in no order.

    The rows are reduced to (station, year) before they meet the station table,
    so the join sees few rows however unevenly stations report. Year comes from
    ``year`` when present, else from ``obs_date``.
    """
    rows = obs if element is None else obs.filter(F.col("element") == element)
    if good_only:
        rows = rows.filter(is_blank(flag))
    if "year" not in rows.columns:
        rows = rows.withColumn("year", year_of("obs_date"))
    per_station = rows.groupBy("station_id", "year").agg(
        F.sum("value").alias("_sum"), F.count("value").alias("_n")
    )
    joined = observed_with_station(per_station, stations, ["country_code"])
    return (
        joined.groupBy("country_code", "year")
        .agg(F.sum("_n").alias("observations"), F.sum("_sum").alias("total"))
        .withColumn("avg_value", ratio("total", "observations"))
        .withColumn("avg_x365", F.col("avg_value") * 365)
    )


def cumulative_summary(annual: DataFrame) -> DataFrame:
    """Running totals over the years of each country."""
    return running_sum(
        annual,
        ["country_code"],
        ["year"],
        {"cum_avg": "avg_value", "cum_avg_x365": "avg_x365", "cum_total": "total"},
        bounded=True,
    )


def drill_down(obs: DataFrame, stations: DataFrame, country, year: int) -> DataFrame:
    """The rows behind one (country, year) average."""
    ids = stations.filter(F.col("country_code") == F.lit(country)).select("station_id")
    # Dates start with their year: a range of text reaches the scan, a substring would not.
    dates = (F.col("obs_date") >= f"{year:04d}") & (F.col("obs_date") < f"{year + 1:04d}")
    return restrict(obs.filter(dates), ids, "station_id")


def missing_countries(
    obs: DataFrame, stations: DataFrame, countries: DataFrame, element: str
) -> DataFrame:
    """(code, name, other element, observations) for countries without one element.

    A country with no observation at all has one row with a null element.
    """
    per_station = obs.groupBy("station_id", "element").agg(F.count(F.lit(1)).alias("n"))
    seen = (
        observed_with_station(per_station, stations, ["country_code"])
        .groupBy("country_code", "element")
        .agg(F.sum("n").alias("observations"))
    )
    measured = seen.filter(F.col("element") == element).select(F.col("country_code").alias("code"))
    absent = exclude(countries.select("code", "name"), measured, "code")
    return absent.join(seen.withColumnRenamed("country_code", "code"), "code", "left").select(
        "code", "name", "element", "observations"
    )


def quality_by_country(obs: DataFrame, stations: DataFrame, names: DataFrame) -> DataFrame:
    """Good and bad rows per country from per-station counts; unknown stations count under null."""
    per_station = quality_profile(obs, ["station_id"], "quality_flag")
    codes = lookup(per_station, stations, "station_id", "station_id", ["country_code"])
    named = lookup(codes, names, "country_code", "code", ["name"])
    return (
        named.groupBy("name")
        .agg(F.sum("good").alias("good"), F.sum("all_rows").alias("all_rows"))
        .withColumn("good_share", ratio("good", "all_rows"))
    )


def quality_by_year(obs: DataFrame) -> DataFrame:
    """Good and bad rows per year."""
    return quality_profile(obs.withColumn("year", year_of("obs_date")), ["year"], "quality_flag")


def fully_good(obs: DataFrame) -> DataFrame:
    """One row: stations with only good rows, the rows they cover, stations with none good."""
    per = quality_profile(obs, ["station_id"], "quality_flag")
    return per.agg(
        F.count_if(F.col("bad") == 0).alias("good_stations"),
        F.sum(F.when(F.col("bad") == 0, F.col("all_rows")).otherwise(0)).alias("good_station_rows"),
        F.count_if(F.col("good") == 0).alias("stations_without_good"),
    )


def unmatched_ids(obs: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """(id, side): ids that only one table holds, in one pass over both.

    Each row carries one bit for its table. The bits of an id are or-ed on the
    map side, so a hot id costs one row a task and nothing is joined. Null is an id like any other.
    """
    tagged = obs.select(F.col(key).alias("id"), F.lit(1).alias("seen")).unionByName(
        stations.select(F.col(key).alias("id"), F.lit(2).alias("seen"))
    )
    seen = tagged.groupBy("id").agg(F.bit_or("seen").alias("seen")).filter(F.col("seen") < 3)
    return seen.select("id", F.when(F.col("seen") == 1, "observations_only").otherwise("stations_only").alias("side"))


def unmatched_counts(obs: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """(side, n) of ``unmatched_ids``; a side without such ids has 0."""
    ids = unmatched_ids(obs, stations, key)
    sides = ("observations_only", "stations_only")
    row = ids.agg(*[F.count_if(F.col("side") == s).alias(s) for s in sides])
    return row.select(F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("n")) for s in sides])))


def reconcile(obs: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """(side, method, n): ids on one side only, by anti join, subtract and exceptAll forms.

    The distinct ids are written first, so the methods read ids and not rows.
    """
    a = pin(obs.select(key).distinct(), "ids")
    b = pin(stations.select(key).distinct(), "ids")
    checks = {
        ("observations_only", "anti_join"): orphans(a, b, key, key),
        ("stations_only", "anti_join"): orphans(b, a, key, key),
        ("observations_only", "subtract"): a.subtract(b),
        ("stations_only", "subtract"): b.subtract(a),
        ("observations_only", "multiset"): multiset_difference(a, b),
        ("stations_only", "multiset"): multiset_difference(b, a),
        ("observations_only", "outer_null"): a.join(b.withColumn("_in", F.lit(1)), key, "left").filter("_in is null"),
        ("stations_only", "outer_null"): a.withColumn("_in", F.lit(1)).join(b, key, "right").filter("_in is null"),
    }
    out = None
    for (side, method), ids in checks.items():
        row = ids.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(side).alias("side"), F.lit(method).alias("method"), "n"
        )
        out = row if out is None else out.unionByName(row)
    return out
