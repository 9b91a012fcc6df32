"""Station tables: enrichment, element counts, totals, networks, distances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import active_in, code_where, extra_size, is_blank, overlap_size
from tallyfield.operators.geo import furthest_pair, pairs_within
from tallyfield.operators.joins import enrich, lookup, membership_count, restrict
from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin


def element_counts(inventory: DataFrame, core: Sequence[str], id_col: str = "station_id") -> DataFrame:
    """(id, core_elements, other_elements, elements): distinct elements in one pass."""
    is_core = F.col("element").isin(list(core))
    distinct = inventory.select(id_col, "element").distinct()
    return distinct.groupBy(id_col).agg(
        F.count_if(is_core).alias("core_elements"),
        F.count_if(~is_core).alias("other_elements"),
        F.count(F.lit(1)).alias("elements"),
    )


def element_counts_by_array(
    inventory: DataFrame, core: Sequence[str], id_col: str = "station_id"
) -> DataFrame:
    """The same counts from one element set per station (element kinds are few)."""
    wanted = F.array(*[F.lit(c) for c in core])
    sets = inventory.groupBy(id_col).agg(F.array_sort(F.collect_set("element")).alias("element_set"))
    return sets.select(
        id_col,
        overlap_size(wanted, "element_set").cast("bigint").alias("core_elements"),
        extra_size(wanted, "element_set").cast("bigint").alias("other_elements"),
        F.size("element_set").cast("bigint").alias("elements"),
    )


def stations_with_all(inventory: DataFrame, core: Sequence[str], id_col: str = "station_id") -> DataFrame:
    """Stations that report every core element."""
    rows = inventory.filter(F.col("element").isin(list(core)))
    return (
        rows.groupBy(id_col)
        .agg(F.count_distinct("element").alias("n"))
        .filter(F.col("n") == len(set(core)))
        .select(id_col)
    )


def stations_with_only(inventory: DataFrame, wanted: Sequence[str], id_col: str = "station_id") -> DataFrame:
    """Stations whose every element is in ``wanted``."""
    return (
        inventory.groupBy(id_col)
        .agg(F.bool_and(F.col("element").isin(list(wanted))).alias("only"))
        .filter("only")
        .select(id_col)
    )


def enrich_stations(
    stations: DataFrame,
    countries: DataFrame,
    states: DataFrame,
    inventory: DataFrame,
    core: Sequence[str],
    state_country: str | None = None,
) -> DataFrame:
    """Stations with country and state names, element counts and years of activity.

    ``stations`` has station_id, country_code and state_code; ``countries`` and
    ``states`` have code and name. With ``state_country`` a state code counts
    only in that country. A station without inventory has 0 elements.
    """
    base = stations
    if state_country is not None:
        base = base.withColumn(
            "state_code", code_where("state_code", F.col("country_code") == F.lit(state_country))
        )
    named = enrich(
        base,
        [
            (countries.select("code", F.col("name").alias("country_name")), "country_code", "code"),
            (states.select("code", F.col("name").alias("state_name")), "state_code", "code"),
        ],
    )
    is_core = F.col("element").isin(list(core))
    per_element = inventory.groupBy("station_id", "element").agg(
        F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year")
    )
    summary = per_element.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("elements"),
        F.count_if(is_core).alias("core_elements"),
        F.count_if(~is_core).alias("other_elements"),
        F.min("first_year").alias("open_year"),
        F.max("last_year").alias("close_year"),
    )
    counts = ["elements", "core_elements", "other_elements"]
    # Both sides hold one row per station: nothing to salt.
    return named.join(summary, "station_id", "left").fillna(0, counts)


def station_totals(stations: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stations per value; rows with a blank key are left out."""
    rows = stations
    for key in by:
        rows = rows.filter(~is_blank(key))
    return rows.groupBy(*by).agg(F.count("station_id").alias("stations"))


def add_station_totals(codes: DataFrame, stations: DataFrame, by: str) -> DataFrame:
    """The code table with a station count, null where there is no station."""
    totals = pin(station_totals(stations, [by]), "totals")
    return lookup(codes, totals, "code", by, ["stations"])


def active_stations(stations: DataFrame, year: int) -> DataFrame:
    """Stations open in ``year``."""
    return stations.filter(active_in("first_year", "last_year", year))


def networks() -> dict[str, Column]:
    """Membership tests of the three station networks."""
    return {
        "gsn": F.col("gsn_flag") == "GSN",
        "hcn": F.col("hcn_crn_flag") == "HCN",
        "crn": F.col("hcn_crn_flag") == "CRN",
    }


def network_overlap(stations: DataFrame) -> DataFrame:
    """Stations in more than one network, with their 0/1 memberships."""
    return membership_count(stations, networks()).filter(F.col("memberships") > 1)


def hemisphere_totals(stations: DataFrame) -> DataFrame:
    """(hemisphere, stations): north and south; stations on the equator are in neither."""
    side = F.when(F.col("lat") > 0, "north").when(F.col("lat") < 0, "south")
    rows = stations.withColumn("hemisphere", side).filter(F.col("hemisphere").isNotNull())
    return rows.groupBy("hemisphere").agg(F.count_distinct("station_id").alias("stations"))


def territory_total(countries: DataFrame, pattern: str, exclude_code) -> DataFrame:
    """Stations over countries whose name matches ``pattern``, leaving one country out."""
    rows = countries.filter(F.col("name").like(pattern) & (F.col("code") != F.lit(exclude_code)))
    return rows.agg(F.sum("stations").cast("bigint").alias("stations"))


def territory_total_by_rows(
    countries: DataFrame, stations: DataFrame, pattern: str, exclude_code
) -> DataFrame:
    """The same number counted on station rows."""
    codes = countries.filter(F.col("name").like(pattern) & (F.col("code") != F.lit(exclude_code)))
    rows = restrict(stations, codes.select(F.col("code").alias("country_code")), "country_code")
    return rows.agg(F.count("station_id").alias("stations"))


def pair_distances(stations: DataFrame, max_km: float) -> DataFrame:
    """Distances between stations of one country up to ``max_km`` apart, each pair once."""
    return pairs_within(stations, "station_id", "lat", "lon", max_km, within="country_code")


def furthest_stations(stations: DataFrame) -> DataFrame:
    """The two stations furthest apart in each country."""
    return furthest_pair(stations, "station_id", "lat", "lon", within="country_code")


def observed_with_station(obs: DataFrame, stations: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Observations of known stations with station columns added."""
    return keyed_join(obs, stations.select("station_id", *cols), ["station_id"], "inner")
