"""Dimensions: regions, states, cities, dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast.functions import calendar as cal
from fieldcast.operators.ranking import surrogate_keys


def build_dim_region(master: DataFrame) -> DataFrame:
    """``region_id, region_name`` from the distinct regions of the city master."""
    names = master.select(F.col("region").alias("region_name")).distinct().filter(
        "region_name IS NOT NULL")
    return surrogate_keys(names, ["region_name"], "region_id").select("region_id", "region_name")


def build_dim_state(master: DataFrame, dim_region: DataFrame) -> DataFrame:
    """``state_id, state_name, region_id``; ids follow the state name."""
    states = (master.select(F.col("state").alias("state_name"),
                            F.col("region").alias("region_name")).distinct()
              .filter("state_name IS NOT NULL"))
    linked = states.join(dim_region, "region_name", "left")
    return surrogate_keys(linked, ["state_name", "region_name"], "state_id").select(
        "state_id", "state_name", "region_id")


def build_dim_city(master: DataFrame, dim_state: DataFrame) -> DataFrame:
    """``city_id, city_name, state_id, district, lat, lng``; ids follow (state, city)."""
    cities = master.withColumnsRenamed({"state": "state_name", "city": "city_name"})
    linked = cities.join(dim_state.select("state_id", "state_name"), "state_name", "left")
    return surrogate_keys(linked, ["state_name", "city_name"], "city_id").select(
        "city_id", "city_name", "state_id", "district", "lat", "lng")


def build_dims(master: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All three dimensions of a city master (city, state, district, region, lat, lng)."""
    region = build_dim_region(master)
    state = build_dim_state(master, region)
    return region, state, build_dim_city(master, state)


def deduplicate_regions(dim_region: DataFrame,
                        dim_state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep the smallest id per region name and point the states at it."""
    canonical = dim_region.groupBy("region_name").agg(F.min("region_id").alias("keep_id"))
    mapping = dim_region.join(canonical, "region_name").select("region_id", "keep_id")
    regions = canonical.select(F.col("keep_id").alias("region_id"), "region_name")
    states = dim_state.join(mapping, "region_id", "left").select(
        "state_id", "state_name", F.col("keep_id").alias("region_id"))
    return regions, states


def build_dim_date(*facts: DataFrame) -> DataFrame:
    """Distinct dates of all facts with ten calendar columns."""
    dates = facts[0].select("date")
    for fact in facts[1:]:
        dates = dates.union(fact.select("date"))
    named = cal.with_names(cal.with_calendar(dates.distinct()))
    return named.select("date", "year", "month", "day", "quarter", "week", "day_of_week",
                        "day_name", "month_name", "is_weekend", "year_month").orderBy("date")


def build_dim_month(dim_date: DataFrame) -> DataFrame:
    return dim_date.select("year", "month", "year_month", "month_name",
                           "quarter").distinct().orderBy("year_month")


def build_dim_year(dim_month: DataFrame) -> DataFrame:
    return dim_month.select("year").distinct().orderBy("year")


def parity(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column in two tables and which table lacks them."""
    left = a.select(col).distinct().withColumn("_in_a", F.lit(True))
    right = b.select(col).distinct().withColumn("_in_b", F.lit(True))
    return left.join(right, col, "full").select(
        col, F.when(F.col("_in_b").isNull(), "missing in second")
        .when(F.col("_in_a").isNull(), "missing in first").otherwise("both").alias("status"))


def city_lists(df: DataFrame, group: str = "state", member: str = "city") -> DataFrame:
    """Members of each group, one row each, with the group's number of members.

    The long form has one shape whatever the size of a group.
    """
    distinct = df.select(group, member).distinct()
    sizes = distinct.groupBy(group).agg(F.count(F.lit(1)).alias("city_count"))
    return distinct.join(sizes, group).select(group, "city_count", member)


def duplicate_bases(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Rows of keys that occur more than once: keys, count of the key, member."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)
    return df.join(sizes, list(keys)).select(*keys, "count", member)
