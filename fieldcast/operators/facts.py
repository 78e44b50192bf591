"""Fact building and star enrichment.

No broadcast hints: Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, where
adaptive execution splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast import config as C
from fieldcast.functions.keys import norm_key, soil_ph


def build_star_schema(fact: DataFrame, dim_city: DataFrame, dim_state: DataFrame,
                      measures: Sequence[str] = C.HOURLY_MEASURES) -> DataFrame:
    """Fact plus ``state_id`` and ``region_id``; unknown keys give NULL ids."""
    fact = fact.select("city_id", "date", *[m for m in measures if m in fact.columns])
    place = dim_city.select("city_id", "state_id").join(
        dim_state.select("state_id", "region_id"), "state_id", "left")
    return fact.join(place, "city_id", "left").select(*fact.columns, "state_id", "region_id")


def city_lookup(dim_city: DataFrame, dim_state: DataFrame) -> DataFrame:
    return dim_city.join(dim_state.select("state_id", "state_name"), "state_id").select(
        "city_id", "state_id", "state_name", norm_key("city_name").alias("city_key"))


def build_fact(raw: DataFrame, dim_city: DataFrame, dim_state: DataFrame,
               city: str = "city") -> DataFrame:
    """Hourly rows joined to city ids by normalised name only.

    A name that exists in two states yields one copy per city.
    """
    keyed = raw.withColumn("city_key", norm_key(city))
    return keyed.join(city_lookup(dim_city, dim_state), "city_key").drop(city, "city_key")


def build_fact_sampled(raw: DataFrame, dim_city: DataFrame, dim_state: DataFrame,
                       city: str = "city") -> DataFrame:
    """As :func:`build_fact` for the flagged cities only (the lookup is cut first)."""
    return build_fact(raw, dim_city.filter("is_sampled"), dim_state, city)


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts whose key the dimension does not hold."""
    return fact.join(dim.select(key).distinct(), key, "left_anti")


def state_weather_avg(fact: DataFrame, dim_city: DataFrame, dim_state: DataFrame) -> DataFrame:
    """Mean temperature and humidity per normalised state name.

    Sums are taken per city before the join, so the shuffle carries cities, not hours.
    """
    per_city = fact.groupBy("city_id").agg(
        F.sum("temperature_2m").alias("t"), F.count("temperature_2m").alias("nt"),
        F.sum("relative_humidity_2m").alias("h"), F.count("relative_humidity_2m").alias("nh"))
    named = per_city.join(dim_city.select("city_id", "state_id"), "city_id").join(
        dim_state.select("state_id", "state_name"), "state_id")
    return named.groupBy(norm_key("state_name").alias("state_clean")).agg(
        (F.sum("t") / F.sum("nt")).alias("temperature_c_avg"),
        (F.sum("h") / F.sum("nh")).alias("humidity_avg"))


def enrich_crop_weather(crop: DataFrame, state_avg: DataFrame,
                        state: str = "state") -> DataFrame:
    """Fill crop temperature, humidity and pH: own value, state average, constant."""
    def own(name):
        return F.col(f"`{name}`") if name in crop.columns else F.lit(None).cast("double")

    joined = crop.withColumn("state_clean", norm_key(state)).join(
        state_avg, "state_clean", "left")
    return joined.withColumns({
        "temperature_c": F.coalesce(own("temperature_c"), "temperature_c_avg",
                                    F.lit(C.DEFAULT_TEMPERATURE)),
        "humidity_%": F.coalesce(own("humidity_%"), "humidity_avg",
                                 F.lit(C.DEFAULT_HUMIDITY)),
        "ph": F.coalesce(own("ph"), soil_ph(state)),
    }).drop("state_clean", "temperature_c_avg", "humidity_avg")
