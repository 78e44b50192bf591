"""Silver to gold: all marts of the gold layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from fieldcast import config as C
from fieldcast.operators.clean import require_columns
from fieldcast.operators.crop import crop_agronomy_profile, crop_ml_features
from fieldcast.operators.dims import (build_dim_date, build_dim_month, build_dim_year,
                                      deduplicate_regions)
from fieldcast.operators.facts import build_star_schema
from fieldcast.operators.renewable import build_renewable_ranking
from fieldcast.operators.rollup import (build_city_profile, build_daily_weather,
                                        build_monthly_weather)
from fieldcast.operators.season import build_season_shift
from fieldcast.plans.views import create_views
from fieldcast.sources.sinks import register, write_dataset

# table -> (partition columns, file count)
LAYOUT: dict[str, tuple[list[str] | None, int | None]] = {
    "dim_region": (None, 1), "dim_state": (None, 1), "dim_city": (None, 1),
    "dim_date": (None, 1), "dim_month": (None, 1), "dim_year": (None, 1),
    "daily_weather": (["state_id", "year"], None),
    "daily_weather_full": (["state_id", "year"], None),
    "monthly_weather": (["state_id", "year"], None),
    "season_shift": (None, 4), "renewable_ranking": (None, 4), "city_profile": (None, 4),
    "crop_ml_dataset": (None, 4), "dim_crop_agronomy_profile": (None, 1),
}


def daily_from_fact(fact: DataFrame, dim_city: DataFrame, dim_state: DataFrame,
                    label: str) -> DataFrame:
    require_columns(fact, C.REQUIRED_FACT_COLUMNS, label)
    return build_daily_weather(build_star_schema(fact, dim_city, dim_state))


def build_gold(silver: Mapping[str, DataFrame], crop: DataFrame | None = None
               ) -> dict[str, DataFrame]:
    """All gold tables as lazy frames.

    The sampled fact feeds the daily and monthly tables, the full fact the season,
    renewable and profile marts.
    """
    regions, states = deduplicate_regions(silver["dim_region"], silver["dim_state"])
    city = silver["dim_city"]
    daily = daily_from_fact(silver["fact_weather_sampled"], city, states, "sampled")
    full = daily_from_fact(silver["fact_weather"], city, states, "full")
    return {"dim_region": regions, "dim_state": states, "dim_city": city,
            **marts(daily, full), **crop_marts(crop)}


def marts(daily: DataFrame, full: DataFrame) -> dict[str, DataFrame]:
    dates = build_dim_date(daily, full)
    months = build_dim_month(dates)
    return {
        "daily_weather": daily, "daily_weather_full": full,
        "monthly_weather": build_monthly_weather(daily), "dim_date": dates,
        "dim_month": months, "dim_year": build_dim_year(months),
        "season_shift": build_season_shift(full),
        "renewable_ranking": build_renewable_ranking(full),
        "city_profile": build_city_profile(full),
    }


def crop_marts(crop: DataFrame | None) -> dict[str, DataFrame]:
    if crop is None:
        return {}
    features = crop_ml_features(crop)
    return {"crop_ml_dataset": features,
            "dim_crop_agronomy_profile": crop_agronomy_profile(features)}


def run_gold(spark: SparkSession, silver: Mapping[str, DataFrame], out: str,
             crop: DataFrame | None = None, database: str | None = None) -> list[str]:
    """Write the gold layer and register its tables and views; returns the table names.

    Both daily tables are written first and read back, so the marts start from stored
    columns instead of a cache that dies with an executor.
    """
    regions, states = deduplicate_regions(silver["dim_region"], silver["dim_state"])
    city = silver["dim_city"]
    daily = {"daily_weather": "fact_weather_sampled", "daily_weather_full": "fact_weather"}
    for table, fact in daily.items():
        write_dataset(daily_from_fact(silver[fact], city, states, fact), f"{out}/{table}",
                      *LAYOUT[table])
    stored = [spark.read.parquet(f"{out}/{t}") for t in daily]
    tables = {"dim_region": regions, "dim_state": states, "dim_city": city,
              **marts(*stored), **crop_marts(crop)}
    dates = tables["dim_date"].persist(StorageLevel.MEMORY_AND_DISK)  # one row per day
    tables["dim_month"] = build_dim_month(dates)
    tables["dim_year"] = build_dim_year(tables["dim_month"])
    for name, df in tables.items():
        if name not in daily:
            partitions, files = LAYOUT[name]
            write_dataset(df, f"{out}/{name}", partitions, files)
    dates.unpersist()
    for name in tables:
        register(spark, name, f"{out}/{name}", database)
    create_views(spark, database)
    return list(tables)
