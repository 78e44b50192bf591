"""Crop matching and batch recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldcast.operators.crop import (MATCH_KEYS, attach_feature_weights, build_crop_profile,
                                      build_crop_weather_match)
from fieldcast.operators.rollup import build_city_season_profile
from fieldcast.sources.sinks import add_audit_columns, write_dataset


def named_daily(daily: DataFrame, dim_city: DataFrame, dim_state: DataFrame,
                dim_region: DataFrame) -> DataFrame:
    """Daily weather with the names of its places."""
    places = dim_city.select("city_id", "city_name", "district", "state_id").join(
        dim_state.select("state_id", "state_name", "region_id"), "state_id").join(
        dim_region.select("region_id", "region_name"), "region_id")
    return daily.join(places.select("city_id", *MATCH_KEYS[:4]), "city_id")


def build_match(daily: DataFrame, crop: DataFrame, overrides: DataFrame | None = None,
                per_year: bool = False, wind_factor: float = 1.0) -> DataFrame:
    """Best crops per place and season from named daily weather and crop yields."""
    profile = build_city_season_profile(daily, MATCH_KEYS[:4], per_year, wind_factor)
    crops = attach_feature_weights(build_crop_profile(crop), overrides)
    return build_crop_weather_match(profile, crops)


def run_match(daily: DataFrame, crop: DataFrame, out: str,
              overrides: DataFrame | None = None) -> None:
    match = add_audit_columns(build_match(daily, crop, overrides), "crop_weather_match")
    write_dataset(match, out, ["season"])
