"""Bronze to silver: place enrichment, dimensions, facts, audits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from fieldcast import config as C
from fieldcast.functions.keys import region_of_state, replace_values
from fieldcast.operators import quality as Q
from fieldcast.operators.dims import build_dims
from fieldcast.operators.facts import build_fact, build_fact_sampled
from fieldcast.operators.geo import enrich_points
from fieldcast.operators.ranking import dedup_first
from fieldcast.operators.sampling import stratified_flag
from fieldcast.sources.sinks import write_dataset


@dataclass
class Silver:
    dim_region: DataFrame
    dim_state: DataFrame
    dim_city: DataFrame
    fact_weather: DataFrame
    fact_weather_sampled: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return vars(self)


def enrich_city_master(master: DataFrame, polygons: DataFrame) -> DataFrame:
    """State, district and region of each city, one row per (city, state)."""
    placed = replace_values(enrich_points(master.select("city", "lat", "lng"), polygons),
                            "state", C.STATE_RENAMES)
    located = placed.withColumn("region", region_of_state("state"))
    return dedup_first(located, ["city", "state"], ["district", "lat", "lng"])


def build_silver(master: DataFrame, hourly: DataFrame, pct: float = C.SAMPLE_SHARE,
                 floor: int = C.SAMPLE_FLOOR, seed: int = C.SAMPLE_SEED) -> Silver:
    """Dimensions with sample flags and both facts.

    ``master``: city, state, district, region, lat, lng; ``hourly``: city, date, measures.
    """
    region, state, city = build_dims(master)
    city = stratified_flag(city, ["state_id"], ["city_id"], pct, floor, seed)
    return Silver(region, state, city, build_fact(hourly, city, state),
                  build_fact_sampled(hourly, city, state))


def silver_checks(s: Silver) -> list[DataFrame]:
    """The audit of the silver tables, one row per check."""
    return [
        Q.check_pk(s.dim_region, "region_id", "dim_region"),
        Q.check_pk(s.dim_state, "state_id", "dim_state"),
        Q.check_fk_not_null(s.dim_state, "region_id", "dim_state"),
        Q.check_pk(s.dim_city, "city_id", "dim_city"),
        Q.check_fk_not_null(s.dim_city, "state_id", "dim_city"),
        Q.check_composite(s.dim_city, ["city_name", "state_id"], "dim_city"),
        Q.check_contiguous(s.dim_city, "city_id", "dim_city"),
        Q.check_flag(s.dim_city, "is_sampled", "dim_city"),
        Q.check_fk_not_null(s.fact_weather, "city_id", "fact_weather"),
        Q.check_fk_not_null(s.fact_weather, ["state_id", "state_name"], "fact_weather"),
        Q.check_orphans(s.fact_weather, s.dim_city, "city_id", "fact_weather"),
        Q.check_fk_not_null(s.fact_weather_sampled, "city_id", "fact_weather_sampled"),
        Q.check_parity(s.fact_weather, s.fact_weather_sampled, "state_name", "state"),
    ]


def run_silver(master: DataFrame, hourly: DataFrame, out: str, fail: bool = True) -> DataFrame:
    """Build, write, read back and audit the silver layer; returns the audit table.

    The audit reads what was written, so it costs scans of the tables, not a rebuild.
    """
    silver = build_silver(master, hourly)
    for name, df in silver.tables().items():
        if name.startswith("dim"):
            write_dataset(df, f"{out}/{name}", coalesce_num=1)
        else:
            write_dataset(df, f"{out}/{name}", ["state_name"])
    spark = master.sparkSession
    written = Silver(**{n: spark.read.parquet(f"{out}/{n}") for n in silver.tables()})
    return Q.run_audit(silver_checks(written), fail)


