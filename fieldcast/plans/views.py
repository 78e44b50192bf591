"""SQL views over the gold tables.

The views read ``season_shift``, ``renewable_ranking``, ``dim_city``, ``dim_state`` and
``dim_region``.  A stored view keeps no order, so ordered views list a sort for their
readers in ``VIEW_ORDER``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_NAMED = ("region_id, state_id, city_id, city_name, state_name, region_name, season, "
          "crop, year")


def _shift_view(side: str, alias: str) -> str:
    return f"""
        SELECT {_NAMED}, round(avg(season_shift_days), 2) AS {alias},
               round(avg(crop_suitability_score), 2) AS avg_crop_score,
               round(avg(season_stability_score), 2) AS avg_stability_score
        FROM v_base_clean WHERE season_shift_days {side} 0 GROUP BY {_NAMED}"""


VIEWS: dict[str, str] = {
    "v_base_clean": """
        SELECT f.region_id, f.state_id, f.city_id, c.city_name, s.state_name, r.region_name,
               f.season, f.crop, f.year, f.avg_temperature, f.avg_rainfall, f.avg_humidity,
               f.official_start_date, f.detected_start_date, f.detected_month,
               f.season_shift_days, f.shift_category,
               round(f.crop_suitability_score, 2) AS crop_suitability_score,
               round(f.season_stability_score, 2) AS season_stability_score
        FROM season_shift f
        LEFT JOIN dim_city c USING (city_id)
        LEFT JOIN dim_state s ON s.state_id = f.state_id
        LEFT JOIN dim_region r ON r.region_id = f.region_id
        WHERE f.official_start_date IS NOT NULL AND f.detected_start_date IS NOT NULL
          AND f.season_shift_days IS NOT NULL""",
    "v_arrival_summary": """
        WITH typed AS (
          SELECT *, CASE WHEN season_shift_days < 0 THEN 'Early Arrival'
                         WHEN season_shift_days > 0 THEN 'Late Arrival'
                         ELSE 'On Time' END AS arrival_type
          FROM v_base_clean)
        SELECT region_id, state_id, year, season, crop, state_name, region_name, arrival_type,
               count(*) AS total_arrivals, round(avg(abs(season_shift_days)), 2) AS avg_shift_days
        FROM typed
        GROUP BY region_id, state_id, year, season, crop, state_name, region_name,
                 arrival_type""",
    "v_trend": f"""
        SELECT {_NAMED}, season_shift_days, shift_category, crop_suitability_score,
               season_stability_score,
               avg(season_shift_days) OVER (
                 PARTITION BY city_id, season ORDER BY year
                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3yr_avg_shift
        FROM v_base_clean""",
    "v_early_arrival": _shift_view("<", "avg_advance_days"),
    "v_late_arrival": _shift_view(">", "avg_delay_days"),
    "v_shift_by_season": """
        SELECT season, round(avg(season_shift_days), 2) AS avg_shift,
               round(avg(crop_suitability_score), 2) AS crop_score,
               round(avg(season_stability_score), 2) AS stability_score,
               count(*) AS observations
        FROM v_base_clean GROUP BY season""",
    "v_dim_state": """
        SELECT state_id, state_name, region_id FROM dim_state
        WHERE state_id IN (SELECT state_id FROM v_base_clean)""",
    "v_dim_region": """
        SELECT region_id, region_name FROM dim_region
        WHERE region_id IN (SELECT region_id FROM v_base_clean)""",
    "v_dim_city": """
        SELECT DISTINCT city_id, city_name, state_id FROM dim_city
        WHERE city_id IN (SELECT city_id FROM v_base_clean)""",
    "v_dim_year": "SELECT DISTINCT year FROM v_base_clean",
    "v_renewable_dashboard": """
        SELECT k.region_id, r.region_name, k.state_id, s.state_name, k.city_id, c.city_name,
               c.district, c.lat, c.lng, k.avg_wind_speed_10m, k.avg_wind_speed_100m,
               k.peak_wind_speed_10m, k.peak_wind_speed_100m, k.avg_cloud_cover,
               k.avg_wind_10m_score, k.avg_wind_100m_score, k.avg_solar_score,
               k.avg_solar_proxy, k.renewable_index, k.renewable_rank, k.renewable_category,
               k.greenhouse_wind_suitability, k.recommended_energy_type
        FROM renewable_ranking k
        JOIN dim_city c ON c.city_id = k.city_id
        JOIN dim_state s ON s.state_id = k.state_id
        JOIN dim_region r ON r.region_id = k.region_id""",
}

VIEW_ORDER: dict[str, str] = {
    "v_trend": "city_name, season, year", "v_early_arrival": "avg_advance_days",
    "v_late_arrival": "avg_delay_days DESC", "v_dim_state": "state_name",
    "v_dim_region": "region_name", "v_dim_city": "city_name", "v_dim_year": "year",
}


def create_views(spark: SparkSession, database: str | None = None,
                 names: Iterable[str] = tuple(VIEWS)) -> None:
    """Create the views, as temporary views or in a database."""
    if database:
        spark.sql(f"USE {database}")
    for name in names:
        body = VIEWS[name]
        if database:
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")
        else:
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {body}")


def read_view(spark: SparkSession, name: str) -> DataFrame:
    """A view in its reading order."""
    df = spark.table(name)
    order = VIEW_ORDER.get(name)
    return spark.sql(f"SELECT * FROM {name} ORDER BY {order}") if order else df
