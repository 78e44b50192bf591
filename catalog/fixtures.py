"""Weather, place and crop tables as fixed projections of the driver tables.

Every table is given twice: as a DataFrame and as a SQL common table expression with the
same columns.  Measures are exact in binary (halves, eighths, integers), so that sums do
not depend on the order of rows.  All rows of the source tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcast.config import HOURLY_MEASURES
from fieldcast.operators.facts import build_star_schema
from fieldcast.operators.renewable import build_renewable_ranking
from fieldcast.operators.rollup import build_daily_weather, daily_features
from fieldcast.operators.season import build_season_shift


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------- hourly weather
_CITIES_SQL = "(SELECT greatest(4, count(*) * 8 // 100) FROM supplier)"


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly weather: one row per line item; the number of cities grows with the table."""
    item = table(spark, sf, "lineitem")
    cities = table(spark, sf, "supplier").agg(
        F.greatest(F.lit(4), F.floor(F.count(F.lit(1)) * 8 / 100)).alias("m")).scalar()
    temp = F.lit(10.0) + F.col("l_quantity") * 0.5
    humidity = F.lit(40.0) + F.round(F.col("l_discount") * 100) * 5
    rain = F.round(F.col("l_tax") * 100) * 0.125
    day = F.to_date("l_shipdate")
    hour = F.col("l_linenumber") * 3
    exprs = {
        "city_id": (F.col("l_suppkey") % cities).cast("int"),
        "date": day,
        "time": day.cast("timestamp") + F.make_dt_interval(hours=hour),
        "hour": hour,
        "temperature_2m": temp,
        "relative_humidity_2m": humidity,
        "dew_point_2m": temp - (F.lit(100.0) - humidity) / 5,
        "apparent_temperature": temp + humidity * 0.125,
        "precipitation": rain,
        "rain": rain,
        "snowfall": F.lit(0.0),
        "snow_depth": F.lit(0.0),
        "pressure_msl": (F.lit(1000) + F.col("l_partkey") % 30).cast("double"),
        "surface_pressure": (F.lit(980) + F.col("l_partkey") % 30
                             + F.col("l_orderkey") % 2).cast("double"),
        "cloud_cover": (F.col("l_partkey") % 101).cast("double"),
        "cloud_cover_low": (F.col("l_partkey") % 41).cast("double"),
        "cloud_cover_mid": (F.col("l_partkey") % 61).cast("double"),
        "cloud_cover_high": (F.col("l_partkey") % 81).cast("double"),
        "wind_speed_10m": (F.col("l_orderkey") % 26).cast("double"),
        "wind_speed_100m": (F.col("l_orderkey") % 26).cast("double") * 1.5,
        "wind_direction_10m": (F.col("l_orderkey") % 360).cast("double"),
        "wind_direction_100m": (F.col("l_partkey") % 360).cast("double"),
        "wind_gusts_10m": (F.col("l_orderkey") % 26).cast("double") * 2
        + (F.col("l_partkey") % 5).cast("double"),
    }
    return item.select(*[c.alias(n) for n, c in exprs.items()])


CTE: dict[str, tuple[tuple[str, ...], str]] = {}

CTE["weather"] = ((), f"""
  SELECT CAST(l_suppkey % {_CITIES_SQL} AS INTEGER) AS city_id,
    CAST(l_shipdate AS DATE) AS date,
    CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_hours(l_linenumber * 3) AS time,
    l_linenumber * 3 AS hour,
    10.0::DOUBLE + l_quantity * 0.5::DOUBLE AS temperature_2m,
    40.0::DOUBLE + round(l_discount * 100) * 5 AS relative_humidity_2m,
    10.0::DOUBLE + l_quantity * 0.5::DOUBLE
      - (100.0::DOUBLE - (40.0::DOUBLE + round(l_discount * 100) * 5)) / 5 AS dew_point_2m,
    10.0::DOUBLE + l_quantity * 0.5::DOUBLE
      + (40.0::DOUBLE + round(l_discount * 100) * 5) * 0.125::DOUBLE AS apparent_temperature,
    round(l_tax * 100) * 0.125::DOUBLE AS precipitation,
    round(l_tax * 100) * 0.125::DOUBLE AS rain,
    0.0::DOUBLE AS snowfall, 0.0::DOUBLE AS snow_depth,
    CAST(1000 + l_partkey % 30 AS DOUBLE) AS pressure_msl,
    CAST(980 + l_partkey % 30 + l_orderkey % 2 AS DOUBLE) AS surface_pressure,
    CAST(l_partkey % 101 AS DOUBLE) AS cloud_cover,
    CAST(l_partkey % 41 AS DOUBLE) AS cloud_cover_low,
    CAST(l_partkey % 61 AS DOUBLE) AS cloud_cover_mid,
    CAST(l_partkey % 81 AS DOUBLE) AS cloud_cover_high,
    CAST(l_orderkey % 26 AS DOUBLE) AS wind_speed_10m,
    CAST(l_orderkey % 26 AS DOUBLE) * 1.5::DOUBLE AS wind_speed_100m,
    CAST(l_orderkey % 360 AS DOUBLE) AS wind_direction_10m,
    CAST(l_partkey % 360 AS DOUBLE) AS wind_direction_100m,
    CAST(l_orderkey % 26 AS DOUBLE) * 2 + CAST(l_partkey % 5 AS DOUBLE) AS wind_gusts_10m
  FROM lineitem""")


# ---------------------------------------------------------------- places
def dim_city(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as cities of their nation, on a quarter-degree grid."""
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        k.cast("int").alias("city_id"), F.col("s_name").alias("city_name"),
        F.col("s_nationkey").alias("state_id"),
        F.concat(F.lit("District "), (k % 5).cast("string")).alias("district"),
        (F.lit(8.0) + (k % 117) * 0.25).alias("lat"),
        (F.lit(68.0) + (k * 7 % 119) * 0.25).alias("lng"))


def dim_state(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("state_id"), F.col("n_name").alias("state_name"),
        F.col("n_regionkey").alias("region_id"))


def dim_region(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))


CTE["dim_city"] = ((), """
  SELECT CAST(s_suppkey AS INTEGER) AS city_id, s_name AS city_name, s_nationkey AS state_id,
    'District ' || (s_suppkey % 5) AS district,
    8.0::DOUBLE + (s_suppkey % 117) * 0.25::DOUBLE AS lat,
    68.0::DOUBLE + (s_suppkey * 7 % 119) * 0.25::DOUBLE AS lng
  FROM supplier""")
CTE["dim_state"] = ((), """
  SELECT n_nationkey AS state_id, n_name AS state_name, n_regionkey AS region_id FROM nation""")
CTE["dim_region"] = ((), """
  SELECT r_regionkey AS region_id, r_name AS region_name FROM region""")


def locations(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as towns: state = nation, region, district by market segment."""
    c = table(spark, sf, "customer")
    places = dim_state(spark, sf).join(dim_region(spark, sf), "region_id")
    return c.join(places, c["c_nationkey"] == places["state_id"]).select(
        F.col("c_custkey").alias("town_id"), F.col("c_name").alias("city"),
        F.col("state_name").alias("state"), F.col("region_name").alias("region"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment"))
        .alias("district"),
        (F.lit(8.0) + (F.col("c_custkey") * 13 % 117) * 0.25).alias("lat"),
        (F.lit(68.0) + (F.col("c_custkey") * 7 % 119) * 0.25).alias("lng"))


CTE["locations"] = (("dim_state", "dim_region"), """
  SELECT c_custkey AS town_id, c_name AS city, state_name AS state, region_name AS region,
    CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE c_mktsegment END AS district,
    8.0::DOUBLE + (c_custkey * 13 % 117) * 0.25::DOUBLE AS lat,
    68.0::DOUBLE + (c_custkey * 7 % 119) * 0.25::DOUBLE AS lng
  FROM customer JOIN dim_state ON c_nationkey = state_id JOIN dim_region USING (region_id)""")


# ---------------------------------------------------------------- gold tables
def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return build_star_schema(weather(spark, sf), dim_city(spark, sf), dim_state(spark, sf))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return build_daily_weather(enriched(spark, sf))


CTE["enriched"] = (("weather", "dim_city", "dim_state"), f"""
  SELECT w.city_id, w.date, {", ".join("w." + m for m in HOURLY_MEASURES)},
    c.state_id, s.region_id
  FROM weather w LEFT JOIN dim_city c ON w.city_id = c.city_id
  LEFT JOIN dim_state s ON c.state_id = s.state_id""")
CTE["daily"] = (("enriched",), """
  SELECT city_id, state_id, region_id, date,
    avg(temperature_2m) AS avg_temperature_2m, max(temperature_2m) AS max_temperature_2m,
    min(temperature_2m) AS min_temperature_2m, avg(relative_humidity_2m) AS avg_humidity,
    sum(precipitation) AS daily_precipitation, sum(rain) AS daily_rain,
    avg(pressure_msl) AS avg_pressure_msl, avg(cloud_cover) AS avg_cloud_cover,
    avg(wind_speed_10m) AS avg_wind_speed_10m, avg(wind_speed_100m) AS avg_wind_speed_100m,
    max(wind_speed_10m) AS max_wind_speed_10m, max(wind_speed_100m) AS max_wind_speed_100m,
    year(date) AS year, month(date) AS month, day(date) AS day, quarter(date) AS quarter,
    weekofyear(date) AS week, dayofweek(date) + 1 AS day_of_week,
    CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM enriched
  WHERE temperature_2m BETWEEN -50 AND 60 AND relative_humidity_2m BETWEEN 0 AND 100
    AND city_id IS NOT NULL AND date IS NOT NULL
  GROUP BY city_id, state_id, region_id, date""")


def season_shift(spark: SparkSession, sf: str) -> DataFrame:
    return build_season_shift(daily(spark, sf))


CTE["season_days"] = (("daily",), """
  SELECT *, CASE WHEN month IN (6, 7, 8, 9) THEN 'Kharif'
                 WHEN month IN (10, 11, 12, 1, 2) THEN 'Rabi' ELSE 'Zaid' END AS season,
    CASE WHEN month IN (1, 2) THEN year - 1 ELSE year END AS season_year,
    CASE WHEN month IN (6, 7, 8, 9) THEN 'Rice, Maize, Soybean, Cotton'
         WHEN month IN (10, 11, 12, 1, 2) THEN 'Wheat, Mustard, Chickpea, Barley'
         ELSE 'Moong, Watermelon, Cucumber, Groundnut' END AS crop
  FROM daily""")
CTE["onset_days"] = (("season_days",), """
  SELECT *,
    CASE season WHEN 'Kharif' THEN make_date(season_year, 6, 1)
      WHEN 'Rabi' THEN make_date(season_year, 10, 15)
      ELSE make_date(season_year, 3, 1) END AS official_start_date,
    coalesce(
      (season = 'Kharif' AND date BETWEEN make_date(season_year, 5, 15)
        AND make_date(season_year, 6, 15) AND avg_temperature_2m BETWEEN 27 AND 30
        AND daily_rain >= 0.2::DOUBLE AND avg_humidity BETWEEN 72 AND 85)
      OR (season = 'Rabi' AND date BETWEEN make_date(season_year, 10, 1)
        AND make_date(season_year, 10, 31) AND avg_temperature_2m BETWEEN 20 AND 25
        AND daily_rain >= 0.01::DOUBLE AND avg_humidity BETWEEN 55 AND 70)
      OR (season = 'Zaid' AND date BETWEEN make_date(season_year, 2, 20)
        AND make_date(season_year, 3, 20) AND avg_temperature_2m BETWEEN 28 AND 31
        AND daily_rain >= 0.02::DOUBLE AND avg_humidity BETWEEN 45 AND 65), false)
      AS is_onset_candidate
  FROM season_days""")
CTE["stability"] = (("onset_days",), """
  SELECT region_id, state_id, city_id, season,
    round(greatest(0.0, 100.0 - (coalesce(stddev_samp(avg_temperature_2m), 0) * 3.0
      + coalesce(stddev_samp(daily_rain), 0) * 0.5
      + coalesce(stddev_samp(avg_humidity), 0) * 1.0)), 2) AS season_stability_score
  FROM onset_days GROUP BY region_id, state_id, city_id, season""")


def _range_sql(col: str, lo: float, hi: float) -> str:
    return (f"CASE WHEN {col} BETWEEN {lo} AND {hi} THEN 100.0::DOUBLE ELSE greatest("
            f"0.0::DOUBLE, 100.0::DOUBLE - least(abs({col} - {lo}), abs({col} - {hi})) "
            f"* 8.0::DOUBLE) END")


def _rain_sql(col: str, minimum: float) -> str:
    return (f"CASE WHEN {col} >= {minimum}::DOUBLE THEN 100.0::DOUBLE ELSE greatest("
            f"0.0::DOUBLE, 100.0::DOUBLE - ({minimum}::DOUBLE - {col}) * 40.0::DOUBLE) END")


def _suit_sql(t: tuple, h: tuple, rain: float) -> str:
    return (f"round(({_range_sql('avg_temperature', *t)} + {_range_sql('avg_humidity', *h)} "
            f"+ {_rain_sql('avg_rainfall', rain)}) / 3.0::DOUBLE, 2)")


CTE["season_summary"] = (("onset_days",), """
  SELECT region_id, state_id, city_id, season, crop, season_year AS year,
    avg(avg_temperature_2m) AS avg_temperature, avg(daily_rain) AS avg_rainfall,
    avg(avg_humidity) AS avg_humidity, min(official_start_date) AS official_start_date,
    min(CASE WHEN is_onset_candidate THEN date END) AS detected_start_date
  FROM onset_days GROUP BY region_id, state_id, city_id, season, crop, season_year""")
CTE["season_shift"] = (("season_summary", "stability"), f"""
  SELECT m.region_id, m.state_id, m.city_id, m.season, crop, year, avg_temperature,
    avg_rainfall, avg_humidity, official_start_date, detected_start_date,
    month(detected_start_date) AS detected_month,
    date_diff('day', official_start_date, detected_start_date) AS season_shift_days,
    CASE WHEN detected_start_date IS NULL THEN 'Not Detected'
      WHEN date_diff('day', official_start_date, detected_start_date) > 14 THEN 'Late (>2 weeks)'
      WHEN date_diff('day', official_start_date, detected_start_date) > 7 THEN 'Slightly Late'
      WHEN date_diff('day', official_start_date, detected_start_date) < -14
        THEN 'Early (>2 weeks)'
      WHEN date_diff('day', official_start_date, detected_start_date) < -7
        THEN 'Slightly Early'
      ELSE 'On Time' END AS shift_category,
    CASE m.season WHEN 'Kharif' THEN {_suit_sql((27, 30), (72, 85), 0.2)}
      WHEN 'Rabi' THEN {_suit_sql((20, 25), (55, 70), 0.01)}
      ELSE {_suit_sql((28, 31), (45, 65), 0.02)} END AS crop_suitability_score,
    season_stability_score
  FROM season_summary m LEFT JOIN stability t
    ON m.region_id IS NOT DISTINCT FROM t.region_id
    AND m.state_id IS NOT DISTINCT FROM t.state_id
    AND m.city_id = t.city_id AND m.season = t.season""")
CTE["base_clean"] = (("season_shift", "dim_city", "dim_state", "dim_region"), """
  SELECT f.region_id, f.state_id, f.city_id, c.city_name, s.state_name, r.region_name,
    f.season, f.crop, f.year, f.avg_temperature, f.avg_rainfall, f.avg_humidity,
    f.official_start_date, f.detected_start_date, f.detected_month, f.season_shift_days,
    f.shift_category, f.crop_suitability_score, f.season_stability_score
  FROM season_shift f LEFT JOIN dim_city c ON f.city_id = c.city_id
  LEFT JOIN dim_state s ON f.state_id = s.state_id
  LEFT JOIN dim_region r ON f.region_id = r.region_id
  WHERE f.detected_start_date IS NOT NULL AND f.official_start_date IS NOT NULL""")


def renewable(spark: SparkSession, sf: str) -> DataFrame:
    return build_renewable_ranking(daily(spark, sf))


CTE["renewable_days"] = (("daily",), """
  SELECT *, least(100.0, avg_wind_speed_10m / 20.0::DOUBLE * 100) AS wind_10m_score,
    least(100.0, avg_wind_speed_100m / 30.0::DOUBLE * 100) AS wind_100m_score,
    greatest(0.0, least(100.0, (1.0 - pow(avg_cloud_cover / 100.0::DOUBLE, 1.3::DOUBLE))
      * 100.0::DOUBLE * (1.0::DOUBLE + 0.15::DOUBLE
        * cos((month - 6) * (2 * 3.14159::DOUBLE / 12))))) AS solar_score
  FROM daily""")
CTE["renewable_cities"] = (("renewable_days",), """
  SELECT region_id, state_id, city_id, avg(avg_wind_speed_10m) AS avg_wind_speed_10m,
    avg(avg_wind_speed_100m) AS avg_wind_speed_100m, avg(avg_cloud_cover) AS avg_cloud_cover,
    avg(wind_10m_score) AS avg_wind_10m_score, avg(wind_100m_score) AS avg_wind_100m_score,
    avg(solar_score) AS avg_solar_score,
    avg(round(wind_10m_score * 0.6::DOUBLE + solar_score * 0.4::DOUBLE, 2))
      AS renewable_index,
    avg(100.0::DOUBLE - avg_cloud_cover) AS avg_solar_proxy,
    max(max_wind_speed_10m) AS peak_wind_speed_10m,
    max(max_wind_speed_100m) AS peak_wind_speed_100m
  FROM renewable_days GROUP BY region_id, state_id, city_id""")
CTE["renewable"] = (("renewable_cities",), """
  SELECT *, dense_rank() OVER (ORDER BY renewable_index DESC) AS renewable_rank,
    CASE WHEN renewable_index >= 70 THEN 'Excellent' WHEN renewable_index >= 50 THEN 'Good'
      WHEN renewable_index >= 30 THEN 'Moderate' ELSE 'Low' END AS renewable_category,
    CASE WHEN avg_wind_speed_10m >= 10 THEN 'High — Small turbine viable'
      WHEN avg_wind_speed_10m >= 5 THEN 'Medium — Turbine with battery storage'
      ELSE 'Low — Solar only recommended' END AS greenhouse_wind_suitability,
    CASE WHEN avg_wind_10m_score > avg_solar_score + 10 THEN 'Wind Primary'
      WHEN avg_solar_score > avg_wind_10m_score + 10 THEN 'Solar Primary'
      ELSE 'Hybrid' END AS recommended_energy_type
  FROM renewable_cities""")

# the mean index from whole hundredths: equal cities have equal values whatever the order of rows
CTE["exact_cities"] = (("renewable_days",), CTE["renewable_cities"][1].replace(
    """avg(round(wind_10m_score * 0.6::DOUBLE + solar_score * 0.4::DOUBLE, 2))
      AS renewable_index""",
    """sum(round(round(wind_10m_score * 0.6::DOUBLE + solar_score * 0.4::DOUBLE, 2) * 100)::BIGINT)
      ::DOUBLE / count(*) / 100 AS renewable_index"""))
CTE["exact_renewable"] = (("exact_cities",), CTE["renewable"][1].replace(
    "renewable_cities", "exact_cities"))


# ---------------------------------------------------------------- notebook-style tables
def hourly(spark: SparkSession, sf: str, gaps: bool = False) -> DataFrame:
    """Weather keyed by city name; with ``gaps`` some readings are NULL."""
    w = weather(spark, sf).join(dim_city(spark, sf).select(
        "city_id", F.col("city_name").alias("city"), F.col("lat").alias("latitude"),
        F.col("lng").alias("longitude"), "state_id"), "city_id")
    if gaps:
        w = w.withColumns({
            "temperature_2m": F.when(F.col("wind_direction_10m") % 7 != 0,
                                     F.col("temperature_2m")),
            "cloud_cover": F.when(F.col("wind_direction_10m") % 11 != 0, F.col("cloud_cover"))})
    return w


CTE["hourly"] = (("weather", "dim_city"), """
  SELECT w.*, c.city_name AS city, c.lat AS latitude, c.lng AS longitude, c.state_id
  FROM weather w JOIN dim_city c ON w.city_id = c.city_id""")
CTE["hourly_gaps"] = (("hourly",), """
  SELECT * REPLACE (
    CASE WHEN wind_direction_10m % 7 <> 0 THEN temperature_2m END AS temperature_2m,
    CASE WHEN wind_direction_10m % 11 <> 0 THEN cloud_cover END AS cloud_cover)
  FROM hourly""")


def days(spark: SparkSession, sf: str, gaps: bool = False) -> DataFrame:
    """Daily features per city, with its coordinates."""
    return daily_features(hourly(spark, sf, gaps), ["city", "latitude", "longitude"])


_DAY_COLUMNS = """
    avg(temperature_2m) AS temp_mean, max(temperature_2m) AS temp_max,
    min(temperature_2m) AS temp_min, avg(relative_humidity_2m) AS humidity_mean,
    avg(dew_point_2m) AS dew_mean, coalesce(sum(precipitation), 0) AS precip_total,
    max(precipitation) AS precip_max, avg(cloud_cover) AS cloud_mean,
    avg(cloud_cover_low) AS cloud_low_mean, avg(cloud_cover_mid) AS cloud_mid_mean,
    avg(cloud_cover_high) AS cloud_high_mean, avg(wind_speed_10m) AS wind_mean_10m,
    max(wind_speed_10m) AS wind_max_10m, avg(wind_speed_100m) AS wind_mean_100m,
    max(wind_speed_100m) AS wind_max_100m, stddev_samp(wind_speed_100m) AS wind_std_100m,
    max(wind_gusts_10m) AS wind_gusts_max, avg(pressure_msl) AS pressure_mean,
    avg(surface_pressure) AS surface_pressure_mean,
    CASE WHEN coalesce(sum(precipitation), 0) > 0 THEN 1 ELSE 0 END AS rain_occurred,
    year(date) AS year, month(date) AS month"""
CTE["days"] = (("hourly",), f"""
  SELECT city, latitude, longitude, date, {_DAY_COLUMNS}
  FROM hourly GROUP BY city, latitude, longitude, date""")
CTE["days_gaps"] = (("hourly_gaps",), f"""
  SELECT city, latitude, longitude, date, {_DAY_COLUMNS}
  FROM hourly_gaps GROUP BY city, latitude, longitude, date""")


def city_values(spark: SparkSession, sf: str) -> DataFrame:
    """One row per city with simple means, for tests over city profiles."""
    return days(spark, sf).groupBy("city", "latitude", "longitude").agg(
        F.avg("temp_mean").alias("mean_temp"), F.avg("precip_total").alias("mean_precip"),
        F.avg("humidity_mean").alias("mean_humidity"), F.avg("cloud_mean").alias("mean_cloud"),
        F.avg("wind_mean_100m").alias("mean_wind_100m"), F.count("date").alias("row_count"))


CTE["city_values"] = (("days",), """
  SELECT city, latitude, longitude, avg(temp_mean) AS mean_temp,
    avg(precip_total) AS mean_precip, avg(humidity_mean) AS mean_humidity,
    avg(cloud_mean) AS mean_cloud, avg(wind_mean_100m) AS mean_wind_100m,
    count(date) AS row_count
  FROM days GROUP BY city, latitude, longitude""")


# ---------------------------------------------------------------- crops
def crops(spark: SparkSession, sf: str) -> DataFrame:
    """Crop yields in the match form: part names as crops, brands as states."""
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        F.concat(F.lit(" "), F.col("p_name")).alias("Crop"), F.col("p_brand").alias("state"),
        (F.lit(12.0) + size * 0.5).alias("Temperature_C"),
        (F.lit(40.0) + (F.col("p_partkey") % 61)).alias("Humidity_%"),
        (F.col("p_partkey") % 997 * 1.0).alias("Rainfall_mm"),
        (F.col("p_partkey") % 13 * 1.0).alias("Wind_Speed_m_s"),
        (F.col("p_partkey") % 25 * 1.0).alias("Solar_Radiation_MJ_m2_day"),
        (F.lit(5.0) + F.col("p_partkey") % 4).alias("pH"),
        (F.floor("p_retailprice") * 3.0).alias("Yield_kg_per_ha"))


CTE["crops"] = ((), """
  SELECT ' ' || p_name AS "Crop", p_brand AS state,
    12.0::DOUBLE + p_size * 0.5::DOUBLE AS "Temperature_C",
    40.0::DOUBLE + p_partkey % 61 AS "Humidity_%",
    CAST(p_partkey % 997 AS DOUBLE) AS "Rainfall_mm",
    CAST(p_partkey % 13 AS DOUBLE) AS "Wind_Speed_m_s",
    CAST(p_partkey % 25 AS DOUBLE) AS "Solar_Radiation_MJ_m2_day",
    5.0::DOUBLE + p_partkey % 4 AS "pH", floor(p_retailprice) * 3.0::DOUBLE AS "Yield_kg_per_ha"
  FROM part""")


def crop_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Crop rows in the cleaned form (lower-case names)."""
    c = crops(spark, sf)
    return c.select(
        F.trim("Crop").alias("crop"), "state", F.col("Temperature_C").alias("temperature_c"),
        F.col("`Humidity_%`").alias("humidity_%"), F.col("Rainfall_mm").alias("rainfall_mm"),
        F.col("pH").alias("ph"), F.col("Yield_kg_per_ha").alias("yield_kg_per_ha"),
        (F.col("Wind_Speed_m_s") * 2).alias("total_n_kg"),
        F.col("Wind_Speed_m_s").alias("total_p_kg"), F.col("pH").alias("total_k_kg"))


CTE["crop_silver"] = (("crops",), """
  SELECT trim("Crop") AS crop, state, "Temperature_C" AS temperature_c,
    "Humidity_%" AS "humidity_%", "Rainfall_mm" AS rainfall_mm, "pH" AS ph, "Yield_kg_per_ha" AS yield_kg_per_ha,
    "Wind_Speed_m_s" * 2 AS total_n_kg, "Wind_Speed_m_s" AS total_p_kg, "pH" AS total_k_kg
  FROM crops""")


def sql(body: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """Body preceded by the common table expressions it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in CTE[name][0]:
            visit(dep)
        ordered.append(name)

    for name in needs:
        visit(name)
    parts = [f"{n} AS ({CTE[n][1]}\n)" for n in ordered]
    parts += [f"{n} AS ({b}\n)" for n, b in (extra or {}).items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body
