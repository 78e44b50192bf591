"""Star schema, daily and monthly tables, season shift, renewables, views."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import fixtures as X
from catalog.registry import present, query, rd
from fieldcast import config as C
from fieldcast.functions import calendar as cal
from fieldcast.functions import scores as S
from fieldcast.operators import clean, dims, renewable, rollup, season
from fieldcast.plans.views import create_views, read_view

_IDS = "CAST(city_id AS BIGINT) AS city_id, CAST(state_id AS BIGINT) AS state_id, " \
       "CAST(region_id AS BIGINT) AS region_id"


def _rounded(cols, digits=6):
    return ", ".join(f"{rd(c, digits)} AS {c}" for c in cols)


def _ints(cols):
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in cols)


_MEASURE_SUMS = ", ".join(f"sum({m}) AS {m}" for m in C.HOURLY_MEASURES)


@query("jn_01_star_schema", X.sql(f"""
SELECT {_ints(["state_id", "region_id"])}, count(*) AS rows, {_MEASURE_SUMS}
FROM enriched GROUP BY state_id, region_id""", "enriched"))
def jn_01(spark, sf):
    return present(X.enriched(spark, sf).groupBy("state_id", "region_id").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(m) for m in C.HOURLY_MEASURES]))


@query("flt_03_plausible_filter", X.sql("""
SELECT city_id::BIGINT AS city_id, count(*) AS rows, sum(temperature_2m) AS temperature_sum
FROM (SELECT * REPLACE (CASE WHEN wind_direction_10m % 7 = 0 THEN NULL
        WHEN wind_direction_10m % 7 = 1 THEN 61 WHEN wind_direction_10m % 7 = 2 THEN 60
        WHEN wind_direction_10m % 7 = 3 THEN -51 ELSE temperature_2m END AS temperature_2m,
        CASE WHEN cloud_cover % 10 = 0 THEN 101 ELSE relative_humidity_2m END
          AS relative_humidity_2m) FROM weather)
WHERE temperature_2m BETWEEN -50 AND 60 AND relative_humidity_2m BETWEEN 0 AND 100
GROUP BY city_id""", "weather"))
def flt_03(spark, sf):
    turn = F.col("wind_direction_10m") % 7
    dirty = X.weather(spark, sf).withColumns({
        "temperature_2m": F.when(turn == 0, None).when(turn == 1, 61.0).when(turn == 2, 60.0)
        .when(turn == 3, -51.0).otherwise(F.col("temperature_2m")),
        "relative_humidity_2m": F.when(F.col("cloud_cover") % 10 == 0, 101.0).otherwise(
            F.col("relative_humidity_2m"))})
    return present(clean.filter_plausible(dirty).groupBy("city_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("temperature_2m").alias("temperature_sum")))


_DAILY = ("avg_temperature_2m", "max_temperature_2m", "min_temperature_2m", "avg_humidity",
          "daily_precipitation", "daily_rain", "avg_pressure_msl", "avg_cloud_cover",
          "avg_wind_speed_10m", "avg_wind_speed_100m", "max_wind_speed_10m",
          "max_wind_speed_100m")
_CAL = ("year", "month", "day", "quarter", "week", "day_of_week", "is_weekend")


@query("agg_01_daily_weather", X.sql(f"""
SELECT {_IDS}, CAST(date AS VARCHAR) AS date, {", ".join(_DAILY)}, {_ints(_CAL)}
FROM daily""", "daily"))
def agg_01(spark, sf):
    return present(X.daily(spark, sf))


_MONTHLY_SQL = f"""
SELECT city_id, state_id, region_id, year, month,
  avg(avg_temperature_2m) AS avg_temperature_2m,
  max(max_temperature_2m) AS max_temperature_2m, min(min_temperature_2m) AS min_temperature_2m,
  avg(avg_humidity) AS avg_humidity, sum(daily_precipitation) AS monthly_precipitation,
  sum(daily_rain) AS monthly_rain, avg(avg_pressure_msl) AS avg_pressure_msl,
  avg(avg_cloud_cover) AS avg_cloud_cover, avg(avg_wind_speed_10m) AS avg_wind_speed_10m,
  avg(avg_wind_speed_100m) AS avg_wind_speed_100m,
  max(max_wind_speed_10m) AS max_wind_speed_10m,
  max(max_wind_speed_100m) AS max_wind_speed_100m, count(DISTINCT date) AS days_observed
FROM daily GROUP BY city_id, state_id, region_id, year, month"""
_MONTHLY = ("avg_temperature_2m", "max_temperature_2m", "min_temperature_2m", "avg_humidity",
            "monthly_precipitation", "monthly_rain", "avg_pressure_msl", "avg_cloud_cover",
            "avg_wind_speed_10m", "avg_wind_speed_100m", "max_wind_speed_10m",
            "max_wind_speed_100m")


@query("agg_04_monthly_weather", X.sql(f"""
SELECT {_IDS}, {_ints(["year", "month", "days_observed"])}, {_rounded(_MONTHLY)},
  CAST(year * 100 + month AS BIGINT) AS year_month,
  CAST(ceil(month / 3.0) AS BIGINT) AS quarter
FROM ({_MONTHLY_SQL})""", "daily"))
def agg_04(spark, sf):
    return present(rollup.build_monthly_weather(X.daily(spark, sf)), 6)


@query("agg_05_city_profile", X.sql(f"""
SELECT {_IDS}, {rd("avg(avg_temperature_2m)")} AS avg_temperature,
  {rd("avg(avg_humidity)")} AS avg_humidity, {rd("avg(daily_rain)")} AS avg_rainfall,
  {rd("avg(avg_pressure_msl)")} AS avg_pressure,
  {rd("avg(avg_cloud_cover)")} AS avg_cloud_cover,
  {rd("avg(avg_wind_speed_10m)")} AS avg_wind_speed_10m,
  {rd("avg(avg_wind_speed_100m)")} AS avg_wind_speed_100m,
  max(max_temperature_2m) AS highest_temperature, min(min_temperature_2m) AS lowest_temperature,
  count(DISTINCT date) AS observation_days
FROM daily GROUP BY city_id, state_id, region_id""", "daily"))
def agg_05(spark, sf):
    return present(rollup.build_city_profile(X.daily(spark, sf)), 6)


_SHIFT = f"""
SELECT {_IDS}, season, crop, CAST(year AS BIGINT) AS year,
  {_rounded(["avg_temperature", "avg_rainfall", "avg_humidity"])},
  CAST(official_start_date AS VARCHAR) AS official_start_date,
  CAST(detected_start_date AS VARCHAR) AS detected_start_date,
  {_ints(["detected_month", "season_shift_days"])}, shift_category, crop_suitability_score,
  season_stability_score
FROM """


@query("agg_06_season_shift", X.sql(_SHIFT + "season_shift", "season_shift"))
def agg_06(spark, sf):
    return present(X.season_shift(spark, sf), 6)


@query("agg_07_season_stability", X.sql(
    f"SELECT {_IDS}, season, season_stability_score FROM stability", "stability"))
def agg_07(spark, sf):
    return present(season.season_stability(season.with_season(X.daily(spark, sf))))


@query("agg_06b_onset_by_window", X.sql("""
SELECT year::BIGINT AS year, count(*) AS days FROM daily WHERE
  (date BETWEEN make_date(year, 5, 15) AND make_date(year, 6, 15)
    AND avg_temperature_2m BETWEEN 27 AND 30 AND daily_rain >= 0.2::DOUBLE
    AND avg_humidity BETWEEN 72 AND 85)
  OR (date BETWEEN make_date(year, 10, 1) AND make_date(year, 10, 31)
    AND avg_temperature_2m BETWEEN 20 AND 25 AND daily_rain >= 0.01::DOUBLE
    AND avg_humidity BETWEEN 55 AND 70)
  OR (date BETWEEN make_date(year, 2, 20) AND make_date(year, 3, 20)
    AND avg_temperature_2m BETWEEN 28 AND 31 AND daily_rain >= 0.02::DOUBLE
    AND avg_humidity BETWEEN 45 AND 65)
GROUP BY year""", "daily"))
def agg_06b(spark, sf):
    return present(season.with_season(X.daily(spark, sf), season_by_window=True).filter(
        "is_onset_candidate").groupBy("year").agg(F.count(F.lit(1)).alias("days")))


_RENEW = ("avg_wind_speed_10m", "avg_wind_speed_100m", "avg_cloud_cover",
          "avg_wind_10m_score", "avg_wind_100m_score", "avg_solar_score", "renewable_index",
          "avg_solar_proxy", "peak_wind_speed_10m", "peak_wind_speed_100m")


@query("agg_08_renewable_summary", X.sql(
    f"SELECT {_IDS}, {_rounded(_RENEW, 5)} FROM renewable_cities", "renewable_cities"))
def agg_08(spark, sf):
    return present(renewable.renewable_summary(renewable.renewable_scores(X.daily(spark, sf))), 5)


@query("win_02_renewable_rank", X.sql(f"""
SELECT {_IDS}, {_rounded(_RENEW, 5)}, CAST(renewable_rank AS BIGINT) AS renewable_rank,
  renewable_category, greenhouse_wind_suitability, recommended_energy_type
FROM exact_renewable""", "exact_renewable"))
def win_02(spark, sf):
    return present(X.renewable(spark, sf), 5)


@query("set_01_dim_date", X.sql(f"""
SELECT CAST(date AS VARCHAR) AS date, {_ints(_CAL)}, dayname(date) AS day_name,
  monthname(date) AS month_name, CAST(year * 100 + month AS BIGINT) AS year_month
FROM (SELECT date, year, month, day, quarter, week, day_of_week, is_weekend FROM daily
      UNION
      SELECT o_orderdate::DATE, year(o_orderdate), month(o_orderdate), day(o_orderdate),
        quarter(o_orderdate), weekofyear(o_orderdate), dayofweek(o_orderdate) + 1,
        CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 ELSE 0 END FROM orders)""", "daily"))
def set_01(spark, sf):
    orders = X.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))
    return present(dims.build_dim_date(X.daily(spark, sf), orders))


@query("set_02_dim_month", X.sql("""
SELECT DISTINCT year::BIGINT AS year, month::BIGINT AS month,
  (year * 100 + month)::BIGINT AS year_month, monthname(date) AS month_name,
  quarter::BIGINT AS quarter FROM daily""", "daily"))
def set_02_month(spark, sf):
    return present(dims.build_dim_month(dims.build_dim_date(X.daily(spark, sf))))


@query("set_02_dim_year", X.sql("SELECT DISTINCT year::BIGINT AS year FROM daily", "daily"))
def set_02_year(spark, sf):
    days = dims.build_dim_date(X.daily(spark, sf))
    return present(dims.build_dim_year(dims.build_dim_month(days)))


@query("scl_01_calendar_parts", """
SELECT o_orderkey, year(o_orderdate)::BIGINT AS year, month(o_orderdate)::BIGINT AS month,
  day(o_orderdate)::BIGINT AS day, quarter(o_orderdate)::BIGINT AS quarter,
  weekofyear(o_orderdate)::BIGINT AS week, (dayofweek(o_orderdate) + 1)::BIGINT AS day_of_week,
  (CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 ELSE 0 END)::BIGINT AS is_weekend
FROM orders""")
def scl_01(spark, sf):
    days = X.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return present(cal.with_calendar(days).drop("date"))


@query("scl_02_names", """
SELECT o_orderkey, dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name,
  (year(o_orderdate) * 100 + month(o_orderdate))::BIGINT AS year_month,
  ceil(month(o_orderdate) / 3.0)::BIGINT AS quarter
FROM orders""")
def scl_02(spark, sf):
    days = X.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    named = cal.with_names(days).withColumn("quarter", cal.quarter_of_month(F.month("date")))
    return present(named.drop("date"))


@query("scl_03_time_parts", """
SELECT event_id, hour(ts)::BIGINT AS hour, CAST(ts::DATE AS VARCHAR) AS date,
  dayofyear(ts)::BIGINT AS day_of_year FROM events""")
def scl_03(spark, sf):
    return present(X.table(spark, sf, "events").select(
        "event_id", F.hour("ts").alias("hour"), F.to_date("ts").alias("date"),
        F.dayofyear("ts").alias("day_of_year")))


@query("scl_04_season_calendars", """
SELECT o_orderkey,
  CASE WHEN month(o_orderdate) IN (6,7,8,9) THEN 'Kharif'
    WHEN month(o_orderdate) IN (3,4,5) THEN 'Zaid' ELSE 'Rabi' END AS gold,
  CASE WHEN month(o_orderdate) IN (6,7,8,9,10) THEN 'Kharif'
    WHEN month(o_orderdate) IN (4,5) THEN 'Zaid' ELSE 'Rabi' END AS ml,
  CASE WHEN month(o_orderdate) IN (12,1,2) THEN 'Winter'
    WHEN month(o_orderdate) IN (3,4,5) THEN 'Summer'
    WHEN month(o_orderdate) IN (6,7,8,9) THEN 'Monsoon' ELSE 'Post-Monsoon' END AS met,
  CASE WHEN month(o_orderdate) IN (12,1,2) THEN 'Winter'
    WHEN month(o_orderdate) IN (3,4,5) THEN 'Zaid'
    WHEN month(o_orderdate) IN (6,7,8,9) THEN 'Kharif' ELSE 'Rabi' END AS up
FROM orders""")
def scl_04(spark, sf):
    month = F.month("o_orderdate")
    return X.table(spark, sf, "orders").select(
        "o_orderkey", *[cal.season(month, c).alias(c) for c in C.CALENDARS])


@query("scl_05_season_year_and_crop", X.sql("""
SELECT season, season_year::BIGINT AS season_year, crop, count(*) AS days
FROM season_days GROUP BY ALL""", "season_days"))
def scl_05(spark, sf):
    s = season.with_season(X.daily(spark, sf))
    return present(s.groupBy("season", "season_year", "crop").agg(
        F.count(F.lit(1)).alias("days")))


@query("scl_06_official_start", X.sql("""
SELECT DISTINCT season, season_year::BIGINT AS season_year,
  CAST(official_start_date AS VARCHAR) AS official_start_date FROM onset_days""", "onset_days"))
def scl_06(spark, sf):
    return present(season.with_season(X.daily(spark, sf)).select(
        "season", "season_year", "official_start_date").distinct())


@query("scl_07_window_bounds", """
SELECT o_orderkey,
  CAST(make_date(year(o_orderdate), 5, 15) AS VARCHAR) AS kharif_first,
  CAST(make_date(year(o_orderdate), 6, 15) AS VARCHAR) AS kharif_last,
  CAST(make_date(year(o_orderdate), 10, 1) AS VARCHAR) AS rabi_first,
  CAST(make_date(year(o_orderdate), 10, 31) AS VARCHAR) AS rabi_last,
  CAST(make_date(year(o_orderdate), 2, 20) AS VARCHAR) AS zaid_first,
  CAST(make_date(year(o_orderdate), 3, 20) AS VARCHAR) AS zaid_last
FROM orders""")
def scl_07(spark, sf):
    cols = []
    for name, rule in C.SEASON_RULES.items():
        first, last = cal.date_bounds(rule, F.year("o_orderdate"))
        cols += [first.alias(f"{name.lower()}_first"), last.alias(f"{name.lower()}_last")]
    return present(X.table(spark, sf, "orders").select("o_orderkey", *cols))


@query("scl_08_onset_condition", X.sql("""
SELECT city_id::BIGINT AS city_id, season, season_year::BIGINT AS season_year,
  count(*) FILTER (is_onset_candidate) AS candidates
FROM onset_days GROUP BY city_id, season, season_year""", "onset_days"))
def scl_08(spark, sf):
    return present(season.with_season(X.daily(spark, sf)).groupBy(
        "city_id", "season", "season_year").agg(
        F.count_if("is_onset_candidate").alias("candidates")))


@query("scl_09_shift_labels", """
SELECT o_orderkey, d::BIGINT AS shift_days,
  CASE WHEN d IS NULL THEN 'Not Detected' WHEN d > 14 THEN 'Late (>2 weeks)'
    WHEN d > 7 THEN 'Slightly Late' WHEN d < -14 THEN 'Early (>2 weeks)'
    WHEN d < -7 THEN 'Slightly Early' ELSE 'On Time' END AS shift_category,
  CASE WHEN d < 0 THEN 'Early Arrival' WHEN d > 0 THEN 'Late Arrival' ELSE 'On Time' END
    AS arrival_type
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL
        ELSE date_diff('day', make_date(year(o_orderdate), month(o_orderdate), 16),
                       o_orderdate::DATE) END AS d FROM orders)""")
def scl_09(spark, sf):
    day = F.to_date("o_orderdate")
    middle = F.make_date(F.year(day), F.month(day), F.lit(16))
    shift = F.when(F.col("o_orderkey") % 9 != 0, F.datediff(day, middle))
    return present(X.table(spark, sf, "orders").select("o_orderkey", shift.alias("shift_days"))
                   .withColumns({"shift_category": S.shift_category("shift_days"),
                                 "arrival_type": S.arrival_type("shift_days")}))


@query("scl_10_range_score", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
  {rd("CASE WHEN v BETWEEN 27 AND 30 THEN 100 ELSE greatest(0, 100 - least(abs(v - 27), abs(v - 30)) * 8) END")} AS score
FROM (SELECT *, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE 10 + l_quantity * 0.5 END AS v
      FROM lineitem)""")
def scl_10(spark, sf):
    v = F.when(F.col("l_partkey") % 7 != 0, F.lit(10.0) + F.col("l_quantity") * 0.5)
    return present(X.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", S.range_score(v, 27, 30).alias("score")), 6)


@query("scl_11_rain_floor_score", f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
  {rd("CASE WHEN v >= 0.5 THEN 100 ELSE greatest(0, 100 - (0.5 - v) * 40) END")} AS score
FROM (SELECT *, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE round(l_tax * 100) * 0.125 END AS v
      FROM lineitem)""")
def scl_11(spark, sf):
    v = F.when(F.col("l_partkey") % 7 != 0, F.round(F.col("l_tax") * 100) * 0.125)
    return present(X.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        S.rain_floor_score(v, 0.5).alias("score")), 6)


@query("scl_12_crop_suitability", X.sql("""
SELECT city_id::BIGINT AS city_id, season, year::BIGINT AS year, crop_suitability_score
FROM season_shift""", "season_shift"))
def scl_12(spark, sf):
    summary = season.season_summary(season.with_season(X.daily(spark, sf)))
    return present(summary.select("city_id", "season", "year",
                                  season.crop_suitability().alias("crop_suitability_score")))


@query("scl_13_wind_scores", X.sql(f"""
SELECT city_id::BIGINT AS city_id, CAST(date AS VARCHAR) AS date,
  {rd("wind_10m_score")} AS wind_10m_score, {rd("wind_100m_score")} AS wind_100m_score
FROM renewable_days""", "renewable_days"))
def scl_13(spark, sf):
    return present(X.daily(spark, sf).select(
        "city_id", "date", S.wind_score("avg_wind_speed_10m", 20.0).alias("wind_10m_score"),
        S.wind_score("avg_wind_speed_100m", 30.0).alias("wind_100m_score")), 6)


@query("scl_14_solar_score", X.sql(f"""
SELECT city_id::BIGINT AS city_id, CAST(date AS VARCHAR) AS date,
  {rd("solar_score")} AS solar_score FROM renewable_days""", "renewable_days"))
def scl_14(spark, sf):
    return present(X.daily(spark, sf).select(
        "city_id", "date", S.solar_score("avg_cloud_cover", "month").alias("solar_score")), 6)


@query("scl_15_renewable_labels", X.sql(f"""
SELECT city_id::BIGINT AS city_id, renewable_category, greenhouse_wind_suitability,
  recommended_energy_type, {rd("renewable_index", 5)} AS renewable_index
FROM renewable""", "renewable"))
def scl_15(spark, sf):
    summary = renewable.renewable_summary(renewable.renewable_scores(X.daily(spark, sf)))
    return present(renewable.renewable_labels(summary).select(
        "city_id", "renewable_category", "greenhouse_wind_suitability",
        "recommended_energy_type", "renewable_index"), 5)


# ---------------------------------------------------------------- views
def _view(spark, sf, name, digits=None):
    """Register the tables one view needs, then the view, and read it."""
    for dim in ("dim_city", "dim_state", "dim_region"):
        getattr(X, dim)(spark, sf).createOrReplaceTempView(dim)
    if name == "v_renewable_dashboard":
        X.renewable(spark, sf).createOrReplaceTempView("renewable_ranking")
        create_views(spark, names=[name])
    else:
        X.season_shift(spark, sf).createOrReplaceTempView("season_shift")
        create_views(spark, names=["v_base_clean", name])
    return present(read_view(spark, name), digits)


_NAMED = ("region_id, state_id, city_id, city_name, state_name, region_name, season, crop, year")
_NAMED_OUT = f"{_IDS}, city_name, state_name, region_name, season, crop, " \
             "CAST(year AS BIGINT) AS year"


@query("jn_08_base_clean", X.sql(_SHIFT.replace(
    "season, crop,", "city_name, state_name, region_name, season, crop,") + "base_clean",
    "base_clean"))
def jn_08(spark, sf):
    return _view(spark, sf, "v_base_clean", 6)


@query("agg_52_arrival_summary", X.sql(f"""
SELECT CAST(region_id AS BIGINT) AS region_id, CAST(state_id AS BIGINT) AS state_id,
  CAST(year AS BIGINT) AS year, season, crop, state_name, region_name,
  CASE WHEN season_shift_days < 0 THEN 'Early Arrival'
    WHEN season_shift_days > 0 THEN 'Late Arrival' ELSE 'On Time' END AS arrival_type,
  count(*) AS total_arrivals, {rd("avg(abs(season_shift_days))", 2)} AS avg_shift_days
FROM base_clean GROUP BY ALL""", "base_clean"))
def agg_52(spark, sf):
    return _view(spark, sf, "v_arrival_summary", 2)


@query("win_04_trend", X.sql(f"""
SELECT {_NAMED_OUT}, CAST(season_shift_days AS BIGINT) AS season_shift_days, shift_category,
  crop_suitability_score, season_stability_score,
  {rd('''avg(season_shift_days) OVER (PARTITION BY city_id, season ORDER BY year
    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)''')} AS rolling_3yr_avg_shift
FROM base_clean""", "base_clean"))
def win_04(spark, sf):
    return _view(spark, sf, "v_trend", 6)


def _side_sql(side, alias):
    return X.sql(f"""
SELECT {_NAMED_OUT}, {rd("avg(season_shift_days)", 2)} AS {alias},
  {rd("avg(crop_suitability_score)", 2)} AS avg_crop_score,
  {rd("avg(season_stability_score)", 2)} AS avg_stability_score
FROM base_clean WHERE season_shift_days {side} 0 GROUP BY {_NAMED}""", "base_clean")


@query("agg_53_early_arrival", _side_sql("<", "avg_advance_days"))
def agg_53(spark, sf):
    return _view(spark, sf, "v_early_arrival", 2)


@query("agg_54_late_arrival", _side_sql(">", "avg_delay_days"))
def agg_54(spark, sf):
    return _view(spark, sf, "v_late_arrival", 2)


@query("agg_55_shift_by_season", X.sql(f"""
SELECT season, {rd("avg(season_shift_days)", 2)} AS avg_shift,
  {rd("avg(crop_suitability_score)", 2)} AS crop_score,
  {rd("avg(season_stability_score)", 2)} AS stability_score, count(*) AS observations
FROM base_clean GROUP BY season""", "base_clean"))
def agg_55(spark, sf):
    return _view(spark, sf, "v_shift_by_season", 2)


@query("jn_16_dim_state_view", X.sql("""
SELECT DISTINCT s.state_id::BIGINT AS state_id, s.state_name, s.region_id::BIGINT AS region_id
FROM base_clean b JOIN dim_state s ON b.state_id = s.state_id""", "base_clean"))
def jn_16_state(spark, sf):
    return _view(spark, sf, "v_dim_state")


@query("jn_16_dim_region_view", X.sql("""
SELECT DISTINCT r.region_id::BIGINT AS region_id, r.region_name
FROM base_clean b JOIN dim_region r ON b.region_id = r.region_id""", "base_clean"))
def jn_16_region(spark, sf):
    return _view(spark, sf, "v_dim_region")


@query("jn_16_dim_city_view", X.sql("""
SELECT DISTINCT c.city_id::BIGINT AS city_id, c.city_name, c.state_id::BIGINT AS state_id
FROM base_clean b JOIN dim_city c ON b.city_id = c.city_id""", "base_clean"))
def jn_16_city(spark, sf):
    return _view(spark, sf, "v_dim_city")


@query("set_04_dim_year_view", X.sql(
    "SELECT DISTINCT year::BIGINT AS year FROM base_clean", "base_clean"))
def set_04(spark, sf):
    return _view(spark, sf, "v_dim_year")


@query("jn_09_renewable_dashboard", X.sql(f"""
SELECT k.region_id::BIGINT AS region_id, r.region_name, k.state_id::BIGINT AS state_id,
  s.state_name, k.city_id::BIGINT AS city_id, c.city_name, c.district, c.lat, c.lng,
  {", ".join(f"{rd('k.' + m, 5)} AS {m}" for m in _RENEW)},
  CAST(k.renewable_rank AS BIGINT) AS renewable_rank, k.renewable_category,
  k.greenhouse_wind_suitability, k.recommended_energy_type
FROM renewable k JOIN dim_city c ON k.city_id = c.city_id
JOIN dim_state s ON k.state_id = s.state_id JOIN dim_region r ON k.region_id = r.region_id""",
    "renewable", "dim_city", "dim_state", "dim_region"))
def jn_09(spark, sf):
    return _view(spark, sf, "v_renewable_dashboard", 5)
