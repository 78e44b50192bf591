"""Daily features, coverage, quality, distribution, outliers, seasons over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import fixtures as X
from catalog.registry import present, query, r, rd
from fieldcast.functions import calendar as cal
from fieldcast.functions import scores as S
from fieldcast.operators import ml, profile, quality, renewable, rollup, season

FEATURES = ("temp_mean", "temp_max", "temp_min", "humidity_mean", "dew_mean", "precip_total",
            "precip_max", "cloud_mean", "cloud_low_mean", "cloud_mid_mean", "cloud_high_mean",
            "wind_mean_10m", "wind_max_10m", "wind_mean_100m", "wind_max_100m",
            "wind_gusts_max", "pressure_mean", "surface_pressure_mean")
_HOURLY_GAPPED = ("temperature_2m", "relative_humidity_2m", "precipitation", "cloud_cover",
                  "wind_speed_10m")


def _rounded(cols, digits=6):
    return ", ".join(f"{rd(c, digits)} AS {c}" for c in cols)


def _avgs(**cols):
    return ", ".join(f"{rd(f'avg({c})')} AS {n}" for n, c in cols.items())


# ---------------------------------------------------------------- daily roll-ups
@query("agg_02_daily_wide", X.sql(f"""
SELECT city, CAST(date AS VARCHAR) AS date, {rd("avg(temperature_2m)")} AS temp_mean,
  {rd("avg(apparent_temperature)")} AS apparent_temp_mean,
  {rd("avg(relative_humidity_2m)")} AS humidity_mean, {rd("avg(dew_point_2m)")} AS dew_point_mean,
  {rd("avg(pressure_msl)")} AS pressure_msl_mean,
  {rd("avg(surface_pressure)")} AS surface_pressure_mean,
  {rd("avg(cloud_cover)")} AS cloud_cover_mean,
  {rd("avg(cloud_cover_low)")} AS cloud_cover_low_mean,
  {rd("avg(cloud_cover_mid)")} AS cloud_cover_mid_mean,
  {rd("avg(cloud_cover_high)")} AS cloud_cover_high_mean,
  {rd("avg(wind_speed_10m)")} AS wind_speed_10m_mean,
  {rd("avg(wind_speed_100m)")} AS wind_speed_100m_mean,
  max(temperature_2m) AS temp_max, min(temperature_2m) AS temp_min,
  sum(precipitation) AS precipitation_sum, sum(rain) AS rain_sum, sum(snowfall) AS snowfall_sum,
  max(wind_gusts_10m) AS wind_gusts_10m_max, count(*) AS n_obs,
  sum(precipitation) > 1.0 AS is_rainy_day,
  max(temperature_2m) - min(temperature_2m) AS diurnal_temp_range
FROM hourly GROUP BY city, date""", "hourly"))
def agg_02(spark, sf):
    wide = rollup.daily_wide(X.hourly(spark, sf)).drop("wind_direction_10m_mean")
    return present(wide, 6)


@query("scl_25_circular_mean", X.sql(f"""
SELECT city, n_obs, CASE WHEN strength > 1e-6 THEN {rd(
    "fmod(degrees(atan2(s, c)) + 360, 360)", 4)} END AS wind_direction
FROM (SELECT city, count(*) AS n_obs, avg(sin(radians(wind_direction_10m))) AS s,
        avg(cos(radians(wind_direction_10m))) AS c,
        sqrt(pow(avg(sin(radians(wind_direction_10m))), 2)
          + pow(avg(cos(radians(wind_direction_10m))), 2)) AS strength
      FROM hourly GROUP BY city)""", "hourly"))
def scl_25(spark, sf):
    return present(X.hourly(spark, sf).groupBy("city").agg(
        F.count(F.lit(1)).alias("n_obs"),
        S.circular_mean("wind_direction_10m").alias("wind_direction")), 4)


@query("agg_03_daily_features", X.sql(f"""
SELECT city, CAST(date AS VARCHAR) AS date, {_rounded(FEATURES)},
  {rd("wind_std_100m")} AS wind_std_100m, rain_occurred::BIGINT AS rain_occurred,
  year::BIGINT AS year, month::BIGINT AS month FROM days_gaps""", "days_gaps"))
def agg_03(spark, sf):
    return present(X.days(spark, sf, gaps=True).drop("latitude", "longitude"), 6)


# ---------------------------------------------------------------- overview and completeness
@query("agg_16_overview", X.sql("""
SELECT count(*) AS total_records, CAST(min(date) AS VARCHAR) AS starting_date,
  CAST(max(date) AS VARCHAR) AS ending_date FROM weather""", "weather"))
def agg_16(spark, sf):
    return present(profile.overview(X.weather(spark, sf)))


@query("agg_16_eda_summary", X.sql(f"""
SELECT count(DISTINCT city) AS cities_loaded, count(*) AS daily_rows,
  CAST(min(date) AS VARCHAR) AS start_date, CAST(max(date) AS VARCHAR) AS end_date,
  (count(*) - count(DISTINCT (city, date)))::BIGINT AS duplicate_city_days,
  sum({" + ".join(f"({f} IS NULL)::INT" for f in FEATURES)})::BIGINT AS missing_weather_cells,
  round(sum({" + ".join(f"({f} IS NULL)::INT" for f in FEATURES)})
    / (count(*) * {len(FEATURES)}) * 100, 3) AS overall_missing_pct
FROM days_gaps""", "days_gaps"))
def agg_16b(spark, sf):
    return present(profile.eda_summary(X.days(spark, sf, gaps=True), FEATURES))


_BLANKS = """SELECT city, CASE WHEN wind_direction_10m % 3 = 0 THEN '  ' ELSE 'x' END AS note,
  temperature_2m, cloud_cover FROM hourly_gaps"""


@query("agg_17_missing_profile", X.sql("""
SELECT city, rows, 'note' AS column_name, a AS missing_value_count,
  round(a / rows * 100, 2) AS missing_pct FROM counted
UNION ALL SELECT city, rows, 'temperature_2m', b, round(b / rows * 100, 2) FROM counted
UNION ALL SELECT city, rows, 'cloud_cover', c, round(c / rows * 100, 2) FROM counted""",
    "hourly_gaps", extra={"blanks": _BLANKS, "counted": """
  SELECT city, count(*) AS rows, count(*) FILTER (trim(note) = '') AS a,
    count(*) FILTER (temperature_2m IS NULL) AS b, count(*) FILTER (cloud_cover IS NULL) AS c
  FROM blanks GROUP BY city"""}))
def agg_17(spark, sf):
    h = X.hourly(spark, sf, gaps=True).select(
        "city", F.when(F.col("wind_direction_10m") % 3 == 0, "  ").otherwise("x").alias("note"),
        "temperature_2m", "cloud_cover")
    return profile.missing_profile(h, ["city"])


@query("agg_19_hourly_coverage", X.sql("""
SELECT city, total_records, unique_hourly_records,
  CAST(lo AS VARCHAR) AS first_available_date, CAST(hi AS VARCHAR) AS last_available_date,
  expected AS expected_hourly_records,
  greatest(expected - unique_hourly_records, 0)::BIGINT AS missing_hourly_records,
  round(unique_hourly_records / expected * 100, 2) AS coverage_percentage
FROM (SELECT city, count(*) AS total_records, count(DISTINCT time) AS unique_hourly_records,
        min(time) AS lo, max(time) AS hi,
        (floor((epoch(max(time)) - epoch(min(time))) / 3600) + 1)::BIGINT AS expected
      FROM hourly GROUP BY city)""", "hourly"))
def agg_19(spark, sf):
    return present(profile.hourly_coverage(X.hourly(spark, sf)))


@query("agg_20_quality_report", X.sql(f"""
SELECT *, CASE WHEN coverage_pct < 95 OR avg_missing_pct > 2 THEN 'REVIEW' ELSE 'OK' END
  AS quality_flag
FROM (SELECT city, count(*) AS rows, 6000::BIGINT AS expected_rows,
    round(count(*) / 6000 * 100, 2) AS coverage_pct,
    (count(*) - count(DISTINCT time))::BIGINT AS duplicate_timestamps,
    round(sum({" + ".join(f"({m} IS NULL)::INT" for m in _HOURLY_GAPPED)})
      / (count(*) * {len(_HOURLY_GAPPED)}) * 100, 3) AS avg_missing_pct,
    count(*) FILTER (relative_humidity_2m < 0 OR relative_humidity_2m > 100)
      AS bad_humidity_vals,
    count(*) FILTER (cloud_cover < 0 OR cloud_cover > 100) AS bad_cloud_vals,
    count(*) FILTER (precipitation < 0) AS bad_precip_vals,
    count(*) FILTER (wind_speed_10m < 0) AS bad_wind_vals
  FROM (SELECT * REPLACE (relative_humidity_2m + 20 AS relative_humidity_2m,
          precipitation - 0.125::DOUBLE AS precipitation) FROM hourly_gaps)
  GROUP BY city)""", "hourly_gaps"))
def agg_20(spark, sf):
    h = X.hourly(spark, sf, gaps=True).withColumns({
        "relative_humidity_2m": F.col("relative_humidity_2m") + 20,
        "precipitation": F.col("precipitation") - 0.125})
    return present(profile.quality_report(h, _HOURLY_GAPPED, 6000))


@query("agg_21_daily_coverage", X.sql("""
SELECT city, count(DISTINCT date) AS days_present, count(*) FILTER (n < 3) AS incomplete_days,
  round(count(DISTINCT date) / 2557 * 100, 2) AS coverage_pct
FROM (SELECT city, date, count(*) AS n FROM hourly GROUP BY 1, 2) GROUP BY city""", "hourly"))
def agg_21(spark, sf):
    return present(profile.daily_coverage(rollup.daily_wide(X.hourly(spark, sf)), 2557,
                                          min_hours=3))


@query("agg_22_city_exclusions", X.sql(f"""
SELECT * EXCLUDE (text), CASE WHEN text = '' THEN 'include' ELSE text END AS reason,
  text <> '' AS exclude_city
FROM (SELECT city, CAST(min(date) AS VARCHAR) AS first_date,
    CAST(max(date) AS VARCHAR) AS last_date, count(DISTINCT year) AS years_covered,
    count(DISTINCT date) AS observed_days,
    (date_diff('day', min(date), max(date)) + 1)::BIGINT AS expected_days,
    {rd("sum((temp_mean IS NULL)::INT + (cloud_mean IS NULL)::INT + (humidity_mean IS NULL)::INT) / (count(*) * 3) * 100")} AS missing_pct,
    (count(*) - count(DISTINCT date))::BIGINT AS duplicate_city_days,
    {rd('''sum(coalesce((temp_max < temp_mean)::INT, 0) + coalesce((temp_mean < temp_min)::INT, 0)
      + coalesce((humidity_mean < 0 OR humidity_mean > 100)::INT, 0)
      + coalesce((precip_total < 0)::INT, 0)) / (count(*) * 4) * 100''')}
      AS consistency_violation_pct,
    {rd("count(DISTINCT date) / (date_diff('day', min(date), max(date)) + 1) * 100")}
      AS coverage_pct
  FROM days_gaps GROUP BY city)
CROSS JOIN LATERAL (SELECT concat_ws('; ',
  CASE WHEN coverage_pct < 90 THEN 'coverage below 90%' END,
  CASE WHEN years_covered < 10 THEN 'fewer than 10 years' END,
  CASE WHEN missing_pct > 20 THEN 'missingness above 20%' END,
  CASE WHEN duplicate_city_days > 0 THEN 'duplicate city-days' END,
  CASE WHEN consistency_violation_pct > 1 THEN 'consistency violations above 1%' END) AS text)
""", "days_gaps"))
def agg_22(spark, sf):
    return present(profile.city_exclusions(X.days(spark, sf, gaps=True),
                                           ["temp_mean", "cloud_mean", "humidity_mean"]), 6)


_PROFILE_SQL = {"profiles": f"""
  SELECT city, avg(temp_mean) AS mean_temp, avg(temp_max) AS mean_temp_max,
    avg(temp_min) AS mean_temp_min, count(*) AS row_count,
    date_diff('day', min(date), max(date)) + 1 AS expected_days,
    count(DISTINCT year(date)) AS years_covered, sum(n - hours)::BIGINT AS duplicate_timestamps,
    sum(absent) / (sum(n) * {len(_HOURLY_GAPPED)}) * 100 AS mean_missing_pct,
    avg(humidity_mean) AS mean_humidity, avg(dew_mean) AS mean_dew,
    avg(precip_total) AS mean_precip, avg(precip_total) * 365.25 AS annual_precip,
    avg((precip_total > 0)::INT) * 100 AS rain_days_pct, avg(cloud_mean) AS mean_cloud,
    avg(wind_mean_100m) AS mean_wind_100m, max(wind_max_100m) AS max_wind_100m,
    avg(pressure_mean) AS mean_pressure,
    count(*) / (date_diff('day', min(date), max(date)) + 1) * 100 AS coverage_pct
  FROM (SELECT city, date, count(*) AS n, count(DISTINCT time) AS hours,
      sum({" + ".join(f"({m} IS NULL)::INT" for m in _HOURLY_GAPPED)}) AS absent,
      avg(temperature_2m) AS temp_mean, max(temperature_2m) AS temp_max,
      min(temperature_2m) AS temp_min, avg(relative_humidity_2m) AS humidity_mean,
      avg(dew_point_2m) AS dew_mean, coalesce(sum(precipitation), 0) AS precip_total,
      avg(cloud_cover) AS cloud_mean, avg(wind_speed_100m) AS wind_mean_100m,
      max(wind_speed_100m) AS wind_max_100m, avg(pressure_msl) AS pressure_mean
    FROM hourly_gaps GROUP BY city, date) GROUP BY city"""}
_PROFILE = ("mean_temp", "mean_temp_max", "mean_temp_min", "mean_missing_pct", "mean_humidity",
            "mean_dew", "mean_precip", "annual_precip", "rain_days_pct", "mean_cloud",
            "mean_wind_100m", "max_wind_100m", "mean_pressure", "coverage_pct")
_PROFILE_INTS = ("row_count", "expected_days", "years_covered", "duplicate_timestamps")
_PROFILE_OUT = (_rounded(_PROFILE, 5) + ", "
                + ", ".join(f"{c}::BIGINT AS {c}" for c in _PROFILE_INTS))


@query("agg_24_city_profile_full", X.sql(f"SELECT city, {_PROFILE_OUT} FROM profiles",
                                         "hourly_gaps", extra=_PROFILE_SQL))
def agg_24(spark, sf):
    return present(profile.city_profile_full(X.hourly(spark, sf, gaps=True), _HOURLY_GAPPED), 5)


@query("agg_23_sparse_cities", X.sql("""
SELECT city, CASE WHEN row_count < (SELECT avg(row_count) FROM profiles) * 0.7
    OR coverage_pct < 90 OR years_covered < 10 OR mean_missing_pct > 10
    OR duplicate_timestamps > 0 THEN 'REVIEW' ELSE 'OK' END AS sparse_flag
FROM (SELECT * REPLACE (coverage_pct + 10 AS coverage_pct, years_covered + 5 AS years_covered,
        CASE WHEN city LIKE '%4' THEN 1 ELSE 0 END AS duplicate_timestamps) FROM profiles)""",
    "hourly_gaps", extra=_PROFILE_SQL))
def agg_23(spark, sf):
    p = profile.city_profile_full(X.hourly(spark, sf, gaps=True), _HOURLY_GAPPED).withColumns({
        "coverage_pct": F.col("coverage_pct") + 10, "years_covered": F.col("years_covered") + 5,
        "duplicate_timestamps": F.col("city").endswith("4").cast("int")})
    return profile.sparse_cities(p).select("city", "sparse_flag")


# ---------------------------------------------------------------- distribution
_LONG = {"long": " UNION ALL ".join(
    f"SELECT '{c}' AS feature, city, {c} AS value FROM days WHERE {c} IS NOT NULL"
    for c in ("temp_mean", "precip_total", "wind_mean_100m", "pressure_mean"))}
_LONG_COLS = ["temp_mean", "precip_total", "wind_mean_100m", "pressure_mean"]


@query("agg_25_describe_plus", X.sql(f"""
SELECT feature, count(*) AS n, {rd("avg(value)")} AS mean, {rd("stddev_samp(value)")} AS std,
  {rd("min(value)")} AS min, {rd("max(value)")} AS max,
  {rd("quantile_cont(value, 0.5)")} AS median, {rd("skewness(value)", 5)} AS skewness,
  {rd("kurtosis(value)", 5)} AS kurtosis,
  CASE WHEN abs(skewness(value)) > 2 THEN 'high skew'
    WHEN abs(skewness(value)) > 1 THEN 'moderate skew' ELSE 'approximately symmetric' END
    AS skew_flag
FROM long GROUP BY feature""", "days", extra=_LONG))
def agg_25(spark, sf):
    out = profile.describe_plus(X.days(spark, sf), _LONG_COLS)
    shape = {c: r(c, 5) for c in ("skewness", "kurtosis")}
    return present(out.withColumns(shape), 6, exact=tuple(shape))


@query("agg_26_zero_share", X.sql(f"""
SELECT {rd("avg(CASE WHEN precip_total = 0 THEN 1.0 ELSE 0.0 END) * 100")} AS zero_pct
FROM days""", "days"))
def agg_26(spark, sf):
    return present(profile.zero_share(X.days(spark, sf), "precip_total"), 6)


def _fence_sql(keys):
    by = "".join(f"{k}, " for k in keys)
    return f"""
  SELECT {by}feature, any_value(lo) AS lower_fence, any_value(hi) AS upper_fence,
    count(*) FILTER (value < lo OR value > hi) AS outlier_count, count(*) AS n
  FROM (SELECT {by}feature, value, q[1] - 1.5 * (q[2] - q[1]) AS lo,
          q[2] + 1.5 * (q[2] - q[1]) AS hi
        FROM long JOIN (SELECT {by}feature, quantile_cont(value, [0.25, 0.75]) AS q
                        FROM long GROUP BY {by}feature) USING ({by}feature))
  GROUP BY {by}feature"""


@query("agg_27_iqr_outliers", X.sql(f"""
SELECT feature, {rd("lower_fence")} AS lower_fence, {rd("upper_fence")} AS upper_fence,
  outlier_count, n, {rd("outlier_count / n * 100")} AS outlier_pct,
  CASE WHEN round(outlier_count / n * 100, 2) > 5 THEN 'REVIEW' ELSE 'OK' END AS flag
FROM fences""", "days", extra={**_LONG, "fences": _fence_sql(())}))
def agg_27(spark, sf):
    return present(profile.iqr_outliers(X.days(spark, sf), _LONG_COLS), 6)


@query("agg_28_iqr_outliers_by_city", X.sql(f"""
SELECT city, feature, {rd("lower_fence")} AS lower_fence, {rd("upper_fence")} AS upper_fence,
  outlier_count, n, {rd("outlier_count / n * 100")} AS outlier_pct FROM fences""",
    "days", extra={**_LONG, "fences": _fence_sql(("city",))}))
def agg_28(spark, sf):
    return present(profile.iqr_outliers_by(X.days(spark, sf), ["city"], _LONG_COLS), 6)


@query("agg_28_outlier_summary", X.sql(f"""
SELECT feature, sum(outlier_count)::BIGINT AS total_outliers,
  {rd("avg(outlier_count / n * 100)")} AS mean_city_outlier_pct,
  {rd("max(outlier_count / n * 100)")} AS max_city_outlier_pct
FROM fences GROUP BY feature""", "days", extra={**_LONG, "fences": _fence_sql(("city",))}))
def agg_28b(spark, sf):
    return present(profile.outlier_summary(
        profile.iqr_outliers_by(X.days(spark, sf), ["city"], _LONG_COLS)), 6)


_METRICS = ["mean_temp", "mean_precip", "mean_humidity"]


def _parts(spark, sf):
    """Per-part metrics as a larger stand-in for city profiles."""
    return X.table(spark, sf, "part").select(
        "p_partkey", "p_brand", (F.col("p_size") * F.col("p_size") * 1.0).alias("mean_temp"),
        (F.col("p_partkey") % 17 * 0.5).alias("mean_precip"),
        F.when(F.col("p_partkey") % 50 == 0, 90.0).otherwise(
            F.lit(20.0) + F.col("p_partkey") % 7).alias("mean_humidity"))


_PARTS = {"parts": """
  SELECT p_partkey, p_brand, p_size * p_size * 1.0::DOUBLE AS mean_temp,
    (p_partkey % 17) * 0.5::DOUBLE AS mean_precip,
    CASE WHEN p_partkey % 50 = 0 THEN 90.0::DOUBLE ELSE 20.0::DOUBLE + p_partkey % 7 END
      AS mean_humidity FROM part"""}


@query("agg_29_robust_anomalies", X.sql(f"""
SELECT p_partkey, {", ".join(f"{rd(f'z_{m}')} AS {m}_robust_z" for m in _METRICS)},
  ({" + ".join(f"(abs(z_{m}) > 3.5)::INT" for m in _METRICS)})::BIGINT AS anomaly_count,
  CASE WHEN {" OR ".join(f"abs(z_{m}) > 3.5" for m in _METRICS)} THEN 'REVIEW' ELSE 'OK' END
    AS anomaly_flag
FROM (SELECT p_partkey, {", ".join(
    f"CASE WHEN mad_{m} > 0 THEN 0.6745 * ({m} - med_{m}) / mad_{m} ELSE 0 END AS z_{m}"
    for m in _METRICS)}
  FROM parts, meds, (SELECT {", ".join(
    f"quantile_cont(abs({m} - med_{m}), 0.5) AS mad_{m}" for m in _METRICS)}
    FROM parts, meds))""", extra={**_PARTS, "meds": "SELECT " + ", ".join(
        f"quantile_cont({m}, 0.5) AS med_{m}" for m in _METRICS) + " FROM parts"}))
def agg_29(spark, sf):
    return present(profile.robust_anomalies(_parts(spark, sf), "p_partkey", _METRICS), 6)


@query("agg_30_sigma_anomalies", X.sql(" UNION ALL ".join(f"""
SELECT p_partkey, '{m}' AS feature, {m} AS value, {rd("a")} AS mean, {rd(f"{m} - a")} AS diff
FROM parts, (SELECT avg({m}) AS a, stddev_samp({m}) AS s FROM parts)
WHERE abs({m} - a) > 2 * s""" for m in _METRICS), extra=_PARTS))
def agg_30(spark, sf):
    return present(profile.sigma_anomalies(_parts(spark, sf), "p_partkey", _METRICS), 6)


@query("agg_40_region_summary", X.sql(" UNION ALL ".join(f"""
SELECT p_brand, '{m}' AS feature, count({m}) AS n, {rd(f"avg({m})")} AS mean,
  {rd(f"stddev_samp({m})")} AS std, {rd(f"quantile_cont({m}, 0.5)")} AS median
FROM parts GROUP BY p_brand""" for m in _METRICS), extra=_PARTS))
def agg_40(spark, sf):
    return present(profile.region_summary(_parts(spark, sf), "p_brand", _METRICS), 6)


@query("agg_42_median_split", X.sql(" UNION ALL ".join(f"""
SELECT '{m}' AS feature, {rd(f"avg({m}) FILTER (lng < mid)")} AS low_mean,
  {rd(f"avg({m}) FILTER (lng >= mid)")} AS high_mean,
  {rd(f"avg({m}) FILTER (lng >= mid) - avg({m}) FILTER (lng < mid)")} AS difference
FROM locations, (SELECT quantile_cont(lng, 0.5) AS mid FROM locations)"""
    for m in ("lat", "town_id")), "locations"))
def agg_42(spark, sf):
    split = profile.median_split(X.locations(spark, sf), "lng")
    return present(profile.split_diff(split, ["lat", "town_id"]), 6)


@query("agg_47_feature_quality", X.sql(" UNION ALL ".join(f"""
SELECT '{m}' AS feature, {rd(f"count(*) FILTER ({m} IS NULL) / count(*) * 100")} AS missing_pct,
  count(DISTINCT {m}) AS unique_values, {rd(f"var_samp({m})")} AS variance FROM hourly_gaps"""
    for m in ("temperature_2m", "cloud_cover", "snowfall", "wind_speed_100m")), "hourly_gaps"))
def agg_47(spark, sf):
    return present(profile.feature_quality(X.hourly(spark, sf, gaps=True), [
        "temperature_2m", "cloud_cover", "snowfall", "wind_speed_100m"]), 6)


_CHECKS_SQL = {"broken": """
  SELECT * REPLACE (CASE WHEN month = 2 THEN temp_max - 12 ELSE temp_max END AS temp_max,
    CASE WHEN year = 1999 THEN 0 ELSE rain_occurred END AS rain_occurred,
    humidity_mean + 12 AS humidity_mean) FROM days"""}


@query("scl_28_consistency_checks", X.sql(" UNION ALL ".join(f"""
SELECT '{name}' AS "check", count(*) FILTER ({test.replace("!=", "<>")}) AS violations,
  CASE WHEN count(*) FILTER ({test.replace("!=", "<>")}) = 0 THEN 'OK' ELSE 'REVIEW' END
    AS status FROM broken""" for name, (_, test) in profile.CONSISTENCY_CHECKS.items()),
    "days", extra=_CHECKS_SQL))
def scl_28(spark, sf):
    d = X.days(spark, sf).withColumns({
        "temp_max": F.when(F.col("month") == 2, F.col("temp_max") - 12).otherwise(
            F.col("temp_max")),
        "rain_occurred": F.when(F.col("year") == 1999, 0).otherwise(F.col("rain_occurred")),
        "humidity_mean": F.col("humidity_mean") + 12})
    return present(profile.consistency_checks(d))


# ---------------------------------------------------------------- over the years
@query("agg_31_yearly_trend", X.sql(f"""
SELECT year::BIGINT AS year, {_avgs(observed_days="n", temperature="t",
    annual_precipitation="p", humidity="h", wind_100m="w", cloud_cover="c")}
FROM (SELECT city, year, count(*) AS n, avg(temp_mean) AS t, sum(precip_total) AS p,
        avg(humidity_mean) AS h, avg(wind_mean_100m) AS w, avg(cloud_mean) AS c
      FROM days GROUP BY city, year) GROUP BY year""", "days"))
def agg_31(spark, sf):
    return present(rollup.yearly_trend(X.days(spark, sf)), 6)


@query("agg_32_yearly_simple", X.sql(f"""
SELECT year::BIGINT AS year, {_rounded(["temp_mean", "precip_total", "wind_100m", "humidity",
                                        "cloud"])}, row_count,
  CASE WHEN row_count < avg(row_count) OVER () * 0.7 THEN 'sparse' ELSE 'ok' END AS data_flag
FROM (SELECT year, avg(temp_mean) AS temp_mean, sum(precip_total) AS precip_total,
        avg(wind_mean_100m) AS wind_100m, avg(humidity_mean) AS humidity,
        avg(cloud_mean) AS cloud, count(temp_mean) AS row_count FROM days GROUP BY year)""",
    "days"))
def agg_32(spark, sf):
    return present(rollup.yearly_simple(X.days(spark, sf)), 6)


_CLIMATE_SQL = {"climate": """
  SELECT month, avg(temp_mean) AS temperature, avg(temp_max) AS maximum_temperature,
    avg(temp_min) AS minimum_temperature, avg(precip_total) AS daily_precipitation,
    avg(humidity_mean) AS humidity, avg(wind_mean_100m) AS wind_100m,
    avg(cloud_mean) AS cloud_cover, avg(dew_mean) AS dew_point FROM days GROUP BY month"""}


@query("agg_33_monthly_climatology", X.sql(f"""
SELECT month::BIGINT AS month, {_rounded(["temperature", "maximum_temperature",
    "minimum_temperature", "daily_precipitation", "humidity", "wind_100m", "cloud_cover",
    "dew_point"])} FROM climate""", "days", extra=_CLIMATE_SQL))
def agg_33(spark, sf):
    return present(rollup.monthly_climatology(X.days(spark, sf)), 6)


@query("agg_33_extreme_months", X.sql("""
SELECT (SELECT month FROM climate ORDER BY temperature DESC, month LIMIT 1)::BIGINT
    AS hottest_month,
  (SELECT month FROM climate ORDER BY daily_precipitation DESC, month LIMIT 1)::BIGINT
    AS wettest_month,
  (SELECT month FROM climate ORDER BY wind_100m DESC, month LIMIT 1)::BIGINT
    AS windiest_month""", "days", extra=_CLIMATE_SQL))
def agg_33b(spark, sf):
    return present(rollup.extreme_months(rollup.monthly_climatology(X.days(spark, sf))))


_DIURNAL = {"temp_mean": "temperature_2m", "humidity_mean": "relative_humidity_2m",
            "wind_mean_100m": "wind_speed_100m"}


@query("agg_34_diurnal_profile", X.sql(f"""
SELECT season, hour(time)::BIGINT AS hour, {_avgs(**_DIURNAL)}
FROM (SELECT *, CASE WHEN month(date) IN (6,7,8,9) THEN 'Kharif'
        WHEN month(date) IN (3,4,5) THEN 'Zaid' ELSE 'Rabi' END AS season FROM hourly)
GROUP BY ALL""", "hourly"))
def agg_34(spark, sf):
    return present(rollup.diurnal_profile(X.hourly(spark, sf), ["season"], _DIURNAL), 6)


@query("agg_34_city_month_hour", X.sql(f"""
SELECT city, month(time)::BIGINT AS month, hour(time)::BIGINT AS hour, {_avgs(**_DIURNAL)}
FROM hourly GROUP BY ALL""", "hourly"))
def agg_34b(spark, sf):
    return present(rollup.diurnal_profile(X.hourly(spark, sf), ["city", "month"], _DIURNAL), 6)


@query("agg_34_user_hours", f"""
SELECT user_id, hour(ts)::BIGINT AS hour, {rd("avg(value)")} AS value FROM events
GROUP BY ALL""")
def agg_34c(spark, sf):
    return present(rollup.diurnal_profile(X.table(spark, sf, "events"), ["user_id"],
                                          {"value": "value"}, "ts"), 6)


@query("agg_35_season_table", X.sql(f"""
SELECT crop_season, {_avgs(observations="n", temperature="t", total_precipitation="p",
    humidity="h", wind_100m="w", cloud_cover="c")}
FROM (SELECT city, year, CASE WHEN month IN (6,7,8,9) THEN 'Kharif'
          WHEN month IN (3,4,5) THEN 'Zaid' ELSE 'Rabi' END AS crop_season, count(*) AS n,
        avg(temp_mean) AS t, sum(precip_total) AS p, avg(humidity_mean) AS h,
        avg(wind_mean_100m) AS w, avg(cloud_mean) AS c FROM days GROUP BY ALL)
GROUP BY crop_season""", "days"))
def agg_35(spark, sf):
    return present(rollup.season_table(X.days(spark, sf)), 6)


@query("agg_36_season_means", X.sql("""
SELECT season, round(avg(temp_mean), 2) AS temp_mean, round(avg(precip_total), 2)
  AS precipitation, round(avg(humidity_mean), 2) AS humidity_mean,
  CASE season WHEN 'Winter' THEN 1 WHEN 'Summer' THEN 2 WHEN 'Monsoon' THEN 3 ELSE 4 END::BIGINT
    AS season_order
FROM (SELECT *, CASE WHEN month IN (12,1,2) THEN 'Winter' WHEN month IN (3,4,5) THEN 'Summer'
    WHEN month IN (6,7,8,9) THEN 'Monsoon' ELSE 'Post-Monsoon' END AS season FROM days)
GROUP BY season""", "days"))
def agg_36(spark, sf):
    return present(rollup.season_means(X.days(spark, sf)))


@query("agg_37_validate_season", X.sql(f"""
SELECT season, {_avgs(avg_temp="temp_mean", avg_rain="precip_total",
                      avg_humidity="humidity_mean")},
  {rd("avg(ok::INT) * 100")} AS in_range_pct,
  CASE WHEN avg(ok::INT) * 100 > 60 THEN 'VALID' ELSE 'WEAK SIGNAL' END AS status
FROM (SELECT *, CASE season WHEN 'Kharif' THEN temp_mean BETWEEN 25 AND 40
        WHEN 'Rabi' THEN temp_mean BETWEEN 8 AND 25
        ELSE temp_mean BETWEEN 25 AND 42 END AS ok
      FROM (SELECT *, CASE WHEN month IN (6,7,8,9) THEN 'Kharif'
              WHEN month IN (3,4,5) THEN 'Zaid' ELSE 'Rabi' END AS season FROM days))
GROUP BY season""", "days"))
def agg_37(spark, sf):
    return present(rollup.validate_season(X.days(spark, sf)), 6)


@query("agg_38_window_stats", X.sql(" UNION ALL ".join(f"""
SELECT w AS "window", '{c}' AS variable, {rd(f"avg({c})")} AS mean,
  {rd(f"stddev_samp({c})")} AS std
FROM (SELECT *, CASE WHEN month IN (3,4,5) THEN 'pre-monsoon' ELSE 'monsoon' END AS w
      FROM days WHERE month BETWEEN 3 AND 9) GROUP BY w""" for c in rollup.WINDOW_COLUMNS),
    "days"))
def agg_38(spark, sf):
    return present(rollup.window_stats(X.days(spark, sf)), 6)


_MONSOON = {"years": "SELECT year, sum(precip_total) AS value FROM days "
                     "WHERE month IN (6,7,8,9) GROUP BY year"}


@query("agg_39_yearly_anomaly", X.sql(f"""
SELECT year::BIGINT AS year, {rd("value")} AS value, {rd("value - avg(value) OVER ()")} AS anomaly
FROM (SELECT year, avg(temp_mean) AS value FROM days WHERE month IN (3,4,5) GROUP BY year)""",
    "days"))
def agg_39(spark, sf):
    return present(rollup.yearly_anomaly(X.days(spark, sf), (3, 4, 5)), 6)


@query("agg_39_anomaly_extremes", X.sql(f"""
SELECT (SELECT year FROM years ORDER BY value DESC, year LIMIT 1)::BIGINT AS best_year,
  {rd("max(value)")} AS best_value,
  (SELECT year FROM years ORDER BY value, year LIMIT 1)::BIGINT AS worst_year,
  {rd("min(value)")} AS worst_value, {rd("stddev_samp(value)")} AS spread FROM years""",
    "days", extra=_MONSOON))
def agg_39b(spark, sf):
    return present(rollup.anomaly_extremes(rollup.yearly_anomaly(
        X.days(spark, sf), (6, 7, 8, 9), "precip_total", "sum")), 6)


def _regional(spark, sf):
    side = F.when(F.col("longitude") < 75, "West").otherwise("East")
    return X.days(spark, sf).withColumn("region", side)


@query("agg_41_region_monthly", X.sql(f"""
SELECT CASE WHEN longitude < 75 THEN 'West' ELSE 'East' END AS region, month::BIGINT AS month,
  {_avgs(temp_mean="temp_mean", precip_total="precip_total", humidity_mean="humidity_mean",
         wind_mean_100m="wind_mean_100m")} FROM days GROUP BY ALL""", "days"))
def agg_41(spark, sf):
    return present(rollup.region_monthly(_regional(spark, sf)), 6)


_PEAKS = {
    "monthly": "SELECT city, latitude, month, avg(precip_total) AS m FROM days GROUP BY ALL",
    "peaks": """SELECT city, latitude, month AS peak_month, m AS peak_value FROM (
      SELECT *, row_number() OVER (PARTITION BY city ORDER BY m DESC, month) AS rn
      FROM monthly) WHERE rn = 1"""}


@query("agg_43_peak_month", X.sql(f"""
SELECT city, latitude, peak_month::BIGINT AS peak_month, {rd("peak_value")} AS peak_value
FROM peaks""", "days", extra=_PEAKS))
def agg_43(spark, sf):
    return present(rollup.peak_month(X.days(spark, sf), ["city", "latitude"]), 6)


@query("agg_44_latitude_bands", X.sql(f"""
SELECT latitude_band, {rd("avg(peak_month)")} AS mean_peak_month, count(*) AS cities
FROM (SELECT *, CASE WHEN latitude BETWEEN 8 AND 8.5 THEN '8-8N'
        WHEN latitude > 8.5 AND latitude <= 9 THEN '8-9N'
        WHEN latitude > 9 AND latitude <= 38 THEN '9-38N' END AS latitude_band FROM peaks)
GROUP BY latitude_band""", "days", extra=_PEAKS))
def agg_44(spark, sf):
    peaks = rollup.peak_month(X.days(spark, sf), ["city", "latitude"])
    return present(rollup.latitude_bands(peaks, [8, 8.5, 9, 38]), 6)


_FP = ("temp_mean", "temp_max", "temp_min", "humidity_mean", "precip_total", "cloud_mean",
       "wind_mean_10m")


@query("agg_45_fingerprint", X.sql("SELECT city, " + ", ".join(
    f"{rd(f'avg({c})')} AS {c}_mean, {rd(f'stddev_samp({c})')} AS {c}_std" for c in _FP)
    + " FROM days GROUP BY city", "days"))
def agg_45(spark, sf):
    return present(rollup.fingerprint(X.days(spark, sf)), 6)


_CITY_FEATURES_SQL = "SELECT city, " + ", ".join(
    f"{rd(f'avg({c})')} AS {c}_avg" for c in rollup.CITY_FEATURES) + ", " + ", ".join(
    f"{rd(f'avg(temp_mean) FILTER (month IN {m})')} AS temp_{n}" for n, m in
    (("kharif", (6, 7, 8, 9)), ("rabi", (10, 11, 12, 1, 2)), ("zaid", (3, 4, 5)))
) + " FROM days GROUP BY city"


@query("agg_46_city_features", X.sql(_CITY_FEATURES_SQL, "days"))
def agg_46(spark, sf):
    return present(rollup.city_features(X.days(spark, sf)), 6)


@query("agg_48_city_means", X.sql(f"""
SELECT city, {_avgs(avg_temperature="temperature_2m", avg_rain="rain",
    avg_humidity="relative_humidity_2m", avg_wind="wind_speed_10m")}, count(*) AS records
FROM hourly_gaps GROUP BY city""", "hourly_gaps"))
def agg_48(spark, sf):
    return present(rollup.city_means(X.hourly(spark, sf, gaps=True), "city", {
        "avg_temperature": "temperature_2m", "avg_rain": "rain",
        "avg_humidity": "relative_humidity_2m", "avg_wind": "wind_speed_10m"}), 6)


# ---------------------------------------------------------------- onset by rolling rows
def _onset_sql(where, rows, test):
    return f"""
  SELECT city, year, min(date) FILTER (hit) AS onset_date FROM (
    SELECT city, year, date, {test} AS hit FROM days WHERE {where}
    WINDOW w AS (PARTITION BY city, year ORDER BY date
                 ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW))
  GROUP BY city, year"""


_O3 = {"onset": _onset_sql("month BETWEEN 5 AND 8", 3, "count(*) OVER w = 3 "
                           "AND sum(precip_total) OVER w >= 9")}
_O7 = {"onset": _onset_sql(
    "date BETWEEN make_date(year, 5, 15) AND make_date(year, 7, 31)", 7,
    "count(*) OVER w = 7 AND sum(precip_total) OVER w >= 15 "
    "AND avg(humidity_mean) OVER w >= 60")}
_ONSET_OUT = """
SELECT city, year::BIGINT AS year, CAST(onset_date AS VARCHAR) AS onset_date,
  dayofyear(onset_date)::BIGINT AS onset_doy FROM onset"""


@query("win_05_onset_3d", X.sql(_ONSET_OUT, "days", extra=_O3))
def win_05(spark, sf):
    return present(season.onset_3d(X.days(spark, sf), floor=9.0))


@query("win_05_onset_stats", X.sql(f"""
SELECT city, {rd("avg(dayofyear(onset_date))")} AS mean_doy,
  {rd("stddev_samp(dayofyear(onset_date))")} AS std_doy, count(*) AS n
FROM onset WHERE onset_date IS NOT NULL GROUP BY city""", "days", extra=_O3))
def win_05b(spark, sf):
    return present(season.onset_stats(season.onset_3d(X.days(spark, sf), floor=9.0), ["city"]), 6)


@query("win_06_onset_7d", X.sql(_ONSET_OUT, "days", extra=_O7))
def win_06(spark, sf):
    return present(season.onset_7d(X.days(spark, sf), rain_floor=15.0))


# ---------------------------------------------------------------- small derived columns
@query("scl_17_month_cyclic", """
SELECT o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 4) + 0.0 AS month_sin,
  round(cos(2 * pi() * month(o_orderdate) / 12), 4) + 0.0 AS month_cos FROM orders""")
def scl_17(spark, sf):
    sin, cos = cal.month_cyclic(F.month("o_orderdate"))
    return X.table(spark, sf, "orders").select(
        "o_orderkey", (sin + 0.0).alias("month_sin"), (cos + 0.0).alias("month_cos"))


@query("scl_18_season_flags", X.sql("""
SELECT city, CAST(date AS VARCHAR) AS date, (month IN (6,7,8,9))::BIGINT AS is_monsoon,
  (month IN (3,4,5))::BIGINT AS is_pre_monsoon, rain_occurred::BIGINT AS rain_occurred,
  round(temp_max - temp_min, 3) AS temp_range FROM days""", "days"))
def scl_18(spark, sf):
    return present(ml.engineered_columns(X.days(spark, sf)).select(
        "city", "date", "is_monsoon", "is_pre_monsoon", "rain_occurred", "temp_range"))


@query("scl_19_energy_score", X.sql(f"""
SELECT city, CASE WHEN w > 18 THEN 'High' WHEN w > 13 THEN 'Medium' ELSE 'Low' END AS wind_class,
  {rd("100 - c")} AS solar_score,
  CASE WHEN 100 - c > 80 THEN 'High' WHEN 100 - c > 70 THEN 'Medium' ELSE 'Low' END
    AS solar_class, {rd("round(w / max(w) OVER () * 50 + (100 - c) / 100 * 50, 2)")}
    AS energy_score
FROM (SELECT city, mean_wind_100m AS w, mean_cloud * 0.5 AS c FROM city_values)""",
    "city_values"))
def scl_19(spark, sf):
    p = X.city_values(spark, sf).withColumn("mean_cloud", F.col("mean_cloud") * 0.5)
    return present(renewable.energy_score(p).select(
        "city", "wind_class", "solar_score", "solar_class", "energy_score"), 6)


@query("scl_20_solar_proxy", """
SELECT o_orderkey, (100 - o_orderkey % 101) / 4.0::DOUBLE AS solar_proxy FROM orders""")
def scl_20(spark, sf):
    return X.table(spark, sf, "orders").select(
        "o_orderkey", S.solar_proxy((F.col("o_orderkey") % 101).cast("double"))
        .alias("solar_proxy"))


@query("scl_24_diagnostic_labels", """
SELECT p_partkey,
  CASE WHEN p_size > 28 THEN 'Warm' WHEN p_size >= 18 THEN 'Temperate' ELSE 'Cool' END
    AS thermal,
  CASE WHEN p_partkey > 1200 THEN 'High Moisture' WHEN p_partkey >= 500 THEN 'Optimal'
    ELSE 'Arid/Low' END AS moisture,
  CASE WHEN p_partkey % 100 > 70 THEN 'Humid Environment' ELSE 'Moderate Air Moisture' END
    AS humidity,
  CASE WHEN p_partkey % 10 < 6.2 THEN 'Acidic' WHEN p_partkey % 10 <= 7.4 THEN 'Neutral'
    ELSE 'Alkaline' END AS soil
FROM part""")
def scl_24(spark, sf):
    return X.table(spark, sf, "part").select(
        "p_partkey", S.thermal_class("p_size").alias("thermal"),
        S.moisture_class("p_partkey").alias("moisture"),
        S.humidity_class(F.col("p_partkey") % 100).alias("humidity"),
        S.soil_class(F.col("p_partkey") % 10).alias("soil"))


# ---------------------------------------------------------------- splits and checks
_SPLIT = {"split": """
  SELECT *, CASE WHEN year < v THEN 'train' WHEN year = v THEN 'validation' ELSE 'test' END
    AS data_split
  FROM days, (SELECT DISTINCT year AS v FROM days ORDER BY v DESC LIMIT 1 OFFSET 2)"""}


@query("ml_20_time_split", X.sql("""
SELECT city, CAST(date AS VARCHAR) AS date, data_split FROM split""", "days", extra=_SPLIT))
def ml_20(spark, sf):
    return present(ml.time_split(X.days(spark, sf)).select("city", "date", "data_split"))


@query("agg_51_split_summary", X.sql(f"""
SELECT data_split, count(*) AS rows, count(DISTINCT city) AS cities,
  CAST(min(date) AS VARCHAR) AS start_date, CAST(max(date) AS VARCHAR) AS end_date,
  {rd("count(*) / (SELECT count(*) FROM split) * 100")} AS row_pct
FROM split GROUP BY data_split""", "days", extra=_SPLIT))
def agg_51(spark, sf):
    return present(ml.split_summary(ml.time_split(X.days(spark, sf))), 6)


@query("ml_20_leakage_check", X.sql("""
SELECT CASE WHEN max(date) FILTER (data_split = 'train')
    < min(date) FILTER (data_split = 'validation')
  AND max(date) FILTER (data_split = 'validation') < min(date) FILTER (data_split = 'test')
  THEN 'PASSED' END AS leakage FROM split""", "days", extra=_SPLIT))
def ml_20b(spark, sf):
    return ml.check_leakage(ml.split_summary(ml.time_split(X.days(spark, sf))))


def _final(name, expr, zero):
    good, bad = ("= 0", "REVIEW") if zero else ("> 0", "FAIL")
    return (f"SELECT '{name}' AS \"check\", ({expr})::BIGINT AS result, CASE WHEN ({expr}) {good} "
            f"THEN 'PASS' ELSE '{bad}' END AS status FROM split")


@query("dq_12_final_checks", X.sql(" UNION ALL ".join([
    _final("duplicate city-date rows", "count(*) - count(DISTINCT (city, date))", True),
    _final("missing city values", "count(*) FILTER (city IS NULL)", True),
    _final("missing date values", "count(*) FILTER (date IS NULL)", True),
    *[_final(f"{s} rows", f"count(*) FILTER (data_split = '{s}')", False)
      for s in ("train", "validation", "test")],
    _final("included cities", "count(DISTINCT city)", False)]), "days", extra=_SPLIT))
def dq_12(spark, sf):
    return quality.final_checks(ml.time_split(X.days(spark, sf)))


# ---------------------------------------------------------------- model-ready exports
def _export_base(spark, sf):
    side = F.when(F.col("longitude") < 75, "West").otherwise("East")
    return X.days(spark, sf).withColumn("region", side)


_EXPORT = {"base": """
  SELECT *, round(sin(2 * pi() * month / 12), 4) + 0.0 AS month_sin,
    round(cos(2 * pi() * month / 12), 4) + 0.0 AS month_cos, dayofyear(date) AS day_of_year,
    CASE WHEN month IN (12,1,2) THEN 'Winter' WHEN month IN (3,4,5) THEN 'Zaid'
      WHEN month IN (6,7,8,9) THEN 'Kharif' ELSE 'Rabi' END AS season,
    CASE WHEN longitude < 75 THEN 'West' ELSE 'East' END AS region
  FROM days WHERE wind_std_100m IS NOT NULL"""}


@query("ml_22_export_onset", X.sql(f"""
SELECT city, CAST(date AS VARCHAR) AS date, year::BIGINT AS year, month::BIGINT AS month,
  month_sin, month_cos, day_of_year::BIGINT AS day_of_year, season,
  (month IN (6,7,8,9))::BIGINT AS is_monsoon, (month IN (3,4,5))::BIGINT AS is_pre_monsoon,
  region, latitude, longitude, {_rounded(["temp_mean", "temp_max", "temp_min"])},
  {rd("round(temp_max - temp_min, 3)")} AS temp_range, {_rounded([
    "humidity_mean", "dew_mean", "precip_total"])}, rain_occurred::BIGINT AS rain_occurred,
  {_rounded(["cloud_mean", "cloud_low_mean", "wind_mean_100m", "wind_max_100m",
             "wind_std_100m", "wind_gusts_max", "pressure_mean"])},
  CASE WHEN year <= 1999 THEN 'train' ELSE 'test' END AS data_split
FROM base""", "days", extra=_EXPORT))
def ml_22_onset(spark, sf):
    keep = ("month_sin", "month_cos", "latitude", "longitude")
    out = ml.export_onset(_export_base(spark, sf), 1999).withColumns(
        {c: F.col(c) + 0.0 for c in keep[:2]})
    return present(out, 6, exact=keep)


@query("ml_22_export_cities", X.sql(_CITY_FEATURES_SQL, "days"))
def ml_22_cities(spark, sf):
    return present(ml.export_cities(_export_base(spark, sf)), 6)


@query("ml_22_export_energy", X.sql(f"""
SELECT city, CAST(date AS VARCHAR) AS date, year::BIGINT AS year, month::BIGINT AS month,
  month_sin, month_cos, season, region, latitude, longitude, {_rounded([
    "wind_mean_100m", "wind_max_100m", "wind_std_100m", "wind_gusts_max", "cloud_mean",
    "cloud_low_mean", "temp_mean", "pressure_mean"])},
  {rd("round(100 - cloud_mean, 2)", 2)} AS solar_proxy,
  CASE WHEN wind_mean_100m > 18 THEN 'High' WHEN wind_mean_100m > 13 THEN 'Medium'
    ELSE 'Low' END AS wind_class,
  CASE WHEN 100 - cloud_mean > 80 THEN 'High' WHEN 100 - cloud_mean > 70 THEN 'Medium'
    ELSE 'Low' END AS solar_class
FROM base""", "days", extra=_EXPORT))
def ml_22_energy(spark, sf):
    keep = ("month_sin", "month_cos", "latitude", "longitude", "solar_proxy")
    out = ml.export_energy(_export_base(spark, sf)).withColumns(
        {c: F.col(c) + 0.0 for c in keep[:2]})
    return present(out, 6, exact=keep)
