"""Coverage, completeness, descriptive statistics, outliers and anomalies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.functions import calendar as cal
from fieldcast.functions.scores import skew_class
from fieldcast.operators.quantiles import exact_quantiles, quantile_table, to_long
from fieldcast.operators.ranking import null_safe_join


def overview(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.min(date).alias("starting_date"), F.max(date).alias("ending_date"))


def _missing(df: DataFrame, col: str) -> Column:
    test = F.col(f"`{col}`").isNull()
    if isinstance(df.schema[col].dataType, T.StringType):
        test = test | (F.trim(F.col(f"`{col}`")) == "")
    return test


def missing_profile(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Missing values per column (and key); blank strings count as missing."""
    cols = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"),
                                    *[F.count_if(_missing(df, c)).alias(c) for c in cols])
    return counted.unpivot([*keys, "rows"], [F.col(f"`{c}`") for c in cols],
                           "column_name", "missing_value_count").withColumn(
        "missing_pct", F.round(F.col("missing_value_count") / F.col("rows") * 100, 2))


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def hourly_coverage(df: DataFrame, key: str = "city", time: str = "time") -> DataFrame:
    """Observed against expected hours per city.

    Distinct hours are counted by grouping on (city, hour) first, so one city with a
    third of the rows is still spread over many tasks.
    """
    hours = df.groupBy(key, time).agg(F.count(F.lit(1)).alias("_n"))
    stats = hours.groupBy(key).agg(
        F.sum("_n").alias("total_records"), F.count(time).alias("unique_hourly_records"),
        F.min(time).alias("first_available_date"), F.max(time).alias("last_available_date"))
    expected = F.coalesce(
        cal.expected_hours("first_available_date", "last_available_date"), F.lit(0))
    return stats.withColumn("expected_hourly_records", expected).withColumns({
        "missing_hourly_records": F.greatest(
            F.col("expected_hourly_records") - F.col("unique_hourly_records"), F.lit(0)),
        "coverage_percentage": F.when(F.col("expected_hourly_records") > 0, F.round(
            cal.coverage_pct("unique_hourly_records", "expected_hourly_records"), 2)
        ).otherwise(0.0),
    })


def quality_report(hourly: DataFrame, measures: Sequence[str], expected_hours: int | Column,
                   key: str = "city", time: str = "time") -> DataFrame:
    """Coverage, duplicates, missing share and impossible values per city."""
    def out_of(col, lo, hi=None):
        bad = F.col(col) < lo
        return bad if hi is None else bad | (F.col(col) > hi)

    bad = {"bad_humidity_vals": out_of("relative_humidity_2m", 0, 100),
           "bad_cloud_vals": out_of("cloud_cover", 0, 100),
           "bad_precip_vals": out_of("precipitation", 0),
           "bad_wind_vals": out_of("wind_speed_10m", 0)}
    absent = sum((F.when(F.col(m).isNull(), 1).otherwise(0) for m in measures), F.lit(0))
    per_hour = hourly.groupBy(key, time).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(absent).alias("_absent"),
        *[F.count_if(test).alias(name) for name, test in bad.items()])
    per_city = per_hour.groupBy(key).agg(
        F.sum("_n").alias("rows"),
        (F.sum("_n") - F.count(F.lit(1))).alias("duplicate_timestamps"),
        F.sum("_absent").alias("_absent"), *[F.sum(n).alias(n) for n in bad])
    expected = F.lit(expected_hours) if isinstance(expected_hours, int) else expected_hours
    out = per_city.withColumns({
        "expected_rows": expected,
        "_coverage": F.col("rows") / expected * 100,
        "_missing": F.col("_absent") / (F.col("rows") * len(measures)) * 100})
    return out.withColumns({
        "coverage_pct": F.round("_coverage", 2), "avg_missing_pct": F.round("_missing", 3),
    }).withColumn("quality_flag", F.when(
        (F.col("coverage_pct") < 95) | (F.col("avg_missing_pct") > 2), "REVIEW"
    ).otherwise("OK")).drop("_coverage", "_missing", "_absent")


def daily_coverage(daily: DataFrame, expected_days: int | Column, key: str = "city",
                   min_hours: int = 20) -> DataFrame:
    """Days present per city and days with too few hours.  One row per city and day."""
    per_day = daily.groupBy(key, "date").agg(F.count_if(F.col("n_obs") < min_hours).alias("_few"))
    expected = F.lit(expected_days) if isinstance(expected_days, int) else expected_days
    return per_day.groupBy(key).agg(
        F.count("date").alias("days_present"), F.sum("_few").alias("incomplete_days")
    ).withColumn("coverage_pct", F.round(F.col("days_present") / expected * 100, 2))


def _reasons(rules: Mapping[str, Column], good: str) -> Column:
    text = F.concat_ws("; ", *[F.when(test, reason) for reason, test in rules.items()])
    return F.when(text == "", good).otherwise(text)


def city_exclusions(daily: DataFrame, features: Sequence[str], key: str = "city",
                    raw_duplicates: DataFrame | None = None) -> DataFrame:
    """Quality figures per city with the reasons to leave it out."""
    absent = sum((F.when(F.col(f).isNull(), 1).otherwise(0) for f in features), F.lit(0))
    checks = {
        "temp_max": F.col("temp_max") < F.col("temp_mean"),
        "temp_min": F.col("temp_mean") < F.col("temp_min"),
        "humidity_mean": (F.col("humidity_mean") < 0) | (F.col("humidity_mean") > 100),
        "precip_total": F.col("precip_total") < 0,
    }
    checks = {c: t for c, t in checks.items() if c in daily.columns}
    broken = sum((F.when(t, 1).otherwise(0) for t in checks.values()), F.lit(0))
    per_day = daily.groupBy(key, "date").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(absent).alias("_absent"),
        F.sum(broken).alias("_broken"))
    per_city = per_day.groupBy(key).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_distinct(F.year("date")).alias("years_covered"),
        F.count("date").alias("observed_days"), F.sum("_n").alias("_rows"),
        F.sum("_absent").alias("_absent"), F.sum("_broken").alias("_broken"))
    out = per_city.withColumns({
        "expected_days": cal.expected_days("first_date", "last_date"),
        "missing_pct": F.col("_absent") / (F.col("_rows") * len(features)) * 100,
        "duplicate_city_days": F.col("_rows") - F.col("observed_days"),
        "consistency_violation_pct":
            F.col("_broken") / (F.col("_rows") * max(len(checks), 1)) * 100,
    }).withColumn("coverage_pct", cal.coverage_pct("observed_days", "expected_days"))
    if raw_duplicates is not None:
        out = out.join(raw_duplicates, key, "left").fillna(0, ["raw_duplicate_timestamps"])
    rules = {
        "coverage below 90%": F.col("coverage_pct") < 90,
        "fewer than 10 years": F.col("years_covered") < 10,
        "missingness above 20%": F.col("missing_pct") > 20,
        "duplicate city-days": F.col("duplicate_city_days") > 0,
        "consistency violations above 1%": F.col("consistency_violation_pct") > 1,
    }
    return out.withColumn("reason", _reasons(rules, "include")).withColumn(
        "exclude_city", F.col("reason") != "include").drop("_rows", "_absent", "_broken")


def sparse_cities(profile: DataFrame, share: float = 0.70) -> DataFrame:
    """REVIEW when rows, coverage, years, missing values or duplicates are off."""
    mean_rows = profile.agg(F.avg("row_count").alias("x")).scalar()
    flag = ((F.col("row_count") < mean_rows * share) | (F.col("coverage_pct") < 90)
            | (F.col("years_covered") < 10) | (F.col("mean_missing_pct") > 10)
            | (F.col("duplicate_timestamps") > 0))
    return profile.withColumn("sparse_flag", F.when(flag, "REVIEW").otherwise("OK"))


def city_profile_full(hourly: DataFrame, measures: Sequence[str],
                      keys: Sequence[str] = ("city",), time: str = "time") -> DataFrame:
    """Twenty-measure city profile: hours to days to cities, two shuffles in all."""
    keys = list(keys)
    absent = sum((F.when(F.col(m).isNull(), 1).otherwise(0) for m in measures), F.lit(0))
    by_hour = hourly.groupBy(*keys, time).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(absent).alias("_absent"),
        *[f(c).alias(n) for n, (f, c) in {
            "_t": (F.sum, "temperature_2m"), "_tn": (F.count, "temperature_2m"),
            "_tx": (F.max, "temperature_2m"), "_tm": (F.min, "temperature_2m"),
            "_h": (F.sum, "relative_humidity_2m"), "_hn": (F.count, "relative_humidity_2m"),
            "_d": (F.sum, "dew_point_2m"), "_dn": (F.count, "dew_point_2m"),
            "_p": (F.sum, "precipitation"),
            "_c": (F.sum, "cloud_cover"), "_cn": (F.count, "cloud_cover"),
            "_w": (F.sum, "wind_speed_100m"), "_wn": (F.count, "wind_speed_100m"),
            "_wx": (F.max, "wind_speed_100m"),
            "_b": (F.sum, "pressure_msl"), "_bn": (F.count, "pressure_msl")}.items()])

    def ratio(top, bottom):
        return F.try_divide(F.sum(top), F.sum(bottom))

    by_day = by_hour.groupBy(*keys, F.to_date(time).alias("date")).agg(
        F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_hours"),
        F.sum("_absent").alias("_absent"), ratio("_t", "_tn").alias("temp_mean"),
        F.max("_tx").alias("temp_max"), F.min("_tm").alias("temp_min"),
        ratio("_h", "_hn").alias("humidity_mean"), ratio("_d", "_dn").alias("dew_mean"),
        F.coalesce(F.sum("_p"), F.lit(0.0)).alias("precip_total"),
        ratio("_c", "_cn").alias("cloud_mean"), ratio("_w", "_wn").alias("wind_mean_100m"),
        F.max("_wx").alias("wind_max_100m"), ratio("_b", "_bn").alias("pressure_mean"))
    return by_day.groupBy(*keys).agg(
        F.avg("temp_mean").alias("mean_temp"), F.avg("temp_max").alias("mean_temp_max"),
        F.avg("temp_min").alias("mean_temp_min"),
        F.count(F.lit(1)).alias("row_count"),
        cal.expected_days(F.min("date"), F.max("date")).alias("expected_days"),
        F.count_distinct(F.year("date")).alias("years_covered"),
        (F.sum("_n") - F.sum("_hours")).alias("duplicate_timestamps"),
        (F.sum("_absent") / (F.sum("_n") * len(measures)) * 100).alias("mean_missing_pct"),
        F.avg("humidity_mean").alias("mean_humidity"), F.avg("dew_mean").alias("mean_dew"),
        F.avg("precip_total").alias("mean_precip"),
        (F.avg("precip_total") * 365.25).alias("annual_precip"),
        (F.avg((F.col("precip_total") > 0).cast("int")) * 100).alias("rain_days_pct"),
        F.avg("cloud_mean").alias("mean_cloud"),
        F.avg("wind_mean_100m").alias("mean_wind_100m"),
        F.max("wind_max_100m").alias("max_wind_100m"),
        F.avg("pressure_mean").alias("mean_pressure"),
    ).withColumn("coverage_pct", cal.coverage_pct("row_count", "expected_days"))


def describe_plus(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes, exact median, bias-corrected skew and kurtosis."""
    long = to_long(df, cols)
    stats = long.groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.skewness("value").alias("_g1"),
        F.kurtosis("value").alias("_g2"))
    n = F.col("n").cast("double")
    fixed = stats.withColumns({
        "skewness": F.when(n > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2)),
        "kurtosis": F.when(n > 3, ((n + 1) * F.col("_g2") + 6) * (n - 1) / ((n - 2) * (n - 3))),
    }).drop("_g1", "_g2")
    median = quantile_table(df, cols, {"median": 0.5})
    return fixed.join(median, "feature").withColumn("skew_flag", skew_class("skewness"))


def zero_share(df: DataFrame, col: str) -> DataFrame:
    """Percent of rows that are exactly zero."""
    return df.agg((F.avg(F.when(F.col(col) == 0, 1.0).otherwise(0.0)) * 100).alias("zero_pct"))


def _with_fences(quartiles: DataFrame) -> DataFrame:
    spread = F.col("q3") - F.col("q1")
    return quartiles.withColumns({"lower_fence": F.col("q1") - 1.5 * spread,
                                  "upper_fence": F.col("q3") + 1.5 * spread}).drop("q1", "q3")


def iqr_outliers_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Inter-quartile fences and outlier share per key and column."""
    keys = list(keys)
    fences = _with_fences(quantile_table(df, cols, {"q1": 0.25, "q3": 0.75}, keys))
    joined = null_safe_join(to_long(df, cols, keys), fences, [*keys, "feature"], "inner")
    outside = (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))
    return joined.groupBy(*keys, "feature", "lower_fence", "upper_fence").agg(
        F.count_if(outside).alias("outlier_count"), F.count(F.lit(1)).alias("n")
    ).withColumn("outlier_pct", F.col("outlier_count") / F.col("n") * 100)


def iqr_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Whole-table fences per column; REVIEW above 5 %."""
    out = iqr_outliers_by(df, [], cols)
    return out.withColumn("flag", F.when(
        F.round("outlier_pct", 2) > 5, "REVIEW").otherwise("OK"))


def outlier_summary(detail: DataFrame) -> DataFrame:
    """Per-column totals of a per-city outlier table."""
    return detail.groupBy("feature").agg(
        F.sum("outlier_count").alias("total_outliers"),
        F.avg("outlier_pct").alias("mean_city_outlier_pct"),
        F.max("outlier_pct").alias("max_city_outlier_pct"))


def robust_anomalies(profile: DataFrame, key: str, cols: Sequence[str],
                     limit: float = 3.5) -> DataFrame:
    """0.6745 (x - median) / MAD per metric, with count of flags and status."""
    medians = exact_quantiles(profile, cols, [0.5]).select(
        "feature", F.col("value").alias("_med"))
    gaps = to_long(profile, cols, [key]).join(medians, "feature").withColumn(
        "_gap", F.abs(F.col("value") - F.col("_med")))
    # one MAD per feature: quantiles of the gap with the feature as key
    mads = exact_quantiles(gaps.select(F.col("feature").alias("metric"), "_gap"), ["_gap"],
                           [0.5], ["metric"]).select(
        F.col("metric").alias("feature"), F.col("value").alias("_mad"))
    scored = gaps.join(mads, "feature").withColumn("_z", F.when(
        F.col("_mad") > 0, F.lit(0.6745) * (F.col("value") - F.col("_med")) / F.col("_mad")
    ).otherwise(0.0))
    wide = scored.groupBy(key).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("_z"))).alias(f"{c}_robust_z")
          for c in cols],
        F.count_if(F.abs("_z") > limit).alias("anomaly_count"))
    return wide.withColumn("anomaly_flag", F.when(
        F.col("anomaly_count") > 0, "REVIEW").otherwise("OK"))


def sigma_anomalies(profile: DataFrame, key: str, cols: Sequence[str],
                    k: float = 2.0) -> DataFrame:
    """Members further than k deviations from the mean, one row per metric."""
    long = to_long(profile, cols, [key])
    stats = long.groupBy("feature").agg(F.avg("value").alias("mean"),
                                        F.stddev_samp("value").alias("_sd"))
    return long.join(stats, "feature").filter(
        F.abs(F.col("value") - F.col("mean")) > F.lit(k) * F.col("_sd")).select(
        key, "feature", "value", "mean", (F.col("value") - F.col("mean")).alias("diff"))


def region_summary(profile: DataFrame, region: str, metrics: Sequence[str]) -> DataFrame:
    """Count, mean, median and deviation of each metric per region."""
    stats = to_long(profile, metrics, [region]).groupBy(region, "feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"))
    median = quantile_table(profile, metrics, {"median": 0.5}, [region])
    return null_safe_join(stats, median, [region, "feature"])


def median_split(df: DataFrame, col: str = "longitude", low: str = "West",
                 high: str = "East", out: str = "side") -> DataFrame:
    """Label rows under the median of a column ``low``, the others ``high``."""
    middle = exact_quantiles(df, [col], [0.5]).select("value").scalar()
    return df.withColumn(out, F.when(F.col(col) < middle, low).otherwise(high))


def split_diff(df: DataFrame, metrics: Sequence[str], side: str = "side",
               low: str = "West", high: str = "East") -> DataFrame:
    """Mean of each metric on both sides and the difference."""
    return to_long(df, metrics, [side]).groupBy("feature").agg(
        F.avg(F.when(F.col(side) == low, F.col("value"))).alias("low_mean"),
        F.avg(F.when(F.col(side) == high, F.col("value"))).alias("high_mean")
    ).withColumn("difference", F.col("high_mean") - F.col("low_mean"))


def feature_quality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing percent, distinct values and variance per feature.

    Values are counted per (feature, value) first, so the distinct count of all
    features costs one shuffle and no task holds all values.
    """
    total = df.agg(F.count(F.lit(1)).alias("x")).scalar()
    long = to_long(df, cols)
    distinct = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c")).groupBy(
        "feature").agg(F.count(F.lit(1)).alias("unique_values"))
    stats = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"),
                                        F.var_samp("value").alias("variance"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return (names.join(stats, "feature", "left").join(distinct, "feature", "left")
            .select("feature",
                    ((total - F.coalesce("n", F.lit(0))) / total * 100).alias("missing_pct"),
                    F.coalesce("unique_values", F.lit(0)).alias("unique_values"), "variance"))


CONSISTENCY_CHECKS: dict[str, tuple[tuple[str, ...], str]] = {
    "temp_max >= temp_mean": (("temp_max", "temp_mean"), "temp_max < temp_mean"),
    "temp_mean >= temp_min": (("temp_mean", "temp_min"), "temp_mean < temp_min"),
    "precip_total >= precip_max": (("precip_total", "precip_max"), "precip_total < precip_max"),
    "wind_max_100m >= wind_mean_100m": (("wind_max_100m", "wind_mean_100m"),
                                        "wind_max_100m < wind_mean_100m"),
    "rain flag agrees with precipitation": (("rain_occurred", "precip_total"),
                                            "(precip_total > 0) != (rain_occurred = 1)"),
    "humidity is between 0 and 100": (("humidity_mean",),
                                      "humidity_mean < 0 OR humidity_mean > 100"),
    "precipitation is non-negative": (("precip_total",), "precip_total < 0"),
}


def consistency_checks(daily: DataFrame,
                       checks: Mapping[str, tuple[Sequence[str], str]] = CONSISTENCY_CHECKS
                       ) -> DataFrame:
    """Violations per physical rule, for the rules whose columns exist; one scan."""
    usable = {n: test for n, (cols, test) in checks.items() if set(cols) <= set(daily.columns)}
    row = daily.agg(*[F.count_if(F.expr(test)).alias(n) for n, test in usable.items()])
    return row.unpivot([], [F.col(f"`{n}`") for n in usable], "check", "violations").withColumn(
        "status", F.when(F.col("violations") == 0, "OK").otherwise("REVIEW"))


def eda_summary(df: DataFrame, features: Sequence[str], city: str = "city") -> DataFrame:
    """Cities, rows, dates, duplicate city-days and missing cells of a daily table."""
    absent = sum((F.when(F.col(f).isNull(), 1).otherwise(0) for f in features), F.lit(0))
    pairs = df.groupBy(city, "date").agg(F.count(F.lit(1)).alias("_n"),
                                         F.sum(absent).alias("_absent"))
    per_city = pairs.groupBy(city).agg(
        F.sum("_n").alias("_n"), F.sum("_absent").alias("_absent"),
        F.count(F.lit(1)).alias("_days"), F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    return per_city.agg(
        F.count(city).alias("cities_loaded"), F.sum("_n").alias("daily_rows"),
        F.min("_lo").alias("start_date"), F.max("_hi").alias("end_date"),
        (F.sum("_n") - F.sum("_days")).alias("duplicate_city_days"),
        F.sum("_absent").alias("missing_weather_cells"),
        F.round(F.sum("_absent") / (F.sum("_n") * len(features)) * 100, 3)
        .alias("overall_missing_pct"))
