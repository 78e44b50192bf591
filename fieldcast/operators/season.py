"""Season onset, shift and suitability."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.config import SEASON_RULES, SeasonRule
from fieldcast.functions import calendar as cal
from fieldcast.functions import scores as S

PLACE_SEASON = ("region_id", "state_id", "city_id", "season")
_SPREAD = {"t": "avg_temperature_2m", "r": "daily_rain", "h": "avg_humidity"}


def with_season(daily: DataFrame, season_by_window: bool = False) -> DataFrame:
    """Season, season year, crops, official start and the onset flag per day.

    With ``season_by_window`` a day inside another season's search window also counts as
    a candidate there: it gets a second row in that season, without measures, so that the
    season's averages stay those of its own months.
    """
    named = daily.withColumn("season", cal.season()).withColumn(
        "season_year", cal.season_year())
    if season_by_window:
        other = cal.window_season()
        own = F.struct(F.col("season"), F.col("season_year"),
                       F.coalesce(other == F.col("season"), F.lit(False)).alias("hit"),
                       F.lit(True).alias("own"))
        extra = F.when(other != F.col("season"), F.struct(
            other.alias("season"), F.col("year").alias("season_year"), F.lit(True).alias("hit"),
            F.lit(False).alias("own")))
        rows = named.withColumn("_s", F.explode(F.array_compact(F.array(own, extra))))
        flagged = rows.withColumns({
            "season": F.col("_s.season"), "season_year": F.col("_s.season_year"),
            "is_onset_candidate": F.col("_s.hit"),
            **{c: F.when(F.col("_s.own"), F.col(c)) for c in _SPREAD.values()}}).drop("_s")
    else:
        flagged = named.withColumn("is_onset_candidate", cal.onset_condition())
    return flagged.withColumns({"crop": cal.season_crop(),
                                "official_start_date": cal.official_start()})


def stability_score(temp_sd: Column, rain_sd: Column, humidity_sd: Column) -> Column:
    """100 less weighted deviations, floor 0, two digits; a NULL deviation counts 0."""
    def sd(c):
        return F.coalesce(c, F.lit(0.0))
    loss = sd(temp_sd) * 3.0 + sd(rain_sd) * 0.5 + sd(humidity_sd) * 1.0
    return F.round(F.greatest(F.lit(0.0), F.lit(100.0) - loss), 2)


def season_stability(season_df: DataFrame) -> DataFrame:
    """Stability of each city's season over all its days."""
    return season_df.groupBy(*PLACE_SEASON).agg(
        stability_score(*[F.stddev_samp(c) for c in _SPREAD.values()])
        .alias("season_stability_score"))


def season_summary(season_df: DataFrame) -> DataFrame:
    """Season means per year, first onset day and the all-year stability.

    The days are shuffled once: each season-year keeps count, mean and sum of squared
    deviations, from which the deviation over all years is combined (a window over the
    few years of a city's season).
    """
    sums = {}
    for k, c in _SPREAD.items():
        sums |= {f"_{k}n": F.count(c), f"_{k}mean": F.avg(c),
                 f"_{k}m2": F.var_pop(c) * F.count(c)}
    per_year = season_df.groupBy(*PLACE_SEASON, "season_year").agg(
        F.min(F.when(F.col("is_onset_candidate"), F.col("date"))).alias("detected_start_date"),
        *[c.alias(n) for n, c in sums.items()],
    )
    years = Window.partitionBy(*PLACE_SEASON)
    pooled = per_year.withColumns({f"_{k}total": F.sum(f"_{k}n").over(years) for k in _SPREAD})
    pooled = pooled.withColumns({
        f"_{k}grand": F.sum(F.col(f"_{k}n") * F.col(f"_{k}mean")).over(years)
        / F.col(f"_{k}total") for k in _SPREAD})
    spread = []
    for k in _SPREAD:
        shift = F.col(f"_{k}mean") - F.col(f"_{k}grand")
        squares = F.sum(F.col(f"_{k}m2") + F.col(f"_{k}n") * shift * shift).over(years)
        freedom = F.col(f"_{k}total") - 1
        spread.append(F.when(freedom > 0, F.sqrt(squares / freedom)))
    return pooled.select(
        *PLACE_SEASON, cal.season_crop().alias("crop"), F.col("season_year").alias("year"),
        F.col("_tmean").alias("avg_temperature"), F.col("_rmean").alias("avg_rainfall"),
        F.col("_hmean").alias("avg_humidity"),
        cal.official_start().alias("official_start_date"), "detected_start_date",
        F.month("detected_start_date").alias("detected_month"),
        stability_score(*spread).alias("season_stability_score"))


def crop_suitability(season: str = "season",
                     rules: Mapping[str, SeasonRule] = SEASON_RULES) -> Column:
    """Mean of the temperature, humidity and rain scores of the season's rule."""
    expr = None
    for name, r in rules.items():
        total = (S.range_score("avg_temperature", r.temp_min, r.temp_max)
                 + S.range_score("avg_humidity", r.humidity_min, r.humidity_max)
                 + S.rain_floor_score("avg_rainfall", r.rain_min))
        score = F.round(total / 3.0, 2)
        test = F.col(season) == name
        expr = F.when(test, score) if expr is None else expr.when(test, score)
    return expr


def build_season_shift(daily: DataFrame, season_by_window: bool = False) -> DataFrame:
    """Season shift fact: onset against the official start, scores and labels."""
    summary = season_summary(with_season(daily, season_by_window))
    shifted = summary.withColumn(
        "season_shift_days", F.datediff("detected_start_date", "official_start_date"))
    return shifted.withColumns({
        "shift_category": S.shift_category(),
        "crop_suitability_score": crop_suitability(),
    }).select(
        "region_id", "state_id", "city_id", "season", "crop", "year", "avg_temperature",
        "avg_rainfall", "avg_humidity", "official_start_date", "detected_start_date",
        "detected_month", "season_shift_days", "shift_category", "crop_suitability_score",
        "season_stability_score")


def onset_rolling(daily: DataFrame, keys: Sequence[str], in_window: Column, rows: int,
                  rain_floor: float, humidity_floor: float | None = None,
                  rain: str = "precip_total", humidity: str = "humidity_mean") -> DataFrame:
    """First day whose last ``rows`` observed days reach the rain (and humidity) floor.

    Rolling frames count rows, not days, inside one key's search window of a year (at
    most a few months of days), and only full frames count.  Keys without an onset
    keep a NULL date.
    """
    frame = Window.partitionBy(*keys).orderBy("date").rowsBetween(1 - rows, 0)
    full = (F.count(rain).over(frame) == rows) & (F.sum(rain).over(frame) >= rain_floor)
    if humidity_floor is not None:
        full = full & (F.count(humidity).over(frame) == rows) & (
            F.avg(humidity).over(frame) >= humidity_floor)
    return (daily.filter(in_window).withColumn("_hit", full).groupBy(*keys)
            .agg(F.min(F.when(F.col("_hit"), F.col("date"))).alias("onset_date"))
            .withColumn("onset_doy", F.dayofyear("onset_date")))


def onset_3d(daily: DataFrame, city: str = "city", floor: float = 30.0) -> DataFrame:
    """Onset by three-row rain sum within May to August."""
    return onset_rolling(daily, [city, "year"], F.col("month").between(5, 8), 3, floor)


def onset_7d(daily: DataFrame, city: str = "city", rain_floor: float = 25.0,
             humidity_floor: float = 60.0) -> DataFrame:
    """Onset by seven-row rain sum and mean humidity within 15 May to 31 July."""
    window = F.col("date").between(F.make_date(F.col("year"), F.lit(5), F.lit(15)),
                                   F.make_date(F.col("year"), F.lit(7), F.lit(31)))
    return onset_rolling(daily, [city, "year"], window, 7, rain_floor, humidity_floor)


def onset_stats(onset: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean and deviation of the onset day over the detected onsets."""
    return onset.filter("onset_doy IS NOT NULL").groupBy(*keys).agg(
        F.avg("onset_doy").alias("mean_doy"), F.stddev_samp("onset_doy").alias("std_doy"),
        F.count("onset_doy").alias("n"))
