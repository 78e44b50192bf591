"""Hand-computed values at the edges of scores, seasons and labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldcast.functions import calendar as cal
from fieldcast.functions import keys as K
from fieldcast.functions import scores as S
from fieldcast.operators import season


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("value,expected", [
    (27.0, 100.0), (30.0, 100.0), (26.875, 99.0), (31.0, 92.0), (10.0, 0.0), (None, 0.0)])
def test_range_score(spark, value, expected):
    assert one(spark, S.range_score(F.lit(value).cast("double"), 27, 30)) == expected


@pytest.mark.parametrize("value,expected", [(0.5, 100.0), (0.25, 90.0), (-9.0, 0.0), (None, 0.0)])
def test_rain_floor_score(spark, value, expected):
    assert one(spark, S.rain_floor_score(F.lit(value).cast("double"), 0.5)) == expected


@pytest.mark.parametrize("days,label", [
    (None, "Not Detected"), (15, "Late (>2 weeks)"), (14, "Slightly Late"), (8, "Slightly Late"),
    (7, "On Time"), (0, "On Time"), (-7, "On Time"), (-8, "Slightly Early"),
    (-14, "Slightly Early"), (-15, "Early (>2 weeks)")])
def test_shift_category(spark, days, label):
    assert one(spark, S.shift_category(F.lit(days).cast("int"))) == label


def test_calendars_differ(spark):
    rows = spark.range(1, 13).select(
        "id", *[cal.season("id", c).alias(c) for c in ("gold", "ml", "met", "up")]).collect()
    by = {r["id"]: r for r in rows}
    assert by[10]["gold"] == "Rabi" and by[10]["ml"] == "Kharif"
    assert by[3]["ml"] == "Rabi" and by[3]["gold"] == "Zaid"
    assert by[11]["met"] == "Post-Monsoon" and by[12]["up"] == "Winter"


def test_solar_score_bounds(spark):
    top = one(spark, S.solar_score(F.lit(0.0), F.lit(6)))
    assert top == 100.0  # 115 before clipping
    assert one(spark, S.solar_score(F.lit(100.0), F.lit(1))) == 0.0


def test_circular_mean_wraps(spark):
    df = spark.createDataFrame([(350.0,), (10.0,), (None,)], "d double")
    x = df.agg(S.circular_mean("d").alias("x")).first()["x"]
    assert min(x, 360 - x) < 1e-9


def test_keys(spark):
    assert one(spark, K.norm_key(F.lit("  New Delhi "))) == "new delhi"
    assert one(spark, K.norm_key(F.lit("St. Mary-1"), strict=True)) == "stmary1"
    assert one(spark, K.base_name(F.lit("Agra_2"))) == "Agra"
    assert one(spark, K.base_name(F.lit("Agra_2b"))) == "Agra_2b"
    assert one(spark, K.soil_ph(F.lit("Rajasthan"))) == 8.1
    assert one(spark, K.soil_ph(F.lit(None).cast("string"))) == 6.8
    assert one(spark, K.region_of_state(F.lit("Goa"))) == "West"
    assert one(spark, K.region_of_state(F.lit("Atlantis"))) == "Other"
    assert one(spark, K.assign_region(F.lit("Goa"), F.lit(30.0), F.lit(90.0))) == "West"
    assert one(spark, K.assign_region(F.lit(None).cast("string"), F.lit(30.0), F.lit(90.0))
               ) == "Northeast"


DAY = "city_id int, state_id int, region_id int, date date, avg_temperature_2m double, " \
      "daily_rain double, avg_humidity double"


def days(spark, rows):
    df = spark.createDataFrame([(1, 1, 1, dt.date(*d), t, r, h) for d, t, r, h in rows], DAY)
    return cal.with_calendar(df)


def test_onset_edges(spark):
    good = (28.0, 0.2, 80.0)
    rows = [((2020, 5, 14), *good), ((2020, 5, 15), *good), ((2020, 6, 1), *good),
            ((2020, 6, 15), *good), ((2020, 6, 16), *good), ((2020, 6, 2), None, 0.2, 80.0)]
    out = season.with_season(days(spark, rows)).select("date", "is_onset_candidate").collect()
    hits = {r["date"].isoformat(): r["is_onset_candidate"] for r in out}
    # 15 May is inside the window but carries the season of its month
    assert hits == {"2020-05-14": False, "2020-05-15": False, "2020-06-01": True,
                    "2020-06-15": True, "2020-06-16": False, "2020-06-02": False}


def test_season_by_window_finds_early_onset(spark):
    rows = [((2020, 5, 20), 28.0, 0.2, 80.0), ((2020, 7, 1), 25.0, 0.0, 50.0)]
    out = {r["season"]: r for r in season.build_season_shift(
        days(spark, rows), season_by_window=True).collect()}
    assert out["Kharif"]["season_shift_days"] == -12
    assert out["Kharif"]["avg_temperature"] == 25.0  # the May day stays out of the averages
    assert out["Zaid"]["season_shift_days"] is None
    assert out["Zaid"]["avg_temperature"] == 28.0
    plain = {r["season"]: r for r in season.build_season_shift(days(spark, rows)).collect()}
    assert plain["Kharif"]["season_shift_days"] is None


def test_january_belongs_to_previous_season(spark):
    rows = [((2021, 1, 5), 22.0, 0.1, 60.0), ((2020, 10, 5), 22.0, 0.1, 60.0),
            ((2020, 10, 31), 22.0, 0.1, 60.0)]
    shift = season.build_season_shift(days(spark, rows)).collect()
    assert len(shift) == 1
    r = shift[0]
    assert (r["season"], r["year"], r["season_shift_days"]) == ("Rabi", 2020, -10)
    assert r["shift_category"] == "Slightly Early"


def test_one_day_season_is_fully_stable(spark):
    r = season.build_season_shift(days(spark, [((2020, 4, 1), 29.0, 0.0, 50.0)])).first()
    assert r["season_stability_score"] == 100.0 and r["shift_category"] == "Not Detected"


def test_stability_forms_agree(spark, sf):
    from catalog import fixtures as X

    flagged = season.with_season(X.daily(spark, sf))
    direct = {tuple(r[:4]): r[4] for r in season.season_stability(flagged).collect()}
    pooled = season.season_summary(flagged).select(
        *season.PLACE_SEASON, "season_stability_score").distinct().collect()
    assert pooled and all(abs(direct[tuple(r[:4])] - r[4]) <= 0.01 for r in pooled)


def test_shift_bounds(spark, sf):
    from catalog import fixtures as X

    bounds = {"Kharif": (0, 14), "Rabi": (-14, 16), "Zaid": (0, 19)}
    rows = X.season_shift(spark, sf).filter("season_shift_days IS NOT NULL").collect()
    assert rows
    for r in rows:
        lo, hi = bounds[r["season"]]
        assert lo <= r["season_shift_days"] <= hi
        assert 0 <= r["crop_suitability_score"] <= 100
        assert 0 <= r["season_stability_score"] <= 100
