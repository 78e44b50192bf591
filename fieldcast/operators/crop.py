"""Crop profiles, crop-to-place matching and suitability."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldcast import config as C
from fieldcast.functions import scores as S
from fieldcast.operators.blocks import BLOCK_ROWS, attach, blocks
from fieldcast.operators.clean import clean_columns, clean_crop, rename_if_absent
from fieldcast.operators.ranking import relative_to_max
from fieldcast.session import checkpoint


def crop_ml_features(crop: DataFrame) -> DataFrame:
    """Canonical names, yield category and total nutrient need, as columns allow."""
    out = rename_if_absent(clean_columns(crop), {
        "yield": "yield_kg_per_ha", "annual_rainfall": "rainfall_mm"})
    if "yield_kg_per_ha" in out.columns:
        out = out.withColumn("yield_category", S.yield_category("yield_kg_per_ha"))
    picks = [next((c for c in (f"{n}_req_kg_per_ha", f"total_{n}_kg") if c in out.columns), None)
             for n in "npk"]
    if all(picks):
        out = out.withColumn("total_npk_requirement",
                             reduce(lambda a, b: a + b, [F.col(c) for c in picks]))
    return out


def crop_agronomy_profile(crop: DataFrame) -> DataFrame:
    """Ideal conditions and their spread per crop; absent measures get constants."""
    name = next(c for c in ("crop", "crop_name") if c in crop.columns)

    def stat(fn, col, default):
        return fn(F.col(f"`{col}`")) if col in crop.columns else F.lit(default)

    return crop.groupBy(F.col(name).alias("crop_name")).agg(
        stat(F.avg, "temperature_c", None).alias("ideal_temp_c"),
        stat(F.stddev_samp, "temperature_c", None).alias("temp_std"),
        stat(F.avg, "humidity_%", None).alias("ideal_humidity_%"),
        stat(F.stddev_samp, "humidity_%", None).alias("humidity_std"),
        stat(F.avg, "rainfall_mm", 0.0).alias("ideal_rainfall_mm"),
        stat(F.stddev_samp, "rainfall_mm", 0.0).alias("rainfall_std"),
        stat(F.avg, "ph", C.DEFAULT_PH).alias("ideal_ph"),
        stat(F.avg, "yield_kg_per_ha", 0.0).alias("avg_yield_kg_ha"),
        F.count(F.lit(1)).alias("historical_record_count"))


def yield_weight(crop: DataFrame) -> DataFrame:
    """Yield relative to the crop's own best yield."""
    return relative_to_max(crop, "Crop", "Yield_kg_per_ha", "yield_weight")


WEIGHTED = ("Temperature_C", "Humidity_%", "Rainfall_mm", "Wind_Speed_m_s",
            "Solar_Radiation_MJ_m2_day")


def build_crop_profile(crop: DataFrame) -> DataFrame:
    """Yield-weighted requirement profile of each crop.

    The weight is the yield over the crop's best yield; that common divisor cancels in a
    weighted mean, so the yield itself is the weight and no second pass is needed.
    """
    y = F.col("Yield_kg_per_ha")
    return clean_crop(crop).groupBy("Crop").agg(
        *[(F.sum(F.col(f"`{c}`") * y) / F.sum(y)).alias(c) for c in WEIGHTED],
        F.avg("pH").alias("pH"), F.avg(y).alias("avg_yield_kg_per_ha"),
        F.count(F.lit(1)).alias("observations"))


def attach_feature_weights(profile: DataFrame, overrides: DataFrame | None = None,
                           features: Sequence[tuple[str, str, float]] = C.MATCH_FEATURES
                           ) -> DataFrame:
    """One weight column per feature: the crop's override, else the default."""
    if overrides is None:
        return profile.withColumns({f"weight_{c}": F.lit(float(d)) for _, c, d in features})
    wide = overrides.groupBy(F.col("crop").alias("_crop")).agg(*[
        F.max(F.when(F.col("feature") == c, F.col("weight"))).alias(f"weight_{c}")
        for _, c, _ in features])
    joined = profile.join(wide, profile["Crop"] == wide["_crop"], "left").drop("_crop")
    return joined.withColumns({
        f"weight_{c}": F.coalesce(F.col(f"`weight_{c}`"), F.lit(float(d)))
        for _, c, d in features})


def feature_ranges(profile: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: minimum, maximum and span per feature; a constant feature spans 1."""
    row = profile.agg(*[f(F.col(f"`{c}`")).alias(f"{n}_{c}") for c in cols
                        for n, f in (("min", F.min), ("max", F.max))])
    spans = {f"span_{c}": F.when(F.col(f"`max_{c}`") != F.col(f"`min_{c}`"),
                                 F.col(f"`max_{c}`") - F.col(f"`min_{c}`")).otherwise(1.0)
             for c in cols}
    return row.withColumns(spans)


MATCH_KEYS = ("region_name", "state_name", "district", "city_name", "season")


def _match_score(crop: Column, features) -> Column:
    terms = [F.greatest(F.lit(0.0), F.lit(100.0) - F.abs(F.col(w) - crop[c])
                        / crop[f"span_{c}"] * 100.0) * crop[f"weight_{c}"]
             for w, c, _ in features]
    return F.round(reduce(lambda a, b: a + b, terms), 2)


def build_crop_weather_match(profile: DataFrame, crops: DataFrame, top: int = C.TOP_CROPS,
                             keys: Sequence[str] = MATCH_KEYS,
                             features: Sequence[tuple[str, str, float]] = C.MATCH_FEATURES,
                             per_block: int = BLOCK_ROWS) -> DataFrame:
    """Score every place-season against every crop and keep the best ``top`` ranks.

    ``crops`` carries the feature and weight columns.  Ties share a rank, so more than
    ``top`` rows may stay.  Scores are made inside an array; only the winners are
    turned into rows, and nothing is shuffled.
    """
    feature_cols = [c for _, c, _ in features]
    crops = checkpoint(crops)  # one row per crop, read for the spans and for the scores
    spans = feature_ranges(crops, feature_cols)
    span_row = spans.agg(F.first(F.struct(*[F.col(f"`span_{c}`") for c in feature_cols]))
                         .alias("s")).scalar()
    spanned = crops.withColumns({f"span_{c}": span_row[f"span_{c}"] for c in feature_cols})
    ranked = profile
    for i, part in enumerate(blocks(spanned, "Crop", per_block)):
        ranked = attach(ranked, "_crops", part, *[F.col(f"`{c}`") for c in spanned.columns])
        more = F.transform("_crops", lambda c: F.struct(
            _match_score(c, features).alias("match_score"), c.alias("crop")))
        ranked = ranked.withColumn("_scored", F.concat("_best", more) if i else more)
        # descending distinct scores; the position of a score is its dense rank
        levels = F.sort_array(F.array_distinct(F.transform("_scored", lambda s: s["match_score"])),
                              asc=False)
        ranked = ranked.withColumn("_levels", F.slice(levels, 1, top)).withColumn(
            "_best", F.filter("_scored", lambda s: F.array_contains("_levels", s["match_score"]))
        ).drop("_scored", "_crops")
    # outer: a plain explode would test the array for rows first, scoring everything twice
    out = ranked.select("*", F.explode_outer("_best").alias("_m")).filter(
        F.col("_m.match_score").isNotNull()).withColumn(
        "crop_rank", F.array_position("_levels", F.col("_m.match_score")).cast("int")
    ).drop("_best", "_levels")
    crop = {"crop_avg_temperature_c": "Temperature_C", "crop_avg_humidity_pct": "Humidity_%",
            "crop_avg_rainfall_mm": "Rainfall_mm", "crop_avg_wind_speed_ms": "Wind_Speed_m_s"}
    weather = ("avg_temperature_2m", "avg_humidity", "season_rainfall", "avg_wind_speed_10m")
    best = F.col("_m.crop")
    return out.select(
        *keys, "days_observed",
        F.when(F.col("days_observed") >= C.CONFIDENT_DAYS, "High").otherwise("Low")
        .alias("match_confidence"),
        best["Crop"].alias("crop_name"), F.col("_m.match_score").alias("match_score"),
        (F.col("_m.match_score") >= C.VIABLE_SCORE).cast("int").alias("is_viable"), "crop_rank",
        S.yield_category(best["avg_yield_kg_per_ha"]).alias("expected_yield_tier"),
        *[x for w, (name, c) in zip(weather, crop.items())
          for x in (F.col(w), best[c].alias(name))],
        best["pH"].alias("pH"), best["avg_yield_kg_per_ha"].alias("avg_yield_kg_per_ha"))


def top_matches(scored: DataFrame, keys: Sequence[str], score: str = "match_score",
                n: int = C.TOP_CROPS, out: str = "crop_rank") -> DataFrame:
    """Dense rank per key, best first, first n ranks (Spark pre-limits each partition)."""
    return scored.withColumn(out, F.dense_rank().over(
        Window.partitionBy(*keys).orderBy(F.desc(score)))).filter(F.col(out) <= n)


def base_crops(spark: SparkSession) -> DataFrame:
    """The fixed table of base crops."""
    spread = C.CROP_SPREAD
    rows = [(n, t, spread["temp"], h, spread["humidity"], r, spread["rainfall"], p,
             spread["ph"], *C.CROP_NPK, y, list(s)) for n, t, r, h, p, y, s in C.BASE_CROPS]
    return spark.createDataFrame(rows, (
        "crop string, temp_mean double, temp_std double, humidity_mean double, "
        "humidity_std double, rainfall_mean double, rainfall_std double, ph_mean double, "
        "ph_std double, n_req double, p_req double, k_req double, avg_yield double, "
        "seasons array<string>"))


def crop_parameters(base: DataFrame, observed: DataFrame) -> DataFrame:
    """Base crops with their observed yield; unseen crops from observed conditions.

    ``observed`` has the columns of :func:`crop_agronomy_profile`.
    """
    seen = observed.groupBy(F.lower(F.trim("crop_name")).alias("crop")).agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in observed.columns])).alias("o"))
    both = base.join(seen, "crop", "full")
    known = F.col("temp_mean").isNotNull()
    floors, fall, n = C.CROP_SPREAD_FLOOR, C.CROP_FALLBACK, C.CROP_NPK

    def pick(own: str, other: Column) -> Column:
        return F.when(known, F.col(own)).otherwise(other).alias(own)

    def spread(col: str, default: str) -> Column:
        return F.greatest(F.coalesce(F.col(f"o.{col}"), F.lit(C.CROP_SPREAD[default])),
                          F.lit(floors[default]))

    return both.select(
        "crop",
        pick("temp_mean", F.coalesce("o.ideal_temp_c", F.lit(fall["temp"]))),
        pick("temp_std", spread("temp_std", "temp")),
        pick("humidity_mean", F.coalesce(F.col("o")["ideal_humidity_%"],
                                         F.lit(fall["humidity"]))),
        pick("humidity_std", spread("humidity_std", "humidity")),
        pick("rainfall_mean", F.coalesce("o.ideal_rainfall_mm", F.lit(fall["rainfall"]))),
        pick("rainfall_std", spread("rainfall_std", "rainfall")),
        pick("ph_mean", F.coalesce("o.ideal_ph", F.lit(fall["ph"]))),
        pick("ph_std", F.lit(C.CROP_SPREAD["ph"])),
        pick("n_req", F.lit(n[0])), pick("p_req", F.lit(n[1])), pick("k_req", F.lit(n[2])),
        F.coalesce("o.avg_yield_kg_ha", "avg_yield", F.lit(fall["yield"])).alias("avg_yield"),
        pick("seasons", F.array(F.lit("whole year"))))


def predict_suitability(conditions: DataFrame, crops: DataFrame, recency: bool = True,
                        top: int | None = None, per_block: int = BLOCK_ROWS) -> DataFrame:
    """Score of every crop for each row of conditions.

    ``conditions`` has temperature, rainfall, humidity, ph and season (NULL season: no
    season test); other columns pass through.  ``top`` keeps the best scores per row,
    before they become rows.
    """
    w = C.SUITABILITY_WEIGHTS[recency]

    def z2(value: str, crop: Column, name: str) -> Column:
        gap = (F.col(value) - crop[f"{name}_mean"]) / crop[f"{name}_std"]
        return gap * gap

    def in_season(crop: Column) -> Column:
        target = F.trim(F.lower("season"))
        hit = F.exists(crop["seasons"], lambda s: F.contains(target, s) | F.contains(s, target)
                       | (s == "whole year"))
        return F.col("season").isNull() | (F.trim("season") == "") | hit

    def scored(crop: Column) -> Column:
        distance = F.sqrt(
            F.lit(w["temp"]) * z2("temperature", crop, "temp")
            + F.lit(w["rain"]) * z2("rainfall", crop, "rainfall")
            + F.lit(w["humidity"]) * z2("humidity", crop, "humidity")
            + F.lit(w["ph"]) * z2("ph", crop, "ph"))
        raw = F.lit(100.0) / (F.lit(1.0) + F.lit(C.DISTANCE_FACTOR) * distance)
        score = F.when(in_season(crop), raw).otherwise(raw * C.OUT_OF_SEASON_FACTOR)
        return F.struct(
            F.round(score, 2).alias("suitability_score"), F.initcap(crop["crop"]).alias("crop"),
            F.when(in_season(crop), "In Season").otherwise("Out of Season").alias("in_season"),
            F.round(crop["temp_mean"], 1).alias("ideal_temp"),
            F.round(crop["rainfall_mean"], 1).alias("ideal_rain"),
            F.round(crop["humidity_mean"], 1).alias("ideal_humidity"),
            crop["n_req"].alias("n_req"), crop["p_req"].alias("p_req"),
            crop["k_req"].alias("k_req"),
            F.round(crop["avg_yield"], 1).alias("avg_yield_kg_ha"))

    # block after block inside the row: what is best so far is merged with the next block, so
    # equal conditions stay rows of their own and a row holds `top` entries and one block
    arrays = conditions.withColumn("_s", F.lit(None))
    for i, part in enumerate(blocks(crops, "crop", per_block)):
        arrays = attach(arrays, "_block", part, *crops.columns)
        more = F.transform("_block", scored)
        more = F.concat("_s", more) if i else more
        if top:
            more = F.slice(F.sort_array(more, asc=False), 1, top)
        arrays = arrays.withColumn("_s", more).drop("_block")
    # outer: a plain inline would test the array for rows first, scoring everything twice
    return arrays.select(*conditions.columns, F.inline_outer("_s")).filter(
        F.col("crop").isNotNull())


def recency_climate(series: DataFrame, keys: Sequence[str] = ("state", "season"),
                    measures: Sequence[str] = ("temp", "rain", "humidity", "ph"),
                    decay: float | None = C.RECENCY_DECAY) -> DataFrame:
    """Climate per key with weights decay^(latest year - year); None weighs years alike.

    A missing measure has no weight in its own mean.

    The weights only matter relative to each other, so they are taken against a common
    year found per key from one small aggregate of years.
    """
    keys = list(keys)
    per_year = series.groupBy(*keys, "year").agg(
        *[x for m in measures for x in (F.sum(m).alias(f"_s_{m}"), F.count(m).alias(f"_n_{m}"))])
    latest = F.max("year").over(Window.partitionBy(*keys))  # a few dozen years per key
    w = F.lit(1.0) if decay is None else F.pow(F.lit(decay), (latest - F.col("year")))
    weighted = per_year.withColumn("_w", w)
    return weighted.groupBy(*keys).agg(*[
        F.round(F.try_divide(F.sum(F.col(f"_s_{m}") * F.col("_w")),
                             F.sum(F.col(f"_n_{m}") * F.col("_w"))), 1)
        .alias(m) for m in measures])


def calibrated_climate(requests: DataFrame, climate: DataFrame,
                       keys: Sequence[str] = ("state", "season"),
                       measures: Sequence[str] = ("temp", "rain", "humidity", "ph"),
                       default: Sequence[float] = C.DEFAULT_CLIMATE) -> DataFrame:
    """Attach the climate of each request, or the default tuple where none is known."""
    joined = requests.join(climate, list(keys), "left")
    return joined.withColumns({m: F.coalesce(m, F.lit(float(d)))
                               for m, d in zip(measures, default)})
