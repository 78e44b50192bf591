"""Crop profiles, matching, suitability, recency and advisory text."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import fixtures as X
from catalog.registry import present, query, r, rd
from fieldcast import config as C
from fieldcast.operators import crop, rollup, text
from fieldcast.plans import crop_match


@query("scl_16_crop_ml_features", X.sql("""
SELECT *, CASE WHEN yield_kg_per_ha >= 3000 THEN 'High' WHEN yield_kg_per_ha >= 1500
  THEN 'Medium' ELSE 'Low' END AS yield_category,
  total_n_kg + total_p_kg + total_k_kg AS total_npk_requirement FROM crop_silver""",
    "crop_silver"))
def scl_16(spark, sf):
    raw = X.crop_silver(spark, sf).withColumnRenamed("rainfall_mm", "Annual-Rainfall")
    return crop.crop_ml_features(raw.withColumnRenamed("yield_kg_per_ha", "Yield"))


@query("agg_09_crop_agronomy_profile", X.sql(f"""
SELECT crop AS crop_name, {rd("avg(temperature_c)")} AS ideal_temp_c,
  {rd("stddev_samp(temperature_c)")} AS temp_std,
  {rd('avg("humidity_%")')} AS "ideal_humidity_%",
  {rd('stddev_samp("humidity_%")')} AS humidity_std,
  {rd("avg(rainfall_mm)")} AS ideal_rainfall_mm,
  {rd("stddev_samp(rainfall_mm)")} AS rainfall_std, {rd("avg(ph)")} AS ideal_ph,
  {rd("avg(yield_kg_per_ha)")} AS avg_yield_kg_ha, count(*) AS historical_record_count
FROM crop_silver GROUP BY crop""", "crop_silver"))
def agg_09(spark, sf):
    return present(crop.crop_agronomy_profile(X.crop_silver(spark, sf)), 6)


_PROFILE_COLS = ("Temperature_C", "Humidity_%", "Rainfall_mm", "Wind_Speed_m_s",
                 "Solar_Radiation_MJ_m2_day")
_CROP_PROFILE = {
    "weighted": """
      SELECT *, "Yield_kg_per_ha" / max("Yield_kg_per_ha") OVER (PARTITION BY "Crop") AS w
      FROM (SELECT * REPLACE (trim("Crop") AS "Crop") FROM crops)
      WHERE "Crop" <> '' AND "Yield_kg_per_ha" > 0 AND "Temperature_C" BETWEEN -10 AND 55
        AND "Humidity_%" BETWEEN 0 AND 100 AND "Rainfall_mm" >= 0""",
    "crop_profile": "SELECT \"Crop\", " + ", ".join(
        f'sum("{c}" * w) / sum(w) AS "{c}"' for c in _PROFILE_COLS) + """,
      avg("pH") AS "pH", avg("Yield_kg_per_ha") AS avg_yield_kg_per_ha,
      count(*) AS observations FROM weighted GROUP BY "Crop" """}


@query("agg_10_crop_profile", X.sql('SELECT "Crop", ' + ", ".join(
    rd(f'"{c}"') + f' AS "{c}"' for c in (*_PROFILE_COLS, "pH", "avg_yield_kg_per_ha"))
    + ", observations FROM crop_profile", "crops", extra=_CROP_PROFILE))
def agg_10(spark, sf):
    return present(crop.build_crop_profile(X.crops(spark, sf)), 6)


@query("win_07_yield_weight", X.sql(f"""
SELECT "Crop", state, "Rainfall_mm", "Temperature_C",
  {rd('"Yield_kg_per_ha" / max("Yield_kg_per_ha") OVER (PARTITION BY "Crop")')} AS yield_weight
FROM crops""", "crops"))
def win_07(spark, sf):
    return present(crop.yield_weight(X.crops(spark, sf)).select(
        "Crop", "state", "Rainfall_mm", "Temperature_C", "yield_weight"), 6)


_NAMED_DAILY = {
    "named": """SELECT d.*, c.city_name, c.district, s.state_name, r.region_name FROM daily d
      JOIN dim_city c ON d.city_id = c.city_id JOIN dim_state s ON c.state_id = s.state_id
      JOIN dim_region r ON s.region_id = r.region_id""",
    "city_season": """
      SELECT region_name, state_name, district, city_name, season,
        avg(avg_temperature_2m) AS avg_temperature_2m, avg(avg_humidity) AS avg_humidity,
        sum(daily_rain) AS season_rainfall, avg(avg_wind_speed_10m) AS avg_wind_speed_10m,
        avg(round((100 - avg_cloud_cover) / 100 * 25, 2)) AS solar_proxy,
        count(*) AS days_observed
      FROM (SELECT *, CASE WHEN month IN (6,7,8,9) THEN 'Kharif'
              WHEN month IN (3,4,5) THEN 'Zaid' ELSE 'Rabi' END AS season FROM named)
      GROUP BY ALL"""}
_PLACES = ("daily", "dim_city", "dim_state", "dim_region")


def _named(spark, sf):
    return crop_match.named_daily(X.daily(spark, sf), X.dim_city(spark, sf),
                                  X.dim_state(spark, sf), X.dim_region(spark, sf))


_SEASON_MEASURES = ("avg_temperature_2m", "avg_humidity", "season_rainfall",
                    "avg_wind_speed_10m")


@query("agg_11_city_season_profile", X.sql(f"""
SELECT region_name, state_name, district, city_name, season, days_observed, {", ".join(
    f"{rd(c)} AS {c}" for c in _SEASON_MEASURES)}, {rd("solar_proxy", 4)} AS solar_proxy
FROM city_season""", *_PLACES, extra=_NAMED_DAILY))
def agg_11(spark, sf):
    out = rollup.build_city_season_profile(_named(spark, sf), crop.MATCH_KEYS[:4])
    return present(out.withColumn("solar_proxy", r("solar_proxy", 4)), 6,
                   exact=("solar_proxy",))


def _overrides(spark, sf):
    """One override row per part: the heaviest size of each crop weighs its rainfall."""
    part = X.table(spark, sf, "part")
    return part.groupBy(F.col("p_name").alias("crop")).agg(
        (F.max("p_size") / 128).alias("weight")).withColumn("feature", F.lit("Rainfall_mm")
    ).filter(F.length("crop") % 2 == 0)


_WEIGHTS = {"overrides": """SELECT p_name AS crop, max(p_size) / 128 AS weight FROM part
  WHERE length(p_name) % 2 = 0 GROUP BY 1""",
            "weighted_profile": """SELECT p.*, coalesce(o.weight, 0.3) AS rain_weight
  FROM crop_profile p LEFT JOIN overrides o ON p."Crop" = o.crop"""}


@query("jn_07_feature_weights", X.sql(f"""
SELECT "Crop", 0.3::DOUBLE AS "weight_Temperature_C", 0.2::DOUBLE AS "weight_Humidity_%",
  {rd("rain_weight")} AS "weight_Rainfall_mm", 0.1::DOUBLE AS "weight_Wind_Speed_m_s",
  0.1::DOUBLE AS "weight_Solar_Radiation_MJ_m2_day" FROM weighted_profile""",
    "crops", extra={**_CROP_PROFILE, **_WEIGHTS}))
def jn_07(spark, sf):
    out = crop.attach_feature_weights(crop.build_crop_profile(X.crops(spark, sf)),
                                      _overrides(spark, sf))
    return present(out.select("Crop", *[F.col(f"`weight_{c}`") for c in _PROFILE_COLS]), 6)


@query("agg_56_feature_ranges", X.sql("SELECT " + ", ".join(
    rd(f'min("{c}")') + f' AS "min_{c}", ' + rd(f'max("{c}")') + f' AS "max_{c}", '
    + rd(f'CASE WHEN max("{c}") <> min("{c}") THEN max("{c}") - min("{c}") ELSE 1 END')
    + f' AS "span_{c}"' for c in _PROFILE_COLS) + " FROM crop_profile",
    "crops", extra=_CROP_PROFILE))
def agg_56(spark, sf):
    return present(crop.feature_ranges(crop.build_crop_profile(X.crops(spark, sf)),
                                       _PROFILE_COLS), 6)


_TERMS = " + ".join(
    f'greatest(0, 100 - abs(s.{w} - c."{f}") / (SELECT CASE WHEN max("{f}") <> min("{f}") '
    f'THEN max("{f}") - min("{f}") ELSE 1 END FROM crop_profile) * 100) * '
    + ("c.rain_weight" if f == "Rainfall_mm" else f"{d}::DOUBLE")
    for w, f, d in C.MATCH_FEATURES)
_MATCH = {"scored": f"""SELECT s.*, c.*, round({_TERMS}, 2) AS match_score
  FROM city_season s CROSS JOIN weighted_profile c""",
          "ranked": """SELECT *, dense_rank() OVER (PARTITION BY region_name, state_name,
    district, city_name, season ORDER BY match_score DESC) AS crop_rank FROM scored"""}


@query("jn_06_crop_weather_match", X.sql(f"""
SELECT region_name, state_name, district, city_name, season, days_observed,
  CASE WHEN days_observed >= 60 THEN 'High' ELSE 'Low' END AS match_confidence,
  "Crop" AS crop_name, match_score, (match_score >= 60)::BIGINT AS is_viable, crop_rank,
  CASE WHEN avg_yield_kg_per_ha >= 3000 THEN 'High' WHEN avg_yield_kg_per_ha >= 1500
    THEN 'Medium' ELSE 'Low' END AS expected_yield_tier,
  {", ".join(f"{rd(c)} AS {c}" for c in _SEASON_MEASURES)},
  {rd('"Temperature_C"')} AS crop_avg_temperature_c, {rd('"Humidity_%"')}
    AS crop_avg_humidity_pct, {rd('"Rainfall_mm"')} AS crop_avg_rainfall_mm,
  {rd('"Wind_Speed_m_s"')} AS crop_avg_wind_speed_ms, {rd('"pH"')} AS "pH",
  {rd("avg_yield_kg_per_ha")} AS avg_yield_kg_per_ha
FROM ranked WHERE crop_rank <= 5""", *_PLACES, "crops",
    extra={**_NAMED_DAILY, **_CROP_PROFILE, **_WEIGHTS, **_MATCH}))
def jn_06(spark, sf):
    out = crop_match.build_match(_named(spark, sf), X.crops(spark, sf), _overrides(spark, sf))
    return present(out, 6, exact=("match_score",))


@query("scl_21_match_score", X.sql("""
SELECT city_name, season, max(match_score) AS best_score,
  count(DISTINCT match_score) AS levels, sum((match_score >= 60)::INT)::BIGINT AS viable
FROM ranked WHERE crop_rank <= 3 GROUP BY city_name, season""", *_PLACES, "crops",
    extra={**_NAMED_DAILY, **_CROP_PROFILE, **_WEIGHTS, **_MATCH}))
def scl_21(spark, sf):
    crops = crop.attach_feature_weights(crop.build_crop_profile(X.crops(spark, sf)),
                                        _overrides(spark, sf))
    profile = rollup.build_city_season_profile(_named(spark, sf), crop.MATCH_KEYS[:4])
    out = crop.build_crop_weather_match(profile, crops, top=3)
    return out.groupBy("city_name", "season").agg(
        F.max("match_score").alias("best_score"),
        F.count_distinct("match_score").alias("levels"), F.sum("is_viable").alias("viable"))


# ---------------------------------------------------------------- suitability
_BASE_SQL = "VALUES " + ", ".join(
    f"('{n}', {t}::DOUBLE, 3.0::DOUBLE, {h}::DOUBLE, 8.0::DOUBLE, {rain}::DOUBLE, "
    f"150.0::DOUBLE, {p}::DOUBLE, 0.5::DOUBLE, {y}::DOUBLE, {list(s)!r})"
    for n, t, rain, h, p, y, s in C.BASE_CROPS)
_PARAMS = {
    "base": f"""SELECT * FROM ({_BASE_SQL}) t(crop, temp_mean, temp_std, humidity_mean,
      humidity_std, rainfall_mean, rainfall_std, ph_mean, ph_std, avg_yield, seasons)""",
    "seen": """SELECT CASE WHEN crop LIKE 'hot %' THEN 'rice' ELSE lower(crop) END AS crop,
        avg(temperature_c) AS t, stddev_samp(temperature_c) / 8 AS ts,
        avg("Humidity_%") AS h, stddev_samp("Humidity_%") / 8 AS hs, avg(rainfall_mm) AS rn,
        stddev_samp(rainfall_mm) / 8 AS rs, avg(ph) AS p, avg(yield_kg_per_ha) AS y
      FROM crop_silver GROUP BY 1""",
    "params": """SELECT coalesce(b.crop, s.crop) AS crop,
        coalesce(temp_mean, t) AS temp_mean,
        coalesce(temp_std, greatest(coalesce(ts, 3), 1.5)) AS temp_std,
        coalesce(humidity_mean, h) AS humidity_mean,
        coalesce(humidity_std, greatest(coalesce(hs, 8), 3)) AS humidity_std,
        coalesce(rainfall_mean, rn) AS rainfall_mean,
        coalesce(rainfall_std, greatest(coalesce(rs, 150), 50)) AS rainfall_std,
        coalesce(ph_mean, p) AS ph_mean, 0.5::DOUBLE AS ph_std,
        coalesce(y, avg_yield) AS avg_yield, coalesce(seasons, ['whole year']) AS seasons
      FROM base b FULL JOIN seen s ON b.crop = s.crop"""}


def _params(spark, sf):
    silver = X.crop_silver(spark, sf)
    renamed = silver.withColumn("crop", F.when(F.col("crop").startswith("hot "), "rice").otherwise(
        F.initcap("crop")))
    seen = crop.crop_agronomy_profile(renamed)
    eased = seen.withColumns({c: F.col(c) / 8 for c in ("temp_std", "humidity_std",
                                                         "rainfall_std")})
    return crop.crop_parameters(crop.base_crops(spark), eased)


_PARAM_COLS = ("temp_mean", "temp_std", "humidity_mean", "humidity_std", "rainfall_mean",
               "rainfall_std", "ph_mean", "ph_std", "avg_yield")


@query("scl_23_crop_parameters", X.sql(
    "SELECT crop, " + ", ".join(f"{rd(c)} AS {c}" for c in _PARAM_COLS)
    + ", array_to_string(seasons, ',') AS seasons FROM params", "crop_silver", extra=_PARAMS))
def scl_23(spark, sf):
    out = _params(spark, sf).withColumn("seasons", F.array_join("seasons", ","))
    return present(out.drop("n_req", "p_req", "k_req"), 6)


_CONDITIONS = {"conditions": """
  SELECT s_suppkey AS place, 15.0::DOUBLE + s_suppkey % 20 AS temperature,
    200.0::DOUBLE + (s_suppkey % 30) * 50 AS rainfall, 40.0::DOUBLE + s_suppkey % 45 AS humidity,
    5.5::DOUBLE + (s_suppkey % 5) * 0.5::DOUBLE AS ph,
    CASE s_suppkey % 4 WHEN 0 THEN 'Monsoon (Kharif)' WHEN 1 THEN 'Winter (Rabi)'
      WHEN 2 THEN 'Summer (Zaid)' END AS season FROM supplier"""}


def _conditions(spark, sf):
    k = F.col("s_suppkey")
    season = (F.when(k % 4 == 0, "Monsoon (Kharif)").when(k % 4 == 1, "Winter (Rabi)")
              .when(k % 4 == 2, "Summer (Zaid)"))
    return X.table(spark, sf, "supplier").select(
        k.alias("place"), (F.lit(15.0) + k % 20).alias("temperature"),
        (F.lit(200.0) + (k % 30) * 50).alias("rainfall"),
        (F.lit(40.0) + k % 45).alias("humidity"), (F.lit(5.5) + (k % 5) * 0.5).alias("ph"),
        season.alias("season"))


def _suit_sql(weights):
    w = weights
    return X.sql(f"""
SELECT place, crop, round(CASE WHEN ok THEN s ELSE s * 0.45 END, 2) AS score,
  CASE WHEN ok THEN 'In Season' ELSE 'Out of Season' END AS in_season
FROM (SELECT place, crop,
    100 / (1 + 0.35 * sqrt({w["temp"]} * pow((temperature - temp_mean) / temp_std, 2)
      + {w["rain"]} * pow((rainfall - rainfall_mean) / rainfall_std, 2)
      + {w["humidity"]} * pow((humidity - humidity_mean) / humidity_std, 2)
      + {w["ph"]} * pow((ph - ph_mean) / ph_std, 2))) AS s,
    season IS NULL OR list_contains(seasons, 'whole year') OR len(list_filter(seasons,
      lambda x: contains(lower(season), x) OR contains(x, lower(season)))) > 0 AS ok
  FROM conditions CROSS JOIN params)""", "crop_silver", extra={**_PARAMS, **_CONDITIONS})


def _suitability(spark, sf, recency):
    out = crop.predict_suitability(_conditions(spark, sf), _params(spark, sf), recency)
    return out.select("place", F.lower("crop").alias("crop"),
                      F.col("suitability_score").alias("score"), "in_season")


@query("scl_22_suitability", _suit_sql(C.SUITABILITY_WEIGHTS[True]))
def scl_22(spark, sf):
    return _suitability(spark, sf, True)


@query("scl_22_suitability_equal", _suit_sql(C.SUITABILITY_WEIGHTS[False]))
def scl_22b(spark, sf):
    return _suitability(spark, sf, False)


_SERIES = {"series": """
  SELECT n_name AS state, o_orderpriority AS season, year(o_orderdate) AS year,
    floor(o_totalprice / 1000) * 0.125::DOUBLE AS temp, o_orderkey % 997 * 1.0::DOUBLE AS rain
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""}


def _series(spark, sf):
    o = X.table(spark, sf, "orders").join(
        X.table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    named = o.join(X.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        F.col("n_name").alias("state"), F.col("o_orderpriority").alias("season"),
        F.year("o_orderdate").alias("year"),
        (F.floor(F.col("o_totalprice") / 1000) * 0.125).alias("temp"),
        (F.col("o_orderkey") % 997 * 1.0).alias("rain"))


@query("win_13_recency_climate", X.sql("""
SELECT state, season, round(sum(temp * w) / sum(w), 1) AS temp,
  round(sum(rain * w) / sum(w), 1) AS rain
FROM (SELECT *, pow(0.85::DOUBLE, max(year) OVER (PARTITION BY state, season) - year) AS w
      FROM series) GROUP BY state, season""", extra=_SERIES))
def win_13(spark, sf):
    return crop.recency_climate(_series(spark, sf), measures=("temp", "rain"))


@query("win_13_calibrated_climate", X.sql("""
SELECT c_custkey, coalesce(temp, 26.0)::DOUBLE AS temp, coalesce(rain, 850.0)::DOUBLE AS rain
FROM (SELECT c_custkey, n_name AS state, CASE WHEN c_custkey % 3 = 0 THEN 'none'
        ELSE '1-URGENT' END AS season FROM customer JOIN nation ON c_nationkey = n_nationkey)
LEFT JOIN (SELECT state, season, round(avg(temp), 1) AS temp, round(avg(rain), 1) AS rain
           FROM series GROUP BY state, season) USING (state, season)""", extra=_SERIES))
def win_13b(spark, sf):
    requests = X.table(spark, sf, "customer").join(
        X.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("state"),
        F.when(F.col("c_custkey") % 3 == 0, "none").otherwise("1-URGENT").alias("season"))
    climate = crop.recency_climate(_series(spark, sf), measures=("temp", "rain"), decay=None)
    return crop.calibrated_climate(requests, climate, measures=("temp", "rain"),
                                   default=(26.0, 850.0)).select("c_custkey", "temp", "rain")


# ---------------------------------------------------------------- advisory text
def _advice_input(spark, sf):
    k = F.col("p_partkey")
    return X.table(spark, sf, "part").select(
        k.alias("id"), F.col("p_name").alias("crop_name"), F.col("p_type").alias("season"),
        (F.lit(10.0) + k % 26).alias("temperature"), (k % 1601 * 1.0).alias("rainfall"),
        (F.lit(30.0) + k % 61).alias("humidity"), (F.lit(5.0) + k % 8 * 0.5).alias("ph"),
        F.lit(22.5).alias("ideal_temp"), F.lit(800.0).alias("ideal_rain"),
        F.lit(60.0).alias("ideal_humidity"), F.lit(6.5).alias("ideal_ph"),
        (k % 40 * 1.0).alias("n_req"), (k % 20 * 1.0).alias("p_req"),
        (k % 30 * 1.0).alias("k_req"), (k % 5000 * 1.0).alias("avg_yield_kg_ha"),
        (k % 100 + 0.25).alias("suitability_score"), F.col("p_brand").alias("city"),
        F.when(k % 2 == 0, F.lower("p_brand")).otherwise(F.lit("North end")).alias("district"),
        F.when(k % 3 != 0, F.lit("ASIA")).alias("state"),
        F.when(k % 4 == 0, "").otherwise("Use certified seed.").alias("context"))


_ADVICE = {"advice": """
  SELECT p_partkey AS id, p_name AS crop_name, p_type AS season,
    10.0::DOUBLE + p_partkey % 26 AS temperature, (p_partkey % 1601)::DOUBLE AS rainfall,
    30.0::DOUBLE + p_partkey % 61 AS humidity, 5.0::DOUBLE + (p_partkey % 8) * 0.5::DOUBLE AS ph,
    (p_partkey % 40)::DOUBLE AS n_req, (p_partkey % 20)::DOUBLE AS p_req,
    (p_partkey % 30)::DOUBLE AS k_req, (p_partkey % 5000)::DOUBLE AS avg_yield_kg_ha,
    p_partkey % 100 + 0.25::DOUBLE AS suitability_score, p_brand AS city,
    CASE WHEN p_partkey % 2 = 0 THEN lower(p_brand) ELSE 'North end' END AS district,
    CASE WHEN p_partkey % 3 <> 0 THEN 'ASIA' END AS state,
    CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'Use certified seed.' END AS context
  FROM part"""}


@query("txt_07_retrieval_query", X.sql("""
SELECT id, concat_ws(' ', crop_name, 'cultivation',
  CASE WHEN temperature > 30 THEN 'high temperature heat stress tolerance'
    WHEN temperature < 18 THEN 'cool temperature frost sensitivity'
    ELSE 'optimal temperature growth' END,
  CASE WHEN rainfall < 400 THEN 'drought water stress low rainfall'
    WHEN rainfall > 1200 THEN 'heavy rainfall drainage excess moisture'
    ELSE 'irrigation rainfall schedule' END,
  CASE WHEN ph < 6.2 THEN 'acidic soil amendment'
    WHEN ph > 7.5 THEN 'alkaline saline soil management'
    ELSE 'neutral soil NPK fertility' END, 'fertilizer pest disease') AS query FROM advice""",
    extra=_ADVICE))
def txt_07(spark, sf):
    return _advice_input(spark, sf).select("id", text.retrieval_query().alias("query"))


@query("txt_08_advisory", X.sql("""
SELECT id, temperature - 22.5 AS temp_deviation, ph - 6.5 AS ph_deviation,
  humidity - 60 AS humidity_deviation, rainfall - 800 AS rain_deviation,
  CASE WHEN abs(temperature - 22.5) <= 2.5 THEN 'optimal' WHEN temperature > 25 THEN 'warmer'
    ELSE 'cooler' END AS temp_class,
  CASE WHEN abs(ph - 6.5) <= 0.5 THEN 'balanced' WHEN ph < 6 THEN 'acidic' ELSE 'alkaline' END
    AS ph_class,
  CASE WHEN humidity - 60 > 10 THEN 'disease risk' WHEN humidity - 60 < -15 THEN 'pest alert'
    ELSE 'low pressure' END AS humidity_class,
  CASE WHEN rainfall - 800 < -200 THEN 'deficit' WHEN rainfall - 800 > 300 THEN 'surplus'
    ELSE 'matched' END AS rain_class,
  CASE WHEN abs(ph - 6.5) <= 0.5 THEN printf('apply baseline N %d, P %d, K %d kg/ha, expected yield %d kg/ha',
      n_req::INT, p_req::INT, k_req::INT, avg_yield_kg_ha::INT)
    WHEN ph < 6 THEN printf('add lime and P %d kg/ha as single super phosphate', p_req::INT)
    ELSE printf('add gypsum and zinc sulphate with N %d, P %d, K %d kg/ha', n_req::INT,
      p_req::INT, k_req::INT) END AS nutrient_action,
  CASE WHEN rainfall < 600 THEN printf('micro-irrigate to bridge %d mm', abs(rainfall - 800)::INT)
    WHEN rainfall > 1100 THEN printf('open drainage for %d mm', (rainfall - 800)::INT)
    ELSE 'rainfed, two supplemental irrigations in dry spells' END AS irrigation_action
FROM advice""", extra=_ADVICE))
def txt_08(spark, sf):
    return text.advisory(_advice_input(spark, sf)).select(
        "id", "temp_deviation", "ph_deviation", "humidity_deviation", "rain_deviation",
        "temp_class", "ph_class", "humidity_class", "rain_class", "nutrient_action",
        "irrigation_action")


@query("txt_09_advisory_prompt", X.sql("""
SELECT id, concat_ws(chr(10), 'Write a data-driven farming advisory.',
  'Location: ' || concat_ws(', ', 'City: ' || city, CASE WHEN lower(district) <> lower(city)
    THEN 'District: ' || district END, 'State: ' || state),
  'Season: ' || season,
  printf('Conditions: temperature %.1f C, rain %.1f mm, humidity %.1f %%, pH %.1f',
    temperature, rainfall, humidity, ph),
  'Crop: ' || crop_name || printf(' (suitability %.2f %%)', suitability_score),
  'Baseline: temperature 22.5 C, rain 800.0 mm, humidity 60.0 %, pH 6.5',
  printf('Nutrients: N %.1f, P %.1f, K %.1f kg/ha', n_req, p_req, k_req),
  printf('Expected yield: %.1f kg/ha', avg_yield_kg_ha), 'Guidelines:',
  CASE WHEN context = '' THEN 'Standard agronomic practices apply.' ELSE context END,
  'Sections: sowing window, nutrients, pests and diseases, irrigation.') AS prompt
FROM advice""", extra=_ADVICE))
def txt_09(spark, sf):
    return text.advisory_prompt(_advice_input(spark, sf)).select("id", "prompt")
