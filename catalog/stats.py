"""Correlation, collinearity, relevance, trends and clustering."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalog import fixtures as X
from catalog.registry import present, query, rd
from fieldcast.functions import scores as S
from fieldcast.operators import ml, profile, rollup, stats

COLS = ("temp_mean", "dew_mean", "humidity_mean", "precip_total", "cloud_mean",
        "cloud_low_mean", "wind_mean_10m", "wind_mean_100m", "wind_gusts_max", "pressure_mean")
GAPPED = ("temp_mean", "dew_mean", "cloud_mean", "wind_mean_100m", "wind_gusts_max")


def _pair_sql(cols, source, name="correlation"):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS {name} FROM {source}"
        for a, b in combinations(cols, 2))


_PAIRS = {"pairs": _pair_sql(GAPPED, "days_gaps")}


@query("ml_07_pearson_pairs", X.sql(
    f"SELECT feature_1, feature_2, {rd('correlation')} AS correlation FROM pairs",
    "days_gaps", extra=_PAIRS))
def ml_07(spark, sf):
    return present(stats.pearson_pairs(X.days(spark, sf, gaps=True), GAPPED), 6)


@query("ml_07_pearson_matrix", X.sql(" UNION ALL ".join(
    f"SELECT '{a}' AS feature, " + ", ".join(
        f"{rd('1.0' if a == b else f'corr({a}, {b})')} AS {b}" for b in GAPPED)
    + " FROM days_gaps" for a in GAPPED), "days_gaps"))
def ml_07b(spark, sf):
    return present(stats.pearson_matrix(X.days(spark, sf, gaps=True), GAPPED), 6)


_RANKED = {"ranked": "SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}"
    for c in GAPPED) + " FROM days_gaps WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in GAPPED),
    "spearman_pairs": _pair_sql(GAPPED, "ranked", "spearman")}


@query("ml_08_spearman", X.sql(f"""
SELECT feature_1, feature_2, {rd("spearman")} AS correlation FROM spearman_pairs""",
    "days_gaps", extra=_RANKED))
def ml_08(spark, sf):
    return present(stats.spearman_pairs(X.days(spark, sf, gaps=True), GAPPED), 6)


@query("ml_09_corr_pairs", X.sql(f"""
SELECT feature_1, feature_2, {rd("correlation")} AS correlation,
  CASE WHEN abs(correlation) >= 0.98 THEN 'DROP ONE — near duplicate'
    ELSE 'WATCH — multicollinearity risk' END AS decision
FROM pairs WHERE abs(correlation) >= 0.5""", "days",
    extra={"pairs": _pair_sql(COLS, "days")}))
def ml_09(spark, sf):
    return present(stats.corr_pairs(stats.pearson_pairs(X.days(spark, sf), COLS), 0.5, 0.98), 6)


@query("ml_09_pair_report", X.sql(f"""
SELECT feature_1, feature_2, {rd("correlation")} AS pearson, {rd("spearman")} AS spearman,
  {rd("greatest(abs(correlation), abs(spearman))")} AS max_absolute_correlation,
  CASE WHEN greatest(abs(correlation), abs(spearman)) >= 0.95
    THEN 'DROP ONE — near duplicate' ELSE 'WATCH — multicollinearity risk' END AS decision
FROM pairs JOIN spearman_pairs USING (feature_1, feature_2)
WHERE greatest(abs(correlation), abs(spearman)) >= 0.6""", "days_gaps",
    extra={**_PAIRS, **_RANKED}))
def ml_09b(spark, sf):
    return present(stats.pair_report(X.days(spark, sf, gaps=True), GAPPED, watch=0.6), 6)


@query("ml_10_max_partner", X.sql(f"""
SELECT feature, {rd("m")} AS max_abs_correlation, partner AS most_correlated_with FROM (
  SELECT feature_1 AS feature, feature_2 AS partner, abs(correlation) AS m,
    row_number() OVER (PARTITION BY feature_1 ORDER BY round(abs(correlation), 12) DESC,
      feature_2) AS rn
  FROM (SELECT * FROM pairs UNION ALL SELECT feature_2, feature_1, correlation FROM pairs))
WHERE rn = 1""", "days", extra={"pairs": _pair_sql(COLS, "days")}))
def ml_10(spark, sf):
    return present(stats.max_partner(stats.pearson_pairs(X.days(spark, sf), COLS)), 6)


@query("ml_11_target_relevance", X.sql(" UNION ALL ".join(
    f"SELECT '{t}' AS target, '{f}' AS feature, {rd(f'corr({t}, {f})')} AS correlation, "
    f"{rd(f'abs(corr({t}, {f}))')} AS absolute_correlation FROM days"
    for t in ("temp_mean", "wind_mean_100m") for f in COLS if f != t), "days"))
def ml_11(spark, sf):
    return present(stats.target_relevance(X.days(spark, sf), COLS,
                                          ["temp_mean", "wind_mean_100m"]), 6)


@query("ml_12_independence", X.sql(f"""
SELECT feature_1, feature_2, {rd("correlation")} AS correlation,
  CASE WHEN abs(correlation) >= 0.8 THEN 'REVIEW' ELSE 'OK' END AS status FROM pairs""",
    "days", extra={"pairs": _pair_sql(COLS, "days")}))
def ml_12(spark, sf):
    return present(stats.independence(X.days(spark, sf), COLS), 6)


# 3 x 3 inverse written out: the factor of i is m_ii times its cofactor over the determinant
_VARS = ("temp_mean", "cloud_mean", "wind_mean_100m")


def _vif_sql(moment):
    a, b, c = _VARS
    m = {(x, y): moment(*sorted((x, y), key=_VARS.index)) for x in _VARS for y in _VARS}
    parts = ", ".join(f"{m[x, y]} AS m_{i}{j}" for i, x in enumerate(_VARS)
                      for j, y in enumerate(_VARS) if i <= j)
    det = ("(m_00*m_11*m_22 + 2*m_01*m_02*m_12 - m_00*m_12*m_12 - m_11*m_02*m_02 "
           "- m_22*m_01*m_01)")
    co = {0: "m_00*(m_11*m_22 - m_12*m_12)", 1: "m_11*(m_00*m_22 - m_02*m_02)",
          2: "m_22*(m_00*m_11 - m_01*m_01)"}
    return X.sql(" UNION ALL ".join(
        f"SELECT '{v}' AS feature, {rd(f'{co[i]} / {det}')} AS vif, CASE "
        f"WHEN {co[i]} / {det} > 10 THEN 'DROP/REVIEW' WHEN {co[i]} / {det} > 5 THEN 'WATCH' "
        f"ELSE 'OK' END AS flag FROM moments" for i, v in enumerate(_VARS)),
        "days_gaps", extra={"moments": f"SELECT {parts} FROM days_gaps WHERE "
                            + " AND ".join(f"{v} IS NOT NULL" for v in _VARS)})


@query("ml_13_vif", _vif_sql(lambda x, y: f"covar_pop({x}, {y})"))
def ml_13(spark, sf):
    return present(stats.vif(X.days(spark, sf, gaps=True), _VARS), 6)


@query("ml_13_vif_no_intercept", _vif_sql(lambda x, y: f"avg({x} * {y})"))
def ml_13b(spark, sf):
    return present(stats.vif(X.days(spark, sf, gaps=True), _VARS, intercept=False), 6)


_MI_FEATURES = ("temperature_2m", "relative_humidity_2m", "cloud_cover")
_MI_COLS = (*_MI_FEATURES, "dew_point_2m")


def _bins(c):
    return f"len(list_filter((SELECT quantile_cont({c}, {[i / 8 for i in range(1, 8)]}) " \
           f"FROM hourly), lambda e: e < {c}))"


@query("ml_14_mutual_information", X.sql(" UNION ALL ".join(f"""
SELECT '{f}' AS feature, {rd('''sum(n / t * ln(n * t / (nx * ny)))''')} AS mutual_information,
  'dew_point_2m' AS target
FROM (SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY x) AS nx,
        sum(n) OVER (PARTITION BY y) AS ny
      FROM (SELECT {_bins(f)} AS x, {_bins("dew_point_2m")} AS y, count(*)::DOUBLE AS n
            FROM hourly GROUP BY ALL))""" for f in _MI_FEATURES), "hourly"))
def ml_14(spark, sf):
    return present(stats.mutual_information(X.hourly(spark, sf), _MI_FEATURES,
                                            "dew_point_2m"), 6)


# two-sided p of Student's t by its finite sum, for the whole degrees of freedom at hand
_P_SQL = """CASE WHEN dof % 2 = 1
  THEN 1 - 2 / pi() * (theta + CASE WHEN dof > 1 THEN sin(theta) * cos(theta) * (1 +
    coalesce(list_sum(list_transform(range(1, ((dof - 1) / 2)::INT), lambda j:
      list_product(list_transform(range(1, j + 1), lambda i: 2 * i / (2 * i + 1)))
      * pow(cos(theta), 2 * j))), 0)) ELSE 0 END)
  ELSE 1 - sin(theta) * (1 + coalesce(list_sum(list_transform(range(1, (dof / 2)::INT),
    lambda j: list_product(list_transform(range(1, j + 1), lambda i: (2 * i - 1) / (2 * i)))
      * pow(cos(theta), 2 * j))), 0)) END"""


def _trend_sql(source, needs):
    return X.sql(f"""
SELECT key, n, {rd("slope")} AS slope, {rd("intercept", 4)} AS intercept, {rd("r")} AS r,
  {rd("t", 5)} AS t, {rd(_P_SQL)} AS p_value
FROM (SELECT *, n - 2 AS dof, atan(abs(t) / sqrt(n - 2)) AS theta
      FROM (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t
            FROM (SELECT key, count(*) AS n, regr_slope(y, x) AS slope,
                    regr_intercept(y, x) AS intercept, corr(x, y) AS r
                  FROM ({source}) GROUP BY key HAVING count(*) >= 4)))""", *needs)


def _trend_out(df, key):
    from catalog.registry import r

    return df.select(F.col(key).alias("key"), "n", r("slope").alias("slope"),
                     r("intercept", 4).alias("intercept"), r("r").alias("r"),
                     r("t", 5).alias("t"), r("p_value").alias("p_value"))


@query("ml_15_linear_trend", _trend_sql(
    "SELECT city AS key, year AS x, avg(temp_mean) AS y FROM days GROUP BY city, year",
    ["days"]))
def ml_15(spark, sf):
    return _trend_out(stats.yearly_city_trend(X.days(spark, sf)), "city")


@query("ml_15_linear_trend_events", _trend_sql(
    "SELECT user_id AS key, day(ts) AS x, avg(value) AS y FROM events GROUP BY user_id, day(ts)",
    []))
def ml_15b(spark, sf):
    e = X.table(spark, sf, "events").groupBy(
        "user_id", F.dayofmonth("ts").alias("x")).agg(F.avg("value").alias("y"))
    return _trend_out(stats.linear_trend(e, ["user_id"], "x", "y"), "user_id")


_TRENDS = [("latitude", "mean_temp"), ("latitude", "mean_precip"), ("longitude", "mean_temp"),
           ("longitude", "mean_humidity")]


@query("ml_16_spatial_trend", X.sql(" UNION ALL ".join(f"""
SELECT '{a}' AS coordinate, '{b}' AS weather_metric, count(*) AS cities_used,
  {rd(f"corr({a}, {b})")} AS correlation,
  CASE WHEN abs(corr({a}, {b})) >= 0.7 THEN 'strong' WHEN abs(corr({a}, {b})) >= 0.4
    THEN 'moderate' ELSE 'weak' END AS strength FROM city_values
  HAVING count(*) >= 5""" for a, b in _TRENDS),
    "city_values"))
def ml_16(spark, sf):
    return present(stats.spatial_trend(X.city_values(spark, sf), _TRENDS), 6)


_DECISION = ("temp_mean", "dew_mean", "cloud_mean", "wind_mean_10m", "wind_mean_100m")


@query("scl_27_feature_decision", X.sql("""
SELECT feature, CASE WHEN missing_pct > 30 THEN 'REVIEW — high missingness'
  WHEN unique_values <= 1 THEN 'DROP — constant feature'
  WHEN variance IS NULL OR variance = 0 THEN 'DROP — zero variance'
  WHEN best >= 0.95 THEN 'REVIEW — near duplicate'
  WHEN best >= 0.80 THEN 'WATCH — correlated' ELSE 'KEEP' END AS recommendation
FROM quality LEFT JOIN (SELECT feature, max(abs(correlation)) AS best FROM (
    SELECT feature_1 AS feature, correlation FROM pairs
    UNION ALL SELECT feature_2, correlation FROM pairs) GROUP BY feature) USING (feature)""",
    "days_gaps", extra={
        "pairs": _pair_sql(_DECISION, "days_gaps"),
        "quality": " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) / count(*) * 100 AS "
            f"missing_pct, count(DISTINCT {c}) AS unique_values, var_samp({c}) AS variance "
            f"FROM days_gaps" for c in _DECISION)}))
def scl_27(spark, sf):
    d = X.days(spark, sf, gaps=True)
    report = stats.feature_report(
        d, profile.feature_quality(d, _DECISION), stats.pearson_pairs(d, _DECISION),
        # independent features, so the inflation factors stay far below their limits
        stats.vif(d, ("temp_mean", "cloud_mean", "wind_mean_100m")))
    return report.select("feature", S.feature_decision(
        "missing_pct", "unique_values", "variance", "max_abs_correlation", "vif")
        .alias("recommendation"))


# ---------------------------------------------------------------- clustering
_FEATURES_SQL = """
SELECT city_id, state_id, region_id,
  avg(avg_temperature_2m) FILTER (month IN (6,7,8,9,10)) AS kharif_temp,
  avg(avg_temperature_2m) FILTER (month IN (11,12,1,2,3)) AS rabi_temp,
  avg(avg_temperature_2m) FILTER (month IN (4,5)) AS zaid_temp,
  avg(avg_temperature_2m) AS annual_mean_temp,
  max(max_temperature_2m) - min(min_temperature_2m) AS temp_range,
  sum(daily_precipitation) FILTER (month IN (6,7,8,9,10)) AS kharif_rainfall,
  sum(daily_precipitation) FILTER (month IN (11,12,1,2,3)) AS rabi_rainfall,
  sum(daily_precipitation) AS annual_rainfall, avg(avg_humidity) AS avg_humidity,
  avg(avg_cloud_cover) AS avg_cloud_cover FROM daily GROUP BY ALL
HAVING kharif_temp IS NOT NULL AND rabi_temp IS NOT NULL"""
_FEATURES = ("kharif_temp", "rabi_temp", "zaid_temp", "annual_mean_temp", "temp_range",
             "kharif_rainfall", "rabi_rainfall", "annual_rainfall", "avg_humidity",
             "avg_cloud_cover")


@query("agg_12_climate_features", X.sql(f"""
SELECT city_id::BIGINT AS city_id, state_id::BIGINT AS state_id, region_id::BIGINT AS region_id,
  {", ".join(f"{rd(c)} AS {c}" for c in _FEATURES)} FROM features""", "daily",
    extra={"features": _FEATURES_SQL}))
def agg_12(spark, sf):
    return present(rollup.extract_climate_features(X.daily(spark, sf)), 6)


def _assigned(spark, sf):
    return rollup.extract_climate_features(X.daily(spark, sf)).withColumn(
        "cluster_id", F.col("city_id") % 5)


_ASSIGNED = {"features": _FEATURES_SQL,
             "assigned": "SELECT *, city_id % 5 AS cluster_id FROM features"}
_STATS = {**_ASSIGNED, "cluster": """
  SELECT cluster_id, avg(kharif_rainfall) AS avg_kharif_rain, avg(kharif_temp) AS avg_kharif_temp,
    avg(rabi_temp) AS avg_rabi_temp, avg(avg_humidity) AS avg_hum FROM assigned GROUP BY 1"""}


@query("agg_13_cluster_stats", X.sql(f"""
SELECT cluster_id::BIGINT AS cluster_id, {", ".join(f"{rd(c)} AS {c}" for c in
    ("avg_kharif_rain", "avg_kharif_temp", "avg_rabi_temp", "avg_hum"))} FROM cluster""",
    "daily", extra=_STATS))
def agg_13(spark, sf):
    return present(ml.cluster_stats(_assigned(spark, sf)), 6)


@query("ml_05_zone_names", X.sql("""
SELECT city_id::BIGINT AS city_id, cluster_id::BIGINT AS cluster_id,
  CASE WHEN lo = 1 THEN 'Hot & Arid Zone' WHEN hi = 1 THEN 'Humid High-Rainfall Zone'
    WHEN avg_kharif_temp > 29 THEN 'Semi-Arid Central Plateau'
    WHEN avg_rabi_temp < 18 THEN 'Sub-Humid Fertile Plains'
    ELSE 'Coastal / Tropical Zone' END AS agro_climatic_zone,
  CASE WHEN lo = 1 THEN 'Kharif: Bajra, Jowar, Groundnut, Sesame | Rabi: Mustard, Chickpea'
    WHEN hi = 1 THEN 'Kharif: Rice, Jute, Tea, Rubber | Rabi: Boro Rice, Pulses'
    WHEN avg_kharif_temp > 29 THEN 'Kharif: Cotton, Soybean, Pulses | Rabi: Wheat, Sunflower'
    WHEN avg_rabi_temp < 18 THEN 'Kharif: Rice, Maize, Sugarcane | Rabi: Wheat, Mustard, Chickpea'
    ELSE 'Kharif: Rice, Coconut, Spices | Rabi: Groundnut, Sugarcane' END AS recommended_crops
FROM assigned JOIN (SELECT *, row_number() OVER (ORDER BY avg_kharif_rain, cluster_id) AS lo,
    row_number() OVER (ORDER BY avg_kharif_rain DESC, cluster_id DESC) AS hi FROM cluster)
  USING (cluster_id)""", "daily", extra=_STATS))
def ml_05(spark, sf):
    return present(ml.map_zones(_assigned(spark, sf)).select(
        "city_id", "cluster_id", "agro_climatic_zone", "recommended_crops"))


def _scaled(spark, sf):
    """Fingerprints of all users' events, scaled."""
    e = X.table(spark, sf, "events").groupBy("user_id").agg(
        F.avg("value").alias("mean_value"), F.max("value").alias("max_value"),
        F.avg(F.hour("ts")).alias("mean_hour"), F.count(F.lit(1)).alias("n"))
    return ml.build_ml_pipeline(e, ["mean_value", "max_value", "mean_hour", "n"])[0]


@query("ml_01_scaled_features", f"""
WITH f AS (SELECT user_id, avg(value) AS v, max(value) AS m, avg(hour(ts)) AS h, count(*) AS n
           FROM events GROUP BY user_id)
SELECT user_id, {rd("(v - avg(v) OVER ()) / stddev_samp(v) OVER ()")} AS mean_value,
  {rd("(m - avg(m) OVER ()) / stddev_samp(m) OVER ()")} AS max_value,
  {rd("(h - avg(h) OVER ()) / stddev_samp(h) OVER ()")} AS mean_hour,
  {rd("(n - avg(n) OVER ()) / stddev_samp(n) OVER ()")} AS n FROM f""")
def ml_01(spark, sf):
    from pyspark.ml.functions import vector_to_array

    v = vector_to_array("features")
    names = ("mean_value", "max_value", "mean_hour", "n")
    return present(_scaled(spark, sf).select(
        "user_id", *[v[i].alias(n) for i, n in enumerate(names)]), 6)


@query("ml_02_k_sweep")
def ml_02(spark, sf):
    return ml.evaluate_optimal_k(_scaled(spark, sf))[1]


@query("ml_04_kmeans")
def ml_04(spark, sf):
    return ml.train_kmeans(_scaled(spark, sf), 8)[1].select("user_id", "cluster_id")


@query("ml_04_nearest_centres", """
SELECT count(DISTINCT user_id) AS users, 8::BIGINT AS clusters, 0::BIGINT AS misplaced
FROM events""")
def ml_04b(spark, sf):
    from pyspark.ml.functions import vector_to_array

    model, rows = ml.train_kmeans(_scaled(spark, sf), 8)
    vector = vector_to_array("features")
    gaps = F.array(*[F.struct(F.aggregate(
        F.zip_with(vector, F.array(*map(F.lit, map(float, centre))), lambda a, b: (a - b) * (a - b)),
        F.lit(0.0), lambda x, y: x + y).alias("gap"), F.lit(i).alias("i"))
        for i, centre in enumerate(model.clusterCenters())])
    own = F.get(gaps, F.col("cluster_id"))["gap"]
    return rows.agg(
        F.count(F.lit(1)).alias("users"), F.count_distinct("cluster_id").alias("clusters"),
        F.count(F.when(own > F.array_min(gaps)["gap"] + 1e-9, 1)).alias("misplaced"))


_CENTRES = {
    "parts": "SELECT vec_id, label, unnest(range(1, 65)) AS pos, "
             "unnest(embedding)::DOUBLE AS v FROM embeddings",
    "centres": "SELECT label, pos, avg(v) AS c, count(*) AS n FROM parts GROUP BY 1, 2",
    "grand": "SELECT pos, avg(v) AS g FROM parts GROUP BY 1",
    "dist": "SELECT vec_id, label, sum((v - c) * (v - c)) AS d2 FROM parts "
            "JOIN centres USING (label, pos) GROUP BY 1, 2",
    "spread": "SELECT label, count(*) AS n, sum(d2) AS w, avg(sqrt(d2)) AS s FROM dist "
              "GROUP BY 1",
    "between": "SELECT sum(n * (c - g) * (c - g)) AS b FROM centres JOIN grand USING (pos)",
    "gaps": "SELECT x.label AS i, y.label AS j, sqrt(sum((x.c - y.c) * (x.c - y.c))) AS d "
            "FROM centres x JOIN centres y ON x.pos = y.pos AND x.label <> y.label GROUP BY 1, 2",
    "worst": "SELECT i, max((a.s + b.s) / d) AS r FROM gaps JOIN spread a ON a.label = i "
             "JOIN spread b ON b.label = j GROUP BY 1"}


@query("ml_03_cluster_indices", X.sql(f"""
SELECT count(*) AS k, {rd("sum(w)", 5)} AS inertia,
  {rd("any_value(b) / (count(*) - 1) / (sum(w) / (sum(n) - count(*)))", 5)} AS calinski_harabasz,
  {rd("(SELECT avg(r) FROM worst)", 5)} AS davies_bouldin
FROM spread, between""", extra=_CENTRES))
def ml_03(spark, sf):
    return present(ml.cluster_indices(X.table(spark, sf, "embeddings"), "embedding", "label"), 5)


@query("ml_06_score_nearest", X.sql(f"""
SELECT vec_id, cluster_id::BIGINT AS cluster_id, {rd("sqrt(d2)")} AS distance_to_centroid
FROM (SELECT vec_id, c.label AS cluster_id, sum((v - c) * (v - c)) AS d2,
        row_number() OVER (PARTITION BY vec_id ORDER BY sum((v - c) * (v - c)), c.label) AS rn
      FROM parts p JOIN centres c ON p.pos = c.pos GROUP BY vec_id, c.label) WHERE rn = 1""",
    extra=_CENTRES))
def ml_06(spark, sf):
    vectors = X.table(spark, sf, "embeddings")
    centres = ml.cluster_centres(vectors, "embedding", "label").select(
        F.col("label").alias("cluster_id"), F.col("centre").alias("centroid"))
    return present(ml.score_nearest(vectors, "embedding", centres).select(
        "vec_id", "cluster_id", "distance_to_centroid"), 6)


@query("ml_17_representatives")
def ml_17(spark, sf):
    return ml.representatives(X.locations(spark, sf).select("city", "state", "lat", "lng"), 20)


def _profiles(spark, sf):
    return rollup.fingerprint(X.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("city"), "l_quantity", "l_extendedprice", "l_discount",
        "l_tax"), "city", ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


@query("ml_18_pca")
def ml_18(spark, sf):
    fp = _profiles(spark, sf)
    return ml.pca2(fp, [c for c in fp.columns if c != "city"], ["city"])


@query("ml_18_pca_axes", """
SELECT count(DISTINCT l_suppkey) AS cities, TRUE AS first_is_wider, TRUE AS uncorrelated
FROM lineitem""")
def ml_18b(spark, sf):
    fp = _profiles(spark, sf)
    found = ml.pca2(fp, [c for c in fp.columns if c != "city"], ["city"])
    one, two = [c for c in found.columns if c != "city"][:2]
    return found.agg(
        F.count_distinct("city").alias("cities"),
        (F.var_samp(one) >= F.var_samp(two)).alias("first_is_wider"),
        (F.abs(F.corr(one, two)) < 1e-6).alias("uncorrelated"))


@query("ml_19_fingerprint_clusters")
def ml_19(spark, sf):
    return ml.fingerprint_clusters(_profiles(spark, sf), "city", 5).select("city", "cluster")
