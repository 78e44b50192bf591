"""Cleaning, keys, joins, windows, sorts, sets, dimensions and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import fixtures as X
from catalog.registry import present, query, rd
from fieldcast import config as C
from fieldcast.functions import calendar as cal
from fieldcast.functions import keys as K
from fieldcast.operators import clean, dims, facts, profile, quality, ranking, rollup, sampling
from fieldcast.plans import silver as plan


# ---------------------------------------------------------------- projections and filters
@query("flt_01_require_columns", X.sql("""
SELECT city_id::BIGINT AS city_id, CAST(date AS VARCHAR) AS date, temperature_2m,
  relative_humidity_2m, precipitation, rain, pressure_msl, cloud_cover, wind_speed_10m,
  wind_speed_100m FROM weather""", "weather"))
def flt_01(spark, sf):
    return present(clean.require_columns(X.weather(spark, sf), C.REQUIRED_FACT_COLUMNS, "fact"))


@query("flt_02_projection", X.sql("""
SELECT c_custkey, c_name, c_acctbal FROM customer"""))
def flt_02(spark, sf):
    return clean.project(X.table(spark, sf, "customer"),
                         ["c_custkey", "not_there", "c_name", "c_acctbal"])


_CLEAN_CROP = """
SELECT * FROM (SELECT trim(CASE WHEN "Rainfall_mm" % 17 = 0 THEN '  ' ELSE "Crop" END) AS "Crop",
    "Temperature_C", "Humidity_%" + 1 AS "Humidity_%", "Rainfall_mm" - 5 AS "Rainfall_mm",
    CASE WHEN "pH" = 6 THEN 0 ELSE "Yield_kg_per_ha" END AS "Yield_kg_per_ha" FROM crops)
WHERE "Crop" <> '' AND "Yield_kg_per_ha" > 0 AND "Temperature_C" BETWEEN -10 AND 55
  AND "Humidity_%" BETWEEN 0 AND 100 AND "Rainfall_mm" >= 0"""


@query("flt_04_clean_crop", X.sql(_CLEAN_CROP, "crops"))
def flt_04(spark, sf):
    dirty = X.crops(spark, sf).select(
        F.when(F.col("Rainfall_mm") % 17 == 0, "  ").otherwise(F.col("Crop")).alias("Crop"),
        "Temperature_C", (F.col("`Humidity_%`") + 1).alias("Humidity_%"),
        (F.col("Rainfall_mm") - 5).alias("Rainfall_mm"),
        F.when(F.col("pH") == 6, 0.0).otherwise(F.col("Yield_kg_per_ha"))
        .alias("Yield_kg_per_ha"))
    return clean.clean_crop(dirty)


@query("flt_05_enforce_schema", X.sql(f"""
SELECT city, count(*) AS rows, min(date) AS first_date, max(date) AS last_date,
  {", ".join(f"sum({m}) AS {m}" for m in C.HOURLY_MEASURES)}
FROM (SELECT * REPLACE (CAST(date AS VARCHAR) AS date,
      CASE WHEN pressure_msl % 7 = 0 THEN NULL ELSE temperature_2m END AS temperature_2m)
      FROM hourly) GROUP BY city""", "hourly"))
def flt_05(spark, sf):
    texts = X.hourly(spark, sf).select(
        F.col("date").cast("string").alias("date"), "city", "hour",
        *[F.col(m).cast("string").alias(m) for m in C.HOURLY_MEASURES[1:]],
        F.when(F.col("pressure_msl") % 7 == 0, "bad").otherwise(
            F.col("temperature_2m").cast("string")).alias("temperature_2m"))
    fixed = clean.enforce_schema(texts)
    return present(fixed.groupBy("city").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), *[F.sum(m).alias(m) for m in C.HOURLY_MEASURES]))


@query("flt_06_norm_key", """
SELECT c_custkey, lower(trim(' ' || c_name || '  ')) AS loose,
  regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS strict FROM customer""")
def flt_06(spark, sf):
    padded = F.concat(F.lit(" "), F.col("c_name"), F.lit("  "))
    return X.table(spark, sf, "customer").select(
        "c_custkey", K.norm_key(padded).alias("loose"),
        K.norm_key("c_name", strict=True).alias("strict"))


@query("flt_07_replace_values", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction'
  WHEN 'MACHINERY' THEN 'Machines' ELSE c_mktsegment END AS segment FROM customer""")
def flt_07(spark, sf):
    df = X.table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return K.replace_values(df, "segment", {"BUILDING": "Construction", "MACHINERY": "Machines"})


@query("flt_08_map_lookup", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open'
  ELSE 'Other' END AS status FROM orders""")
def flt_08(spark, sf):
    return X.table(spark, sf, "orders").select("o_orderkey", K.map_lookup(
        "o_orderstatus", {"F": "finished", "O": "open"}, "Other").alias("status"))


@query("flt_08_assign_region", X.sql("""
SELECT town_id, CASE WHEN town_id % 5 = 0 THEN 'North' WHEN town_id % 5 = 1 THEN 'South'
  WHEN lng >= 88 AND lat >= 21 THEN 'Northeast' WHEN lat >= 28 THEN 'North'
  WHEN lng <= 76 AND lat >= 15 THEN 'West' WHEN lat < 20 THEN 'South'
  WHEN lng >= 84 THEN 'East' ELSE 'Central' END AS region FROM locations""", "locations"))
def flt_08b(spark, sf):
    town = F.col("town_id") % 5
    state = F.when(town == 0, "Uttar Pradesh").when(town == 1, "Tamil Nadu").otherwise(
        F.when(town == 2, F.col("state")))
    return X.locations(spark, sf).select(
        "town_id", K.assign_region(state, "lat", "lng").alias("region"))


@query("flt_09_base_name", """
SELECT user_id || '_' || event_type AS raw,
  regexp_replace(event_type || '_' || user_id, '_[0-9]+$', '') AS base, count(*) AS events
FROM events GROUP BY ALL""")
def flt_09(spark, sf):
    e = X.table(spark, sf, "events").withColumns({
        "raw": F.concat_ws("_", "user_id", "event_type"),
        "base": K.base_name(F.concat_ws("_", "event_type", "user_id"))})
    return e.groupBy("raw", "base").agg(F.count(F.lit(1)).alias("events"))


@query("flt_10_rename_if_absent", """
SELECT p_partkey, p_retailprice AS yield_kg_per_ha, p_size::BIGINT AS rainfall_mm FROM part""")
def flt_10(spark, sf):
    raw = X.table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("yield"),
                                            F.col("p_size").cast("bigint").alias("rainfall_mm"))
    return clean.rename_if_absent(raw)


@query("flt_11_fill_chain", """
SELECT p_partkey, coalesce(CASE WHEN p_partkey % 3 <> 0 THEN p_size * 0.5 END,
  CASE WHEN p_partkey % 2 = 0 THEN 20.5 END, 25.0)::DOUBLE AS temperature_c FROM part""")
def flt_11(spark, sf):
    own = F.when(F.col("p_partkey") % 3 != 0, F.col("p_size") * 0.5)
    average = F.when(F.col("p_partkey") % 2 == 0, 20.5)
    return X.table(spark, sf, "part").select(
        "p_partkey", K.fill_chain(own, average, C.DEFAULT_TEMPERATURE).alias("temperature_c"))


_PH_STATES = ("Maharashtra", "Punjab", "Rajasthan", "Tamil Nadu", "Kerala", "Elsewhere")
_PH_VALUES = (7.4, 6.8, 8.1, 6.3, 5.8, 6.8)


@query("flt_12_soil_ph", f"""
SELECT c_custkey, [{", ".join(f"{v}::DOUBLE" for v in _PH_VALUES)}][c_nationkey % 6 + 1] AS ph
FROM customer""")
def flt_12(spark, sf):
    state = F.element_at(F.array(*[F.lit(s) for s in _PH_STATES]), F.col("c_nationkey") % 6 + 1)
    return X.table(spark, sf, "customer").select("c_custkey", K.soil_ph(state).alias("ph"))




@query("flt_13_clean_locations", X.sql("""
SELECT town_id, state, trim(city) AS city,
  coalesce(nullif(trim(district), ''), trim(city)) AS district, 'General' AS region
FROM locations WHERE town_id % 13 <> 0""", "locations"))
def flt_13(spark, sf):
    raw = X.locations(spark, sf).select(
        "town_id", F.concat(F.lit(" "), "city", F.lit(" ")).alias("city"), "district",
        F.when(F.col("town_id") % 13 != 0, F.col("state")).alias("state"))
    return clean.clean_locations(raw).select("town_id", "state", "city", "district", "region")


@query("flt_14_search_locations", X.sql("""
SELECT town_id, city, state FROM locations
WHERE region = 'ASIA' AND (contains(lower(city), 'house') OR contains(lower(district), 'house')
  OR contains(lower(state), 'house'))""", "locations"))
def flt_14(spark, sf):
    return clean.search_locations(X.locations(spark, sf), region="ASIA", keyword="House").select(
        "town_id", "city", "state")


@query("flt_15_bbox", X.sql("""
SELECT town_id, (lat BETWEEN 10 AND 30 AND lng BETWEEN 70.5 AND 90) AS inside
FROM locations""", "locations"))
def flt_15(spark, sf):
    return X.locations(spark, sf).select(
        "town_id", K.in_bbox("lat", "lng", (10, 30, 70.5, 90)).alias("inside"))


@query("flt_16_drop_years", """
SELECT year(o_orderdate)::BIGINT AS year, count(*) AS orders FROM orders
WHERE year(o_orderdate) < 2001 GROUP BY 1""")
def flt_16(spark, sf):
    o = X.table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return present(clean.drop_years(o, F.col("year") < 2001).groupBy("year").agg(
        F.count(F.lit(1)).alias("orders")))


@query("flt_17_complete_cases", """
SELECT l_returnflag, count(*) AS rows, sum(l_quantity) AS quantity FROM lineitem
WHERE l_partkey % 7 <> 0 AND l_orderkey % 5 <> 0 AND l_orderkey % 3 <> 0 GROUP BY 1""")
def flt_17(spark, sf):
    li = X.table(spark, sf, "lineitem").select(
        "l_returnflag", F.when(F.col("l_partkey") % 7 != 0, F.col("l_quantity"))
        .cast("double").alias("l_quantity"),
        F.when(F.col("l_orderkey") % 5 == 0, float("inf"))
        .when(F.col("l_orderkey") % 3 == 0, float("nan")).otherwise(1.0).alias("x"))
    return clean.complete_cases(li, ["l_quantity", "x"]).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity"))


# ---------------------------------------------------------------- joins
def _raw(spark, sf):
    """Hourly rows with a city name of odd spelling; two suppliers each share a name."""
    return X.weather(spark, sf).withColumn("city", F.concat(
        F.lit(" STATION "), F.floor(F.col("city_id") / 2).cast("string"), F.lit(" "))).drop("city_id")


def _stations(spark, sf):
    return X.dim_city(spark, sf).withColumn("city_name", F.concat(
        F.lit("Station "), F.floor(F.col("city_id") / 2).cast("string")))


_LOOKUP = {
    "raw": "SELECT * EXCLUDE (city_id), city_id // 2 AS station FROM weather",
    "lookup": "SELECT c.*, s.state_name, c.city_id // 2 AS station FROM dim_city c "
              "JOIN dim_state s ON c.state_id = s.state_id",
}


@query("jn_02_build_fact", X.sql("""
SELECT l.city_id::BIGINT AS city_id, l.state_name, count(*) AS rows, sum(rain) AS rain
FROM raw r JOIN lookup l ON r.station = l.station GROUP BY ALL""",
    "weather", "dim_city", "dim_state", extra=_LOOKUP))
def jn_02(spark, sf):
    fact = facts.build_fact(_raw(spark, sf), _stations(spark, sf), X.dim_state(spark, sf))
    return present(fact.groupBy("city_id", "state_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("rain").alias("rain")))


_RANKED_SQL = {
    **_LOOKUP,
    "flagged": """
      SELECT *, row_number() OVER (PARTITION BY state_id ORDER BY md5('42|' || city_id))
        <= greatest(2, ceil(count(*) OVER (PARTITION BY state_id) * 0.3)) AS is_sampled
      FROM lookup""",
}


@query("jn_03_build_fact_sampled", X.sql("""
SELECT l.city_id::BIGINT AS city_id, l.state_name, count(*) AS rows, sum(rain) AS rain
FROM raw r JOIN flagged l ON r.station = l.station AND l.is_sampled GROUP BY ALL""",
    "weather", "dim_city", "dim_state", extra=_RANKED_SQL))
def jn_03(spark, sf):
    flagged = sampling.stratified_flag(_stations(spark, sf), floor=2)
    fact = facts.build_fact_sampled(_raw(spark, sf), flagged, X.dim_state(spark, sf))
    return present(fact.groupBy("city_id", "state_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("rain").alias("rain")))


_DIMS_SQL = {
    "regions": "SELECT row_number() OVER (ORDER BY region) AS region_id, region AS region_name "
               "FROM (SELECT DISTINCT region FROM locations)",
    "states": "SELECT row_number() OVER (ORDER BY state) AS state_id, state AS state_name, "
              "region_id FROM (SELECT DISTINCT state, region FROM locations) "
              "JOIN regions ON region = region_name",
    "cities": "SELECT row_number() OVER (ORDER BY state, city) AS city_id, city AS city_name, "
              "state_id, district, lat, lng FROM locations JOIN states ON state = state_name",
}


@query("jn_04_dimension_joins", X.sql("""
SELECT state_id, state_name, region_id FROM states""", "locations", extra=_DIMS_SQL))
def jn_04(spark, sf):
    master = X.locations(spark, sf)
    return present(dims.build_dim_state(master, dims.build_dim_region(master)))


def _doubled_regions(spark, sf):
    base = X.dim_region(spark, sf)
    again = base.select((F.col("region_id") + 10).alias("region_id"), "region_name")
    states = X.dim_state(spark, sf).withColumn("region_id", F.when(
        F.col("state_id") % 2 == 1, F.col("region_id") + 10).otherwise(F.col("region_id")))
    return base.unionByName(again), states


@query("jn_05_deduplicate_regions", X.sql("""
SELECT s.state_id::BIGINT AS state_id, s.state_name, s.region_id::BIGINT AS region_id,
  r.region_name FROM dim_state s JOIN dim_region r ON s.region_id = r.region_id""",
    "dim_state", "dim_region"))
def jn_05(spark, sf):
    regions, states = dims.deduplicate_regions(*_doubled_regions(spark, sf))
    return present(states.join(regions, "region_id").select(
        "state_id", "state_name", "region_id", "region_name"))


_STATE_AVG = {"averages": """
  SELECT lower(trim(s.state_name)) AS state_clean, avg(temperature_2m) AS t,
    avg(relative_humidity_2m) AS h
  FROM weather w JOIN dim_city c ON w.city_id = c.city_id
  JOIN dim_state s ON c.state_id = s.state_id GROUP BY 1"""}


@query("agg_14_state_weather_avg", X.sql(f"""
SELECT state_clean, {rd("t")} AS temperature_c_avg, {rd("h")} AS humidity_avg
FROM averages""", "weather", "dim_city", "dim_state", extra=_STATE_AVG))
def agg_14(spark, sf):
    return present(facts.state_weather_avg(
        X.weather(spark, sf), X.dim_city(spark, sf), X.dim_state(spark, sf)), 6)


@query("jn_10_enrich_crop_weather", X.sql(f"""
SELECT p_partkey, ' Nation_' || (p_partkey % 25) || ' ' AS state,
  {rd("coalesce(CASE WHEN p_partkey % 4 = 0 THEN p_size END, t, 25.0)")} AS temperature_c,
  {rd("coalesce(h, 65.0)")} AS "humidity_%", 6.8::DOUBLE AS ph
FROM part LEFT JOIN averages ON 'nation_' || (p_partkey % 25) = state_clean""",
    "weather", "dim_city", "dim_state", extra=_STATE_AVG))
def jn_10(spark, sf):
    crop = X.table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit(" Nation_"), (F.col("p_partkey") % 25).cast("string"),
                              F.lit(" ")).alias("state"),
        F.when(F.col("p_partkey") % 4 == 0, F.col("p_size").cast("double"))
        .alias("temperature_c"))
    averages = facts.state_weather_avg(X.weather(spark, sf), X.dim_city(spark, sf),
                                       X.dim_state(spark, sf))
    return present(facts.enrich_crop_weather(crop, averages), 6)


@query("jn_11_join_features", """
SELECT c.c_custkey, o.orders, o.first_order, n.n_name FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS orders, min(o_orderkey) AS first_order
           FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey
LEFT JOIN (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) n
  ON c.c_custkey = n.c_custkey""")
def jn_11(spark, sf):
    customer = X.table(spark, sf, "customer")
    orders = X.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_order"))
    names = customer.join(X.table(spark, sf, "nation"),
                          F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_name")
    return clean.join_features(customer.select("c_custkey"), "c_custkey", orders, names)


@query("jn_12_orphans", X.sql("""
SELECT s_suppkey AS city_id, s_nationkey::BIGINT AS s_nationkey FROM supplier
WHERE s_suppkey NOT IN (SELECT city_id FROM weather)""", "weather"))
def jn_12(spark, sf):
    cities = X.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("city_id"),
                                                   "s_nationkey")
    return present(facts.orphans(cities, X.weather(spark, sf), "city_id"))


@query("jn_13_split_by_keys", """
SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)
  AS rich FROM orders""")
def jn_13(spark, sf):
    rich = X.table(spark, sf, "customer").filter("c_acctbal > 5000").select(
        F.col("c_custkey").alias("o_custkey"))
    inside, outside = clean.split_by_keys(X.table(spark, sf, "orders"), rich, "o_custkey")
    return inside.select("o_orderkey", F.lit(True).alias("rich")).unionByName(
        outside.select("o_orderkey", F.lit(False).alias("rich")))


# ---------------------------------------------------------------- windows
@query("win_01_surrogate_keys", X.sql("""
SELECT city_id, city_name, state_id, district, lat, lng FROM cities""",
    "locations", extra=_DIMS_SQL))
def win_01(spark, sf):
    return present(dims.build_dims(X.locations(spark, sf))[2])


@query("win_03_top_matches", """
SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice,
  dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS crop_rank
  FROM orders) WHERE crop_rank <= 5""")
def win_03(spark, sf):
    from fieldcast.operators.crop import top_matches

    orders = X.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return present(top_matches(orders, ["o_custkey"], "o_totalprice"))


@query("win_08_stratified_flag", X.sql("""
SELECT town_id, state, row_number() OVER (PARTITION BY state ORDER BY md5('42|' || town_id))
  <= greatest(15, ceil(count(*) OVER (PARTITION BY state) * 0.3)) AS is_sampled
FROM locations""", "locations"))
def win_08(spark, sf):
    return sampling.stratified_flag(X.locations(spark, sf), ["state"], ["town_id"]).select(
        "town_id", "state", "is_sampled")


@query("win_09_group_anomaly", f"""
SELECT p_partkey, {rd("p_size - avg(p_size) OVER (PARTITION BY p_brand)")} AS p_size_anomaly
FROM part""")
def win_09(spark, sf):
    out = ranking.group_anomaly(X.table(spark, sf, "part"), "p_brand", ["p_size"])
    return present(out.select("p_partkey", "p_size_anomaly"), 6)


@query("win_07_relative_to_max", f"""
SELECT p_partkey, {rd("p_size / max(p_size) OVER (PARTITION BY p_type)")} AS share
FROM part""")
def win_07(spark, sf):
    out = ranking.relative_to_max(X.table(spark, sf, "part"), "p_type", "p_size", "share")
    return present(out.select("p_partkey", "share"), 6)


@query("win_10_dedup_first", """
SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def win_10(spark, sf):
    orders = X.table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")
    return ranking.dedup_first(orders, ["o_custkey", "o_orderpriority"],
                               ["o_totalprice", "o_orderkey"])


@query("win_11_dedup_none", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, any_value(l_partkey) AS l_partkey
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) = 1""")
def win_11(spark, sf):
    li = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return present(ranking.dedup_none(li, ["l_orderkey", "l_linenumber"]))


@query("win_12_group_count", """
SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type) AS count FROM events""")
def win_12(spark, sf):
    return ranking.with_group_count(X.table(spark, sf, "events"),
                                    ["user_id", "event_type"]).select("event_id", "count")


# ---------------------------------------------------------------- sorts and selections
@query("srt_01_order_by", """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey""")
def srt_01(spark, sf):
    return ranking.order_by(X.table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal"), [F.desc("c_acctbal"), "c_custkey"])


@query("srt_02_top_k", """
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20""")
def srt_02(spark, sf):
    return ranking.top_k(X.table(spark, sf, "part").select("p_partkey", "p_retailprice"),
                         "p_retailprice", 20, ties=["p_partkey"])


@query("srt_02_bottom_k", """
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 20""")
def srt_02b(spark, sf):
    return ranking.top_k(X.table(spark, sf, "part").select("p_partkey", "p_retailprice"),
                         "p_retailprice", 20, ascending=True, ties=["p_partkey"])


@query("srt_03_select_even", """
WITH chosen AS (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9800),
head AS (SELECT c_name FROM chosen ORDER BY c_name LIMIT 50),
rest AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS pos FROM customer
         WHERE c_name NOT IN (SELECT c_name FROM chosen)),
size AS (SELECT count(*) AS n, 50 - (SELECT count(*) FROM chosen) AS need FROM rest),
picks AS (SELECT i * (n - 1) // greatest(need - 1, 1) AS pos FROM size, range(50) t(i)
          WHERE i < need)
SELECT c_name, 'preferred' AS picked_as FROM head
UNION ALL SELECT c_name, 'spaced' FROM rest WHERE pos IN (SELECT pos FROM picks)""")
def srt_03(spark, sf):
    customer = X.table(spark, sf, "customer")
    preferred = customer.filter("c_mktsegment = 'BUILDING' AND c_acctbal > 9800")
    return ranking.select_even(customer.select("c_name"), "c_name", preferred, 50)


@query("srt_04_top_up", """
WITH matched AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_totalprice > 495000)
SELECT c_custkey, 'matched' AS picked_as FROM customer
WHERE c_custkey IN (SELECT c_custkey FROM matched)
UNION ALL
SELECT c_custkey, 'filled' FROM (SELECT c_custkey, row_number() OVER (
    ORDER BY md5('42|' || c_custkey)) AS rn FROM customer
  WHERE c_custkey NOT IN (SELECT c_custkey FROM matched))
WHERE rn <= 400 - (SELECT count(*) FROM customer
                   WHERE c_custkey IN (SELECT c_custkey FROM matched))""")
def srt_04(spark, sf):
    matched = X.table(spark, sf, "orders").filter("o_totalprice > 495000").select(
        F.col("o_custkey").alias("c_custkey"))
    return sampling.top_up(X.table(spark, sf, "customer").select("c_custkey"), matched,
                           "c_custkey", 400)


@query("srt_05_sorted_distinct", "SELECT DISTINCT p_brand FROM part ORDER BY 1")
def srt_05(spark, sf):
    return ranking.sorted_distinct(X.table(spark, sf, "part"), "p_brand")


@query("ml_21_cap_sample", """
SELECT o_orderkey FROM orders ORDER BY md5('42|' || o_orderkey) LIMIT 500""")
def ml_21(spark, sf):
    return sampling.cap_sample(X.table(spark, sf, "orders").select("o_orderkey"), 500,
                               ["o_orderkey"])


@query("agg_57_sampling_summary", X.sql("""
SELECT state, count(*) AS total_cities, count(*) FILTER (s) AS selected_cities,
  round(count(*) FILTER (s) / count(*) * 100, 2) AS selected_pct,
  round((SELECT count(*) FILTER (s) / count(*) * 100 FROM flagged), 2) AS overall_pct
FROM flagged GROUP BY state""", "locations", extra={"flagged": """
  SELECT state, row_number() OVER (PARTITION BY state ORDER BY md5('42|' || town_id))
    <= greatest(15, ceil(count(*) OVER (PARTITION BY state) * 0.3)) AS s FROM locations"""}))
def agg_57(spark, sf):
    return sampling.sampling_summary(sampling.stratified_flag(
        X.locations(spark, sf), ["state"], ["town_id"]), "state")


# ---------------------------------------------------------------- sets and lists
@query("set_03_concat", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS segment
FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""")
def set_03(spark, sf):
    a = X.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"))
    b = X.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("segment"))
    return clean.concat(a, b)


@query("set_05_parity", """
WITH a AS (SELECT DISTINCT l_suppkey % 40 AS k FROM lineitem),
b AS (SELECT DISTINCT s_nationkey::BIGINT + 20 AS k FROM supplier)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing in second'
  WHEN a.k IS NULL THEN 'missing in first' ELSE 'both' END AS status
FROM a FULL JOIN b ON a.k = b.k""")
def set_05(spark, sf):
    a = X.table(spark, sf, "lineitem").select((F.col("l_suppkey") % 40).alias("k"))
    b = X.table(spark, sf, "supplier").select((F.col("s_nationkey").cast("bigint") + 20).alias("k"))
    return dims.parity(a, b, "k")


@query("agg_15_cities_by_state", X.sql("""
SELECT state, count(*) OVER (PARTITION BY state) AS city_count, city
FROM (SELECT DISTINCT state, city FROM locations)""",
    "locations"))
def agg_15(spark, sf):
    return present(dims.city_lists(X.locations(spark, sf)))


@query("agg_50_duplicate_bases", """
SELECT * FROM (SELECT p_brand || ' ' || p_size AS base,
  count(*) OVER (PARTITION BY p_brand, p_size) AS count, p_partkey::VARCHAR AS member
  FROM part) WHERE count > 1""")
def agg_50(spark, sf):
    part = X.table(spark, sf, "part").select(
        F.concat_ws(" ", "p_brand", "p_size").alias("base"),
        F.col("p_partkey").cast("string").alias("member"))
    return present(dims.duplicate_bases(part, ["base"], "member"))


@query("agg_49_location_kpis", X.sql("""
SELECT count(DISTINCT state) AS states, count(DISTINCT district) AS districts,
  count(DISTINCT region) AS regions, count(*) AS cities FROM locations""", "locations"))
def agg_49(spark, sf):
    return rollup.location_kpis(X.locations(spark, sf))


@query("agg_49_top_districts", X.sql("""
SELECT district, count(*) AS city_count FROM locations GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 10""", "locations"))
def agg_49b(spark, sf):
    return rollup.top_districts(X.locations(spark, sf))


@query("agg_58_value_counts", """
SELECT event_type, count(*) AS count FROM events GROUP BY 1""")
def agg_58(spark, sf):
    return rollup.value_counts(X.table(spark, sf, "events"), "event_type")


# ---------------------------------------------------------------- coercion and headers
@query("src_10_clean_columns", """
SELECT c_custkey AS customer_key, c_name AS full_name FROM customer""")
def src_10(spark, sf):
    odd = X.table(spark, sf, "customer").select(F.col("c_custkey").alias(" Customer Key"),
                                                F.col("c_name").alias("Full-Name "))
    return clean.clean_columns(odd)


@query("src_11_canonical_headers", X.sql("""
SELECT city, count(*) AS rows, sum(temperature_2m) AS temperature_2m,
  sum(relative_humidity_2m) AS relative_humidity_2m, sum(wind_speed_100m) AS wind_speed_100m
FROM hourly GROUP BY city""", "hourly"))
def src_11(spark, sf):
    odd = X.hourly(spark, sf).select(
        "city", F.col("time").alias("Date Time"),
        F.col("temperature_2m").alias("Temperature_2m (C)"),
        F.col("relative_humidity_2m").alias("relative_humidity_2m (%)"),
        F.col("wind_speed_100m").alias("Wind Speed 100m"))
    out = clean.canonicalise(odd, keep=["city"])
    return present(out.groupBy("city").agg(F.count("time").alias("rows"), *[
        F.sum(c).alias(c) for c in ("temperature_2m", "relative_humidity_2m",
                                    "wind_speed_100m")]))


@query("src_12_coerce_types", """
SELECT event_type, count(*) AS rows, count(v) AS numbers, round(sum(v), 2) AS total,
  CAST(min(ts) AS VARCHAR) AS first_ts
FROM (SELECT event_type, date_trunc('second', ts) AS ts,
        CASE WHEN event_id % 4 <> 0 THEN value END AS v FROM events WHERE event_id % 5 <> 0)
GROUP BY 1""")
def src_12(spark, sf):
    raw = X.table(spark, sf, "events").select(
        "event_type", F.when(F.col("event_id") % 5 == 0, "not a time").otherwise(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(
            F.col("value").cast("string")).alias("v"))
    out = clean.coerce_types(raw, "ts", ["v"])
    return present(out.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count("v").alias("numbers"),
        F.round(F.sum("v"), 2).alias("total"), F.min("ts").alias("first_ts")))


@query("scl_26_coverage", """
SELECT user_id, (date_diff('day', min(ts)::DATE, max(ts)::DATE) + 1)::BIGINT AS expected_days,
  (floor((epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts)))) / 3600)
    + 1)::BIGINT AS expected_hours,
  count(DISTINCT ts::DATE) / (date_diff('day', min(ts)::DATE, max(ts)::DATE) + 1) * 100
    AS coverage_pct
FROM events GROUP BY user_id""")
def scl_26(spark, sf):
    e = X.table(spark, sf, "events")
    per_day = e.groupBy("user_id", F.to_date("ts").alias("d")).agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    span = per_day.groupBy("user_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                          F.count("d").alias("n"))
    first, last = F.to_date("lo"), F.to_date("hi")
    return present(span.select(
        "user_id", cal.expected_days(first, last).alias("expected_days"),
        cal.expected_hours("lo", "hi").alias("expected_hours"),
        cal.coverage_pct("n", cal.expected_days(first, last)).alias("coverage_pct")))


# ---------------------------------------------------------------- audits
def _built(spark, sf):
    region, state, city = dims.build_dims(X.locations(spark, sf))
    return region, state, sampling.stratified_flag(city)




@query("dq_01_primary_key", """
SELECT 'lineitem primary key' AS name, 'FAILED' AS status,
  format('rows: {}, distinct: {}, null: {}', count(*), count(DISTINCT l_orderkey),
         count(*) FILTER (l_orderkey IS NULL)) AS details FROM lineitem
UNION ALL SELECT 'orders primary key', 'PASSED', format('rows: {}, distinct: {}, null: 0',
  count(*), count(DISTINCT o_orderkey)) FROM orders
UNION ALL SELECT 'part primary key', 'FAILED', format('rows: {}, distinct: {}, null: {}',
  count(*), count(DISTINCT k), count(*) FILTER (k IS NULL))
  FROM (SELECT CASE WHEN p_partkey % 7 <> 0 THEN p_partkey END AS k FROM part)""")
def dq_01(spark, sf):
    part = X.table(spark, sf, "part").select(
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_partkey")).alias("k"))
    return quality.union_checks([
        quality.check_pk(X.table(spark, sf, "lineitem"), "l_orderkey", "lineitem"),
        quality.check_pk(X.table(spark, sf, "orders"), "o_orderkey", "orders"),
        quality.check_pk(part, "k", "part")])


@query("dq_02_fk_not_null", X.sql("""
SELECT 'fact state_id not null' AS name,
  CASE WHEN count(*) FILTER (state_id IS NULL) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
  format('rows: {}, null: {}', count(*), count(*) FILTER (state_id IS NULL)) AS details
FROM enriched""", "enriched"))
def dq_02(spark, sf):
    return quality.check_fk_not_null(X.enriched(spark, sf), ["state_id", "state_name"], "fact")


@query("dq_03_composite_key", """
SELECT 'lineitem composite key' AS name,
  CASE WHEN count(*) = count(DISTINCT (l_orderkey, l_linenumber)) THEN 'PASSED'
    ELSE 'FAILED' END AS status,
  format('rows: {}, distinct: {}', count(*), count(DISTINCT (l_orderkey, l_linenumber)))
    AS details FROM lineitem""")
def dq_03(spark, sf):
    return quality.check_composite(X.table(spark, sf, "lineitem"),
                                   ["l_orderkey", "l_linenumber"], "lineitem")


@query("dq_04_contiguous", """
SELECT 'dim_city key range' AS name, 'PASSED' AS status,
  format('min: 1, max: {}, rows: {}', count(*), count(*)) AS details FROM customer
UNION ALL SELECT 'orders key range', 'FAILED', format('min: {}, max: {}, rows: {}',
  min(o_orderkey), max(o_orderkey), count(*)) FROM orders""")
def dq_04(spark, sf):
    return quality.union_checks([
        quality.check_contiguous(dims.build_dims(X.locations(spark, sf))[2], "city_id",
                                 "dim_city"),
        quality.check_contiguous(X.table(spark, sf, "orders"), "o_orderkey", "orders")])


@query("dq_05_sample_flag", """
SELECT 'dim_city is_sampled' AS name, 'PASSED' AS status,
  format('flagged: {} of {}', sum(least(n, greatest(15, ceil(n * 0.3))))::BIGINT, sum(n)::BIGINT)
    AS details
FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)""")
def dq_05(spark, sf):
    return quality.check_flag(_built(spark, sf)[2], "is_sampled", "dim_city")


@query("dq_06_orphans", """
SELECT 'lineitem referential integrity' AS name,
  CASE WHEN count(*) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
  format('unmatched rows: {}', count(*)) AS details
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""")
def dq_06(spark, sf):
    part = X.table(spark, sf, "part").filter("p_size > 5").select(
        F.col("p_partkey").alias("l_partkey"))
    return quality.check_orphans(X.table(spark, sf, "lineitem"), part, "l_partkey", "lineitem")


@query("dq_07_parity", """
SELECT 'nation parity' AS name, CASE WHEN a = b THEN 'PASSED' ELSE 'FAILED' END AS status,
  format('first: {}, second: {}', a, b) AS details
FROM (SELECT count(DISTINCT c_nationkey) AS a FROM customer),
     (SELECT count(DISTINCT s_nationkey) AS b FROM supplier)""")
def dq_07(spark, sf):
    a = X.table(spark, sf, "customer").select(F.col("c_nationkey").alias("n"))
    b = X.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("n"))
    return quality.check_parity(a, b, "n", "nation")


@query("dq_08_shape", X.sql("""
SELECT 'weather shape' AS name, 'PASSED' AS status,
  format('rows: {}, columns: 23', count(*)) AS details FROM weather
UNION ALL SELECT 'part shape', 'FAILED', format('rows: {}, columns: 6', count(*)) FROM part""",
    "weather"))
def dq_08(spark, sf):
    return quality.union_checks([
        quality.check_shape(X.weather(spark, sf), 20, "weather"),
        quality.check_shape(X.table(spark, sf, "part"), 20, "part")])


@query("dq_09_any_null_key", X.sql("""
SELECT 'fact key present' AS name, 'FAILED' AS status, 'null key found: yes' AS details
FROM (SELECT count(*) AS n FROM weather WHERE wind_direction_10m % 7 = 0) WHERE n > 0
UNION ALL SELECT 'orders key present', 'PASSED', 'null key found: no' FROM (
  SELECT count(*) AS n FROM orders WHERE o_orderkey IS NULL) WHERE n = 0""", "weather"))
def dq_09(spark, sf):
    gap = X.weather(spark, sf).withColumn("city_id", F.when(
        F.col("wind_direction_10m") % 7 != 0, F.col("city_id")))
    return quality.union_checks([
        quality.check_any_null(gap, ["city_id", "date"], "fact"),
        quality.check_any_null(X.table(spark, sf, "orders"), ["o_orderkey"], "orders")])


def _unique(label, table, key):
    return (f"SELECT '{label} primary key' AS name, CASE WHEN count(*) = count(DISTINCT {key}) "
            f"AND count({key}) = count(*) THEN 'PASSED' ELSE 'FAILED' END AS status, "
            f"format('rows: {{}}, distinct: {{}}, null: {{}}', count(*), count(DISTINCT {key}), "
            f"count(*) FILTER ({key} IS NULL)) AS details FROM {table}")


def _present(label, table, key):
    return (f"SELECT '{label} {key} not null', CASE WHEN count({key}) = count(*) THEN 'PASSED' "
            f"ELSE 'FAILED' END, format('rows: {{}}, null: {{}}', count(*), "
            f"count(*) FILTER ({key} IS NULL)) FROM {table}")


_AUDIT_SQL = " UNION ALL ".join([
    _unique("dim_region", "regions", "region_id"), _unique("dim_state", "states", "state_id"),
    _present("dim_state", "states", "region_id"), _unique("dim_city", "flagged_cities", "city_id"),
    _present("dim_city", "flagged_cities", "state_id"),
    """SELECT 'dim_city composite key', 'PASSED', format('rows: {}, distinct: {}', count(*),
      count(DISTINCT (city_name, state_id))) FROM flagged_cities""",
    """SELECT 'dim_city key range', 'PASSED', format('min: {}, max: {}, rows: {}', min(city_id),
      max(city_id), count(*)) FROM flagged_cities""",
    """SELECT 'dim_city is_sampled', 'PASSED', format('flagged: {} of {}',
      count(*) FILTER (is_sampled), count(*)) FROM flagged_cities""",
    _present("fact_weather", "fact", "city_id"), _present("fact_weather", "fact", "state_id"),
    """SELECT 'fact_weather referential integrity', 'PASSED', format('unmatched rows: {}',
      count(*)) FROM fact WHERE city_id NOT IN (SELECT city_id FROM flagged_cities)""",
    _present("fact_weather_sampled", "sampled", "city_id"),
    """SELECT 'state parity', CASE WHEN a = b THEN 'PASSED' ELSE 'FAILED' END,
      format('first: {}, second: {}', a, b) FROM (SELECT count(DISTINCT state_id) AS a FROM fact),
      (SELECT count(DISTINCT state_id) AS b FROM sampled)"""])


@query("dq_10_audit", X.sql(_AUDIT_SQL, "locations", "weather", extra={
    **_DIMS_SQL,
    "flagged_cities": """SELECT *, row_number() OVER (PARTITION BY state_id
        ORDER BY md5('42|' || city_id)) <= greatest(15,
          ceil(count(*) OVER (PARTITION BY state_id) * 0.3)) AS is_sampled FROM cities""",
    "named": """SELECT w.city_id AS station, l.city FROM weather w
      JOIN locations l ON l.town_id = w.city_id""",
    "fact": """SELECT c.city_id, c.state_id, c.is_sampled FROM named n
      JOIN flagged_cities c ON lower(trim(n.city)) = lower(trim(c.city_name))""",
    "sampled": "SELECT * FROM fact WHERE is_sampled"}))
def dq_10(spark, sf):
    """The whole silver audit on dimensions built from customers and their weather."""
    master = X.locations(spark, sf)
    towns = master.select(F.col("town_id").alias("city_id"), "city")
    hourly = X.weather(spark, sf).withColumn("city_id", F.col("city_id").cast("bigint")).join(
        towns, "city_id").drop("city_id")
    return quality.run_audit(plan.silver_checks(plan.build_silver(master, hourly)), fail=False)


@query("dq_10_audit_totals", X.sql(f"""
SELECT count(*) AS performed, count(*) FILTER (status = 'PASSED') AS passed,
  count(*) FILTER (status = 'FAILED') AS failed FROM ({" UNION ALL ".join([
    _unique("lineitem", "lineitem", "l_orderkey"), _unique("orders", "orders", "o_orderkey"),
    _present("fact", "enriched", "state_id")])})""", "enriched"))
def dq_10b(spark, sf):
    return quality.audit_totals(quality.union_checks([
        quality.check_pk(X.table(spark, sf, "lineitem"), "l_orderkey", "lineitem"),
        quality.check_pk(X.table(spark, sf, "orders"), "o_orderkey", "orders"),
        quality.check_fk_not_null(X.enriched(spark, sf), "state_id", "fact")]))


@query("dq_11_grain", """
SELECT 'lineitem grain' AS name, 'FAILED' AS status,
  format('repeated keys: {}', count(*)) AS details
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def dq_11(spark, sf):
    return quality.check_grain(X.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                               "lineitem")


@query("agg_18_duplicate_counts", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS count FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def agg_18(spark, sf):
    return present(profile.duplicate_counts(X.table(spark, sf, "lineitem"),
                                            ["l_orderkey", "l_linenumber"]))
