"""Contracts, header matching, facts and audits on broken inputs."""

import pytest
from pyspark.sql import functions as F

from fieldcast.operators import clean, dims, facts, quality
from fieldcast.plans import silver


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.require_columns(df, ["b"]).columns == ["b"]
    with pytest.raises(ValueError, match="missing columns: .'c'"):
        clean.require_columns(df, ["a", "c"])
    with pytest.raises(ValueError, match="duplicate"):
        clean.require_columns(df.select("a", "a", "b"), ["b"])


def test_match_columns_prefers_exact():
    cols = ["Temperature_2m (°C)", "temperature", "Wind Speed 10m", "DATE"]
    found = clean.match_columns(cols)
    assert found["temperature_2m"] == "temperature"
    assert found["wind_speed_10m"] == "Wind Speed 10m" and found["time"] == "DATE"
    assert "rain" not in found


def test_canonicalise_needs_time(spark):
    with pytest.raises(ValueError, match="time"):
        clean.canonicalise(spark.createDataFrame([(1.0,)], "temperature double"))


def test_coerce_types(spark):
    df = spark.createDataFrame([("2020-01-01 03:00", "1.5"), ("nope", "2"), ("2020-01-02", "x")],
                               "t string, v string")
    assert [r["v"] for r in clean.coerce_types(df, "t", ["v"]).orderBy("t").collect()] == [1.5, None]


def test_plausible_filter_edges(spark):
    rows = [(1, "d", -50.0, 0.0), (1, "d", 60.0, 100.0), (1, "d", 60.1, 50.0), (1, "d", 5.0, 101.0),
            (None, "d", 5.0, 50.0), (1, None, 5.0, 50.0), (1, "d", None, 50.0)]
    df = spark.createDataFrame(
        rows, "city_id int, date string, temperature_2m double, relative_humidity_2m double")
    assert clean.filter_plausible(df).count() == 2


def test_name_join_fans_out(spark):
    state = spark.createDataFrame([(1, "A"), (2, "B")], "state_id int, state_name string")
    city = spark.createDataFrame([(1, "Agra", 1), (2, "agra ", 2), (3, "Pune", 1)],
                                 "city_id int, city_name string, state_id int")
    raw = spark.createDataFrame([(" AGRA", 1.0), ("Pune", 2.0), ("Nowhere", 3.0)],
                                "city string, rain double")
    out = sorted((r["city_id"], r["state_name"], r["rain"])
                 for r in facts.build_fact(raw, city, state).collect())
    assert out == [(1, "A", 1.0), (2, "B", 1.0), (3, "A", 2.0)]


def dims_of(spark):
    master = spark.createDataFrame(
        [("Agra", "UP", "Agra", "North", 27.0, 78.0), ("Pune", "MH", "Pune", "West", 18.5, 73.8),
         ("Agra", "MH", "Nagpur", "West", 21.0, 79.0)],
        "city string, state string, district string, region string, lat double, lng double")
    return dims.build_dims(master)


def test_dims_have_sequential_keys(spark):
    region, state, city = dims_of(spark)
    assert {r["region_name"]: r["region_id"] for r in region.collect()} == {"North": 1, "West": 2}
    assert {r["state_name"]: r["state_id"] for r in state.collect()} == {"MH": 1, "UP": 2}
    assert [(r["city_id"], r["city_name"], r["state_id"]) for r in city.orderBy("city_id").collect()
            ] == [(1, "Agra", 1), (2, "Pune", 1), (3, "Agra", 2)]


def test_audits_fail_on_broken_dims(spark):
    region, state, city = dims_of(spark)
    city = city.withColumn("is_sampled", F.lit(True))
    fact = city.select("city_id", F.lit("MH").alias("state_name"))
    good = silver.Silver(region, state, city, fact, fact)
    assert quality.run_audit(silver.silver_checks(good)).filter("status = 'FAILED'").count() == 0

    twice = silver.Silver(region, state, city.union(city.limit(1)), fact, fact)
    with pytest.raises(ValueError, match="dim_city primary key"):
        quality.run_audit(silver.silver_checks(twice))
    orphan = silver.Silver(region, state, city.filter("city_id > 1"), fact, fact)
    failed = quality.run_audit(silver.silver_checks(orphan), fail=False).filter(
        "status = 'FAILED'").toPandas()
    assert set(failed["name"]) == {"dim_city key range", "fact_weather referential integrity"}
    unsampled = silver.Silver(region, state, city.withColumn("is_sampled", F.lit(False)), fact,
                              fact.filter("city_id < 0"))
    failed = quality.run_audit(silver.silver_checks(unsampled), fail=False).filter(
        "status = 'FAILED'").toPandas()
    assert set(failed["name"]) == {"dim_city is_sampled", "state parity"}


def test_null_key_is_found(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert quality.any_null_key(df, ["k"]) and not quality.any_null_key(df.dropna(), ["k"])
    assert quality.check_pk(df, "k", "t").first()["status"] == "FAILED"


def test_city_lists_have_one_shape(spark):
    df = spark.range(100).select(F.lit("s").alias("state"), F.col("id").cast("string").alias("city"))
    rows = dims.city_lists(df.unionByName(df)).collect()
    assert sorted(r.city for r in rows) == sorted(str(i) for i in range(100))
    assert {r.city_count for r in rows} == {100}


def test_silver_job_round_trip(spark, tmp_path):
    master = spark.createDataFrame(
        [(f"Town {i}", f"State {i % 3}", "D", "North", 20.0 + i, 75.0) for i in range(12)],
        "city string, state string, district string, region string, lat double, lng double")
    hourly = spark.createDataFrame(
        [(f" town {i} ", "2020-01-01", float(i)) for i in range(12)],
        "city string, date string, rain double")
    audit = silver.run_silver(master, hourly, str(tmp_path))
    assert audit.count() == 13
    assert spark.read.parquet(f"{tmp_path}/fact_weather").count() == 12
