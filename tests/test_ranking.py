"""Numbering, sampling, de-duplication and quantiles against brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldcast.operators import ranking, sampling
from fieldcast.operators.quantiles import exact_quantiles, quantile_table


def test_global_order_numbers_all_rows(spark):
    df = spark.range(5000).select((F.hash("id") % 100000).alias("a"), "id")
    out = ranking.global_order(df, ["a", "id"]).toPandas().sort_values(["a", "id"])
    assert out["row_id"].tolist() == list(range(1, 5001))


def test_global_order_weight_is_running_total(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("w"))
    out = ranking.global_order(df, ["id"], "total", weight="w").toPandas().sort_values("id")
    assert out["total"].tolist() == np.cumsum(np.arange(1000) % 7).tolist()


def test_dense_rank_shares_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 5.0), (4, None)], "k int, v double")
    out = {r["k"]: r["r"] for r in ranking.global_dense_rank(df, "v", "r").collect()}
    assert out == {2: 1, 1: 2, 3: 2, 4: 3}


def test_hashed_rank_in_a_hot_group(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") < 2500, "hot").otherwise(F.col("id").cast("string")).alias("g"),
        F.md5(F.col("id").cast("string")).alias("h"))
    out = ranking.hashed_rank(df, ["g"], "h").toPandas()
    want = out.sort_values("h").groupby("g").cumcount() + 1
    assert (out.sort_values("h")["rank"] == want).all()
    assert (out.groupby("g")["group_total"].first() == out.groupby("g").size()).all()


@pytest.mark.parametrize("size", [1, 14, 15, 16, 50, 51, 200])
def test_stratified_counts(spark, size):
    df = spark.range(size).select(F.lit(1).alias("state_id"), F.col("id").alias("city_id"))
    flagged = sampling.stratified_flag(df).filter("is_sampled").count()
    assert flagged == min(size, max(15, math.ceil(0.3 * size)))


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(400).select((F.col("id") % 3).alias("state_id"), F.col("id").alias("city_id"))
    def picked(d):
        return {r["city_id"] for r in sampling.stratified_flag(d).filter("is_sampled").collect()}
    assert picked(df.repartition(1)) == picked(df.repartition(13))


def test_cap_sample_and_top_up(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert sampling.cap_sample(df, 37, ["k"]).count() == 37
    assert sampling.cap_sample(df, 5000, ["k"]).count() == 1000
    out = sampling.top_up(df, df.filter("k < 10"), "k", 50).toPandas()
    assert len(out) == 50 and set(range(10)) <= set(out["k"])


def test_dedup(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 9, None), (None, 3, "x"),
                                (None, 2, "y")], "k int, o int, v string")
    first = {(r["k"], r["o"], r["v"]) for r in ranking.dedup_first(df, ["k"], ["o"]).collect()}
    assert first == {(1, 1, "a"), (2, 9, None), (None, 2, "y")}
    assert [tuple(r) for r in ranking.dedup_none(df, ["k"]).collect()] == [(2, 9, None)]


def test_select_even_matches_linspace(spark):
    names = [f"c{i:03d}" for i in range(97)]
    df = spark.createDataFrame([(n,) for n in names], "city string")
    preferred = df.filter("city IN ('c005', 'c050')")
    out = {r["city"] for r in ranking.select_even(df, "city", preferred, 20).collect()}
    rest = [n for n in names if n not in ("c005", "c050")]
    want = {rest[i] for i in np.linspace(0, len(rest) - 1, 18, dtype=int)} | {"c005", "c050"}
    assert out == want


def test_group_helpers_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "g int, v double")
    out = sorted((r["g"] or 0, r["v"], r["v_anomaly"])
                 for r in ranking.group_anomaly(df, "g", ["v"]).collect())
    assert out == [(0, 1.0, -1.0), (0, 3.0, 1.0), (1, 5.0, 0.0)]


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6) | st.sampled_from([0.0, 1.5]), min_size=1,
                       max_size=60),
       p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]))
def test_quantiles_of_small_groups(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [p]).first()["value"]
    assert got == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


def test_quantiles_of_large_skewed_groups(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"g": np.where(rng.random(60000) < 0.7, "hot", "cold"),
                          "x": rng.lognormal(size=60000), "z": rng.integers(0, 3, 60000) * 1.0})
    out = quantile_table(spark.createDataFrame(frame), ["x", "z"],
                         {"q1": 0.25, "q2": 0.5, "q3": 0.75}, ["g"]).toPandas()
    for g, part in frame.groupby("g"):
        for col in ("x", "z"):
            row = out[(out["g"] == g) & (out["feature"] == col)].iloc[0]
            assert [row["q1"], row["q2"], row["q3"]] == pytest.approx(
                np.quantile(part[col], [0.25, 0.5, 0.75]))


@pytest.mark.parametrize("accuracy,most_cells", [(10000, 20_000), (10000, 7), (2, 20_000), (2, 5)])
def test_quantiles_where_brackets_are_wide_or_miss(spark, accuracy, most_cells):
    """A poor sketch misses ranks; few cells force narrowing; ties never end it wrongly."""
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"g": ["a"] * 3000 + ["b"] * 40 + [None] * 5,
                          "x": np.concatenate([rng.lognormal(0, 3, 3000), np.arange(40.0) - 20,
                                               [1.0, 1.0, 2.0, np.nan, -1e300]]),
                          "z": rng.integers(0, 2, 3045) * 1.0})
    probs = [0.0, 0.01, 0.5, 0.75, 1.0]
    out = exact_quantiles(spark.createDataFrame(frame), ["x", "z"], probs, ["g"], accuracy,
                          most_cells).toPandas()
    assert len(out) == 3 * 2 * len(probs)
    for (g, feature), part in out.groupby(["g", "feature"], dropna=False):
        rows = frame[frame["g"].isna() if pd.isna(g) else frame["g"] == g][feature].dropna()
        assert part.sort_values("p")["value"].tolist() == pytest.approx(
            np.quantile(rows, probs), rel=1e-12)


@pytest.mark.parametrize("digits,most", [(3, 5000), (1, 3)])
def test_smallest_hashes_against_ranks(spark, digits, most):
    """Groups of all sizes, null keys, repeated keys, quotas of none and of more than there are."""
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"g": rng.choice(["hot", "cold", "rare", None], 4000,
                                          p=[0.9, 0.08, 0.01, 0.01]),
                          "id": rng.integers(0, 3500, 4000)})
    df = spark.createDataFrame(frame).withColumn("h", ranking.order_hash("id", seed=1))
    for quota in (F.lit(0), F.lit(25), F.ceil(F.col("group_total") * 0.3), F.lit(10_000)):
        for keys in (["g"], []):
            out = ranking.smallest_hashes(df, keys, "h", quota, "s", digits, most).toPandas()
            assert len(out) == 4000 and list(out.columns) == ["g", "id", "h", "s"]
            for _, part in (out.groupby("g", dropna=False) if keys else [(0, out)]):
                n = len(part)
                want = {"0": 0, "25": 25, "10000": n}.get(
                    str(quota).split("'")[1], int(np.ceil(n * 0.3)))
                assert part["s"].sum() == min(n, want)
                taken, left = part[part["s"]]["h"], part[~part["s"]]["h"]
                assert not len(taken) or not len(left) or taken.max() <= left.min()


@pytest.mark.parametrize("rich,balance", [(60, 1), (50, 1), (49, 2), (3, 5)])
def test_select_even_and_its_sql_keep_to_fifty(spark, tmp_path, rich, balance):
    """The SQL used to return all preferred names, and none beside 49 of them."""
    import duckdb

    from catalog import silver
    from catalog.registry import ORACLES

    rows = [(f"c{i * 37 % 211:03d}", "BUILDING", 9900.0 if i < rich else 1.0) for i in range(211)]
    path = str(tmp_path / "customer.parquet")
    spark.createDataFrame(rows, "c_name string, c_mktsegment string, c_acctbal double").write.parquet(
        path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(con.execute(ORACLES["srt_03_select_even"]).fetchall())
    got = sorted(tuple(r) for r in silver.srt_03(spark, str(tmp_path)).collect())
    assert got == want and len(got) == 50
    assert sum(how == "preferred" for _, how in got) == min(rich, 50)


def test_cities_of_equal_index_share_a_rank(spark):
    """Means of the same days in another order used to differ in the last bits."""
    from fieldcast.operators import renewable

    # one city has each day three times: the same mean from other sums
    days = [(c, float(v % 20), float(v % 97)) for c, times in ((1, 1), (2, 3), (3, 7))
            for v in range(1, 180) for _ in range(times)]
    daily = spark.createDataFrame(days, "city_id int, wind double, cloud double").select(
        F.lit(1).alias("region_id"), F.lit(1).alias("state_id"), "city_id",
        F.lit(6).alias("month"), F.col("wind").alias("avg_wind_speed_10m"),
        F.col("wind").alias("avg_wind_speed_100m"), F.col("cloud").alias("avg_cloud_cover"),
        F.col("wind").alias("max_wind_speed_10m"), F.col("wind").alias("max_wind_speed_100m"))
    plain = renewable.renewable_summary(renewable.renewable_scores(daily)).select(
        "renewable_index").distinct().count()
    assert plain > 1
    out = renewable.build_renewable_ranking(daily).collect()
    assert [r["renewable_rank"] for r in out] == [1, 1, 1]
    assert len({r["renewable_index"] for r in out}) == 1


def test_quantiles_of_few_kinds_need_no_brackets(spark, monkeypatch):
    """Columns of few distinct values used to go through sketch and brackets as well."""
    from fieldcast.operators import quantiles

    monkeypatch.setattr(quantiles, "_picked", None)
    rng = np.random.default_rng(8)
    frame = pd.DataFrame({"g": rng.choice(["a", "b", None], 3000), "x": rng.integers(0, 50, 3000) / 8,
                          "z": np.where(rng.random(3000) < 0.1, np.nan, rng.integers(-3, 3, 3000))})
    for keys in (["g"], []):
        out = exact_quantiles(spark.createDataFrame(frame), ["x", "z"], [0.0, 0.25, 0.5, 0.99, 1.0],
                              keys).toPandas()
        groups = frame.groupby("g", dropna=False) if keys else [(None, frame)]
        for g, part in groups:
            for col in ("x", "z"):
                mine = out[out["feature"] == col]
                if keys:
                    mine = mine[mine["g"].isna() if pd.isna(g) else mine["g"] == g]
                assert mine.sort_values("p")["value"].tolist() == pytest.approx(
                    np.quantile(part[col].dropna(), [0.0, 0.25, 0.5, 0.99, 1.0]), rel=1e-12)
