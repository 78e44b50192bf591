"""Statistics against numpy and pandas, clustering by invariants."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldcast.operators import ml, profile, rollup, stats


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    a = rng.normal(size=800)
    return pd.DataFrame({"a": a, "b": a * 2 + rng.normal(size=800), "c": rng.integers(0, 4, 800) * 1.0,
                         "d": rng.exponential(size=800) + 5})


def test_spearman_with_ties(spark, frame):
    got = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in stats.spearman_pairs(
        spark.createDataFrame(frame), list(frame)).collect()}
    want = frame.rank().corr()
    assert all(v == pytest.approx(want.loc[k], abs=1e-9) for k, v in got.items()) and len(got) == 6


@pytest.mark.parametrize("intercept", [True, False])
def test_vif_by_regression(spark, frame, intercept):
    cols = ["a", "b", "d"]
    got = {r["feature"]: r["vif"] for r in stats.vif(
        spark.createDataFrame(frame), cols, intercept).collect()}
    for c in cols:
        x = frame[[o for o in cols if o != c]].to_numpy()
        y = frame[c].to_numpy()
        if intercept:
            x = np.column_stack([x, np.ones(len(y))])
        resid = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        total = ((y - y.mean()) ** 2).sum() if intercept else (y ** 2).sum()
        assert got[c] == pytest.approx(total / (resid ** 2).sum())


def test_skew_and_kurtosis_match_pandas(spark, frame):
    out = profile.describe_plus(spark.createDataFrame(frame), list(frame)).toPandas().set_index(
        "feature")
    for c in frame:
        assert out.loc[c, "skewness"] == pytest.approx(frame[c].skew())
        assert out.loc[c, "kurtosis"] == pytest.approx(frame[c].kurt())
        assert out.loc[c, "median"] == pytest.approx(frame[c].median())


# reference points of Student's t: (t, degrees of freedom, two-sided p)
@pytest.mark.parametrize("t,dof,p", [
    (1.0, 1, 0.5), (12.706204736, 1, 0.05), (4.302652730, 2, 0.05), (2.570581836, 5, 0.05),
    (2.228138852, 10, 0.05), (3.169272673, 10, 0.01), (0.0, 7, 1.0), (2.042272456, 30, 0.05)])
def test_p_values(spark, t, dof, p):
    got = spark.range(1).select(stats.t_two_sided_p(F.lit(t), F.lit(dof)).alias("p")).first()["p"]
    assert got == pytest.approx(p, abs=1e-8)


def test_linear_trend_needs_points_and_handles_exact_fit(spark):
    df = spark.createDataFrame([("x", i, 2.0 * i) for i in range(5)] + [("y", 1, 1.0)],
                               "k string, x int, y double")
    out = stats.linear_trend(df, ["k"], "x", "y").collect()
    assert [(r["k"], r["slope"]) for r in out] == [("x", 2.0)]
    assert out[0]["p_value"] == pytest.approx(0.0, abs=1e-12)


def test_robust_anomalies(spark):
    df = spark.createDataFrame([(i, float(i % 5), 1.0) for i in range(40)] + [(99, 500.0, 1.0)],
                               "k int, v double, flat double")
    out = profile.robust_anomalies(df, "k", ["v", "flat"]).toPandas().set_index("k")
    v = pd.Series([float(i % 5) for i in range(40)] + [500.0])
    mad = (v - v.median()).abs().median()
    assert out.loc[99, "v_robust_z"] == pytest.approx(0.6745 * (500 - v.median()) / mad)
    assert out.loc[99, "anomaly_flag"] == "REVIEW" and (out["anomaly_count"] > 0).sum() == 1
    assert (out["flat_robust_z"] == 0).all()


def test_kmeans_assigns_nearest_centre(spark, frame):
    scaled, pipeline = ml.build_ml_pipeline(spark.createDataFrame(frame), list(frame))
    model, pred = ml.train_kmeans(scaled, 4)
    x = np.array([r["v"] for r in scaled.select(vector_to_array("features").alias("v")).collect()])
    assert x.mean(axis=0) == pytest.approx(0, abs=1e-9)
    assert x.std(axis=0, ddof=1) == pytest.approx(1)
    centres = np.array(model.clusterCenters())
    rows = pred.select(vector_to_array("features").alias("v"), "cluster_id").collect()
    for r in rows:
        d = np.linalg.norm(centres - np.array(r["v"]), axis=1)
        assert d[r["cluster_id"]] == pytest.approx(d.min())
    assert model.summary.trainingCost < ((x - x.mean(axis=0)) ** 2).sum()


def test_score_nearest_with_zero_deviation(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([9.0, 5.0],)], "v array<double>")
    params = spark.createDataFrame([(0, [-1.0, 0.0]), (1, [1.0, 0.0])],
                                   "cluster_id int, centroid array<double>")
    means, sds = F.array(F.lit(5.0), F.lit(5.0)), F.array(F.lit(4.0), F.lit(0.0))
    out = [(r["cluster_id"], r["distance_to_centroid"])
           for r in ml.score_nearest(df, "v", params, means, sds).collect()]
    assert out == [(0, 0.0), (1, 0.0)]


def test_best_k_is_first_best(spark, frame):
    scaled, _ = ml.build_ml_pipeline(spark.createDataFrame(frame), ["a", "b"])
    best, table = ml.evaluate_optimal_k(scaled, 2, 4)
    rows = table.collect()
    assert best == max(rows, key=lambda r: r["silhouette"])["k"]
    assert [r["is_best"] for r in rows].count(True) == 1


def test_representatives_are_members(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(f"c{i}", float(x), float(y)) for i, (x, y) in enumerate(
        rng.normal(size=(120, 2)))] + [("gone", None, 1.0)], "city string, lat double, lng double")
    out = ml.representatives(df, 10)
    assert 1 <= out.count() <= 10 and out.select("cluster").distinct().count() == out.count()
    assert out.filter("city = 'gone'").count() == 0


def test_time_split_needs_four_years(spark):
    df = spark.createDataFrame([(y,) for y in (2018, 2019, 2020)], "year int")
    with pytest.raises(Exception, match="four years"):
        ml.time_split(df).collect()


def test_leakage_is_reported(spark):
    bad = spark.createDataFrame([("train", "2020-05-01", "2020-12-31"),
                                 ("validation", "2020-06-01", "2020-12-31"),
                                 ("test", "2021-01-01", "2021-12-31")],
                                "data_split string, start_date string, end_date string")
    with pytest.raises(Exception, match="leakage"):
        ml.check_leakage(bad).collect()


def test_mutual_information_of_copies(spark):
    df = spark.createDataFrame([(float(i), float(i), float(i * 7919 % 256)) for i in range(256)],
                               "x double, y double, z double")
    out = {r["feature"]: r["mutual_information"] for r in stats.mutual_information(
        df, ["y", "z"], "x", bins=4).collect()}
    assert out["y"] == pytest.approx(np.log(4))
    assert out["z"] < 0.2


def test_peak_month_tie_goes_to_first(spark):
    df = spark.createDataFrame([("c", 5, 1.0), ("c", 3, 1.0), ("c", 7, 0.5)],
                               "city string, month int, precip_total double")
    assert rollup.peak_month(df).first()["peak_month"] == 3


def test_pearson_pairs_in_one_pass_over_batches(spark):
    """All pairs against pandas: gaps, far means, a constant and an empty column, many batches."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=500)
    frame = pd.DataFrame({"a": base + 1e6, "b": 3 * base + rng.normal(size=500), "c": 0.1,
                          "d": rng.normal(size=500) * 1e-4, "e": np.nan,
                          "f": np.where(rng.random(500) < 0.4, np.nan, base ** 2)})
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in frame.to_numpy()]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame)).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        pairs = stats.pearson_pairs(df, list("abcdef"))
        plan = pairs._jdf.queryExecution().toString()
        got = {(r.feature_1, r.feature_2): r.correlation for r in pairs.collect()}
        assert "corr(" not in plan and len(got) == 15
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for (x, y), r in got.items():
        if "c" in (x, y) or "e" in (x, y):
            assert r is None
        else:
            assert abs(r - frame[x].corr(frame[y])) < 1e-9
    none = stats.pearson_pairs(df.limit(0), ["a", "b"]).collect()
    assert [tuple(r) for r in none] == [("a", "b", None)]
