"""Cases at the edge: missing values, empty sides, ties, and reference tables of several blocks."""

import pytest
from pyspark.sql import functions as F

from fieldcast.operators import crop, geo, ranking, text
from fieldcast.session import checkpoint


def test_points_without_coordinates_get_no_polygon(spark):
    square = [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]
    polys = spark.createDataFrame([(1, "A", "D", square)], "polygon_id int, state string, "
                                  "district string, rings array<array<array<double>>>")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 5.0, 5.0), (3, None, None), (4, 1.0, None)],
                                   "id int, lng double, lat double")
    rows = {r.id: r.state for r in geo.enrich_points(points, polys).collect()}
    assert rows == {1: "A", 2: "A", 3: None, 4: None}


def test_missing_measures_have_no_weight(spark):
    series = spark.createDataFrame([("s", "k", 2020, 10.0, None), ("s", "k", 2021, None, None)],
                                   "state string, season string, year int, temp double, rain double")
    row = crop.recency_climate(series, measures=("temp", "rain")).first()
    assert row.temp == 10.0 and row.rain is None


def test_first_rows_with_maps_and_ties(spark):
    rows = spark.createDataFrame([("a", 1, 5, {"x": 1}), ("a", 1, 3, {"y": 2}), ("a", 2, 0, {}),
                                  ("b", None, 1, None)], "k string, o int, v int, m map<string,int>")
    got = {r.k: (r.o, r.v, r.m) for r in ranking.dedup_first(rows, ["k"], ["o"]).collect()}
    assert got == {"a": (1, 3, {"y": 2}), "b": (None, 1, None)}


@pytest.mark.parametrize("block_values", [20_000_000, 4])
def test_similarity_edges(spark, block_values, monkeypatch):
    monkeypatch.setattr(text, "PRODUCT_VALUES", 3)
    schema = "embedding array<double>"
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])],
                                    f"query_id int, {schema}")
    items = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(9)] + [
        (20, None), (21, [None, 1.0])], f"item_id int, {schema}").coalesce(1)
    got = sorted((r.query_id, r["rank"], r.item_id, r.score) for r in text.similarity_topk(
        queries, items, k=2, block_values=block_values).collect())
    assert got == [(1, 1, 2, 2.0), (1, 2, 5, 2.0), (3, 1, 0, 1.0), (3, 2, 1, 1.0)]
    assert text.similarity_topk(queries.limit(0), items).count() == 0
    assert text.similarity_topk(queries, items.limit(0)).count() == 0


def test_no_names(spark):
    chunks = spark.createDataFrame([("s", 1, "wheat and rice"), ("s", 2, None)],
                                   "source string, position int, page_content string")
    names = spark.createDataFrame([("Rice",), ("",), (None,)], "crop_name string")
    assert [r.crop_name for r in text.keyword_topk(names, chunks).collect()] == ["Rice"]
    none = text.keyword_topk(names.limit(0), chunks)
    assert none.count() == 0 and "rank" in none.columns


@pytest.mark.parametrize("per_block", [1, 5, 5000])
def test_equal_conditions_keep_their_rows(spark, per_block):
    crops = spark.createDataFrame(
        [(f"c{i}", 20.0 + i, 2.0, 500.0, 90.0, 60.0, 5.0, 6.5, 0.5, 1.0, 1.0, 1.0, 9.0,
          ["kharif"]) for i in range(9)],
        "crop string, temp_mean double, temp_std double, rainfall_mean double, "
        "rainfall_std double, humidity_mean double, humidity_std double, ph_mean double, "
        "ph_std double, n_req double, p_req double, k_req double, avg_yield double, "
        "seasons array<string>")
    asked = spark.createDataFrame([(24.0, 500.0, 60.0, 6.5, "kharif")] * 2,
                                  "temperature double, rainfall double, humidity double, "
                                  "ph double, season string")
    rows = crop.predict_suitability(asked, crops, top=3, per_block=per_block).collect()
    assert len(rows) == 6
    assert sorted({r.crop for r in rows}) == ["C3", "C4", "C5"]
    assert crop.predict_suitability(asked, crops, per_block=per_block).count() == 18


def test_checkpoint_cuts_lineage(spark):
    assert checkpoint(spark.range(3).withColumn("x", F.lit(1))).count() == 3
