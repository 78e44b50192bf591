"""Polygons, chunks, retrieval and matching against brute force."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcast.operators import crop, geo, text
from fieldcast.sources import readers

SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]
FAR = [[10, 10], [12, 10], [12, 12], [10, 12], [10, 10]]
NEXT = [[4, 0], [8, 0], [8, 4], [4, 4], [4, 0]]


@pytest.fixture
def polygons(spark, tmp_path):
    def feature(state, district, kind, coords):
        return {"type": "Feature", "properties": {"NAME_1": state, "NAME_2": district},
                "geometry": {"type": kind, "coordinates": coords}}
    path = tmp_path / "d.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        feature("A", "ring", "MultiPolygon", [[SQUARE, HOLE], [FAR]]),
        feature("B", "next", "Polygon", [NEXT])]}, indent=1))
    return readers.load_polygons(spark, str(path))


def test_polygons_with_holes_and_parts(spark, polygons):
    assert polygons.count() == 2
    pts = [(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 11.0, 11.0), (4, 6.0, 2.0), (5, 9.0, 9.0),
           (6, 4.0, 2.0), (7, 1.0, 2.0)]
    df = spark.createDataFrame(pts, "id int, lng double, lat double")
    got = {r["id"]: r["state"] for r in geo.spatial_join(df, polygons).collect()}
    # 2 is in the hole, 6 on the shared border (first id wins), 7 on the hole's border
    assert got == {1: "A", 2: None, 3: "A", 4: "B", 5: None, 6: "A", 7: "A"}
    near = {r["id"]: (r["state"], r["distance"]) for r in geo.nearest_polygon(
        df.filter("id IN (2, 5)"), polygons).collect()}
    assert near[2][0] == "A" and near[5][0] == "A"
    one_degree = np.pi / 180 * geo.EARTH_RADIUS
    assert near[2][1] == pytest.approx(one_degree, rel=1e-3)
    assert geo.enrich_points(df, polygons).filter("state IS NULL").count() == 0


def _mercator(lng, lat):
    return (geo.EARTH_RADIUS * np.radians(lng),
            geo.EARTH_RADIUS * np.log(np.tan(np.pi / 4 + np.radians(lat) / 2)))


@pytest.mark.parametrize("scale", [1.0, 1e-3])
def test_nearest_polygon_brute_force(spark, scale):
    """Long and short edges, a dense shape, far points, ties, repeats, points without place."""
    rng = np.random.default_rng(8)

    def star(cx, cy, radius, corners):
        turn = np.linspace(0, 2 * np.pi, corners, endpoint=False)
        ring = np.stack([cx + radius * np.cos(turn), cy + radius * np.sin(turn)], 1) * scale
        return [[float(a), float(b)] for a, b in [*ring, ring[0]]]

    box = [[x * scale, y * scale] for x, y in [(-20.0, -9.0), (21.0, -9.0), (21.0, -8.0),
                                               (-20.0, -8.0), (-20.0, -9.0)]]
    shapes = [("dense", [star(3, 3, 0.5, 500), star(3, 3, 0.2, 9)]), ("long", [box]),
              ("twin", [box]), ("dot", [[[9 * scale, 9 * scale]] * 3]), ("none", [])] + [
        (f"s{i}", [star(*rng.uniform(-9, 9, 2), rng.uniform(0.05, 2), 7)]) for i in range(9)]
    polys = spark.createDataFrame([(n, n.upper(), "d", r) for n, r in shapes],
                                  "polygon_id string, state string, district string, "
                                  "rings array<array<array<double>>>")
    places = [(a * scale, b * scale) for a, b in [*rng.uniform(-12, 12, (150, 2)), (3.0, 3.0),
                                                  (9.0, 9.0), (0.0, -20.0), (-80.0, 60.0)]]
    places += places[:3] + [(float(170), -80.0)] + [tuple(p) for p in shapes[0][1][0][:5]]
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(places)]
    points = spark.createDataFrame(rows + [(-1, None, 1.0), (-2, float("nan"), 1.0)],
                                   "id long, lng double, lat double")
    got = {r["id"]: r for r in geo.nearest_polygon(points, polys).collect()}
    assert len(got) == len(rows) + 2
    assert got[-1]["polygon_id"] is None and got[-2]["polygon_id"] is None
    for i, lng, lat in rows:
        x, y = _mercator(lng, lat)
        near = []
        for name, rings in shapes:
            for ring in rings:
                px, py = _mercator(*np.array(ring).T)
                dx, dy = np.diff(px), np.diff(py)
                length = dx * dx + dy * dy
                along = np.divide((x - px[:-1]) * dx + (y - py[:-1]) * dy, length,
                                  out=np.zeros_like(length), where=length > 0).clip(0, 1)
                near.append((np.hypot(x - px[:-1] - along * dx, y - py[:-1] - along * dy).min(),
                             name))
        least = min(near)[0]
        assert got[i]["distance"] == pytest.approx(least, rel=1e-9, abs=1e-6)
        assert got[i]["polygon_id"] in {n for d, n in near if d <= least * (1 + 1e-9) + 1e-6}
        assert got[i]["polygon_id"] != "twin" and got[i]["state"] == got[i]["polygon_id"].upper()
    assert geo.nearest_polygon(points, polys.limit(0)).filter("polygon_id IS NULL").count() == len(
        rows) + 2


@pytest.mark.parametrize("cell,most_edges", [(1.0, 256), (8.0, 40)])
def test_one_huge_polygon_among_small_ones(spark, cell, most_edges):
    """Stars with a hole, a jagged giant over all: the grid agrees with all edges of each."""
    rng = np.random.default_rng(6)

    def star(cx, cy, radius, corners):
        turn = np.linspace(0, 2 * np.pi, corners, endpoint=False)
        reach = radius * rng.uniform(0.6, 1.0, corners)
        ring = np.round(np.stack([cx + reach * np.cos(turn), cy + reach * np.sin(turn)], 1), 2)
        return [[float(a), float(b)] for a, b in [*ring, ring[0]]]

    shapes = [("p9", "giant", "all", [star(5, 5, 7, 400), star(5, 5, 1.5, 30)])] + [
        (f"p{i}", f"s{i}", "small", [star(rng.uniform(0, 10), rng.uniform(0, 10), 0.7, 9)])
        for i in range(8)] + [("q", "box", "lined up", [[[-3.0, 2.0], [2.0, 2.0], [2.0, 4.0],
                                                         [-3.0, 4.0], [-3.0, 2.0]]]),
                   ("r", "box", "on cell borders", [[[12.0, 8.0], [13.0, 8.0], [13.0, 16.0],
                                                     [12.0, 16.0], [12.0, 8.0]]])]
    polys = spark.createDataFrame(shapes, "polygon_id string, state string, district string, "
                                          "rings array<array<array<double>>>")
    spots = [(float(a), float(b)) for a, b in rng.uniform(-3, 18, (400, 2))]
    spots += [(float(a), float(b)) for a in range(-3, 13) for b in range(-3, 13)]
    spots += [tuple(p) for _, _, _, rings in shapes for p in rings[0][:20]]
    points = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spots)] + [
        (-1, None, 1.0)], "id long, lng double, lat double")
    found = {r.id: r.polygon_id for r in geo.spatial_join(
        points, polys, cell, most_edges=most_edges).collect()}
    whole = geo.with_edges(polys).agg(F.array_sort(F.collect_list(F.struct(
        "polygon_id", "edges"))).alias("a")).scalar()
    hit = F.get(F.filter("whole", lambda p: geo.intersects(F.col("lng"), F.col("lat"),
                                                           p["edges"])), 0)
    wanted = {r.id: r.p for r in points.withColumn("whole", whole).select(
        "id", hit["polygon_id"].alias("p")).collect()}
    assert found == wanted
    leaves, splits = geo.cell_index(polys, cell, most_edges)
    if most_edges == 40:
        assert splits
        most = leaves.select(F.aggregate("_polys", F.lit(0), lambda n, p: n + F.size(p["edges"]))
                             .alias("n")).agg(F.max("n")).first()[0]
        assert most <= 40


def test_split_keeps_separators_and_overlap():
    body = "# Guide\n## Sowing\n" + "sow the seed early " * 20 + "\n## Water\n" + "water it " * 10
    chunks = text.split_text(body, 120, 30)
    assert all(len(c) <= 120 for c in chunks)
    assert chunks[0] == "# Guide" and any(c.startswith("## Water") for c in chunks)
    assert chunks[1] == "## Sowing"  # the long piece after it is cut at blanks
    tail = chunks[2][-20:].strip()
    assert tail in chunks[3][:40]  # overlap repeats the tail
    joined = " ".join(chunks)
    assert all(w in joined for w in body.split())


def test_split_edge_cases():
    assert text.split_text("short") == ["short"]
    assert text.split_text("x" * 700) == ["x" * 700]  # nothing to cut at
    assert text.split_text("aa bb", 4, 0) == ["aa", "bb"]
    assert text.split_text("aa bb cc dd", 6, 3) == ["aa bb", "bb cc", "cc dd"]


def test_chunk_documents_handles_null_and_blank(spark):
    df = spark.createDataFrame([(1, None), (2, "  "), (3, "one two")], "id int, text string")
    out = text.chunk_documents(df).collect()
    assert [(r["id"], r["position"], r["page_content"]) for r in out] == [(3, 0, "one two")]


@pytest.mark.parametrize("block_values", [20_000_000, 8])
def test_similarity_matches_brute_force(spark, block_values):
    rng = np.random.default_rng(0)
    items, queries = rng.normal(size=(300, 4)), rng.normal(size=(7, 4))
    items[5] = items[9]  # a tie
    i = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(items)],
                              "item_id long, embedding array<double>").repartition(5)
    q = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(queries)],
                              "query_id long, embedding array<double>")
    out = text.similarity_topk(q, i, k=4, block_values=block_values).toPandas()
    scores = queries @ items.T
    for k in range(7):
        want = sorted(range(300), key=lambda j: (-round(scores[k, j], 12), j))[:4]
        assert out[out["query_id"] == k].sort_values("rank")["item_id"].tolist() == want


def test_embeddings_find_the_same_text(spark):
    docs = spark.createDataFrame([(0, "rice needs water"), (1, "wheat in winter"),
                                  (2, "cotton pests and spray")], "item_id long, page_content string")
    vec = text.embed(docs, features=64)
    q = vec.select(F.col("item_id").alias("query_id"), "embedding")
    out = text.similarity_topk(q, vec, k=1).collect()
    assert all(r["query_id"] == r["item_id"] for r in out)
    assert all(r["score"] == pytest.approx(1.0) for r in out)


def test_similarity_of_repeated_rows_and_mixed_lengths(spark):
    """Each query row gets its k items, each item row is one, only equal lengths meet."""
    schema = "embedding array<double>"
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]),
                                     (2, [1.0, 1.0, 1.0]), (3, []), (4, [float("nan"), 1.0])],
                                    f"query_id int, {schema}")
    items = spark.createDataFrame([("a", [2.0, 1.0]), ("b", [1.0, 3.0]), ("b", [1.0, 3.0]),
                                   ("c", [1.0, 1.0, 0.0]), (None, [9.0, 9.0])],
                                  f"item_id string, {schema}")
    for block_values in (1, 4, 100):
        got = sorted((r.query_id, r["rank"], r.item_id, r.score) for r in text.similarity_topk(
            queries, items, k=2, block_values=block_values).collect())
        assert got == sorted([(1, 1, "a", 2.0), (1, 2, "b", 1.0), (1, 1, "b", 3.0),
                              (1, 2, "b", 3.0), (1, 1, "b", 3.0), (1, 2, "b", 3.0),
                              (2, 1, "c", 2.0)])


@pytest.mark.parametrize("k", [1, 2, 5])
def test_keyword_topk_brute_force(spark, k):
    names = ["Rice", "RICE", "ice", "Maize", "zz", "of rice", " rice", "e", "-", "price of",
             "\u00dcber", "x.y", "maize  and", "  "]
    texts = ["RICE and maize", "ice only", "price of rice", "nothing", "maize", None, "",
             "\u00fcber-ice  of rice", "x.y\tice", "xzy", "maize  and\nice", "ice only",
             "a price of rice, a price of maize " * 50]
    rows = [("s", i, t) for i, t in enumerate(texts)] + [("s", 1, texts[1])] * 2
    chunks = spark.createDataFrame(rows, "source string, position int, page_content string")
    q = spark.createDataFrame([(n,) for n in names + names[:2]] + [(None,)], "crop_name string")
    out = text.keyword_topk(q, chunks.repartition(3), k)
    assert out.columns == ["crop_name", *chunks.columns, "rank"]
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["crop_name"], r["rank"])):
        assert r["page_content"] == texts[r["position"]]
        got.setdefault(r["crop_name"], []).append(r["position"])
    want = {n: sorted(i for _, i, t in rows if t and n.lower() in t.lower())[:k]
            for n in names}
    assert got == {n: found for n, found in want.items() if found}


def test_clean_chunks(spark):
    df = spark.createDataFrame([("a", 0, "## Title \nbody"), ("b", 1, " ## Title \nbody "),
                                ("b", 2, "x # y")], "source string, position int, page_content string")
    out = {(r["source"], r["page_content"]) for r in text.clean_chunks(df).collect()}
    assert out == {("a", "**Title**\nbody"), ("b", "x # y")}


def test_location_text(spark):
    df = spark.createDataFrame([("Pune", "pune", "MH"), ("Pune", "Haveli", None)],
                               "city string, district string, state string")
    assert [r[0] for r in df.select(text.location_text()).collect()] == [
        "City: Pune, State: MH", "City: Pune, District: Haveli"]


def profile_frame(spark):
    rows = [("R", "S", "D", f"c{i}", "Kharif", 20.0 + i, 50.0 + i, 300.0 * i, 5.0, 10.0, 50 + 5 * i)
            for i in range(6)]
    return spark.createDataFrame(rows, (
        "region_name string, state_name string, district string, city_name string, season string, "
        "avg_temperature_2m double, avg_humidity double, season_rainfall double, "
        "avg_wind_speed_10m double, solar_proxy double, days_observed int"))


def crop_frame(spark):
    rows = [(f"crop{i}", 15.0 + i % 7, 40.0 + 3 * (i % 5), 100.0 * (i % 9), 4.0, 11.0, 6.5,
             500.0 * i, 3) for i in range(23)]
    return spark.createDataFrame(rows, (
        "Crop string, Temperature_C double, `Humidity_%` double, Rainfall_mm double, "
        "Wind_Speed_m_s double, Solar_Radiation_MJ_m2_day double, pH double, "
        "avg_yield_kg_per_ha double, observations int"))


def test_match_in_blocks_equals_one_block(spark):
    crops = crop.attach_feature_weights(crop_frame(spark))
    whole = crop.build_crop_weather_match(profile_frame(spark), crops).toPandas()
    parts = crop.build_crop_weather_match(profile_frame(spark), crops, per_block=5).toPandas()
    key = ["city_name", "crop_rank", "crop_name"]
    assert len(whole) >= 30
    assert whole.sort_values(key)[[*key, "match_score"]].values.tolist() == parts.sort_values(
        key)[[*key, "match_score"]].values.tolist()
    assert set(whole["match_confidence"]) == {"High", "Low"}


def test_constant_feature_spans_one(spark):
    row = crop.feature_ranges(crop_frame(spark), ["Wind_Speed_m_s"]).first()
    assert row["span_Wind_Speed_m_s"] == 1.0


def test_suitability_example(spark):
    """Rice at its own ideal conditions scores 100."""
    cond = spark.createDataFrame([(1, 26.0, 1100.0, 78.0, 6.5, None)],
                                 "id int, temperature double, rainfall double, humidity double, "
                                 "ph double, season string")
    out = crop.predict_suitability(cond, crop.base_crops(spark)).toPandas()
    assert len(out) == 26
    best = out.sort_values("suitability_score", ascending=False).iloc[0]
    assert best["crop"] == "Rice" and best["suitability_score"] == 100.0
    top = crop.predict_suitability(cond, crop.base_crops(spark), top=3, per_block=4).toPandas()
    want = out.nlargest(3, "suitability_score")["suitability_score"].tolist()
    assert sorted(top["suitability_score"], reverse=True) == want


def test_out_of_season_penalty(spark):
    cond = spark.createDataFrame([(1, 26.0, 1100.0, 78.0, 6.5, "Winter (Rabi)")],
                                 "id int, temperature double, rainfall double, humidity double, "
                                 "ph double, season string")
    rows = {r["crop"]: r for r in crop.predict_suitability(cond, crop.base_crops(spark)).collect()}
    assert rows["Rice"]["suitability_score"] == 45.0
    assert rows["Rice"]["in_season"] == "Out of Season"
    assert rows["Banana"]["in_season"] == "In Season"  # whole year


def test_recency_weights_recent_years(spark):
    df = spark.createDataFrame([("s", "k", 2015, 10.0), ("s", "k", 2025, 20.0)],
                               "state string, season string, year int, temp double")
    w = 0.85 ** 10
    got = crop.recency_climate(df, measures=("temp",)).first()["temp"]
    assert got == round((10 * w + 20) / (w + 1), 1)
    assert crop.recency_climate(df, measures=("temp",), decay=None).first()["temp"] == 15.0


def test_chunking_holds_few_texts_at_a_time(spark):
    """Chunks of a whole Arrow batch used to be held at once; kept columns stay with their text."""
    import pyarrow as pa

    texts = pa.array(["a" * 40, None, "", "b" * 70, "c", "d" * 10])
    assert list(text._pieces(texts, 50)) == [(0, 4), (4, 6)]
    assert list(text._pieces(texts.slice(0, 0), 50)) == []
    rows = [(i, f"word{i} " * (i % 400) if i % 7 else None, [i]) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, text string, more array<int>").coalesce(1)
    out = text.chunk_documents(df)
    assert out.columns == ["k", "more", "position", "page_content"]
    got = [(r["k"], r["more"], r["position"], r["page_content"]) for r in out.collect()]
    assert got == [(k, m, p, c) for k, t, m in rows
                   for p, c in enumerate(text.split_text(t) if t else [])]
