"""Polygons, chunks and retrieval."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import fixtures as X
from catalog.registry import present, query, rd
from fieldcast.operators import geo, text


# ---------------------------------------------------------------- polygons
def polygons(spark, sf):
    """Each nation is a plot of a 5 x 5 grid: a square, or an L where its key is odd."""
    n = F.col("n_nationkey")
    x, y = F.lit(70.0) + n % 5 * 4, F.lit(8.0) + F.floor(n / 5) * 4

    def ring(*points):
        return F.array(F.array(*[F.array(x + dx, y + dy) for dx, dy in points]))

    square = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    ell = ring((0, 0), (4, 0), (4, 1.5), (1.5, 1.5), (1.5, 4), (0, 4), (0, 0))
    return X.table(spark, sf, "nation").select(
        n.cast("string").alias("polygon_id"), F.col("n_name").alias("state"),
        F.concat(F.lit("plot "), n.cast("string")).alias("district"),
        F.when(n % 2 == 1, ell).otherwise(square).alias("rings"))


def points(spark, sf):
    """Customers on a grid that falls inside, outside and on the borders of the plots."""
    k = F.col("c_custkey")
    return X.table(spark, sf, "customer").select(
        k.alias("town_id"), (F.lit(68.0) + k * 13 % 97 * 0.25).alias("lng"),
        (F.lit(6.5) + k * 7 % 97 * 0.25).alias("lat"))


# the border belongs to the plot; of two plots that share it the smaller id (as text) counts
_GEO = {
    "points": """SELECT c_custkey AS town_id,
      68.0::DOUBLE + (c_custkey * 13 % 97) * 0.25::DOUBLE AS lng,
      6.5::DOUBLE + (c_custkey * 7 % 97) * 0.25::DOUBLE AS lat FROM customer""",
    "plots": """SELECT n_nationkey::VARCHAR AS polygon_id, n_name AS state,
      'plot ' || n_nationkey AS district, n_nationkey % 2 = 1 AS ell,
      70.0::DOUBLE + n_nationkey % 5 * 4 AS x, 8.0::DOUBLE + n_nationkey // 5 * 4 AS y
      FROM nation""",
    "matched": """SELECT town_id, lng, lat, min(polygon_id) AS polygon_id
      FROM points LEFT JOIN plots ON lng BETWEEN x AND x + 4 AND lat BETWEEN y AND y + 4
        AND (NOT ell OR lng <= x + 1.5 OR lat <= y + 1.5) GROUP BY ALL""",
    "edges": """SELECT polygon_id, x + a AS x1, y + b AS y1, x + c AS x2, y + d AS y2
      FROM plots JOIN (VALUES (false, 0, 0, 4, 0), (false, 4, 0, 4, 4), (false, 4, 4, 0, 4),
        (false, 0, 4, 0, 0), (true, 0, 0, 4, 0), (true, 4, 0, 4, 1.5), (true, 4, 1.5, 1.5, 1.5),
        (true, 1.5, 1.5, 1.5, 4), (true, 1.5, 4, 0, 4), (true, 0, 4, 0, 0)) v(e, a, b, c, d)
        ON ell = e""",
    "metric": """SELECT polygon_id, 6378137 * radians(x1) AS x1, 6378137 * radians(x2) AS x2,
        6378137 * ln(tan(pi() / 4 + radians(y1) / 2)) AS y1,
        6378137 * ln(tan(pi() / 4 + radians(y2) / 2)) AS y2 FROM edges""",
    "lost": """SELECT town_id, 6378137 * radians(lng) AS px,
        6378137 * ln(tan(pi() / 4 + radians(lat) / 2)) AS py
      FROM matched WHERE polygon_id IS NULL""",
    "gaps": """SELECT town_id, polygon_id, min(sqrt(pow(px - x1 - t * (x2 - x1), 2)
          + pow(py - y1 - t * (y2 - y1), 2))) AS distance
      FROM (SELECT *, greatest(0, least(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1))
              / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS t FROM lost CROSS JOIN metric)
      GROUP BY town_id, polygon_id"""}


@query("jn_14_point_in_polygon", X.sql("""
SELECT town_id, lng, lat, m.polygon_id, state, district
FROM matched m LEFT JOIN plots p ON m.polygon_id = p.polygon_id""", extra=_GEO))
def jn_14(spark, sf):
    return geo.spatial_join(points(spark, sf), polygons(spark, sf), cell=2.0)


@query("jn_15_nearest_polygon", X.sql(f"""
SELECT town_id, polygon_id, {rd("distance", 3)} AS distance FROM gaps
QUALIFY row_number() OVER (PARTITION BY town_id ORDER BY distance, polygon_id) = 1""", extra=_GEO))
def jn_15(spark, sf):
    joined = geo.spatial_join(points(spark, sf), polygons(spark, sf), cell=2.0)
    lost = joined.filter("polygon_id IS NULL").select("town_id", "lng", "lat")
    return present(geo.nearest_polygon(lost, polygons(spark, sf)).select(
        "town_id", "polygon_id", "distance"), 3)


@query("jn_15_enriched_points", X.sql("""
SELECT town_id, p.polygon_id, state, district FROM (
  SELECT m.town_id, coalesce(m.polygon_id, n.polygon_id) AS polygon_id FROM matched m
  LEFT JOIN (SELECT town_id, polygon_id FROM gaps QUALIFY row_number() OVER (
    PARTITION BY town_id ORDER BY distance, polygon_id) = 1) n ON m.town_id = n.town_id)
  JOIN plots p USING (polygon_id)
UNION ALL SELECT -town_id - 1, NULL, NULL, NULL FROM matched""", extra=_GEO))
def jn_15b(spark, sf):
    # each town once more without coordinates: no polygon may claim it
    towns = points(spark, sf).select("town_id", "lng", "lat")
    lost = towns.select((-F.col("town_id") - 1).alias("town_id"),
                        F.lit(None).cast("double").alias("lng"), "lat")
    return geo.enrich_points(towns.unionByName(lost), polygons(spark, sf), 2.0).select(
        "town_id", "polygon_id", "state", "district")


# ---------------------------------------------------------------- chunks
def chunks(spark, sf):
    docs = X.table(spark, sf, "documents").select("doc_id", "source", "text")
    return text.chunk_documents(docs)


@query("txt_01_chunks")
def txt_01(spark, sf):
    return chunks(spark, sf)


@query("txt_01_chunk_sizes", """
SELECT count(*) AS documents, 0::BIGINT AS oversized, 0::BIGINT AS empty FROM documents
WHERE trim(text) <> ''""")
def txt_01b(spark, sf):
    """Chunks longer than 600 may only be single unbroken pieces, and none is empty."""
    per = chunks(spark, sf).groupBy("doc_id").agg(
        F.count_if((F.length("page_content") > 600)
                   & F.trim("page_content").contains(" ")).alias("over"),
        F.count_if(F.col("page_content") == "").alias("none"))
    return per.agg(F.count(F.lit(1)).alias("documents"), F.sum("over").alias("oversized"),
                   F.sum("none").alias("empty"))


@query("txt_03_embeddings")
def txt_03(spark, sf):
    unit = text.embed(chunks(spark, sf), features=256)
    return unit.select("doc_id", "position", F.size("embedding").alias("width"),
                       F.round(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v), 6)
                       .alias("norm"))


@query("txt_04_similarity_topk", X.sql(f"""
SELECT query_id::BIGINT AS query_id, item_id, {rd("score", 5)} AS score, rank FROM (
  SELECT label AS query_id, vec_id AS item_id, sum(v * c) AS score,
    row_number() OVER (PARTITION BY label ORDER BY sum(v * c) DESC, vec_id) AS rank
  FROM (SELECT vec_id, unnest(range(1, 65)) AS pos, unnest(embedding)::DOUBLE AS v
        FROM embeddings)
  JOIN (SELECT label, pos, avg(v) AS c FROM (SELECT label, unnest(range(1, 65)) AS pos,
          unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY 1, 2) USING (pos)
  GROUP BY label, vec_id) WHERE rank <= 5"""))
def txt_04(spark, sf):
    from fieldcast.operators.ml import cluster_centres

    items = X.table(spark, sf, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    queries = cluster_centres(X.table(spark, sf, "embeddings"), "embedding", "label").select(
        F.col("label").cast("bigint").alias("query_id"), F.col("centre").alias("embedding"))
    return present(text.similarity_topk(queries, items, k=5), 5)


def search_sides(spark, sf):
    """Benchmark texts and all document chunks, embedded alike."""
    parts = chunks(spark, sf).withColumn("item_id", F.concat_ws("/", "doc_id", "position"))
    wanted = X.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("page_content"))
    weights = text.fit_weights(parts, features=256)
    return text.embed(wanted, weights=weights), text.embed(parts, weights=weights)


@query("txt_04_text_search")
def txt_04b(spark, sf):
    """Benchmark texts against all document chunks by hashed TF-IDF."""
    return text.similarity_topk(*search_sides(spark, sf), k=1)


@query("txt_04_text_search_scores", """
SELECT count(*) AS found, 0::BIGINT AS wrong_scores, 0::BIGINT AS out_of_range,
  0::BIGINT AS out_of_order
FROM benchmark, range(3) WHERE text IS NOT NULL""")
def txt_04c(spark, sf):
    """Three chunks per text; scores are the products of the vectors and fall with the rank."""
    queries, items = search_sides(spark, sf)
    best = text.similarity_topk(queries, items, k=3)
    named = best.join(queries.select("query_id", F.col("embedding").alias("q")), "query_id").join(
        items.select("item_id", F.col("embedding").alias("i")), "item_id")
    product = F.aggregate(F.zip_with("q", "i", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    before = F.lag("score").over(Window.partitionBy("query_id").orderBy("rank"))
    return named.withColumns({"product": product, "before": before}).agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.abs(F.col("score") - F.col("product")) > 1e-9).alias("wrong_scores"),
        F.count_if(~F.col("score").between(-1e-9, 1 + 1e-9)).alias("out_of_range"),
        F.count_if(F.col("score") > F.col("before")).alias("out_of_order"))


@query("txt_05_keyword_topk", """
SELECT name, doc_id, rank FROM (
  SELECT name, doc_id, row_number() OVER (PARTITION BY name ORDER BY doc_id) AS rank
  FROM documents JOIN (SELECT DISTINCT string_split(text, ' ')[3] AS name FROM benchmark)
    ON contains(lower(text), lower(name)))
WHERE rank <= 2""")
def txt_05(spark, sf):
    names = X.table(spark, sf, "benchmark").select(
        F.get(F.split("text", " "), 2).alias("name"))
    docs = X.table(spark, sf, "documents").select("doc_id", "text")
    return text.keyword_topk(names, docs, 2, "name", "text", ["doc_id"]).select(
        "name", "doc_id", F.col("rank").cast("bigint").alias("rank"))


@query("txt_06_clean_chunks", r"""
SELECT doc_id, regexp_replace(body, '^#+[ \t]*([^\n]*?)[ \t]*$', '**\1**', 'g') AS body
FROM (SELECT min(doc_id) AS doc_id, body FROM (
  SELECT doc_id, '## ' || lang || chr(10) || source || chr(10) || '#' || (n_chars % 3) AS body
  FROM documents) GROUP BY body)""".replace("'^#", "'(?m)^#"))
def txt_06(spark, sf):
    docs = X.table(spark, sf, "documents").select("doc_id", F.concat(
        F.lit("## "), "lang", F.lit("\n"), "source", F.lit("\n#"),
        (F.col("n_chars") % 3).cast("string")).alias("body"))
    return text.clean_chunks(docs, "body", ["doc_id"]).select("doc_id", "body")
