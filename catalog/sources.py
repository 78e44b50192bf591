"""Readers and writers, each as a round trip of the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import fixtures as X
from catalog.geo_text import polygons
from catalog.registry import present, query
from fieldcast.operators.ml import build_ml_pipeline, train_kmeans
from fieldcast.operators.text import chunk_documents
from fieldcast.plans import gold as gold_plan
from fieldcast.plans import zones
from fieldcast.session import scratch_dir
from fieldcast.sources import readers, sinks


def _folder(spark, name):
    return f"{scratch_dir(spark)}/fieldcast/{name}-{uuid.uuid4().hex}"


def _totals(df, key):
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"),
                               F.sum("temperature_2m").alias("temperature"),
                               F.sum("rain").alias("rain"))


_TOTALS = X.sql("""SELECT city, count(*) AS rows, sum(temperature_2m) AS temperature,
  sum(rain) AS rain FROM hourly GROUP BY city""", "hourly")


@query("src_01_read_first", "SELECT l_returnflag, count(*) AS rows FROM lineitem GROUP BY 1")
def src_01(spark, sf):
    df = readers.read_first(spark, [f"{sf}/not_there", f"{sf}/lineitem.parquet"])
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))


@query("src_02_read_first_set", """
SELECT s_nationkey::BIGINT AS nation, count(*) AS rows FROM (
  SELECT s_nationkey FROM supplier UNION ALL SELECT s_nationkey FROM supplier) GROUP BY 1""")
def src_02(spark, sf):
    again = _folder(spark, "suppliers")
    X.table(spark, sf, "supplier").write.parquet(again)
    df = readers.read_first_set(spark, [[f"{sf}/supplier.parquet", f"{sf}/not_there"],
                                        [f"{sf}/supplier.parquet", again]])
    return df.groupBy(F.col("s_nationkey").cast("bigint").alias("nation")).agg(
        F.count(F.lit(1)).alias("rows"))


#: Columns of the station files: known, so they are read once and not once more for their types.
_HOURLY_CSV = "`Unnamed: 0` long, date timestamp, temperature_2m double, rain double"


def _hourly_csv(spark, sf):
    """Weather as one folder of CSV files per city."""
    path = _folder(spark, "hourly")
    X.hourly(spark, sf).select(
        F.monotonically_increasing_id().alias("Unnamed: 0"),
        F.col("time").alias("date"), "temperature_2m", "rain",
        F.regexp_replace("city", "#", " ").alias("station")).repartition("station").write.option(
        "header", True).partitionBy("station").csv(path)
    return path


@query("src_03_read_csv", _TOTALS)
def src_03(spark, sf):
    df = readers.read_csv(spark, f"{_hourly_csv(spark, sf)}/*/*.csv")
    named = df.withColumn("city", F.regexp_replace(
        F.url_decode(readers.source_name("station=([^/]+)/")), " ", "#"))
    return _totals(named, "city")


@query("src_04_probe_schema", """
SELECT c_mktsegment AS segment, count(*) AS rows, round(sum(c_acctbal), 2) AS balance
FROM customer GROUP BY 1""")
def src_04(spark, sf):
    path = _folder(spark, "probe")
    X.table(spark, sf, "customer").repartition(4).write.option("header", True).csv(path)
    files = [r["path"] for r in readers.file_inventory(spark, path, "*.csv").select(
        "path").orderBy("path").collect()]
    df = readers.read_csv_with_probe(spark, files, probe=files[0])
    return df.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("src_05_ingest_city_csv", _TOTALS)
def src_05(spark, sf):
    df = readers.ingest_city_csv(spark, _hourly_csv(spark, sf), schema=_HOURLY_CSV,
                                 city_pattern="station=([^/]+)/")
    clean = df.withColumn("city", F.regexp_replace("city", " ", "#"))
    out = _folder(spark, "bronze")
    sinks.write_dataset(clean, out, ["city"])
    return _totals(spark.read.parquet(out), "city")


@query("src_06_source_file", """
SELECT 'orders.parquet' AS source_file, count(*) AS rows FROM orders
UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem""")
def src_06(spark, sf):
    both = [readers.with_source_file(spark.read.parquet(f"{sf}/{t}.parquet")).groupBy(
        "source_file").agg(F.count(F.lit(1)).alias("rows")) for t in ("orders", "lineitem")]
    return both[0].unionByName(both[1])


@query("src_07_city_master", X.sql("""
SELECT city_name AS city, lat, lng FROM dim_city""", "dim_city"))
def src_07(spark, sf):
    path = _folder(spark, "master")
    sinks.write_csv(X.dim_city(spark, sf).select(
        F.col("city_id").alias("Unnamed: 0"), F.col("city_name").alias("city"), "lat", "lng"),
        path)
    return readers.load_city_master(spark, path)


@query("src_08_polygons", """
SELECT n_name AS state, 'plot ' || n_nationkey AS district, 1::BIGINT AS rings,
  CASE WHEN n_nationkey % 2 = 1 THEN 7 ELSE 5 END::BIGINT AS corners FROM nation""")
def src_08(spark, sf):
    path = _folder(spark, "polygons")
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("state").alias("NAME_1"), F.col("district").alias("NAME_2"))
        .alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates"))
        .alias("geometry")))
    polygons(spark, sf).select(feature.alias("value")).write.text(path)
    loaded = readers.load_polygons(spark, path, per_line=True)
    return present(loaded.select("state", "district", F.size("rings").alias("rings"),
                                 F.size(F.col("rings")[0]).alias("corners")))


@query("src_09_file_inventory")
def src_09(spark, sf):
    return readers.file_inventory(spark, sf, "*.parquet").select("file_name", "size_mb")


@query("src_09_file_summary")
def src_09b(spark, sf):
    return readers.file_summary(readers.file_inventory(spark, sf, "*.parquet"))


#: Documents in one text file: a whole file is one row, so files must not grow with the table.
FILE_DOCUMENTS = 200


@query("src_13_load_documents", """
SELECT lang, sum(length(text))::BIGINT + count(*) AS characters FROM documents GROUP BY lang""")
def src_13(spark, sf):
    path = _folder(spark, "documents")
    X.table(spark, sf, "documents").select("text", "lang").write.option(
        "maxRecordsPerFile", FILE_DOCUMENTS).partitionBy("lang").text(path)
    loaded = readers.load_documents(spark, f"{path}/*/*.txt").select(
        "text", F.regexp_extract(F.col("_metadata.file_path"), "lang=([^/]+)/", 1).alias("lang"))
    return loaded.groupBy("lang").agg(F.sum(F.length("text")).alias("characters"))


@query("snk_01_coalesced_parquet", "SELECT count(*) AS rows, 1::BIGINT AS files FROM customer")
def snk_01(spark, sf):
    path = _folder(spark, "dims")
    sinks.write_dataset(X.table(spark, sf, "customer").repartition(6), path, coalesce_num=1)
    back = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("f"))
    return back.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("f").alias("files"))


@query("snk_02_partitioned_parquet", X.sql("""
SELECT state_id::BIGINT AS state_id, year::BIGINT AS year, count(*) AS days,
  sum(daily_rain) AS rain FROM daily WHERE state_id IS NOT NULL GROUP BY ALL""", "daily"))
def snk_02(spark, sf):
    path = _folder(spark, "daily")
    sinks.write_dataset(X.daily(spark, sf), path, ["state_id", "year"])
    back = spark.read.parquet(path).filter("state_id IS NOT NULL")
    return present(back.groupBy("state_id", "year").agg(F.count(F.lit(1)).alias("days"),
                                                        F.sum("daily_rain").alias("rain")))


@query("snk_03_csv_report", """
SELECT p_brand AS brand, count(*) AS parts FROM part GROUP BY 1""")
def snk_03(spark, sf):
    path = _folder(spark, "report")
    sinks.write_csv(X.table(spark, sf, "part").groupBy(F.col("p_brand").alias("brand")).agg(
        F.count(F.lit(1)).alias("parts")), path)
    return readers.read_csv(spark, path, schema="brand string, parts bigint")


@query("snk_04_audit_columns", """
SELECT r_regionkey::BIGINT AS r_regionkey, 'gold' AS etl_layer, 'demo' AS etl_job,
  true AS stamped FROM region""")
def snk_04(spark, sf):
    out = sinks.add_audit_columns(X.table(spark, sf, "region"), "demo")
    return present(out.select("r_regionkey", "etl_layer", "etl_job",
                              F.col("etl_timestamp").isNotNull().alias("stamped")))


@query("snk_05_register", "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1")
def snk_05(spark, sf):
    path = _folder(spark, "orders")
    sinks.write_dataset(X.table(spark, sf, "orders"), path, coalesce_num=4)
    name = sinks.register(spark, "gold_orders", path)
    return spark.sql(f"SELECT o_orderstatus, count(*) AS orders FROM {name} GROUP BY 1")


@query("snk_05_gold_layer", X.sql("""
SELECT (SELECT count(*) FROM daily) AS daily_weather,
  (SELECT count(*) FROM (SELECT DISTINCT city_id, year, month FROM daily)) AS monthly_weather,
  (SELECT count(*) FROM season_shift) AS season_shift,
  (SELECT count(*) FROM (SELECT DISTINCT city_id FROM daily)) AS city_profile,
  (SELECT count(*) FROM (SELECT DISTINCT date FROM daily)) AS dim_date,
  (SELECT count(*) FROM base_clean) AS v_base_clean""", "season_shift", "base_clean"))
def snk_05b(spark, sf):
    """The whole gold job, written and registered, then counted through its names."""
    silver = {"dim_region": X.dim_region(spark, sf), "dim_state": X.dim_state(spark, sf),
              "dim_city": X.dim_city(spark, sf), "fact_weather": X.weather(spark, sf),
              "fact_weather_sampled": X.weather(spark, sf)}
    gold_plan.run_gold(spark, silver, _folder(spark, "gold"), X.crop_silver(spark, sf))
    names = ("daily_weather", "monthly_weather", "season_shift", "city_profile", "dim_date",
             "v_base_clean")
    return spark.sql("SELECT " + ", ".join(
        f"(SELECT count(*) FROM {n}) AS {n}" for n in names))


@query("snk_06_save_model")
def snk_06(spark, sf):
    from pyspark.ml.clustering import KMeansModel

    events = X.table(spark, sf, "events").groupBy("user_id").agg(
        F.avg("value").alias("v"), F.count(F.lit(1)).alias("n"))
    scaled = build_ml_pipeline(events, ["v", "n"])[0]
    model, _ = train_kmeans(scaled, 4)
    path = _folder(spark, "model")
    sinks.save_model(model, path)
    return KMeansModel.load(path).transform(scaled).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("users"))


@query("snk_06_zone_job")
def snk_06b(spark, sf):
    path = _folder(spark, "zones")
    zones.run_zones(X.daily(spark, sf), path, k=4)
    return spark.read.parquet(f"{path}/agro_climatic_zones")


@query("txt_02_chunk_store", "SELECT count(*) AS documents FROM documents WHERE trim(text) <> ''")
def txt_02(spark, sf):
    path = _folder(spark, "chunks")
    docs = X.table(spark, sf, "documents").select("doc_id", "source", "text")
    sinks.write_chunks(chunk_documents(docs), path)
    return spark.read.parquet(path).agg(F.count_distinct("doc_id").alias("documents"))
