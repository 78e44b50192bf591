"""Readers: candidate paths, CSV families, polygons, documents, file inventories."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# a missing path fails in analysis, a file of another format while its schema is read
_UNREADABLE = (PySparkException, Py4JJavaError)


def _attempt(spark: SparkSession, paths: Sequence[str], fmt: str) -> DataFrame:
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    return reader.format(fmt).load(list(paths))


def _first(candidates: Iterable, read: Callable[..., DataFrame], formats: Sequence[str]
           ) -> DataFrame:
    tried = []
    for candidate in candidates:
        for fmt in formats:
            try:
                df = read(candidate, fmt)
            except _UNREADABLE as err:
                tried.append(f"{fmt}:{candidate} ({type(err).__name__})")
                continue
            if df.columns:
                return df
    raise FileNotFoundError(f"no readable path: {tried}")


def read_first(spark: SparkSession, paths: Sequence[str],
               formats: Sequence[str] = ("parquet", "csv")) -> DataFrame:
    """The first candidate path that can be read, in any of the formats."""
    return _first(paths, lambda p, f: _attempt(spark, [p], f), formats)


def read_first_set(spark: SparkSession, path_sets: Sequence[Sequence[str]]) -> DataFrame:
    """The first set of Parquet directories that can all be read, as one table."""
    return _first(path_sets, lambda ps, f: _attempt(spark, ps, f), ("parquet",))


def read_csv(spark: SparkSession, path: str | Sequence[str], header: bool = True,
             infer: bool = True, schema: str | None = None) -> DataFrame:
    """CSV files by path, list or glob; a schema spares the inference pass."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", infer)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_csv_with_probe(spark: SparkSession, files: Sequence[str],
                        probe: str | None = None) -> DataFrame:
    """Learn the schema from one file and read all files with it.

    Without a probe, the first listed file is metadata and left out, and the second is
    the probe.
    """
    files = list(files)
    if probe is None:
        files = files[1:]
        probe = files[0]
    schema = read_csv(spark, probe).schema
    return spark.read.option("header", True).schema(schema).csv(files)


def source_name(pattern: str = r"([^/]+?)(?:\.[^./]+)?$") -> Column:
    """Part of the file path of each row, by default the file name without extension."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def with_source_file(df: DataFrame, out: str = "source_file") -> DataFrame:
    """Add the file name of each row (call it right after the scan)."""
    return df.select("*", F.col("_metadata.file_name").alias(out))


def ingest_city_csv(spark: SparkSession, root: str, schema: str | None = None,
                    master: str | None = None,
                    city_pattern: str = r"([^/]+?)\.csv(?:\.gz)?$") -> DataFrame:
    """All hourly city files under ``root`` as one table.

    The city comes from the file name, an unnamed index column is dropped and a byte
    order mark is tolerated (UTF-8 is read with the mark stripped).  ``master`` is the
    name of the city master file, which is not hourly data and is left out.
    """
    reader = (spark.read.option("header", True).option("recursiveFileLookup", True)
              .option("encoding", "UTF-8").option("enforceSchema", False))
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    raw = reader.csv(root)
    kept = [c for c in raw.columns if c.lower() not in ("unnamed: 0", "_c0")]
    rows = raw.select(*[F.col(f"`{c}`").alias(c.lstrip("\ufeff")) for c in kept],
                      F.col("_metadata.file_name").alias("_file"),
                      F.regexp_extract(F.url_decode(F.col("_metadata.file_path")),
                                       city_pattern, 1).alias("city"))
    if master:
        rows = rows.filter(F.col("_file") != master)
    return rows.drop("_file")


def load_city_master(spark: SparkSession, path: str) -> DataFrame:
    """City master CSV: typed, without unnamed columns, rows without a city dropped."""
    raw = read_csv(spark, path)
    kept = [c for c in raw.columns if not c.lower().startswith("unnamed") and c != "_c0"]
    typed = raw.select(*[
        F.col(f"`{c}`").try_cast("double").alias(c) if c in ("lat", "lng")
        else F.col(f"`{c}`") for c in kept])
    return typed.dropna(subset=["city"])


# coordinates stay text first: their nesting depends on the geometry type
_FEATURE = ("struct<properties: struct<NAME_1: string, NAME_2: string>, "
            "geometry: struct<type: string, coordinates: string>>")


def load_polygons(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """District polygons: ``polygon_id, state, district, rings``.

    A FeatureCollection is one JSON value; with ``per_line`` each line holds one feature,
    which lets Spark split large files.  All rings of all parts go in one list.
    """
    if per_line:
        features = spark.read.text(path).select(
            F.from_json("value", _FEATURE).alias("f")).select("f.*")
    else:
        features = (spark.read.schema(f"features array<{_FEATURE}>")
                    .option("multiLine", True).json(path)
                    .select(F.explode("features").alias("f")).select("f.*"))
    text = F.col("geometry.coordinates")
    polygon = F.from_json(text, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    rings = F.when(F.col("geometry.type") == "MultiPolygon", multi).otherwise(polygon)
    named = features.select(F.col("properties.NAME_1").alias("state"),
                            F.col("properties.NAME_2").alias("district"), rings.alias("rings"))
    return named.withColumn("polygon_id", F.concat_ws(
        "/", "state", "district", F.substring(F.md5(F.to_json("rings")), 1, 6))).select(
        "polygon_id", "state", "district", "rings")


def load_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files with their file name as ``source``; each file must fit a task's memory."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("source"), F.col("value").alias("text")).filter(
        F.trim("text") != "")


def file_inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Name, path and size of the files under a folder; contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", glob).load(root).select("path", "length"))
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "path",
                        (F.col("length") / (1024 * 1024)).alias("size_mb"))


def file_summary(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count(F.lit(1)).alias("total_files"), F.round(F.sum("size_mb"), 2).alias("total_mb"),
        F.round(F.avg("size_mb"), 2).alias("average_mb"),
        F.round(F.min("size_mb"), 2).alias("smallest_mb"),
        F.round(F.max("size_mb"), 2).alias("largest_mb"))
