"""Readers and writers on small files."""

import pytest
from pyspark.sql import functions as F

from fieldcast.plans import gold
from fieldcast.sources import readers, sinks


def test_read_first_falls_back_to_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2.5\n")
    df = readers.read_first(spark, [str(tmp_path / "none"), str(tmp_path / "x.csv")])
    # a CSV file is no Parquet file, so the second format is used
    assert df.columns == ["a", "b"] and df.first()["b"] == 2.5
    with pytest.raises(FileNotFoundError):
        readers.read_first(spark, [str(tmp_path / "none")])


def test_ingest_city_files(spark, tmp_path):
    root = tmp_path / "w_d_1"
    root.mkdir()
    (root / "Agra.csv").write_bytes(
        "﻿date,rain\n2020-01-01 00:00:00,1.5\n2020-01-01 01:00:00,\n".encode("utf-8"))
    (root / "New Delhi.csv").write_text("date,rain\n2020-01-01 00:00:00,2.0\n")
    (root / "cities.csv").write_text("date,rain\nx,1\n")
    df = readers.ingest_city_csv(spark, str(tmp_path), "date string, rain double", "cities.csv")
    out = sorted((r["city"], r["date"], r["rain"]) for r in df.fillna(-1.0).collect())
    assert out == [("Agra", "2020-01-01 00:00:00", 1.5), ("Agra", "2020-01-01 01:00:00", -1.0),
                   ("New Delhi", "2020-01-01 00:00:00", 2.0)]


def test_ingest_drops_index_column(spark, tmp_path):
    (tmp_path / "Agra.csv").write_text(",date,rain\n0,2020-01-01,1.5\n")
    assert readers.ingest_city_csv(spark, str(tmp_path)).columns == ["date", "rain", "city"]


def test_probe_schema_applies_to_all(spark, tmp_path):
    for name, body in (("0meta", "k\nx\n"), ("a", "v\n1.5\n"), ("b", "v\n2\n")):
        (tmp_path / f"{name}.csv").write_text(body)
    files = [str(tmp_path / f"{n}.csv") for n in ("0meta", "a", "b")]
    df = readers.read_csv_with_probe(spark, files)
    assert dict(df.dtypes) == {"v": "double"} and df.count() == 2


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_bytes(b"x" * 1024 * 1024)
    (tmp_path / "sub" / "b.csv").write_bytes(b"x" * 512 * 1024)
    inv = readers.file_inventory(spark, str(tmp_path), "*.csv")
    row = readers.file_summary(inv).first()
    assert (row["total_files"], row["total_mb"], row["smallest_mb"]) == (2, 1.5, 0.5)


def test_documents(spark, tmp_path):
    (tmp_path / "g.md").write_text("# A\n\nline")
    (tmp_path / "empty.md").write_text("  ")
    rows = readers.load_documents(spark, str(tmp_path / "*.md")).collect()
    assert [(r["source"], r["text"]) for r in rows] == [("g.md", "# A\n\nline")]


def test_partitioned_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.write_dataset(df, path, "p")
    sinks.write_dataset(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 9]


def test_gold_job_writes_and_registers(spark, sf, tmp_path):
    from catalog import fixtures as X

    silver = {n: getattr(X, n)(spark, sf) for n in ("dim_region", "dim_state", "dim_city")}
    fact = X.weather(spark, sf)
    silver |= {"fact_weather": fact, "fact_weather_sampled": fact.filter("city_id = 1")}
    names = gold.run_gold(spark, silver, str(tmp_path), X.crop_silver(spark, sf))
    assert set(names) == set(gold.LAYOUT)
    full, part = (spark.table(t).count() for t in ("daily_weather_full", "daily_weather"))
    assert 0 < part < full
    assert spark.table("renewable_ranking").agg(F.min("renewable_rank")).first()[0] == 1
    assert spark.table("v_base_clean").count() <= spark.table("season_shift").count()
    assert set(gold.build_gold(silver)) == set(names) - {
        "crop_ml_dataset", "dim_crop_agronomy_profile"}


def test_document_files_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    """All texts of a language used to be one file, and so one row."""
    from catalog import sources

    monkeypatch.setattr(sources, "FILE_DOCUMENTS", 7)
    docs = [(i, f"text {i}" if i % 9 else None, "de" if i % 5 == 0 else "en") for i in range(100)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(
        str(tmp_path / "documents.parquet"))
    lines = []

    def load(*args):
        rows = load_documents(*args)
        lines.extend(r["text"].count("\n") for r in rows.collect())
        return rows

    load_documents = readers.load_documents
    monkeypatch.setattr(readers, "load_documents", load)
    got = {r["lang"]: r["characters"] for r in sources.src_13(spark, str(tmp_path)).collect()}
    assert got == {g: sum(len(t or "") + 1 for _, t, lang in docs if lang == g)
                   for g in ("de", "en")}
    assert sum(lines) == 100 and max(lines) <= 7


def test_city_ingest_query_reads_the_files_once(spark, sf, monkeypatch):
    """Its schema is given, equals what Spark would infer, and spares the pass over all files."""
    from catalog import sources

    asked = []

    def ingest(session, root, schema=None, **more):
        asked.append(schema)
        given = ingest_city_csv(session, root, schema=schema, **more)
        inferred = ingest_city_csv(session, root, **more)
        assert given.dtypes == inferred.dtypes
        assert given.exceptAll(inferred).isEmpty() and inferred.exceptAll(given).isEmpty()
        return given

    ingest_city_csv = sources.readers.ingest_city_csv
    monkeypatch.setattr(sources.readers, "ingest_city_csv", ingest)
    assert sources.src_05(spark, sf).count() > 0
    assert asked and asked[0]
