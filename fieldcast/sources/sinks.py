"""Writers, audit columns and table registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_dataset(df: DataFrame, path: str, partition_columns: Sequence[str] | str | None = None,
                  coalesce_num: int | None = None) -> None:
    """Overwrite Parquet, partitioned or in a few files.

    A partitioned write is rebalanced on its partition columns first: few files per
    folder, while a folder that holds much of the data is still split over several
    tasks.  Only the partitions at hand are replaced.
    """
    if partition_columns:
        cols = [partition_columns] if isinstance(partition_columns, str) else list(
            partition_columns)
        (df.hint("rebalance", *cols).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path))
        return
    if coalesce_num:  # a shuffle, so that what comes before keeps all its tasks
        df = df.repartition(coalesce_num)
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def add_audit_columns(df: DataFrame, job: str, layer: str = "gold") -> DataFrame:
    """Load time, layer and job name."""
    return df.withColumns({"etl_timestamp": F.current_timestamp(), "etl_layer": F.lit(layer),
                           "etl_job": F.lit(job)})


def register(spark: SparkSession, name: str, path: str, database: str | None = None) -> str:
    """Publish a Parquet dataset under a name that SQL can use; returns that name.

    With a database an external table is created there, else a temporary view.
    """
    if database is None:
        spark.read.parquet(path).createOrReplaceTempView(name)
        return name
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    full = f"{database}.{name}"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.catalog.createTable(full, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(full)):
        spark.catalog.recoverPartitions(full)
    return full


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Replace the chunk store (text, source, position)."""
    chunks.write.mode("overwrite").parquet(path)
