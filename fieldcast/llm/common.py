"""Shared small helpers of the pipeline operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcast.session import scratch_dir

#: Rows that Spark hands to Python at once; long texts make larger batches, see `small_batches`.
BATCH_ROWS = 256


def identity(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Column:
    """Key that spreads documents evenly, also where the id is missing."""
    return F.coalesce(F.col(doc_id), F.xxhash64(F.col(text)))


def texts(df: DataFrame, *more: str, text: str = "text", doc_id: str = "doc_id",
          spread: bool = True) -> DataFrame:
    """Id and whole text (null: empty) and the columns named, dealt out evenly.

    A row group is the smallest part of a Parquet scan.  Files of few large row groups would
    keep most executors idle in the Python stages, so the rows are dealt out by their id once;
    adaptive execution merges small parts.  ``spread=False`` keeps the input's partitions.
    All other columns are dropped here, so their names cannot clash with results.
    """
    narrow = df.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"), *more)
    return narrow.repartition(identity(narrow)) if spread else narrow


def strings(column: pa.Array) -> Iterator[str]:
    """Values of a string column one by one; null: empty."""
    for value in column:
        yield value.as_py() or ""


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS,
           size: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that results of one piece stay small (rows and about bytes)."""
    for batch in batches:
        step = max(1, min(rows, int(rows * size / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def pinned(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder as Parquet and read on from there.

    Files instead of ``checkpoint()``: a checkpointed frame hands its inferred constraints on,
    and in a loop of joins they double with every round until planning never ends.
    """
    spark = df.sparkSession
    folder = f"{scratch_dir(spark).rstrip('/')}/pinned/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def own_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"{stem}_{uuid.uuid4().hex[:8]}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def list_array(values: np.ndarray, lengths: list[int]) -> pa.ListArray:
    """Arrow list column from flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
