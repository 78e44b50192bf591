"""Bounded samples of labelled documents, for operators that fit a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id", parts: int = 5) -> Column:
    """True for the documents kept out of all fitting: crc32 of the id as text, mod ``parts``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == 0,
                      F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, seed: int,
           text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents not held out.

    The rows are those whose ids hash lowest, so the sample does not depend on partitions.  A
    document labelled more than once takes its smallest label; null labels count as none.
    The chosen ids are broadcast: there are at most ``rows``.
    """
    marks = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
             .where(~held_out()).orderBy(F.xxhash64(F.lit(seed), "doc_id")).limit(rows))
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text), F.lit("")).alias("text"))
    return narrow.join(F.broadcast(marks), "doc_id").select("doc_id", "text", "label")
