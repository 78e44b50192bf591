"""Documents to training sequences: toxic and poor documents go, near copies go, the rest is packed.

`STAGES` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next function's docs.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldcast.llm import near_copies, packing, quality_rules, tokenizer, toxicity
from fieldcast.llm.common import identity, table
from fieldcast.session import scratch_dir

#: The stages are fitted to the corpus at hand, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep(docs.repartition(identity(docs)), model)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base rules and the fences of their language and source."""
    return quality_rules.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without near copies before them.

    Near copies are linked by SimHash, checked by five-word Jaccard similarity (0.8 or more), and
    those of that similarity beyond its radius are searched too.
    """
    return near_copies.keep_first(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their token ids."""
    return packing.pack(docs, tokenizer.default_path("byte_bpe_50k.json"), end_id=1,
                        with_ids=True)


STAGES = [("toxicity", drop_toxic), ("quality_rules", apply_quality_rules),
          ("simhash_near_dedup", drop_near_copies), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    folder = f"{scratch_dir(spark).rstrip('/')}/corpus_pipeline/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
