"""Session options and reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Sizes are checked by Spark itself: below the threshold a join side is
# broadcast, above it the join shuffles and adaptive execution splits skew.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "52428800",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


SHUFFLE_TARGET_MB = 128
SHUFFLE_WIDTH_MAX = 40_000  # more reducers cost the driver more than spilling costs a task


def shuffle_options(input_gb: float) -> dict[str, str]:
    """Shuffle width for an input size: about 128 MB per partition, within limits.

    The operators combine before they shuffle, so the exchanged data is a fraction of the
    input, and adaptive execution merges what turns out small.
    """
    partitions = min(max(200, int(input_gb * 1024 / SHUFFLE_TARGET_MB)), SHUFFLE_WIDTH_MAX)
    return {"spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{SHUFFLE_TARGET_MB}m"}


def build_session(app_name: str = "fieldcast", master: str | None = None,
                  extra: dict[str, str] | None = None,
                  input_gb: float | None = None) -> SparkSession:
    """Create (or reuse) a session with the options the operators are tuned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = shuffle_options(input_gb) if input_gb else {}
    for key, value in {**DEFAULTS, **sized, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; on a cluster
    the other executors could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the files."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(spark))
    return df.checkpoint(eager=True)
