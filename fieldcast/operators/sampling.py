"""Samples that depend only on keys and a seed, never on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcast import config as C
from fieldcast.operators.ranking import order_hash, smallest_hashes


def stratified_flag(df: DataFrame, strata: Sequence[str] = ("state_id",),
                    key: Sequence[str] = ("city_id",), pct: float = C.SAMPLE_SHARE,
                    floor: int = C.SAMPLE_FLOOR, seed: int = C.SAMPLE_SEED,
                    out: str = "is_sampled") -> DataFrame:
    """Flag max(floor, ceil(pct * n)) members of each stratum, in hash order."""
    quota = F.greatest(F.lit(floor), F.ceil(F.col("group_total") * F.lit(pct)))
    return smallest_hashes(df.withColumn("_hash", order_hash(*key, seed=seed)), strata, "_hash",
                           quota, out).drop("_hash")


def sampling_summary(df: DataFrame, stratum: str = "state_id",
                     flag: str = "is_sampled") -> DataFrame:
    """Total, selected and percent per stratum, with the overall share kept."""
    per = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("total_cities"),
                                  F.count_if(F.col(flag)).alias("selected_cities"))
    overall = per.agg((F.sum("selected_cities") / F.sum("total_cities") * 100).alias("x")).scalar()
    return per.withColumn(
        "selected_pct", F.round(F.col("selected_cities") / F.col("total_cities") * 100, 2)
    ).withColumn("overall_pct", F.round(overall, 2))


def cap_sample(df: DataFrame, n: int, key: Sequence[str], seed: int = C.SAMPLE_SEED) -> DataFrame:
    """Exactly min(n, rows) rows in hash order; the sample is never gathered in one task."""
    return smallest_hashes(df.withColumn("_hash", order_hash(*key, seed=seed)), [], "_hash",
                           F.lit(n), "_taken_in").filter("_taken_in").drop("_hash", "_taken_in")


def top_up(df: DataFrame, matched: DataFrame, key: str, n: int,
           seed: int = C.SAMPLE_SEED) -> DataFrame:
    """All matched keys, filled up from the rest at random (by hash) to n rows."""
    keys = matched.select(key).distinct()
    have = df.join(keys, key, "left_semi")
    rest = df.join(keys, key, "left_anti")
    extra = cap_sample(rest, max(0, n - have.count()), [key], seed)
    return have.withColumn("picked_as", F.lit("matched")).unionByName(
        extra.withColumn("picked_as", F.lit("filled")))
