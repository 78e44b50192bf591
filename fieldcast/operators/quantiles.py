"""Exact quantiles without holding a group's values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.functions.keys import finite
from fieldcast.operators.ranking import null_safe_join
from fieldcast.session import checkpoint

_ACCURACY = 10000
_PARTS = 256
#: Distinct values that the last pass may count inside one bracket.
MOST_CELLS = 20_000
#: Groups whose brackets are broadcast; more meet their rows in a shuffle.
BROADCAST_GROUPS = 20_000


def _nudged(bound: Column, direction: int) -> Column:
    """A bound moved outwards a little, as a recomputed mean may differ in its last bits."""
    return bound + F.lit(direction) * F.abs(bound) * F.lit(1e-9)


def to_long(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per key, feature and finite value."""
    wide = df.select(*keys, *[finite(F.col(f"`{c}`")).alias(c) for c in cols])
    return wide.unpivot([F.col(k) for k in keys], [F.col(f"`{c}`") for c in cols],
                        "feature", "value").filter("value IS NOT NULL")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    keys: Sequence[str] = (), accuracy: int = _ACCURACY,
                    most_cells: int = MOST_CELLS) -> DataFrame:
    """Linear-interpolated quantiles per key, feature and probability, by distributed selection.

    Each quantile needs the values at two ranks.  A sketch brackets every rank.  Where a bracket
    may hold more than ``most_cells`` distinct values it is narrowed: one pass counts what lies
    below and inside and takes a histogram of the inside, and the rank's part of it is the next
    bracket.  Then one pass counts the distinct values inside all brackets (map-side combined),
    and each rank is read from its few ordered cells.  A rank that its bracket misses gets the
    part beside it and goes through the same steps again, so the answer is exact whatever the
    sketch returns, and no task orders a group's values.

    Where no group has more than ``most_cells`` distinct values of a column, by an estimate, none
    of this is needed: one pass counts the distinct values, and ranks are read from running counts.

    Groups without values have no row.
    """
    keys = list(keys)
    by = [*keys, "feature"]
    probs = sorted({float(p) for p in probs})
    gap = 2.0 / _ACCURACY
    long = to_long(df, cols, keys)
    kinds = df.groupBy(*keys).agg(F.greatest(F.lit(0), F.lit(0), *[
        F.approx_count_distinct(finite(F.col(f"`{c}`"))) for c in cols]).alias("kinds"))
    if (kinds.agg(F.max("kinds")).first()[0] or 0) <= most_cells:
        return _between(_counted(long, by, probs), by, probs)
    bounds = [b for p in probs for b in (max(p - gap, 0.0), min(p + gap, 1.0))]
    sketch = long.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"),
        F.percentile_approx("value", bounds, accuracy).alias("_b"))
    ranks = F.array(*[F.struct(
        F.lit(2 * i + side).alias("t"),
        F.least(F.floor(F.lit(p) * (F.col("n") - 1)) + side, F.col("n") - 1).alias("k"),
        _nudged(F.col("_b")[2 * i], -1).alias("lo"),
        _nudged(F.col("_b")[2 * i + 1], 1).alias("hi"))
        for i, p in enumerate(probs) for side in (0, 1)])
    start = checkpoint(sketch.select(*by, "n", "least", "most", F.explode(ranks).alias("r")).select(
        *by, "n", "least", "most", "r.*",
        (F.col("n") * (2 * gap + 2.0 / _ACCURACY) > most_cells).alias("wide")))
    few = start.select(*by).distinct().count() <= BROADCAST_GROUPS
    found, left = None, start
    while True:
        while not left.filter("wide").isEmpty():
            left = checkpoint(_narrowed(long, left.filter("wide"), by, few, most_cells)
                              .unionByName(left.filter("NOT wide")))
        picked = checkpoint(_picked(long, left, by, few))
        hit = picked.filter("value IS NOT NULL").select(*by, "n", "t", "value")
        found = hit if found is None else found.unionByName(hit)
        left = picked.filter("value IS NULL").select(
            *by, "n", "least", "most", "t", "k", *_beside(), F.lit(True).alias("wide"))
        if left.isEmpty():
            break
    at = lambda t: F.max(F.when(F.col("t") == t, F.col("value")))
    wide = found.groupBy(*by, "n").agg(*[at(t).alias(f"_v{t}") for t in range(2 * len(probs))])
    return _between(wide, by, probs)


def _counted(long: DataFrame, by: list[str], probs: list[float]) -> DataFrame:
    """The values at the two ranks of each probability, from running counts of distinct values."""
    counts = long.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("_count"))
    group = Window.partitionBy(*by)
    upto = F.sum("_count").over(group.orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    placed = counts.withColumns({"n": F.sum("_count").over(group), "_upto": upto})

    def at(p: float, side: int) -> Column:
        k = F.least(F.floor(F.lit(p) * (F.col("n") - 1)) + side, F.col("n") - 1)
        # the first value whose running count passes the rank
        return F.min(F.when(F.col("_upto") > k, F.col("value")))

    return placed.groupBy(*by, "n").agg(*[
        at(p, side).alias(f"_v{2 * i + side}") for i, p in enumerate(probs) for side in (0, 1)])


def _between(wide: DataFrame, by: list[str], probs: list[float]) -> DataFrame:
    """A row per probability, interpolated between the values at its two ranks."""
    position = F.col("q.p") * (F.col("n") - 1)
    return wide.select(*by, "n", F.explode(F.array(*[
        F.struct(F.lit(p).alias("p"), F.col(f"_v{2 * i}").alias("a"),
                 F.col(f"_v{2 * i + 1}").alias("b"))
        for i, p in enumerate(probs)])).alias("q")).select(
        *by, "n", F.col("q.p").alias("p"),
        (F.col("q.a") + (F.col("q.b") - F.col("q.a")) * (position - F.floor(position)))
        .alias("value"))


def _hits(long: DataFrame, left: DataFrame, by: list[str], few: bool) -> DataFrame:
    """A row per rank and value not above its bracket."""
    brackets = left.groupBy(*by).agg(F.collect_list(F.struct("t", "lo", "hi")).alias("_r"))
    side = F.broadcast(brackets) if few else brackets  # `few`: counted, BROADCAST_GROUPS at most
    return null_safe_join(long, side, by, "inner").select(
        *by, "value", F.explode(F.filter("_r", lambda r: F.col("value") <= r["hi"])).alias("_h")
    ).select(*by, F.col("_h.t").alias("t"), F.col("_h.lo").alias("lo"), "value")


def _beside() -> list[Column]:
    """The part beside a bracket that misses its rank: below it or above it."""
    below = F.col("k") < F.col("_below")
    return [F.when(below, F.col("least")).otherwise(F.col("hi")).alias("lo"),
            F.when(below, F.col("lo")).otherwise(F.col("most")).alias("hi")]


def _narrowed(long: DataFrame, left: DataFrame, by: list[str], few: bool,
              most_cells: int) -> DataFrame:
    """Brackets around the part of a histogram of their inside that holds the rank."""
    inside = F.when(F.col("value") >= F.col("lo"), F.col("value"))
    counts = _hits(long, left, by, few).groupBy(*by, "t").agg(
        F.count(F.lit(1)).alias("_upto"), F.count(inside).alias("_in"),
        F.approx_count_distinct(inside).alias("_kinds"),
        F.percentile_approx(inside, [i / _PARTS for i in range(_PARTS + 1)], _ACCURACY)
        .alias("_h"))
    both = null_safe_join(left, counts, [*by, "t"]).withColumn(
        "_below", F.coalesce(F.col("_upto") - F.col("_in"), F.lit(0))).withColumn(
        "_at", F.floor((F.col("k") - F.col("_below")) / F.col("_in") * _PARTS).cast("int"))
    fits = (F.col("k") >= F.col("_below")) & (F.col("k") < F.col("_upto"))
    low = F.when(F.col("_at") >= 2, _nudged(F.element_at("_h", F.greatest(
        F.col("_at") - 1, F.lit(1))), -1)).otherwise(F.col("lo"))
    high = F.when(F.col("_at") < _PARTS - 2, _nudged(F.element_at("_h", F.least(
        F.col("_at") + 4, F.lit(_PARTS + 1))), 1)).otherwise(F.col("hi"))
    lo, hi = _beside()
    return both.select(*by, "n", "least", "most", "t", "k",
                       F.when(fits, low).otherwise(lo).alias("lo"),
                       F.when(fits, high).otherwise(hi).alias("hi"),
                       F.coalesce(~fits | (F.col("_kinds") * (5.0 / _PARTS) > most_cells),
                                  F.lit(True)).alias("wide"))


def _picked(long: DataFrame, left: DataFrame, by: list[str], few: bool) -> DataFrame:
    """The value at each rank, null where the bracket misses it."""
    cell = F.when(F.col("value") >= F.col("lo"), F.col("value"))
    cells = _hits(long, left, by, few).select(*by, "t", cell.alias("_cell")).groupBy(
        *by, "t", "_cell").agg(F.count(F.lit(1)).alias("_count"))
    lists = cells.groupBy(*by, "t").agg(
        F.coalesce(F.sum(F.when(F.col("_cell").isNull(), F.col("_count"))), F.lit(0))
        .alias("_below"),
        F.sort_array(F.collect_list(F.when(F.col("_cell").isNotNull(),
                                           F.struct("_cell", "_count")))).alias("_cells"))
    both = null_safe_join(left, lists, [*by, "t"]).withColumn(
        "_below", F.coalesce("_below", F.lit(0)))
    nothing = F.lit(None).cast("double")
    value = F.aggregate(
        "_cells", F.struct(F.col("_below").alias("seen"), nothing.alias("value")),
        lambda a, c: F.struct(
            (a["seen"] + c["_count"]).alias("seen"),
            F.when((F.col("k") >= a["seen"]) & (F.col("k") < a["seen"] + c["_count"]),
                   c["_cell"]).otherwise(a["value"]).alias("value")),
        lambda a: a["value"])
    return both.withColumn("value", value)


def quantile_table(df: DataFrame, cols: Sequence[str], probs: dict[str, float],
                   keys: Sequence[str] = ()) -> DataFrame:
    """As :func:`exact_quantiles`, one column per named probability."""
    long = exact_quantiles(df, cols, list(probs.values()), keys)
    return long.groupBy(*keys, "feature").agg(
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(name)
          for name, p in probs.items()])
