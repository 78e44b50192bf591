"""Numbering, ranking and de-duplication that never gather one group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.session import checkpoint

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in these bits


def _columns(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def global_order(df: DataFrame, order: Sequence[str | Column], out: str = "row_id",
                 weight: str | None = None) -> DataFrame:
    """Number all rows 1..n in ``order`` without a single-partition window.

    The rows are range-partitioned and sorted, and pinned by a checkpoint so that
    partition numbers cannot change; only one count per partition is then summed up.
    ``weight`` gives instead the running total of that column up to and including
    the row.  ``order`` must identify rows.
    """
    cols = _columns(order)
    ranged = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
              .withColumn("_position", F.monotonically_increasing_id()))
    pinned = checkpoint(ranged).withColumn("_part", F.shiftright("_position", _LOCAL_BITS))
    size = F.sum(weight) if weight else F.count(F.lit(1))
    sizes = pinned.groupBy("_part").agg(size.alias("_size"))
    before = F.coalesce(
        F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))
    offsets = (sizes.select("_part", before.cast("long").alias("_before"))
               .agg(F.map_from_entries(F.collect_list(F.struct("_part", "_before"))).alias("m"))
               .scalar())
    start = F.element_at(offsets, F.col("_part"))
    if weight:
        within = F.sum(weight).over(
            Window.partitionBy("_part").orderBy("_position")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    else:
        within = F.col("_position").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)) + 1
    return pinned.withColumn(out, (start + within).cast("long")).drop("_position", "_part")


def surrogate_keys(df: DataFrame, order_cols: Sequence[str], out: str) -> DataFrame:
    """Contiguous integer keys 1..n in natural-key order."""
    numbered = global_order(df, order_cols, out)
    return numbered.withColumn(out, F.col(out).cast("int"))


def global_dense_rank(df: DataFrame, col: str, out: str, descending: bool = True) -> DataFrame:
    """Dense rank over the whole table: number the distinct values, join them back.

    The table is pinned first: a mean that is computed again may differ in its last bit,
    and would then not find its own rank.
    """
    direction = F.desc_nulls_last if descending else F.asc_nulls_last
    df = checkpoint(df)
    ranks = global_order(df.select(col).distinct(), [direction(col)], out).select(
        F.col(col).alias("_value"), F.col(out).cast("int").alias(out))
    return df.join(ranks, df[col].eqNullSafe(ranks["_value"]), "left").drop("_value")


def order_hash(*cols: str | Column, seed: int) -> Column:
    """Stable pseudo-random order: md5 of seed and key, the same on every engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)),
                             *[c.cast("string") for c in _columns(cols)]))


def hashed_rank(df: DataFrame, keys: Sequence[str], hash_col: str, out: str = "rank",
                total: str = "group_total", digits: int = 3) -> DataFrame:
    """Exact rank by hex hash inside each group, and the group size.

    The first hex digits cut every group into up to 16^digits slices of ordered
    hashes.  Slices are counted (with map-side combine), their offsets summed, and
    rows are numbered inside their slice only, so a group that holds a third of the
    table is ranked by many tasks.
    """
    sliced = df.withColumn("_slice", F.substring(hash_col, 1, digits))
    by_group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    sizes = (
        sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(
            by_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn(total, F.sum("_size").over(by_group))
        .drop("_size")
    )
    joined = null_safe_join(sliced, sizes, [*keys, "_slice"])
    within = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(hash_col))
    return joined.withColumn(out, F.col("_before") + within).drop("_slice", "_before")


#: Rows of a group at the cut that are ranked, and groups whose cuts are broadcast.
CUT_ROWS, BROADCAST_GROUPS = 5000, 20_000


def smallest_hashes(df: DataFrame, keys: Sequence[str], hash_col: str, quota: Column,
                    out: str = "is_sampled", digits: int = 3, most: int = CUT_ROWS) -> DataFrame:
    """Flag the rows with the smallest hex hashes of each group, exactly ``quota`` of them.

    ``quota`` is an expression over ``group_total``.  The hash up to which rows are taken is
    found by counting prefixes (map-side combined) and counting again, with more digits, only
    inside the prefix where the quota is reached, until few rows lie there.  Rows before the cut
    are taken by comparison; only those at the cut (``most`` of a group, or rows of one hash) are
    ranked, so neither a large group nor a small sample of it sorts its rows.  Fewer rows than
    the quota: all; of rows with one hash any.
    """
    own = "_group"
    keys = list(keys)
    rows = df if keys else df.withColumn(own, F.lit(0))
    by = keys or [own]
    head = F.substring(F.col(hash_col), F.lit(1), F.length("_prefix"))
    cut = checkpoint(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("group_total")).select(
        *by, quota.cast("long").alias("_quota"), F.lit("").alias("_prefix"),
        F.lit(0).cast("long").alias("_taken"), F.col("group_total").alias("_size")))
    few = cut.count() <= BROADCAST_GROUPS
    inside = (F.col("_quota") > F.col("_taken")) & (F.col("_quota") < F.col("_taken") + F.col("_size"))
    deeper = inside & (F.col("_size") > most) & (F.length("_prefix") < 32)

    def with_cut(side: DataFrame) -> DataFrame:
        return null_safe_join(rows, F.broadcast(side) if few else side, by, "inner")

    while not cut.filter(deeper).isEmpty():
        longer = F.substring(F.col(hash_col), F.lit(1), F.length("_prefix") + digits)
        counts = with_cut(cut.filter(deeper)).filter(head == F.col("_prefix")).groupBy(
            *by, "_quota", "_taken", longer.alias("_next")).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_next"))  # 16^digits rows at most
        placed = counts.withColumn("_upto", F.col("_taken") + upto).filter(
            (F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota")))
        cut = checkpoint(cut.filter(~deeper).unionByName(placed.select(
            *by, "_quota", F.col("_next").alias("_prefix"),
            (F.col("_upto") - F.col("_n")).alias("_taken"), F.col("_n").alias("_size"))))
    joined = with_cut(cut)
    at_cut = inside & (head == F.col("_prefix"))
    whole = (F.col("_quota") >= F.col("_taken") + F.col("_size")) & (head == F.col("_prefix"))
    sure = joined.filter(~at_cut).withColumn(out, (head < F.col("_prefix")) | whole)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(hash_col))
    ranked = joined.filter(at_cut).withColumn(out, rank <= F.col("_quota") - F.col("_taken"))
    return sure.unionByName(ranked).drop("_quota", "_prefix", "_taken", "_size", own)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join that also pairs NULL keys; key columns are kept once (from the left)."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    condition = on[0]
    for extra in on[1:]:
        condition = condition & extra
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def with_group(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Attach group aggregates to every row: aggregate first, then join back.

    Unlike a window, the aggregate combines before the shuffle and the join can be
    broadcast or split by adaptive execution when one group dominates.
    """
    summary = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return null_safe_join(df, summary, keys)


def with_group_count(df: DataFrame, keys: Sequence[str], out: str = "count") -> DataFrame:
    return with_group(df, keys, **{out: F.count(F.lit(1))})


def relative_to_max(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """Value relative to the maximum of its own group."""
    return with_group(df, [key], _max=F.max(col)).withColumn(
        out, F.col(col) / F.col("_max")).drop("_max")


def group_anomaly(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Deviation of each column from its own group's mean."""
    means = {f"_mean_{c}": F.avg(c) for c in cols}
    out = with_group(df, [key], **means)
    return out.withColumns(
        {f"{c}_anomaly": F.col(c) - F.col(f"_mean_{c}") for c in cols}).drop(*means)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in ``order``, by a minimum of structs (map-side combined).

    Rows equal in ``order`` go by the values of the other columns from left to right, NULL
    first; maps have no order and are only carried along.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    lead = [c for c in order if c not in keys]
    comparable = [c for c in rest if "map<" not in df.schema[c].dataType.simpleString()]
    packed = F.min_by(F.struct(*lead, *rest), F.struct(F.lit(0).alias("_"), *lead, *comparable)
                      ).alias("_row")
    return df.groupBy(*keys).agg(packed).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedup_none(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop every member of a key that occurs more than once."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
            .filter("_n = 1").select(*df.columns))


def top_k(df: DataFrame, col: str, k: int, ascending: bool = False,
          ties: Sequence[str] = ()) -> DataFrame:
    """First k rows by a measure; ``ties`` make the choice deterministic."""
    lead = F.asc_nulls_last(col) if ascending else F.desc_nulls_last(col)
    return df.orderBy(lead, *ties).limit(k)


def order_by(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*cols)


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def select_even(df: DataFrame, key: str, preferred: DataFrame, n: int) -> DataFrame:
    """Preferred keys first, then evenly spaced picks from the ordered rest, up to n.

    ``preferred`` is a table of keys.  Picked positions are
    floor(i * (rest - 1) / (need - 1)), as an evenly spaced index would give.
    """
    chosen = df.join(preferred.select(key).distinct(), key, "left_semi")
    rest = df.join(preferred.select(key).distinct(), key, "left_anti")
    counts = chosen.agg(F.count(F.lit(1)).alias("have")).withColumn(
        "left_over", rest.agg(F.count(F.lit(1)).alias("x")).scalar())
    need = F.greatest(F.least(F.lit(n) - F.col("have"), F.col("left_over")), F.lit(0))
    picks = counts.select(
        F.explode(F.when(need > 0, F.transform(
            F.sequence(F.lit(0).cast("long"), need.cast("long") - 1),
            lambda i: F.when(need == 1, F.lit(0)).otherwise(
                F.floor(i * (F.col("left_over") - 1) / F.greatest(need - 1, F.lit(1)))
            ).cast("long") + 1))).alias("_pos")).distinct()
    numbered = global_order(rest, [key], "_pos")
    extra = numbered.join(picks, "_pos", "left_semi").drop("_pos")
    head = global_order(chosen, [key], "_pos").filter(F.col("_pos") <= n).drop("_pos")
    return head.withColumn("picked_as", F.lit("preferred")).unionByName(
        extra.withColumn("picked_as", F.lit("spaced")))
