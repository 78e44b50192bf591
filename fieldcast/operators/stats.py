"""Correlation, collinearity, relevance and trends on tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcast.functions.keys import finite
from fieldcast.functions.scores import correlation_strength, vif_flag
from fieldcast.operators.clean import complete_cases
from fieldcast.operators.quantiles import exact_quantiles, to_long
from fieldcast.operators.ranking import global_order
from fieldcast.session import checkpoint


_MOMENTS = "pair int, n double, mx double, my double, vx double, vy double, c double"


def _joined(a: tuple, b: tuple) -> tuple:
    """Counts, means and centred sums of two sets of rows as those of both; arrays or numbers."""
    n = a[0] + b[0]
    dx, dy, share = b[1] - a[1], b[2] - a[2], b[0] / np.maximum(n, 1)
    both = a[0] * share
    return (n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * both,
            a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both)


def _batch_moments(values: np.ndarray, x: list[int], y: list[int]) -> tuple:
    """Moments of the pairs of columns (x, y) over the rows where both are present."""
    there = ~np.isnan(values)
    count = np.maximum(there.sum(0), 1)
    # centred from a value that occurs: a constant column gives exact zeros
    least = np.min(values, axis=0, where=there, initial=np.inf)
    least = np.where(np.isfinite(least), least, 0.0)
    shift = least + np.where(there, values - least, 0.0).sum(0) / count
    held, there = np.where(there, values - shift, 0.0), there.astype(np.float64)
    n = (there.T @ there)[x, y]
    sums, squares = held.T @ there, (held * held).T @ there
    some = np.maximum(n, 1)
    sx, sy = sums[x, y], sums[y, x]
    return (n, shift[x] + sx / some, shift[y] + sy / some, squares[x, y] - sx * sx / some,
            squares[y, x] - sy * sy / some, (held.T @ held)[x, y] - sx * sy / some)


def _pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], name: str) -> DataFrame:
    """One scan, one row of moments per task and pair, joined to (feature_1, feature_2, r).

    One ``corr`` per pair in one aggregate has more buffers than Spark compiles code for, so the
    moments of all pairs are matrix products of a batch.  Undefined correlations are NULL.
    """
    cols = df.columns
    x, y = ([cols.index(p[side]) for p in pairs] for side in (0, 1))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                found = _batch_moments(np.stack([c.to_numpy(zero_copy_only=False)
                                                 for c in batch.columns], axis=1), x, y)
                held = found if held is None else _joined(held, found)
        if held is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(x)), pa.int32()), *map(pa.array, held)],
                names=["pair", "n", "mx", "my", "vx", "vy", "c"])

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        held = None
        for row in rows.drop(columns="pair").itertuples(index=False, name=None):
            held = row if held is None else _joined(held, row)
        n, _, _, vx, vy, c = held
        r = c / np.sqrt(vx * vy) if n > 1 and vx * vy > 0 else None
        return pd.DataFrame({"pair": rows["pair"].iloc[:1], name: pd.Series([r], dtype="float64",
                                                                            index=rows.index[:1])})

    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    found = numbers.mapInArrow(moments, _MOMENTS).groupBy("pair").applyInPandas(
        join, f"pair int, `{name}` double").withColumn(name, F.nanvl(F.col(name), F.lit(None)))
    names = df.sparkSession.range(1).select(F.posexplode(F.array(*[
        F.struct(F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2")) for a, b in pairs])))
    return names.select(F.col("pos").alias("pair"), "col.*").join(found, "pair", "left").select(
        "feature_1", "feature_2", name)


def pearson_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Upper triangle of the Pearson matrix; NULLs are dropped pair by pair."""
    clean = df.select(*[finite(c).alias(c) for c in cols])
    return _pairs(clean, list(combinations(cols, 2)), "correlation")


def mirror(pairs: DataFrame) -> DataFrame:
    """Both triangles of a pair table."""
    flipped = pairs.select(F.col("feature_2").alias("feature_1"),
                           F.col("feature_1").alias("feature_2"),
                           *[c for c in pairs.columns if not c.startswith("feature_")])
    return pairs.unionByName(flipped)


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full matrix: one row per feature, one column per partner."""
    long = mirror(pearson_pairs(df, cols))
    return long.groupBy(F.col("feature_1").alias("feature")).agg(*[
        F.max(F.when(F.col("feature_1") == c, F.lit(1.0))
              .when(F.col("feature_2") == c, F.col("correlation"))).alias(c) for c in cols])


def average_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Average rank of every distinct value of each column (long form).

    Distinct values are counted, then their counts are summed in one range-partitioned
    order over all columns; ties of any size cost one row.
    """
    counts = to_long(df, cols).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("_count"))
    running = global_order(counts, ["feature", "value"], "_cum", weight="_count")
    start = running.groupBy("feature").agg(
        F.min(F.col("_cum") - F.col("_count")).alias("_base"))
    return running.join(start, "feature").select(
        "feature", "value",
        (F.col("_cum") - F.col("_base") - (F.col("_count") - 1) / 2).alias("rank"))


def with_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each value by its average rank (complete rows).

    The rows are pinned with a number each, since they meet their ranks by exact equality: one
    join in long form for all columns, then one row per number again.
    """
    rows = checkpoint(complete_cases(df.select(*cols), cols).withColumn(
        "_row", F.monotonically_increasing_id()))
    ranked = to_long(rows, cols, ["_row"]).join(average_ranks(rows, cols), ["feature", "value"])
    return ranked.groupBy("_row").agg(*[
        F.max(F.when(F.col("feature") == c, F.col("rank"))).alias(c) for c in cols]).drop("_row")


def spearman_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Upper triangle of the Spearman matrix: Pearson correlation of average ranks."""
    return pearson_pairs(with_ranks(df, cols), cols)


def corr_pairs(pairs: DataFrame, watch: float = 0.80, drop: float = 0.95,
               value: str = "correlation", strict: bool = False) -> DataFrame:
    """Pairs from ``watch`` upwards with a decision; ``strict`` compares by ``>``."""
    r = F.abs(F.col(value))
    keep, near = (r > watch, r > drop) if strict else (r >= watch, r >= drop)
    return pairs.filter(keep).withColumn("decision", F.when(
        near, "DROP ONE — near duplicate").otherwise("WATCH — multicollinearity risk"))


def pair_report(df: DataFrame, cols: Sequence[str], watch: float = 0.80,
                drop: float = 0.95) -> DataFrame:
    """Pearson and Spearman side by side; the larger absolute value decides."""
    both = pearson_pairs(df, cols).withColumnRenamed("correlation", "pearson").join(
        spearman_pairs(df, cols).withColumnRenamed("correlation", "spearman"),
        ["feature_1", "feature_2"]).withColumn(
        "max_absolute_correlation", F.greatest(F.abs("pearson"), F.abs("spearman")))
    return corr_pairs(both, watch, drop, "max_absolute_correlation")


def max_partner(pairs: DataFrame, value: str = "correlation") -> DataFrame:
    """Strongest partner of each feature; the alphabetically first wins a tie.

    Values are compared on twelve digits, so that noise in the last bits decides nothing.
    """
    size = F.round(F.abs(F.col(value)), 12)
    best = F.min(F.struct((-size).alias("a"), "feature_2")).alias("b")
    return mirror(pairs).filter(F.col(value).isNotNull()).groupBy(
        F.col("feature_1").alias("feature")).agg(best).select(
        "feature", (-F.col("b.a")).alias("max_abs_correlation"),
        F.col("b.feature_2").alias("most_correlated_with"))


def target_relevance(df: DataFrame, features: Sequence[str],
                     targets: Sequence[str]) -> DataFrame:
    """Correlation of each feature with each target, strongest first."""
    pairs = [(t, f) for t in targets for f in features if f != t]
    clean = df.select(*[finite(c).alias(c) for c in dict.fromkeys([*features, *targets])])
    return _pairs(clean, pairs, "correlation").select(
        F.col("feature_1").alias("target"), F.col("feature_2").alias("feature"), "correlation",
        F.abs("correlation").alias("absolute_correlation")).orderBy(
        "target", F.desc("absolute_correlation"))


def independence(df: DataFrame, cols: Sequence[str], limit: float = 0.80) -> DataFrame:
    """Pairs of a feature set that are not independent."""
    return pearson_pairs(df, cols).withColumn("status", F.when(
        F.abs("correlation") >= limit, "REVIEW").otherwise("OK"))


def vif(df: DataFrame, cols: Sequence[str], intercept: bool = True) -> DataFrame:
    """Variance inflation factors over complete rows.

    Spark reduces the table to one row of k(k+1)/2 moments; only that row reaches the
    small matrix inverse.
    """
    cols = list(cols)
    clean = complete_cases(df.select(*cols), cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]

    def moment(i: int, j: int) -> Column:
        a, b = F.col(cols[i]), F.col(cols[j])
        return F.covar_pop(a, b) if intercept else F.avg(a * b)

    row = clean.agg(F.array(*[moment(i, j) for i, j in pairs]).alias("m"))

    def invert(batches):
        for batch in batches:
            for values in batch["m"]:
                m = np.zeros((len(cols), len(cols)))
                for (i, j), v in zip(pairs, values):
                    m[i, j] = m[j, i] = v
                yield pd.DataFrame({"feature": cols,
                                    "vif": np.diag(np.linalg.inv(m)) * np.diag(m)})

    return row.mapInPandas(invert, "feature string, vif double").withColumn(
        "flag", vif_flag("vif"))


def mutual_information(df: DataFrame, features: Sequence[str], target: str,
                       bins: int = 8) -> DataFrame:
    """Mutual information (nats) of each feature with a target, equal-frequency bins.

    Bin edges are exact quantiles; only joint counts of bins are shuffled.
    """
    cols = list(dict.fromkeys([*features, target]))
    clean = complete_cases(df.select(*cols), cols)
    edges = exact_quantiles(clean, cols, [i / bins for i in range(1, bins)]).groupBy(
        "feature").agg(F.sort_array(F.collect_list("value")).alias("e"))
    packed = edges.agg(F.map_from_entries(F.collect_list(F.struct("feature", "e"))).alias("m"))
    with_edges = clean.select(*cols, packed.scalar().alias("_m")).select(
        *cols, *[F.element_at("_m", F.lit(c)).alias(f"_e_{c}") for c in cols])

    def bin_of(c: str) -> Column:
        above = [(F.get(f"_e_{c}", F.lit(i)) < F.col(c)).cast("int") for i in range(bins - 1)]
        return sum(above[1:], above[0])

    binned = with_edges.select(*[bin_of(c).alias(c) for c in cols])
    wanted = [f for f in features if f != target]
    joint = binned.select(F.col(target).alias("y"), F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("x")) for f in wanted])).alias("s")
    ).groupBy(F.col("s.feature").alias("feature"), F.col("s.x").alias("x"), "y").agg(
        F.count(F.lit(1)).alias("n"))

    def total(*by: str) -> Column:  # at most bins * bins rows per feature
        return F.sum("n").over(Window.partitionBy("feature", *by))

    all_counts = joint.withColumns({"nx": total("x"), "ny": total("y"), "nt": total()})
    term = F.col("n") / F.col("nt") * F.log(
        F.col("n").cast("double") * F.col("nt") / (F.col("nx").cast("double") * F.col("ny")))
    return all_counts.groupBy("feature").agg(F.sum(term).alias("mutual_information")).withColumn(
        "target", F.lit(target))


def t_two_sided_p(t: Column, dof: Column) -> Column:
    """Two-sided p-value of Student's t for whole degrees of freedom.

    Uses the finite trigonometric sum for the distribution, so it stays a column
    expression.
    """
    odd = dof % 2 == 1
    theta = F.atan(F.abs(t) / F.sqrt(dof))
    cos2 = F.pow(F.cos(theta), F.lit(2.0))
    # terms: even dof  1, 1/2 c2, 1*3/(2*4) c2^2 ... ; odd dof  c, 2/3 c^3, 2*4/(3*5) c^5 ...
    count = F.when(odd, (dof - 1) / 2).otherwise(dof / 2).cast("int")
    steps = F.when(count > 1, F.sequence(F.lit(1), count - 1)).otherwise(
        F.array().cast("array<int>"))
    first = F.when(odd, F.cos(theta)).otherwise(F.lit(1.0))

    def grow(acc: Column, k: Column) -> Column:
        ratio = F.when(odd, 2 * k / (2 * k + 1)).otherwise((2 * k - 1) / (2 * k))
        term = acc["term"] * ratio * cos2
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    series = F.aggregate(steps, F.struct(first.alias("term"), first.alias("total")), grow,
                         lambda acc: acc["total"])
    inner = F.when(odd, F.lit(2.0) / F.pi() * (
        theta + F.when(dof > 1, F.sin(theta) * series).otherwise(0.0))
    ).otherwise(F.sin(theta) * series)
    return F.greatest(F.lit(0.0), F.lit(1.0) - inner)


def linear_trend(df: DataFrame, keys: Sequence[str], x: str, y: str,
                 min_points: int = 4) -> DataFrame:
    """Least-squares slope, intercept, r, t and p of y over x per key."""
    fit = df.groupBy(*keys).agg(
        F.regr_count(F.col(y), F.col(x)).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.corr(F.col(x), F.col(y)).alias("r"),
    ).filter(F.col("n") >= min_points)
    dof = F.col("n") - 2
    t = F.col("r") * F.sqrt(dof / (F.lit(1.0) - F.col("r") * F.col("r")))
    return fit.withColumn("t", F.when(F.abs("r") < 1, t)).withColumn(
        "p_value", F.when(F.abs("r") < 1, t_two_sided_p(F.col("t"), dof)).when(
            F.col("r").isNotNull(), 0.0))


def yearly_city_trend(daily: DataFrame, key: str = "city", col: str = "temp_mean") -> DataFrame:
    """Trend of yearly means per city (more than three years)."""
    yearly = daily.groupBy(key, "year").agg(F.avg(col).alias("y"))
    return linear_trend(yearly, [key], "year", "y")


def spatial_trend(profile: DataFrame, pairs: Sequence[tuple[str, str]],
                  min_rows: int = 5) -> DataFrame:
    """Correlation of coordinates with metrics, with strength and row count."""
    def both(a, b):
        return F.col(a).isNotNull() & F.col(b).isNotNull()

    row = profile.agg(F.array(*[F.struct(
        F.lit(a).alias("coordinate"), F.lit(b).alias("weather_metric"),
        F.count_if(both(a, b)).alias("cities_used"),
        (F.min(F.when(both(a, b), F.col(a))) < F.max(F.when(both(a, b), F.col(a))))
        .alias("varies"), F.corr(F.col(a), F.col(b)).alias("correlation"))
        for a, b in pairs]).alias("t"))
    return row.select(F.inline("t")).filter(
        (F.col("cities_used") >= min_rows) & F.col("varies")).drop("varies").withColumn(
        "strength", correlation_strength("correlation"))


def feature_report(df: DataFrame, quality: DataFrame, pairs: DataFrame,
                   vifs: DataFrame) -> DataFrame:
    """Quality, strongest partner and VIF of each feature side by side."""
    return quality.join(max_partner(pairs), "feature", "left").join(
        vifs.select("feature", "vif"), "feature", "left")
