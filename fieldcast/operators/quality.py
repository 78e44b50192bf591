"""Audits: every check is one aggregate that yields one row (name, status, details)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(stats: DataFrame, name: str, passed: Column, details: Column) -> DataFrame:
    return stats.select(F.lit(name).alias("name"),
                        F.when(passed, "PASSED").otherwise("FAILED").alias("status"),
                        details.alias("details"))


def _distinct_counted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and distinct keys by grouping on the key (map-side combined, skew-proof)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum(F.when(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]),
                                F.col("_n"))), F.lit(0)).alias("nulls"),
        F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])).alias("_ng"))


def check_pk(df: DataFrame, key: str, label: str) -> DataFrame:
    """Key unique and never NULL."""
    s = _distinct_counted(df, [key]).withColumn("distinct_keys", F.col("groups") - F.col("_ng"))
    return _row(s, f"{label} primary key",
                (F.col("nulls") == 0) & (F.col("total") == F.col("distinct_keys")),
                F.format_string("rows: %d, distinct: %d, null: %d",
                                "total", "distinct_keys", "nulls"))


def check_fk_not_null(df: DataFrame, cols: str | Sequence[str], label: str) -> DataFrame:
    """No NULL foreign key; of several candidate columns the first existing one counts."""
    candidates = [cols] if isinstance(cols, str) else list(cols)
    col = next(c for c in candidates if c in df.columns)
    s = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(col).isNull()).alias("nulls"))
    return _row(s, f"{label} {col} not null", F.col("nulls") == 0,
                F.format_string("rows: %d, null: %d", "total", "nulls"))


def check_composite(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Composite natural key unique."""
    return _row(_distinct_counted(df, cols), f"{label} composite key",
                F.col("total") == F.col("groups"),
                F.format_string("rows: %d, distinct: %d", "total", "groups"))


def check_contiguous(df: DataFrame, key: str, label: str) -> DataFrame:
    """Keys run from 1 to the row count."""
    s = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"),
               F.count(F.lit(1)).alias("total"))
    ok = (F.col("lo") == 1) & (F.col("hi") == F.col("total"))
    return _row(s, f"{label} key range", F.coalesce(ok, F.lit(False)),
                F.format_string("min: %d, max: %d, rows: %d", "lo", "hi", "total"))


def check_flag(df: DataFrame, flag: str, label: str, expected: Column | int | None = None
               ) -> DataFrame:
    """Some but not more than all rows flagged, or exactly the expected number."""
    s = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(flag)).alias("flagged"))
    if expected is None:
        ok = (F.col("flagged") > 0) & (F.col("flagged") <= F.col("total"))
    else:
        ok = F.col("flagged") == (F.lit(expected) if isinstance(expected, int) else expected)
    return _row(s, f"{label} {flag}", ok,
                F.format_string("flagged: %d of %d", "flagged", "total"))


def check_orphans(fact: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    """Every key of the fact exists in the dimension.

    Facts are counted per key before the anti join, so the join moves keys, not facts.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    s = per_key.join(dim.select(key).distinct(), key, "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("lost"))
    return _row(s, f"{label} referential integrity", F.col("lost") == 0,
                F.format_string("unmatched rows: %d", "lost"))


def check_parity(a: DataFrame, b: DataFrame, col: str, label: str) -> DataFrame:
    """Both tables hold the same number of distinct values."""
    s = a.agg(F.count_distinct(col).alias("first")).withColumn(
        "second", b.agg(F.count_distinct(col).alias("x")).scalar())
    return _row(s, f"{label} parity", F.col("first") == F.col("second"),
                F.format_string("first: %d, second: %d", "first", "second"))


def check_shape(df: DataFrame, min_cols: int, label: str) -> DataFrame:
    """At least one row and ``min_cols`` columns."""
    width = len(df.columns)
    s = df.agg(F.count(F.lit(1)).alias("total"))
    return _row(s, f"{label} shape", (F.col("total") > 0) & F.lit(width >= min_cols),
                F.format_string("rows: %d, columns: %d", F.col("total"), F.lit(width)))


def any_null_key(df: DataFrame, cols: Sequence[str]) -> bool:
    """Whether any key is NULL; stops at the first hit."""
    hit = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in cols])
    return not df.filter(hit).isEmpty()


def check_any_null(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Table form of :func:`any_null_key`; each task sends at most one row."""
    hit = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in cols])
    s = df.filter(hit).select(F.lit(1).alias("x")).limit(1).agg(
        F.count(F.lit(1)).alias("found"))
    return _row(s, f"{label} key present", F.col("found") == 0,
                F.format_string("null key found: %s",
                                F.when(F.col("found") > 0, "yes").otherwise("no")))


def check_grain(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """No key combination occurs twice."""
    s = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count_if(F.col("_n") > 1).alias("repeated"))
    return _row(s, f"{label} grain", F.col("repeated") == 0,
                F.format_string("repeated keys: %d", "repeated"))


def union_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def audit_totals(audit: DataFrame) -> DataFrame:
    return audit.agg(F.count(F.lit(1)).alias("performed"),
                     F.count_if(F.col("status") == "PASSED").alias("passed"),
                     F.count_if(F.col("status") == "FAILED").alias("failed"))


def run_audit(checks: Sequence[DataFrame], fail: bool = True) -> DataFrame:
    """All checks as one table; with ``fail``, raise when any of them failed."""
    audit = union_checks(checks)
    if fail:
        rows = audit.collect()  # one row per check
        bad = [f"{r['name']} ({r['details']})" for r in rows if r["status"] == "FAILED"]
        if bad:
            raise ValueError(f"{len(bad)} audit(s) failed: {'; '.join(bad)}")
        audit = audit.sparkSession.createDataFrame(rows, audit.schema)
    return audit


def final_checks(df: DataFrame, city: str = "city", split: str = "data_split") -> DataFrame:
    """Final figures of a prepared table with PASS / REVIEW / FAIL."""
    pairs = df.groupBy(city, "date", split).agg(F.count(F.lit(1)).alias("_n"))
    figures = pairs.agg(
        F.sum(F.col("_n") - 1).alias("duplicate city-date rows"),
        F.coalesce(F.sum(F.when(F.col(city).isNull(), F.col("_n"))), F.lit(0))
        .alias("missing city values"),
        F.coalesce(F.sum(F.when(F.col("date").isNull(), F.col("_n"))), F.lit(0))
        .alias("missing date values"),
        *[F.coalesce(F.sum(F.when(F.col(split) == s, F.col("_n"))), F.lit(0)).alias(f"{s} rows")
          for s in ("train", "validation", "test")],
        F.count_distinct(city).alias("included cities"))
    names = figures.columns
    long = figures.select(*[F.col(f"`{n}`").cast("long").alias(n) for n in names]).unpivot(
        [], [F.col(f"`{n}`") for n in names], "check", "result")
    zero_wanted = F.col("check").isin(*names[:3])
    return long.withColumn("status", F.when(
        zero_wanted, F.when(F.col("result") == 0, "PASS").otherwise("REVIEW")
    ).otherwise(F.when(F.col("result") > 0, "PASS").otherwise("FAIL")))
