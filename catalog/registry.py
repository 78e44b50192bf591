"""Collects queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(name)
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def _offset(digits: int) -> float:
    """Shift that moves exact ties (dyadic means) off the rounding edge, on both engines."""
    return 2.0 * 10.0 ** -(digits + 2) if digits >= 4 else 0.0


def r(col: str | Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero; ``rd`` in the SQL twins does the same."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double") + F.lit(_offset(digits)), digits) + 0.0


def rd(sql: str, digits: int = 6) -> str:
    return f"(round(CAST({sql} AS DOUBLE) + {_offset(digits)!r}::DOUBLE, {digits}) + 0.0)"


def present(df: DataFrame, digits: int | None = None, exact: tuple[str, ...] = ()) -> DataFrame:
    """Comparable output: dates as text, counts as bigint, doubles rounded if asked."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DoubleType) and digits and f.name not in exact:
            c = r(c, digits)
        out.append(c.alias(f.name))
    return df.select(*out)
