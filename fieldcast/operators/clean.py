"""Contracts, projections, filters and header clean-up."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast import config as C
from fieldcast.functions.keys import finite


def require_columns(df: DataFrame, cols: Sequence[str], label: str = "input") -> DataFrame:
    """Fail when a column is missing or named twice; return the projection."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"[{label}] missing columns: {missing}")
    twice = sorted(c for c, n in Counter(df.columns).items() if n > 1)
    if twice:
        raise ValueError(f"[{label}] duplicate columns: {twice}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Those of the listed columns that exist, in list order."""
    return df.select(*[F.col(f"`{c}`") for c in cols if c in df.columns])


def filter_plausible(df: DataFrame, ranges: Mapping[str, tuple[float, float]] | None = None,
                     not_null: Sequence[str] = ("city_id", "date")) -> DataFrame:
    """Rows whose keys exist and whose measures lie in their physical ranges."""
    ranges = ranges or {"temperature_2m": (-50, 60), "relative_humidity_2m": (0, 100)}
    for c in not_null:
        df = df.filter(F.col(c).isNotNull())
    for c, (lo, hi) in ranges.items():
        df = df.filter(F.col(c).isNotNull() & F.col(c).between(lo, hi))
    return df


def clean_crop(df: DataFrame) -> DataFrame:
    """Crop rows with a name, a positive yield and possible weather values."""
    return (
        df.withColumn("Crop", F.trim("Crop"))
        .filter(F.col("Crop").isNotNull() & (F.col("Crop") != ""))
        .filter(F.col("Yield_kg_per_ha") > 0)
        .filter(F.col("Temperature_C").between(-10, 55))
        .filter(F.col("`Humidity_%`").between(0, 100))
        .filter(F.col("Rainfall_mm") >= 0)
    )


def enforce_schema(df: DataFrame,
                   schema: Sequence[tuple[str, str]] = C.HOURLY_FILE_SCHEMA) -> DataFrame:
    """Exactly the listed columns, each cast to its type (bad values become NULL)."""
    require_columns(df, [c for c, _ in schema], "schema")
    return df.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in schema])


def rename_if_absent(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Rename old names to canonical ones unless the canonical name exists."""
    mapping = mapping or {"annual_rainfall": "rainfall_mm", "yield": "yield_kg_per_ha"}
    return df.withColumnsRenamed({old: new for old, new in mapping.items()
                                  if old in df.columns and new not in df.columns})


def clean_columns(df: DataFrame) -> DataFrame:
    """Trimmed lower-case names, blanks and hyphens as underscores."""
    return df.toDF(*[re.sub(r"[ -]", "_", c.strip().lower()) for c in df.columns])


def match_columns(cols: Sequence[str],
                  aliases: Mapping[str, Sequence[str]] = C.COLUMN_ALIASES) -> dict[str, str]:
    """Canonical name -> raw header: exact alias first, then alias as a prefix."""
    squeezed = {c: re.sub("[^a-z0-9]", "", c.lower()) for c in cols}
    found = {}
    for name, alts in aliases.items():
        exact = (c for c in cols if squeezed[c] in alts)
        prefixed = (c for c in cols if squeezed[c].startswith(tuple(alts)))
        hit = next(exact, None) or next(prefixed, None)
        if hit is not None:
            found[name] = hit
    return found


def canonicalise(df: DataFrame, aliases: Mapping[str, Sequence[str]] = C.COLUMN_ALIASES,
                 required: Sequence[str] = ("time", "temperature_2m"),
                 keep: Sequence[str] = ()) -> DataFrame:
    """Select the matched headers under their canonical names."""
    matched = match_columns([c for c in df.columns if c not in keep], aliases)
    missing = [c for c in required if c not in matched]
    if missing:
        raise ValueError(f"required columns not found: {missing}")
    return df.select(*keep, *[F.col(f"`{raw}`").alias(std) for std, raw in matched.items()])


def coerce_types(df: DataFrame, time_col: str, numeric_cols: Sequence[str]) -> DataFrame:
    """Parse time and numbers; bad values become NULL, rows without a time go."""
    return df.withColumns({
        time_col: F.try_to_timestamp(F.col(time_col).cast("string")),
        **{c: F.col(c).try_cast("double") for c in numeric_cols},
    }).dropna(subset=[time_col])


def clean_locations(df: DataFrame) -> DataFrame:
    """Usable place rows: state and city present, blank district becomes the city."""
    out = df.dropna(subset=["state", "city"]).withColumns(
        {"state": F.trim("state"), "city": F.trim("city")})
    district = F.trim("district") if "district" in df.columns else F.lit(None)
    region = F.trim("region") if "region" in df.columns else F.lit("General")
    return out.withColumns({
        "district": F.coalesce(F.nullif(district, F.lit("")), F.col("city")),
        "region": region})


def search_locations(df: DataFrame, state: str | None = None, district: str | None = None,
                     region: str | None = None, keyword: str | None = None) -> DataFrame:
    """Equality filters plus a case-insensitive keyword over three columns."""
    for col, value in (("state", state), ("district", district), ("region", region)):
        if value is not None:
            df = df.filter(F.col(col) == value)
    if keyword:
        hit = F.lit(False)
        for col in ("city", "district", "state"):
            hit = hit | F.coalesce(F.contains(F.lower(col), F.lit(keyword.lower())), F.lit(False))
        df = df.filter(hit)
    return df


def drop_years(df: DataFrame, keep: Column | None = None) -> DataFrame:
    """Drop incomplete years; by default those from 2024 on."""
    return df.filter(F.col("year") < 2024 if keep is None else keep)


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows without NULL, NaN or infinity in the listed numeric columns."""
    return df.withColumns({c: finite(c) for c in cols}).dropna(subset=list(cols))


def split_by_keys(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in / is not in the key table."""
    wanted = keys.select(key).distinct()
    return df.join(wanted, key, "left_semi"), df.join(wanted, key, "left_anti")


def concat(*dfs: DataFrame) -> DataFrame:
    """Append frames by column name; absent columns become NULL."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def join_features(df: DataFrame, key: str, *features: DataFrame) -> DataFrame:
    """Left-join feature tables that share one key."""
    for table in features:
        df = df.join(table, key, "left")
    return df
