"""Keys, lookups and value cleaning on single columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast import config as C


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_key(col: str | Column, strict: bool = False) -> Column:
    """Join key: trimmed lower case, or only ``[a-z0-9]`` when ``strict``."""
    lowered = F.lower(_col(col))
    return F.regexp_replace(lowered, "[^a-z0-9]", "") if strict else F.trim(lowered)


def base_name(col: str | Column) -> Column:
    """Name without a trailing numeric suffix (``X_2`` gives ``X``)."""
    return F.regexp_replace(_col(col), r"_\d+$", "")


def replace_values(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace whole values of one column."""
    return df.replace(dict(mapping), subset=[col])


def class_lookup(col: str | Column, classes: Mapping, default) -> Column:
    """Ladder ``class -> members`` turned into one CASE expression."""
    expr = None
    for label, members in classes.items():
        test = _col(col).isin(*members)
        expr = F.when(test, F.lit(label)) if expr is None else expr.when(test, F.lit(label))
    return expr.otherwise(F.lit(default))


def map_lookup(col: str | Column, mapping: Mapping, default) -> Column:
    """Dictionary lookup with a default, for dictionaries of literal size."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(col)), F.lit(default))


def region_of_state(col: str | Column) -> Column:
    """Macro region of a state, else ``Other``."""
    return class_lookup(col, C.REGION_STATES, "Other")


def assign_region(state: str | Column, lat: str | Column, lon: str | Column) -> Column:
    """Region by state name; unknown states fall back to coordinate rules."""
    lat, lon = _col(lat), _col(lon)
    by_place = (
        F.when((lon >= 88) & (lat >= 21), "Northeast")
        .when(lat >= 28, "North")
        .when((lon <= 76) & (lat >= 15), "West")
        .when(lat < 20, "South")
        .when(lon >= 84, "East")
        .otherwise("Central")
    )
    by_name = class_lookup(norm_key(state, strict=True), C.COORDINATE_REGION_STATES, None)
    return F.coalesce(by_name, by_place)


def soil_ph(col: str | Column) -> Column:
    """Soil pH class of a state."""
    return class_lookup(col, C.SOIL_PH_STATES, C.DEFAULT_PH).cast("double")


def fill_chain(col: str | Column, *alternatives) -> Column:
    """Own value, else the first non-null alternative (columns or constants)."""
    rest = [a if isinstance(a, Column) else F.lit(a) if not isinstance(a, str) else F.col(a)
            for a in alternatives]
    return F.coalesce(_col(col), *rest)


def in_bbox(lat: str | Column, lon: str | Column,
            box: Sequence[float] = (6, 38, 68, 98)) -> Column:
    """Inside ``(lat_min, lat_max, lon_min, lon_max)``, bounds included."""
    return _col(lat).between(box[0], box[1]) & _col(lon).between(box[2], box[3])


def finite(col: str | Column) -> Column:
    """NULL for NaN and infinities."""
    c = _col(col).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)
