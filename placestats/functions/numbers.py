"""Casts, rounding and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.constants import EARTH_KM


def parse_number(col: Column, null_tokens: list[str], default: int | None = None) -> Column:
    """Whole number from text; listed tokens and unparsable text are missing."""
    token = F.upper(F.trim(col))
    value = F.when(~token.isin(null_tokens), F.trim(col).try_cast("decimal(18,0)").try_cast("int"))
    return value if default is None else F.coalesce(value, F.lit(default))


def to_int(col: Column, default: int | None = None) -> Column:
    value = col.try_cast("int")
    return value if default is None else F.coalesce(value, F.lit(default))


def flag_eq(col: Column, value: int) -> Column:
    """Numeric test on a text column; text that is no number is false."""
    return F.coalesce(col.try_cast("int") == value, F.lit(False))


def round_half_up(col: Column, digits: int = 0) -> Column:
    return F.round(col, digits)


def round_half_even(col: Column, digits: int = 0) -> Column:
    return F.bround(col, digits)


def clamp(col: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Keep a value within bounds; null stays null (GREATEST and LEAST alone skip it)."""
    out = col
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(col.isNotNull(), out)


def safe_ratio(num: Column, den: Column, scale: float = 1.0, default: float | None = 0.0) -> Column:
    """`num / den * scale` in double, `default` unless the denominator is positive."""
    ratio = num.cast("double") * F.lit(float(scale)) / den.cast("double")
    guarded = F.when(den > 0, ratio)
    return guarded if default is None else guarded.otherwise(F.lit(float(default)))


def share_pct(num: Column, den: Column, even: bool = False) -> Column:
    """Percentage to one digit, 0 for an empty total."""
    pct = safe_ratio(num, den, 100.0)
    return F.bround(pct, 1) if even else F.round(pct, 1)


def fill_sentinel(df: DataFrame, values: dict) -> DataFrame:
    """Replace nulls by per-column sentinels. Keep this the last step."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def arc_km(chord: Column) -> Column:
    """Kilometres on the sphere of a squared half-chord (the haversine)."""
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * F.lit(2 * EARTH_KM)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres on a sphere."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.when(chord.isNotNull(), arc_km(chord))
