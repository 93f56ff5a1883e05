"""Row filters over time and place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.constants import METRO_BOX


def as_timestamp(as_of: str | Column | None) -> Column:
    """The clock: an explicit moment, or now."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of


def drop_future(df: DataFrame, ts: str, as_of: str | None = None) -> DataFrame:
    return df.where(F.col(ts).isNotNull() & (F.col(ts) <= as_timestamp(as_of)))


def complete_months(df: DataFrame, ts: str, as_of: str | None = None) -> DataFrame:
    """Rows before the month of `as_of`. A plain range on `ts`, so it reaches the scan."""
    start = F.date_trunc("month", as_timestamp(as_of)).cast("timestamp_ntz")
    return df.where(F.col(ts) < start)


def since_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    return df.where(F.col(ts) >= F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz"))


def trailing_months(df: DataFrame, ts: str, n: int = 12, as_of: str | None = None, anchor: str = "max") -> DataFrame:
    """Rows of the last `n` months, ending at `as_of`, else at the newest row (`anchor="max"`) or today (`"now"`).

    The newest row is a scalar subquery over the one column, whose value is pushed
    into the scan like a literal.
    """
    if anchor not in ("max", "now"):
        raise ValueError(f"unknown anchor {anchor!r}")
    kind = df.schema[ts].dataType
    if as_of is None and anchor == "max":
        start = df.agg(F.add_months(F.max(F.col(ts).cast("date")), -n).cast(kind)).scalar()
    else:
        start = F.add_months(as_timestamp(as_of).cast("date"), -n).cast(kind)
    return df.where(F.col(ts) >= start)


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float] = METRO_BOX) -> Column:
    """Is the coordinate inside (lat min, lat max, long min, long max)? Missing is outside."""
    inside = lat.between(box[0], box[1]) & lon.between(box[2], box[3])
    return F.coalesce(inside, F.lit(False))


def validate_bbox(
    df: DataFrame, lat: str = "lat", lon: str = "long", box: tuple = METRO_BOX, flag: str = "valid_location"
) -> DataFrame:
    """Null out coordinates outside the box and flag the rows."""
    ok = in_box(F.col(lat), F.col(lon), box)
    return df.withColumns({flag: ok, lat: F.when(ok, F.col(lat)), lon: F.when(ok, F.col(lon))})
