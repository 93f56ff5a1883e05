"""Array and JSON expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name an expression that the body uses several times, so it is evaluated once."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def get_or(arr: Column, i: Column | int, default: Column) -> Column:
    """Element `i` (from 0) or `default` when out of range."""
    return F.coalesce(F.get(arr, i if isinstance(i, Column) else F.lit(i)), default)


def explode_pos(df: DataFrame, col: str, value: str, pos: str = "pos") -> DataFrame:
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.posexplode(col).alias(pos, value))


def close_ring(ring: Column) -> Column:
    """Append the first point so the ring ends where it began."""
    return F.concat(ring, F.slice(ring, 1, 1))


def json_path(col: Column, path: str, dtype: str) -> Column:
    return F.get_json_object(col, path).try_cast(dtype)


def json_object(fields: Mapping[str, Column]) -> Column:
    """JSON text of a struct; null fields are written as null."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"})
