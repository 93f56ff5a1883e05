"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_text(name: str) -> Column:
    """The text with null counted as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it in `body`."""
    return F.transform(F.array(value), body)[0]


def row_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits that name a row by the content of `columns`; rows that repeat all of them share it.

    Each value carries its length, so no two lists of values read alike; null differs from empty.
    """
    parts = []
    for c in columns:
        s = F.col(c).cast("string")
        parts += [F.coalesce(F.length(s).cast("string"), F.lit("-")), F.coalesce(s, F.lit(""))]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts).cast("binary")))


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns an operator is about to add, in any letter case."""
    low = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in low])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of `df` has, in any letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
