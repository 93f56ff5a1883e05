"""Joins in the shapes place analytics needs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.functions.text import norm_text


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    cols: dict[str, str],
    dim_key: str | None = None,
    how: str = "left",
    norm: bool = False,
    only_when: Column | None = None,
    defaults: dict | None = None,
) -> DataFrame:
    """Add dimension columns (`{dim column: new name}`) by one key.

    `norm` compares trimmed upper-case text, `only_when` limits the left rows that
    may match, `defaults` fill what found no partner.
    """
    shape = norm_text if norm else (lambda c: c)
    side = dim.select(
        shape(F.col(dim_key or key)).alias("_k"), *[F.col(c).alias(f"_d_{name}") for c, name in cols.items()]
    )
    on = shape(F.col(key)) == F.col("_k")
    if only_when is not None:
        on = on & only_when
    out = df.join(side, on, how).drop("_k")
    defaults = defaults or {}
    filled = {
        name: F.coalesce(F.col(f"_d_{name}"), F.lit(defaults[name])) if name in defaults else F.col(f"_d_{name}")
        for name in cols.values()
    }
    return out.withColumns(filled).drop(*[f"_d_{name}" for name in cols.values()])


def keep_matched(df: DataFrame, ref: DataFrame, key: str, cols: Sequence[str], tolerant: str | None = None) -> DataFrame:
    """Inner join that keeps rows known to `ref`; `tolerant` casts the left key first."""
    left_key = F.col(key).try_cast(tolerant) if tolerant else F.col(key)
    side = ref.select(F.col(key).alias("_k"), *cols)
    return df.join(side, left_key == F.col("_k"), "inner").drop("_k")


def left_fill(a: DataFrame, b: DataFrame, key: str, fills: dict, norm: bool = False) -> DataFrame:
    """Left join that takes the columns of `fills` from `b`; unmatched rows get the fill.

    A fill of None leaves nulls. `norm` compares names without case.
    """
    shape = F.upper if norm else (lambda c: c)
    side = b.select(shape(F.col(key)).alias("_k"), *[F.col(c).alias(f"_b_{c}") for c in fills])
    out = a.join(side, shape(F.col(key)) == F.col("_k"), "left").drop("_k")
    filled = {
        c: F.col(f"_b_{c}") if v is None else F.coalesce(F.col(f"_b_{c}"), F.lit(v)) for c, v in fills.items()
    }
    return out.withColumns(filled).drop(*[f"_b_{c}" for c in fills])


def match_exact(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str], how: str = "left") -> DataFrame:
    """Equality join on several columns, doubles compared exactly."""
    side = b.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *cols)
    on = reduce(lambda p, q: p & q, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    return a.join(side, on, how).drop(*[f"_k_{k}" for k in keys])


def update_by_key(df: DataFrame, patch: DataFrame, key: str, col: str) -> DataFrame:
    """Overwrite `col` where the patch has a row for the key."""
    side = patch.select(F.col(key).alias("_k"), F.col(col).alias("_new"))
    return (
        df.join(side, F.col(key) == F.col("_k"), "left")
        .withColumn(col, F.coalesce("_new", F.col(col)))
        .drop("_k", "_new")
    )


def update_where(df: DataFrame, cond: Column, col: str, value: Column) -> DataFrame:
    """Overwrite `col` where a predicate holds."""
    return df.withColumn(col, F.when(cond, value).otherwise(F.col(col)))


def neighbours_of(df: DataFrame, pairs: DataFrame, name: str, col: str = "neighborhood_name", itself: bool = False) -> DataFrame:
    """Rows of the areas adjacent to `name`; `pairs` has columns a and b."""
    near = pairs.where(F.col("a") == name).select(F.col("b").alias("_n"))
    if itself:
        near = near.unionByName(df.where(F.col(col) == name).select(F.col(col).alias("_n"))).distinct()
    return df.join(near, F.col(col) == F.col("_n"), "left_semi")
