"""Grouped counts, shares, lists and reshaping. All pre-aggregate before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.functions.numbers import share_pct


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def conditional_counts(df: DataFrame, keys: Sequence[str], conds: Mapping[str, Column], **more: Column) -> DataFrame:
    """One count per condition, plus any further aggregates."""
    counts = [F.count_if(c).alias(n) for n, c in conds.items()]
    return df.groupBy(*keys).agg(*counts, *[c.alias(n) for n, c in more.items()])


def profile_by_area(dim: DataFrame, fact: DataFrame, key: str, keep: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Every area of `dim` with aggregates of its facts; areas without facts stay.

    Facts are aggregated before the join, so only one row per area meets the
    dimension however many facts an area has.
    """
    per_area = fact.where(F.col(key).isNotNull()).groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
    return dim.select(key, *keep).join(per_area, key, "left")


def type_breakdown(df: DataFrame, keys: Sequence[str], col: str, groups: Mapping[str, Sequence[str]], **more: Column) -> DataFrame:
    """Counts of value groups as named columns; absent values count zero."""
    return conditional_counts(df, keys, {n: F.col(col).isin(list(v)) for n, v in groups.items()}, **more)


def is_true_text(col: Column) -> Column:
    """Truth of a boolean or of its text form."""
    return F.coalesce(F.lower(col.cast("string")) == "true", F.lit(False))


def true_share(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    out = df.groupBy(*keys).agg(F.count_if(is_true_text(F.col(col))).alias("n_true"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("true_pct", share_pct(F.col("n_true"), F.col("n"), even=True))


def kpis(df: DataFrame, spec: Mapping[str, Column]) -> DataFrame:
    """One row of whole-table figures."""
    return df.agg(*[c.alias(n) for n, c in spec.items()])


def distribution(df: DataFrame, col: str) -> DataFrame:
    return count_by(df, [col])


def collect_sorted(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """Sorted distinct values per key, for relations of bounded degree such as adjacency."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(col)).alias(name))


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "component", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), var, value)


def to_wide(df: DataFrame, keys: Sequence[str], col: str, values: Sequence, agg: Column) -> DataFrame:
    """Pivot over a fixed list of values; missing combinations become 0."""
    return df.groupBy(*keys).pivot(col, list(values)).agg(agg).fillna(0, subset=[str(v) for v in values])


def align(df: DataFrame, schema: Mapping[str, str], constants: Mapping[str, object] | None = None) -> DataFrame:
    """Project a source onto a common schema: cast, add constants, null for the rest."""
    constants = constants or {}
    cols = []
    for name, dtype in schema.items():
        if name in constants:
            cols.append(F.lit(constants[name]).cast(dtype).alias(name))
        elif name in df.columns:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)


def union_aligned(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for more in dfs[1:]:
        out = out.unionByName(more)
    return out


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])
