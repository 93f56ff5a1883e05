"""Row choice and row numbers that no hot key can pull into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placestats.session import materialize


def dedupe(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in `order`.

    Spark keeps at most one row per key and map task before the shuffle (window
    group limit), so a key with most of the rows still ships only a few. Give
    explicit null order and a unique last key in `order` for a stable result.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first `k` rows of each group."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def first_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Column) -> DataFrame:
    """Values of `cols` from the row with the least `order` in each group."""
    best = F.min_by(F.struct(*cols), order).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def number_rows(
    df: DataFrame, order: Sequence[str], partition: Sequence[str] = (), name: str = "rn", parts: int | None = None
) -> DataFrame:
    """Row numbers 1.. over `order`, per `partition` or over the whole frame.

    The rows are dealt by range once, sorted and written with their place in their range.
    Only the sizes of the ranges meet in one place, and go back to the rows, so neither a
    whole table nor a hot partition is sorted by a single task. The order must be unique.
    """
    keys = list(partition)
    ranged = df.repartitionByRange(*([parts] if parts else []), *keys, *order).sortWithinPartitions(*keys, *order)
    ranged = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()))  # range in the high bits, place in the low ones
    ranged = ranged.withColumn("_part", F.shiftright("_id", 33))
    spans = ranged.groupBy(*keys, "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = spans.select(*keys, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    on = [ranged[k].eqNullSafe(shifts[k]) for k in keys] + [ranged["_part"] == shifts["_part"]]
    cond = on[0]
    for extra in on[1:]:
        cond = cond & extra
    numbered = ranged.alias("r").join(shifts.alias("s"), cond)
    return numbered.select(*[F.col(f"r.{c}") for c in df.columns], (F.col("r._id") + F.col("s._shift")).cast("bigint").alias(name))


def order_by(df: DataFrame, *keys: tuple[str, str]) -> DataFrame:
    """Sort by (column, direction) pairs with nulls last both ways."""
    cols = [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last() for c, d in keys]
    return df.orderBy(*cols)


def top_k(df: DataFrame, k: int, *keys: tuple[str, str]) -> DataFrame:
    """The first `k` rows of an order; plans as a per-task top-k plus a merge."""
    return order_by(df, *keys).limit(k)


def bottom_k(df: DataFrame, k: int, *keys: tuple[str, str]) -> DataFrame:
    """The last `k` rows of the same order."""
    cols = [F.col(c).asc_nulls_first() if d == "desc" else F.col(c).desc_nulls_first() for c, d in keys]
    return df.orderBy(*cols).limit(k)
