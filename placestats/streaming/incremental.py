"""Incremental loads, in batch and as a stream of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from placestats.functions.dates import month_of
from placestats.operators.ranking import dedupe
from placestats.operators.series import fill_months
from placestats.session import materialize
from placestats.sources.writers import MonthTable, upsert


def newer_than(source: DataFrame, target: DataFrame | None, ts: str) -> DataFrame:
    """Rows later than the newest row of `target`; all rows on a first run.

    Older arrivals are dropped for good. The mark is a scalar subquery over one
    column, and its bare value is what the source scan gets as a filter.
    """
    if target is None:
        return source
    earliest = F.lit("0001-01-01 00:00:00").cast(target.schema[ts].dataType)
    return source.where(F.col(ts) > target.agg(F.coalesce(F.max(ts), earliest)).scalar())


def fresh_rows(
    source: DataFrame, target: DataFrame | None, ts: str, dedupe_keys: Sequence[str], key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The rows of a run, one per `key`: newer than the target, de-duplicated.

    Where `key` is part of `dedupe_keys` the first row per `key` is also the first of its
    `dedupe_keys`, so one reduction does both.
    """
    fresh = newer_than(source, target, ts)
    if not set(key) <= set(dedupe_keys):
        fresh = dedupe(fresh, dedupe_keys, order)
    return dedupe(fresh, key, order)


def incremental(
    source: DataFrame, target: DataFrame | None, ts: str, dedupe_keys: Sequence[str], key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """State of the target after one run. The reduced rows are written once, because their keys
    strike out the stored rows and they themselves are added."""
    fresh = fresh_rows(source, target, ts, dedupe_keys, key, order)
    return upsert(target, fresh if target is None else materialize(fresh), key, unique=True)


def run_incremental(
    source: DataFrame, table: MonthTable, ts: str, dedupe_keys: Sequence[str], key: Sequence[str], order: Sequence[Column], mark: DataFrame | None = None
) -> list[int]:
    """One batch run against a table by months; returns the months it rewrote.

    Rows count as new after the newest row of the table, or of `mark`, if given.
    """
    known = table.newest() if mark is None else mark
    return table.upsert(materialize(fresh_rows(source, known, ts, dedupe_keys, key, order)), key, unique=True)


def _mark(spark: SparkSession, table: MonthTable, ts: str, kind: DataType, path: str) -> DataFrame:
    """The newest time before a batch, kept in a file, so that a replay after a failed write starts from the same one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        newest = table.newest()
        last = spark.range(1).select(F.lit(None).cast(kind).alias(ts)) if newest is None else newest.agg(F.max(ts).alias(ts))
        last.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stream_incremental(
    stream: DataFrame,
    table: MonthTable,
    ts: str,
    dedupe_keys: Sequence[str],
    key: Sequence[str],
    order: Sequence[Column],
    checkpoint: str,
    lateness: str | None = None,
) -> StreamingQuery:
    """The same run for every micro-batch of a file stream, until it is drained.

    A batch that is replayed after a failure writes the same rows again, by key, and so
    changes nothing. With `lateness` repeats within that delay are also dropped by a
    stateful de-duplication ahead of the batch function.
    """
    if lateness:
        stream = stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(dedupe_keys))
    kind = stream.schema[ts].dataType

    def run(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            mark = _mark(batch.sparkSession, table, ts, kind, f"{checkpoint.rstrip('/')}-marks/{number}")
            run_incremental(batch, table, ts, dedupe_keys, key, order, mark)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_daily_counts(stream: DataFrame, table: MonthTable, group: Sequence[str], ts: str, checkpoint: str, lateness: str) -> StreamingQuery:
    """Keep counts per group and day up to date from a stream, until it is drained; `table` is one by `day`.

    Days are event-time windows under a watermark, so state is dropped once a day is older
    than `lateness`; rows that come later than that are lost. Every micro-batch writes the
    days it changed with their whole count, by key, so a replay changes nothing.
    """
    keys = list(group)
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    counted = timed.groupBy(*keys, F.window(ts, "1 day").alias("_day")).agg(F.count(F.lit(1)).alias("y"))
    days = counted.select(*keys, F.col("_day.start").cast("date").alias("day"), "y")

    def run(batch: DataFrame, _: int) -> None:
        table.upsert(materialize(batch), [*keys, "day"], unique=True)

    return days.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def monthly_from_days(days: DataFrame, group: Sequence[str]) -> DataFrame:
    """Gap-free monthly counts from counts per day."""
    keys = list(group)
    return fill_months(days.groupBy(*keys, month_of(F.col("day")).alias("month")).agg(F.sum("y").alias("y")), keys)
