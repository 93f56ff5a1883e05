"""Writers: full refresh, append, upsert by month, rejected rows, bucketed tables, exports and load reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from placestats.operators.filters import as_timestamp
from placestats.operators.ranking import dedupe


def with_audit(df: DataFrame, as_of: str | None = None, file_name: bool = False) -> DataFrame:
    """Adds load_timestamp and _load_date, and _file_name for frames read from files."""
    now = as_timestamp(as_of)
    cols = {"load_timestamp": now.cast("timestamp_ntz"), "_load_date": now.cast("date")}
    if file_name:
        cols["_file_name"] = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return df.withColumns(cols)


def write_full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_result(df: DataFrame, path: str, as_of: str | None = None) -> None:
    """Replace a result table, stamping its rows."""
    stamped = df.withColumn("load_timestamp", as_timestamp(as_of).cast("timestamp_ntz"))
    stamped.write.mode("overwrite").parquet(path)


def write_append(df: DataFrame, path: str, as_of: str | None = None, file_name: bool = False) -> None:
    """Append to a table partitioned by load date; the first write creates it."""
    with_audit(df, as_of, file_name).write.mode("append").partitionBy("_load_date").parquet(path)


def export(df: DataFrame, fmt: str, path: str, stamp: bool = False) -> str:
    """Write csv, json or text files; with `stamp` the folder name ends in the UTC time."""
    if stamp:
        path = f"{path}_{datetime.now(timezone.utc):%Y%m%dT%H%M%S}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif fmt == "text":
        writer.text(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")
    return path


def load_report(df: DataFrame, date_col: str | None = None, day: str | None = None, not_null: str | None = None) -> DataFrame:
    """Row counts of a load: all, of one day, and with a column filled."""
    counts = [F.count(F.lit(1)).alias("rows_total")]
    if date_col:
        today = F.lit(day).cast("date") if day else F.current_date()
        counts.append(F.count_if(F.col(date_col).cast("date") == today).alias("rows_today"))
    if not_null:
        counts.append(F.count(F.col(not_null)).alias("rows_filled"))
    return df.agg(*counts)


def upsert(
    target: DataFrame | None, batch: DataFrame, key: Sequence[str], order: Sequence[Column] | None = None, unique: bool = False
) -> DataFrame:
    """`target` with the rows of `batch` inserted or replaced by key.

    With `order` the first row per key of the batch wins. With `unique` the caller vouches
    for unique keys, and nothing is checked. Without both a repeated key fails the job when
    the result is computed.
    """
    key = list(key)
    if unique:
        rows = batch
    elif order is not None:
        rows = dedupe(batch, key, order)
    else:
        counts = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*batch.columns)).alias("_r"))
        guard = F.when(F.col("_n") > 1, F.raise_error(F.lit("upsert: batch holds a key more than once")).cast("boolean"))
        rows = counts.where(F.coalesce(guard, F.lit(True))).select("_r.*")
    if target is None:
        return rows
    # the key columns of the batch are enough to strike out the replaced rows
    return target.join(batch.select(*key), key, "left_anti").unionByName(rows)


MONTH = "event_month"  # year * 100 + month, 0 without a time


class MonthTable:
    """A Parquet table partitioned by the month of a time column, for one writer at a time.

    An upsert rewrites the months of its batch and those that hold its keys so far, by
    dynamic partition overwrite; the files of all other months stay as they are. A month
    that loses all its rows is removed after the write. Months are replaced one after the
    other, so a run that died in between is made good by running the same batch again.
    """

    def __init__(self, spark: SparkSession, path: str, ts: str):
        self.spark, self.path, self.ts = spark, path.rstrip("/"), ts

    def _at(self, *parts: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def months(self) -> list[int]:
        """The months in store, one folder each."""
        at, fs = self._at()
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{MONTH}="))

    def stored(self) -> DataFrame | None:
        """The rows with their month."""
        return self.spark.read.parquet(self.path) if self.months() else None

    def read(self) -> DataFrame | None:
        rows = self.stored()
        return None if rows is None else rows.drop(MONTH)

    def newest(self) -> DataFrame | None:
        """The rows of the last month: the greatest time is among them."""
        rows = self.stored()
        return None if rows is None else rows.where(F.col(MONTH) == self.months()[-1]).drop(MONTH)

    def upsert(self, batch: DataFrame, key: Sequence[str], order: Sequence[Column] | None = None, unique: bool = False) -> list[int]:
        """Insert or replace by key; returns the months that were rewritten. See `upsert` for `order` and `unique`.

        `batch` is read more than once, so it must not change between reads. Rows of the
        batch may move their key to another month.
        """
        named = batch.withColumn(MONTH, F.coalesce(F.year(self.ts) * 100 + F.month(self.ts), F.lit(0)))
        stored = self.stored()
        months = named.select(MONTH)
        if stored is not None:
            # of the stored rows only the keys are read here
            months = months.unionByName(stored.join(batch.select(*key), list(key), "left_semi").select(MONTH))
        touched = sorted(r[0] for r in months.distinct().collect())  # a number a month
        if not touched:
            return []
        merged = upsert(None if stored is None else stored.where(F.col(MONTH).isin(touched)), named, key, order, unique)
        watch = Observation()
        # a hot month is split, small ones share a task
        spread = merged.hint("rebalance", F.col(MONTH)).observe(watch, F.collect_set(MONTH).alias("written"))
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(self.path)
        for gone in set(touched) - set(watch.get["written"]):
            at, fs = self._at(f"{MONTH}={gone}")
            fs.delete(at, True)
        return touched


def write_checked(checked: DataFrame, path: str, reason: str = "_reject") -> dict[str, int]:
    """Write rows with a null `reason` to the folder of accepted rows and the others to that of rejected ones.

    One pass over the rows; the counts `read`, `accepted` and `rejected` come from the write itself.
    """
    watch = Observation()
    counted = checked.observe(watch, F.count(F.lit(1)).alias("read"), F.count_if(F.col(reason).isNull()).alias("accepted"), F.count(reason).alias("rejected"))
    status = F.when(F.col(reason).isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    counted.withColumn("_status", status).write.mode("overwrite").partitionBy("_status").parquet(path)
    return {k: watch.get[k] for k in ("read", "accepted", "rejected")}


def read_checked(spark: SparkSession, path: str, schema: StructType, accepted: bool = True, reason: str = "_reject") -> DataFrame:
    """One of the two sides of `write_checked`; `schema` is that of the checked rows. Accepted rows come without the reason."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("_status", StringType())])).parquet(path)
    side = rows.where(F.col("_status") == ("accepted" if accepted else "rejected")).drop("_status")
    return side.drop(reason, "_line") if accepted else side


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Save a table hashed and sorted by `keys`: joins, groupings and de-duplication by these keys then plan no exchange."""
    # one task a bucket, so a bucket is one file
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
