"""Incremental loads and keyed updates."""

from pyspark.sql import functions as F

from catalog import query
from catalog.series import DENSE, NEEDS, orders_by_area
from placestats.operators.joins import update_by_key
from placestats.operators.ranking import dedupe
from placestats.session import new_folder
from placestats.sources.writers import MonthTable, load_report, upsert, with_audit
from placestats.streaming.incremental import (
    incremental, monthly_from_days, newer_than, run_incremental, stream_daily_counts, stream_incremental,
)

# the first load holds the events up to this moment, the next one brings all again
_MARK = "2024-01-15 00:00:00"
_SEEN = f"SELECT * FROM fx_incident WHERE occurred_on_date <= TIMESTAMP '{_MARK}'"


def state_sql(source: str, target: str) -> str:
    return f"""
SELECT incident_number, offense_code, occurred_on_date, load_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY incident_number ORDER BY load_seq DESC) AS rn FROM (
    SELECT s.* FROM {source} s WHERE occurred_on_date > (SELECT max(occurred_on_date) FROM {target})))
WHERE rn = 1"""


_FIRST = f"""
SELECT incident_number, offense_code, occurred_on_date, load_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY incident_number ORDER BY load_seq DESC) AS rn FROM ({_SEEN})) WHERE rn = 1"""
_FINAL = """SELECT * FROM fresh UNION ALL SELECT * FROM stored WHERE incident_number NOT IN (SELECT incident_number FROM fresh)"""
_COLS = ["incident_number", "offense_code", "occurred_on_date", "load_seq"]


def latest():
    return [F.col("load_seq").desc_nulls_last()]


@query(
    "newer_than",
    f"SELECT load_seq FROM fx_incident WHERE occurred_on_date > (SELECT max(occurred_on_date) FROM ({_SEEN}))",
    ["fx_incident"],
)
def _(t):
    seen = t.fx_incident.where(F.col("occurred_on_date") <= F.lit(_MARK).cast("timestamp_ntz"))
    return newer_than(t.fx_incident, seen, "occurred_on_date").select("load_seq")


@query(
    "incremental_batch",
    _FINAL,
    ["fx_incident"],
    {"stored": _FIRST, "fresh": state_sql("fx_incident", "stored")},
)
def _(t):
    """Two runs: a first load up to a date, then everything against that state."""
    rows = t.fx_incident.select(*_COLS)
    first = rows.where(F.col("occurred_on_date") <= F.lit(_MARK).cast("timestamp_ntz"))
    keys = ["incident_number", "offense_code"]
    state = incremental(first, None, "occurred_on_date", keys, ["incident_number"], latest())
    return incremental(rows, state, "occurred_on_date", keys, ["incident_number"], latest())


@query(
    "incremental_stream",
    _FINAL,
    ["fx_incident"],
    {"stored": _FIRST, "fresh": state_sql("fx_incident", "stored")},
)
def _(t):
    """The same two loads, the second arriving as a stream of the event files."""
    spark = t.spark
    rows = t.fx_incident.select(*_COLS)
    base = new_folder(spark)
    table = MonthTable(spark, f"{base}/table", "occurred_on_date")
    first = rows.where(F.col("occurred_on_date") <= F.lit(_MARK).cast("timestamp_ntz"))
    keys = ["incident_number", "offense_code"]
    run_incremental(first, table, "occurred_on_date", keys, ["incident_number"], latest())
    rows.write.mode("overwrite").parquet(f"{base}/landing")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/landing")
    run = stream_incremental(
        stream, table, "occurred_on_date", keys, ["incident_number"], latest(), f"{base}/progress"
    )
    run.awaitTermination()
    return table.read()


@query(
    "upsert",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
       UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, 'N' FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""",
)
def _(t):
    """Every order is stored; those since 2000 arrive again with a new price and state."""
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    since = F.col("o_orderdate") >= F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    batch = t.orders.where(since).withColumns({"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit("N")})
    return upsert(t.orders.select(*cols), batch.select(*cols), ["o_orderkey"])


@query(
    "upsert_by_month",
    """WITH moved AS (SELECT o_orderkey, o_orderdate + INTERVAL 40 DAY AS o_orderdate, 'MOVED' AS o_orderstatus FROM orders WHERE o_orderkey % 50 = 0),
       late AS (SELECT o_orderkey, o_orderdate, 'LATE' AS o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01' AND o_orderkey % 50 <> 0)
       SELECT * FROM moved UNION ALL SELECT * FROM late UNION ALL
       SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderkey % 50 <> 0 AND o_orderdate < TIMESTAMP '2001-06-01'""",
)
def _(t):
    """All orders, then two batches: some move to another month, the newest change their state."""
    table = MonthTable(t.spark, new_folder(t.spark), "o_orderdate")
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    moved = F.col("o_orderkey") % 50 == 0
    table.upsert(rows, ["o_orderkey"], unique=True)
    table.upsert(rows.where(moved).withColumns({"o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS"), "o_orderstatus": F.lit("MOVED")}), ["o_orderkey"], unique=True)
    late = rows.where(~moved & (F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz")))
    table.upsert(late.withColumn("o_orderstatus", F.lit("LATE")), ["o_orderkey"], unique=True)
    return table.read()


@query("monthly_series_stream", "SELECT location_id, month, y FROM dense", NEEDS, DENSE)
def _(t):
    """The monthly series from a stream of files of orders, drained twice: the second half arrives after a restart."""
    spark, base = t.spark, new_folder(t.spark)
    rows = orders_by_area(t).select("location_id", "o_orderdate")
    table = MonthTable(spark, f"{base}/days", "day")
    half = F.lit("1998-06-01").cast("timestamp_ntz")
    for part in (rows.where(F.col("o_orderdate") < half), rows.where(F.col("o_orderdate") >= half)):
        part.write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/landing")
        stream_daily_counts(stream, table, ["location_id"], "o_orderdate", f"{base}/progress", "1 day").awaitTermination()
    return monthly_from_days(table.read(), ["location_id"])


_SHIP = "l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax"


@query(
    "upsert_latest",
    f"""WITH batch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_SHIP}) AS rn FROM lineitem WHERE l_orderkey % 2 = 0) WHERE rn = 1),
       stored AS (SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS price FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY ALL)
       SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS price FROM batch UNION ALL
       SELECT l_orderkey, l_linenumber, round(price, 2) FROM stored s WHERE NOT EXISTS (
         SELECT 1 FROM batch b WHERE b.l_orderkey = s.l_orderkey AND b.l_linenumber = s.l_linenumber)""",
)
def _(t):
    """A stored table of every third order; the items of every second arrive with repeated keys, the latest shipment wins."""
    order = [F.col("l_shipdate").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    ]
    key = ["l_orderkey", "l_linenumber"]
    stored = t.lineitem.where(F.col("l_orderkey") % 3 == 0).groupBy(*key).agg(F.min("l_extendedprice").alias("l_extendedprice"))
    batch = t.lineitem.where(F.col("l_orderkey") % 2 == 0).transform(lambda df: dedupe(df, key, order))
    out = upsert(stored, batch.select(*key, "l_extendedprice"), key, unique=True)
    return out.select(*key, F.round("l_extendedprice", 2).alias("price"))


@query(
    "update_by_key",
    """SELECT c.c_custkey, coalesce(o.seg, c.c_mktsegment) AS c_mktsegment FROM customer c
       LEFT JOIN (SELECT o_custkey, 'ORDERED ' || CAST(count(*) AS VARCHAR) AS seg FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""",
)
def _(t):
    patch = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.concat(F.lit("ORDERED "), F.count(F.lit(1)).cast("string")).alias("c_mktsegment")
    )
    return update_by_key(t.customer, patch, "c_custkey", "c_mktsegment").select("c_custkey", "c_mktsegment")


@query(
    "load_report",
    """SELECT count(*) AS rows_total, count(*) FILTER (CAST(ts AS DATE) = DATE '2024-01-10') AS rows_today, count(props) AS rows_filled FROM events""",
)
def _(t):
    return load_report(t.events, "ts", "2024-01-10", "props")


@query(
    "audit_columns",
    """SELECT event_id, TIMESTAMP '2024-02-01 10:00:00' AS load_timestamp, DATE '2024-02-01' AS _load_date, 'events.parquet' AS _file_name FROM events""",
)
def _(t):
    out = with_audit(t.events, "2024-02-01 10:00:00", file_name=True)
    return out.select("event_id", "load_timestamp", "_load_date", "_file_name")
