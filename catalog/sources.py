"""Readers over texts built from the driver tables, and sinks written and read back."""

import uuid

from pyspark.sql import functions as F

from catalog import query
from placestats import constants as K
from placestats.fixtures import Tables
from placestats.functions.geometry import geom_to_geojson
from placestats.operators.ranking import dedupe
from placestats.plans import locations
from placestats.session import new_folder
from placestats.sources import readers, writers


# --- landed JSON -------------------------------------------------------------------
def order_pages(t: Tables, whole):
    """A page of orders per customer; every eleventh is no JSON, every thirteenth lacks its list."""
    status = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus"))
    record = F.struct(F.col("o_orderkey").alias("_id"), status.alias("status"), F.lit(7).alias("extra"))
    listed = t.orders.groupBy("o_custkey").agg(F.collect_list(record).alias("r"))
    text = F.when(F.col("o_custkey") % 11 == 0, F.lit("<html>busy</html>")).when(F.col("o_custkey") % 13 == 0, F.lit('{"success":false}')).otherwise(whole(F.col("r")))
    return listed.select(text.alias("page"))


_PAGED = "SELECT o_orderkey AS _id, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END AS status FROM orders WHERE o_custkey % 11 <> 0 AND o_custkey % 13 <> 0"


@query("parse_json_pages", _PAGED)
def _(t):
    pages = order_pages(t, lambda r: F.to_json(F.struct(F.lit(True).alias("success"), F.struct(r.alias("records")).alias("result"))))
    return readers.parse_json_pages(pages, "page", {"_id": "bigint", "status": "string"})


@query("parse_json_list", _PAGED.replace("o_orderkey AS _id", "CAST(o_orderkey AS VARCHAR) AS _id"))
def _(t):
    return readers.parse_json_pages(order_pages(t, F.to_json), "page", ["_id", "status"], records=None)


# --- CSV -----------------------------------------------------------------------------
CSV_SCHEMA = {"id": "int", "note": "string", "score": "double", "state": "string"}


@query(
    "parse_csv_tolerant",
    """SELECT CAST(o_orderkey AS INTEGER) AS id, 'say "' || o_orderstatus || '", ok' AS note,
       CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) / 4 END AS score, 'MA' AS state
       FROM orders WHERE o_orderkey % 7 <> 0 AND (o_orderkey % 6 <> 5 OR o_orderkey % 4 = 0 OR o_orderkey % 5 = 0)""",
)
def _(t):
    return readers.parse_csv_tolerant(order_lines(t), "line", CSV_SCHEMA, columns=["id", "note", "score"], defaults={"state": "MA"})


def order_lines(t: Tables):
    """Quoted, padded, short, long and bad lines; the state column is not in the file."""
    key, score = F.col("o_orderkey"), (F.col("o_custkey") / F.lit(4.0)).cast("string")
    score = F.when(key % 5 == 0, F.lit("NULL")).when(key % 6 == 5, F.lit("n/k")).otherwise(score)
    head = F.concat(F.when(key % 7 == 0, F.lit("x")).otherwise(F.lit("  ")), key.cast("string"), F.lit(', "say ""'), "o_orderstatus", F.lit('"", ok"'))
    line = F.when(key % 4 == 0, head).when(key % 3 == 0, F.concat(head, F.lit(","), score, F.lit(",more,cells"))).otherwise(F.concat(head, F.lit(", "), score))
    return t.orders.select(line.alias("line"))


@query(
    "csv_quarantine",
    """WITH l AS (SELECT *, o_orderkey % 7 = 0 AS bad_id, o_orderkey % 6 = 5 AND o_orderkey % 5 <> 0 AND o_orderkey % 4 <> 0 AS bad_score FROM orders),
       c AS (SELECT count(*) AS rows_read, count(*) FILTER (NOT bad_id AND NOT bad_score) AS rows_accepted, count(*) FILTER (bad_id OR bad_score) AS rows_rejected FROM l)
       SELECT CASE WHEN bad_id THEN NULL ELSE CAST(o_orderkey AS INTEGER) END AS id, 'say "' || o_orderstatus || '", ok' AS note,
       CASE WHEN bad_score OR o_orderkey % 4 = 0 OR o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) / 4 END AS score, 'MA' AS state,
       CASE WHEN bad_id AND bad_score THEN 'id is no int; score is no double' WHEN bad_id THEN 'id is no int' WHEN bad_score THEN 'score is no double' END AS reject,
       bad_id OR bad_score AS has_line, rows_read, rows_accepted, rows_rejected FROM l, c""",
)
def _(t):
    """Both sides of one load, read back, with the counts that the write itself made."""
    path = new_folder(t.spark)
    rows = readers.parse_csv_checked(order_lines(t), "line", CSV_SCHEMA, columns=["id", "note", "score"], defaults={"state": "MA"})
    counts = writers.write_checked(rows, path)
    good = writers.read_checked(t.spark, path, rows.schema).withColumns({"reject": F.lit(None).cast("string"), "has_line": F.lit(False)})
    bad = writers.read_checked(t.spark, path, rows.schema, accepted=False)
    bad = bad.select("id", "note", "score", "state", F.col("_reject").alias("reject"), F.col("_line").isNotNull().alias("has_line"))
    return good.unionByName(bad).withColumns({f"rows_{k}": F.lit(v).cast("long") for k, v in counts.items()})


@query(
    "parse_multiheader_csv",
    """SELECT CAST(c_custkey AS VARCHAR) AS FACILITY_ID, c_name AS STREET, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS BED_COUNT,
       'x' AS BED_COUNT_1, 'n' || CAST(c_nationkey AS VARCHAR) || '.csv' AS _file_name FROM customer""",
)
def _(t):
    """A sheet per nation: a preamble, blank records, two header lines with blank, unnamed and repeated cells, then customers."""
    cell = lambda *xs: F.array(*[F.lit(x) for x in xs])
    head = [cell("Report", "", "", ""), cell("", "", "", ""), cell("as of", "now", "", ""), cell("Facility", "Unnamed: 1", "Bed", "Bed"), cell(" ", "", "", ""), cell("ID", "Street", "Count", "Count")]
    file = F.concat(F.lit("s3://landing/n"), F.col("c_nationkey").cast("string"), F.lit(".csv"))
    tops = t.customer.select(file.alias("f")).distinct().select("f", F.posexplode(F.array(*head)).alias("i", "cells"))
    beds = F.when(F.col("c_custkey") % 3 == 0, F.lit("NULL")).otherwise(F.col("c_nationkey").cast("string"))
    rows = t.customer.select(file.alias("f"), (F.lit(10) + F.col("c_custkey") * 2).cast("int").alias("i"), F.array(F.col("c_custkey").cast("string"), F.concat(F.lit(" "), "c_name"), beds, F.lit("x")).alias("cells"))
    blank = t.customer.select(file.alias("f"), (F.lit(11) + F.col("c_custkey") * 2).cast("int").alias("i"), cell("", " ", "", "").alias("cells"))
    return readers.parse_multiheader_csv(tops.unionByName(rows).unionByName(blank), "f", "i", "cells", drop_rows=3)


# --- GeoJSON and the master list ------------------------------------------------------
@query(
    "parse_geojson",
    """SELECT city, CAST(row_number() OVER (PARTITION BY city ORDER BY location_id) - 1 AS INTEGER) AS pos, upper(neighborhood_name) AS name, sqmiles,
       CASE WHEN location_id % 5 = 0 THEN -1 ELSE 5 + 2 * (location_id % 2) END::INTEGER AS n_points FROM fx_location""",
    ["fx_location"],
)
def _(t):
    """A FeatureCollection per city; the name sits in one of four properties, every fifth feature has no geometry."""
    name = F.concat(F.lit(" "), F.lower("neighborhood_name"))
    which = F.col("location_id") % 4
    props = F.to_json(F.struct(
        F.when(which == 0, name).otherwise(F.lit("")).alias("NAME"), F.when(which == 1, name).alias("NEIGHBORHD"),
        F.when(which == 2, name).alias("name_"), F.when(which == 3, name).alias("neighborhood"), F.col("sqmiles"),
    ))
    shape = F.when(F.col("location_id") % 5 == 0, F.lit("null")).otherwise(geom_to_geojson(F.col("geometry")))
    feature = F.concat(F.lit('{"type":"Feature","properties":'), F.replace(props, F.lit('"name_"'), F.lit('"name"')), F.lit(',"geometry":'), shape, F.lit("}"))
    listed = F.sort_array(F.collect_list(F.struct("location_id", feature.alias("f"))))
    docs = t.polygons.groupBy("city").agg(F.concat(F.lit('{"features":['), F.array_join(F.transform(listed, lambda x: x["f"]), ","), F.lit("]}")).alias("doc"))
    rows = readers.parse_geojson(docs, "doc", {"sqmiles": "double"}, keep=["city"])
    return rows.select("city", "pos", "name", "sqmiles", F.coalesce(F.size(F.get(F.get("geometry", F.lit(0)), F.lit(0))), F.lit(-1)).alias("n_points"))


_cities = ", ".join(f"({i}, '{n}', {a}, {b})" for i, (n, a, b) in enumerate(K.GREATER_CITIES))


@query(
    "master_locations",
    f"""SELECT CAST(row_number() OVER (ORDER BY src, pos) AS INTEGER) AS location_id, name, city, granularity, has_geometry, sqmiles, lat FROM (
       SELECT 0 AS src, location_id AS pos, neighborhood_name AS name, 'BOSTON' AS city, 'NEIGHBORHOOD' AS granularity, TRUE AS has_geometry, sqmiles, NULL::DOUBLE AS lat FROM fx_location
       UNION ALL SELECT 1, i, n, n, 'CITY', FALSE, NULL, a FROM (VALUES {_cities}) AS v(i, n, a, b))""",
    ["fx_location"],
)
def _(t):
    """The areas of the polygon table, then the fixed cities, numbered in that order."""
    feats = t.polygons.select(F.col("location_id").alias("pos"), F.col("neighborhood_name").alias("name"), "sqmiles", "geometry")
    master = locations.master_locations([locations.neighbourhoods(feats, "BOSTON", "sqmiles"), locations.cities(t.spark)])
    return master.select("location_id", "name", "city", "granularity", "has_geometry", "sqmiles", F.when(~F.col("has_geometry"), F.col("centroid_lat")).alias("lat"))


# --- sinks: write, read back ------------------------------------------------------------
@query("sink_full_refresh", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 2 = 0")
def _(t):
    path = new_folder(t.spark)
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey")
    writers.write_full_refresh(rows, path, ["c_nationkey"])
    writers.write_full_refresh(rows.where("c_custkey % 2 = 0"), path, ["c_nationkey"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "sink_result_table",
    "SELECT o_custkey, count(*) AS n, TIMESTAMP '2024-02-01 10:00:00' AS load_timestamp FROM orders GROUP BY o_custkey",
)
def _(t):
    path = new_folder(t.spark)
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    writers.write_result(counts.where("o_custkey < 0"), path, "2024-01-01 00:00:00")
    writers.write_result(counts, path, "2024-02-01 10:00:00")
    return t.spark.read.parquet(path)


@query(
    "sink_append",
    """SELECT event_id, TIMESTAMP '2024-02-01 10:00:00' AS load_timestamp, DATE '2024-02-01' AS _load_date FROM events WHERE event_id % 2 = 0
       UNION ALL SELECT event_id, TIMESTAMP '2024-02-02 11:00:00', DATE '2024-02-02' FROM events WHERE event_id % 3 = 0""",
)
def _(t):
    """Two daily loads into one table; the first creates it."""
    path = new_folder(t.spark)
    for n, at in ((2, "2024-02-01 10:00:00"), (3, "2024-02-02 11:00:00")):
        writers.write_append(t.events.where(F.col("event_id") % n == 0).select("event_id"), path, at)
    return t.spark.read.parquet(path).select("event_id", "load_timestamp", "_load_date")


@query(
    "sink_export",
    """SELECT c_custkey, c_name || ', "x"' AS label, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS balance, f AS form FROM customer CROSS JOIN (VALUES ('csv'), ('json')) AS v(f)""",
)
def _(t):
    """The same rows as CSV and as JSON lines, read back with their types."""
    rows = t.customer.select("c_custkey", F.concat("c_name", F.lit(', "x"')).alias("label"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).alias("balance"))
    csv = t.spark.read.schema(rows.schema).option("header", True).option("escape", '"').csv(writers.export(rows, "csv", new_folder(t.spark), stamp=True))
    lines = t.spark.read.schema(rows.schema).json(writers.export(rows, "json", new_folder(t.spark)))
    return csv.withColumn("form", F.lit("csv")).unionByName(lines.withColumn("form", F.lit("json")))


@query(
    "bucketed_profile",
    """SELECT o.o_orderkey, o.o_custkey, count(l.l_orderkey) AS n_items, round(coalesce(sum(l.l_extendedprice), 0), 2) AS price,
       (SELECT max(x.l_linenumber) FROM lineitem x WHERE x.l_orderkey = o.o_orderkey) AS last_line
       FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o.o_custkey""",
)
def _(t):
    """Orders with their items, from two tables bucketed by order: neither the join, the sums nor the last item shuffles."""
    return profile_by_order(*bucketed_orders(t))


def bucketed_orders(t: Tables):
    name, where = f"t{uuid.uuid4().hex}", new_folder(t.spark)
    orders = writers.write_bucketed(t.orders.select("o_orderkey", "o_custkey"), f"{name}_orders", ["o_orderkey"], 16, f"{where}/orders")
    items = writers.write_bucketed(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), f"{name}_items", ["l_orderkey"], 16, f"{where}/items")
    return orders, items


def profile_by_order(orders, items):
    sums = items.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("p"))
    last = dedupe(items, ["l_orderkey"], [F.col("l_linenumber").desc()]).select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("last_line"))
    joined = orders.join(sums, orders.o_orderkey == sums.l_orderkey, "left").join(last, F.col("o_orderkey") == F.col("k"), "left")
    return joined.select("o_orderkey", "o_custkey", F.coalesce("n", F.lit(0)).alias("n_items"), F.round(F.coalesce("p", F.lit(0.0)), 2).alias("price"), "last_line")
