"""Joins to areas, geometry and adjacency."""

from pyspark.sql import functions as F

from catalog import query
from catalog.cleaning import INCIDENT_COLS, incidents, stores
from catalog.sqltext import (
    CLEAN_INCIDENT, CLEAN_NEEDS, GEO_FACILITY, GEO_FACILITY_NEEDS, LOCATED, LOCATED_NEEDS, LOCATED_STORE,
    LOCATED_STORE_NEEDS, OVERLAID, OVERLAY_NEEDS,
)
from placestats import constants as K
from placestats.fixtures import Tables
from placestats.functions.geometry import (
    geojson_to_geom, geom_edges, geom_to_geojson, geom_to_wkt, wkt_to_geom,
)
from placestats.functions.nested import close_ring, json_path
from placestats.operators import spatial
from placestats.operators.dissolve import dissolve, signed_area
from placestats.operators.narrative import feature_collection, features
from placestats.plans import board, crime, grocery, healthcare

# the rest of the incident columns keep their names; only these are added by the join
PLACE_COLS = ["location_id", "neighborhood_name", "city", "resolution_method"]


def geocode_ok(t: Tables):
    return t.fx_geocode.where(
        F.col("geocode_status").isin(K.GEOCODE_OK_INCIDENT) & F.col("lat").isNotNull() & (F.col("lat") != K.MISSING_COORD)
        & F.col("long").isNotNull() & (F.col("long") != K.MISSING_COORD)
    )


def located_incidents(t: Tables):
    return crime.locate_incidents(incidents(t), t.fx_geocode, t.polygons)


def located_stores(t: Tables):
    return grocery.store_mart(stores(t), t.polygons)


def geo_facilities(t: Tables):
    return healthcare.clean_facilities(t.fx_facility.drop("location_id"), t.fx_facility_geocode)


@query(
    "overlay_coordinates",
    "SELECT load_seq, incident_number, lat, long, valid_location FROM overlaid",
    OVERLAY_NEEDS,
    OVERLAID,
)
def _(t):
    out = spatial.overlay_coordinates(incidents(t), geocode_ok(t), "incident_number")
    return out.select("load_seq", "incident_number", "lat", "long", "valid_location")


@query(
    "pip_inner",
    f"SELECT {', '.join(INCIDENT_COLS + PLACE_COLS)} FROM located",
    LOCATED_NEEDS,
    LOCATED,
)
def _(t):
    return located_incidents(t).select(*INCIDENT_COLS, *PLACE_COLS)


@query(
    "pip_raw_points",
    """SELECT p.load_seq, e.location_id FROM fx_incident p JOIN fx_edge e
       ON (e.y1 > p.lat) <> (e.y2 > p.lat) AND p.long < (e.x2 - e.x1) * (p.lat - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1
       GROUP BY p.load_seq, e.location_id HAVING count(*) % 2 = 1""",
    ["fx_incident", "fx_edge"],
)
def _(t):
    return spatial.spatial_join(t.fx_incident, t.polygons).select("load_seq", "location_id")


@query(
    "pip_left_fallback",
    "SELECT objectid, store_name, lat, long, location_id, neighborhood_name, city, resolution_method FROM located_store",
    LOCATED_STORE_NEEDS,
    LOCATED_STORE,
)
def _(t):
    return located_stores(t).select(
        "objectid", "store_name", "lat", "long", "location_id", "neighborhood_name", "city", "resolution_method"
    )


@query(
    "resolve_location",
    """SELECT facility_id, city, lat, long, has_valid_location, location_id, neighborhood_name, city_name, resolution_method
       FROM located_facility""",
    GEO_FACILITY_NEEDS,
    GEO_FACILITY,
)
def _(t):
    out = healthcare.facility_mart(geo_facilities(t), t.polygons)
    return out.select(
        "facility_id", "city", "lat", "long", "has_valid_location", "location_id", "neighborhood_name", "city_name", "resolution_method"
    )


@query(
    "pip_one_match",
    """SELECT p.load_seq, min(l.location_id) AS location_id FROM fx_incident p LEFT JOIN (
         SELECT a.load_seq, b.location_id FROM fx_incident a JOIN fx_location b
         ON a.long >= b.x0 - 0.03 AND a.long < b.x0 + b.w + 0.03 AND a.lat >= b.y0 - 0.03 AND a.lat < b.y0 + b.h + 0.03) l
       ON p.load_seq = l.load_seq GROUP BY p.load_seq""",
    ["fx_incident", "fx_location"],
)
def _(t):
    """Overlapping boxes around the areas: the lowest area id wins."""
    x0, y0, x1, y1 = F.col("x0") - 0.03, F.col("y0") - 0.03, F.col("x0") + F.col("w") + 0.03, F.col("y0") + F.col("h") + 0.03
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    ring = F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in corners])
    boxes = t.fx_location.withColumn("geometry", F.array(F.array(ring)))
    points = t.fx_incident.select("load_seq", "lat", "long")
    out = spatial.spatial_join(points, boxes, how="left", one_match="location_id", point_key=["load_seq"])
    return out.select("load_seq", "location_id")


# three sources by event type, each on its own columns
_SOURCES = {
    "int_a": "SELECT c.* FROM clean_incident c JOIN events e ON e.event_id = c.load_seq WHERE e.event_type NOT IN ('view', 'click')",
    "int_b": "SELECT c.* FROM clean_incident c JOIN events e ON e.event_id = c.load_seq WHERE e.event_type = 'view'",
    "int_c": "SELECT c.* FROM clean_incident c JOIN events e ON e.event_id = c.load_seq WHERE e.event_type = 'click'",
}
_COMMON = """incident_number, CAST(offense_code AS VARCHAR) AS offense_code, offense_description, district, {area} AS source_neighborhood,
  {lat} AS lat, {valid} AS valid_location, crime_severity_label, '{city}' AS source_city, {place} AS location_id, {method} AS resolution_method"""


@query(
    "union_sources",
    "SELECT * FROM ("
    + f"SELECT {_COMMON.format(area=chr(39) + 'N/A' + chr(39), lat='lat', valid='valid_location', city='BOSTON', place='CAST(NULL AS INTEGER)', method='CAST(NULL AS VARCHAR)')} FROM int_a UNION ALL "
    + f"SELECT {_COMMON.format(area='reporting_area', lat='lat', valid='valid_location', city='CAMBRIDGE', place='CAST(NULL AS INTEGER)', method='CAST(NULL AS VARCHAR)')} FROM int_b UNION ALL "
    + f"SELECT {_COMMON.format(area=chr(39) + 'N/A' + chr(39), lat='CAST(NULL AS DOUBLE)', valid='CAST(NULL AS BOOLEAN)', city='SOMERVILLE', place='40', method=chr(39) + 'CITY_ASSIGNMENT' + chr(39))} FROM int_c)",
    CLEAN_NEEDS,
    {**CLEAN_INCIDENT, **_SOURCES},
)
def _(t):
    typed = incidents(t).join(t.events.select(F.col("event_id").alias("load_seq"), "event_type"), "load_seq")
    a = typed.where(~F.col("event_type").isin("view", "click"))
    b = typed.where(F.col("event_type") == "view").withColumn("source_neighborhood", F.col("reporting_area"))
    c = typed.where(F.col("event_type") == "click").drop("lat", "long", "valid_location")
    both = crime.union_cities({"BOSTON": a, "CAMBRIDGE": b})
    rest = spatial.assign_location(crime.union_cities({"SOMERVILLE": c}), {"location_id": 40}, "CITY_ASSIGNMENT")
    return both.unionByName(rest, allowMissingColumns=True).select(
        "incident_number", "offense_code", "offense_description", "district", "source_neighborhood", "lat",
        "valid_location", "crime_severity_label", "source_city", "location_id", "resolution_method",
    )


_SIDE = "CASE WHEN abs({v}) <= 1e-12 THEN 0 ELSE sign({v}) END"


def _turn(p, q, x):
    return _SIDE.format(v=f"(({q[0]} - {p[0]}) * ({x[1]} - {p[1]}) - ({q[1]} - {p[1]}) * ({x[0]} - {p[0]}))")


_a1, _a2, _b1, _b2 = ("a.x1", "a.y1"), ("a.x2", "a.y2"), ("b.x1", "b.y1"), ("b.x2", "b.y2")
ADJACENT = {
    "snapped": "SELECT location_id, round(x1, 9) AS x1, round(y1, 9) AS y1, round(x2, 9) AS x2, round(y2, 9) AS y2 FROM fx_edge",
    "adjacent": f"""
SELECT DISTINCT a.location_id AS a, b.location_id AS b FROM snapped a JOIN snapped b ON a.location_id <> b.location_id
WHERE greatest(a.x1, a.x2) >= least(b.x1, b.x2) AND greatest(b.x1, b.x2) >= least(a.x1, a.x2)
  AND greatest(a.y1, a.y2) >= least(b.y1, b.y2) AND greatest(b.y1, b.y2) >= least(a.y1, a.y2)
  AND ({_turn(_a1, _a2, _b1)}) * ({_turn(_a1, _a2, _b2)}) <= 0 AND ({_turn(_b1, _b2, _a1)}) * ({_turn(_b1, _b2, _a2)}) <= 0""",
    "adjacent_name": """
SELECT x.neighborhood_name AS a, y.neighborhood_name AS b FROM adjacent p JOIN fx_location x ON p.a = x.location_id
JOIN fx_location y ON p.b = y.location_id""",
}
ADJACENT_NEEDS = ["fx_location", "fx_edge"]


@query("adjacency", "SELECT a, b FROM adjacent", ADJACENT_NEEDS, ADJACENT)
def _(t):
    return spatial.adjacency(t.polygons)


@query(
    "adjacency_lists",
    "SELECT a, string_agg(b, ', ' ORDER BY b) AS neighbours FROM adjacent_name GROUP BY a",
    ADJACENT_NEEDS,
    ADJACENT,
)
def _(t):
    lists = board.adjacency_lists(board.adjacency_pairs(t.polygons))
    return lists.select("a", F.array_join("neighbours", ", ").alias("neighbours"))


@query(
    "adjacency_in_scope",
    """SELECT p.a, p.b FROM adjacent p JOIN fx_location x ON p.a = x.location_id JOIN fx_location y ON p.b = y.location_id
       WHERE x.granularity = 'NEIGHBORHOOD' AND y.granularity = 'NEIGHBORHOOD'""",
    ADJACENT_NEEDS,
    ADJACENT,
)
def _(t):
    scope = t.polygons.where(F.col("granularity") == "NEIGHBORHOOD")
    return spatial.adjacency(scope)


CENTROIDS = {
    "shifted": """
SELECT e.location_id, l.x0, l.y0, (e.x1 - l.x0) AS ax, (e.y1 - l.y0) AS ay, (e.x2 - l.x0) AS bx, (e.y2 - l.y0) AS by_
FROM fx_edge e JOIN fx_location l ON e.location_id = l.location_id""",
    "centroids": """
SELECT location_id, round(min(x0) + sum((ax + bx) * (ax * by_ - bx * ay)) / (3 * sum(ax * by_ - bx * ay)), 6) AS centroid_long,
  round(min(y0) + sum((ay + by_) * (ax * by_ - bx * ay)) / (3 * sum(ax * by_ - bx * ay)), 6) AS centroid_lat
FROM shifted GROUP BY location_id""",
}


@query("centroid", "SELECT location_id, centroid_lat, centroid_long FROM centroids", ["fx_location", "fx_edge"], CENTROIDS)
def _(t):
    return spatial.with_centroid(t.polygons).select("location_id", "centroid_lat", "centroid_long")


@query(
    "wkt_roundtrip",
    """SELECT location_id, CAST(count(*) AS INTEGER) AS n_edges, round(sum(x1), 6) AS sum_x, round(sum(y1), 6) AS sum_y,
       TRUE AS same_text FROM fx_edge GROUP BY location_id""",
    ["fx_edge"],
)
def _(t):
    text = t.polygons.select("location_id", geom_to_wkt(F.col("geometry")).alias("wkt"))
    back = text.withColumn("geometry", wkt_to_geom(F.col("wkt")))
    edges = geom_edges(F.col("geometry"))

    def total(name):
        return F.round(F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + e[name]), 6)

    return back.select(
        "location_id", F.size(edges).alias("n_edges"), total("x1").alias("sum_x"), total("y1").alias("sum_y"),
        (geom_to_wkt(F.col("geometry")) == F.col("wkt")).alias("same_text"),
    )


@query(
    "geojson_roundtrip",
    "SELECT location_id, 'Polygon' AS kind, round(min(x0), 6) AS first_x, round(min(y0), 6) AS first_y FROM fx_location GROUP BY location_id",
    ["fx_location"],
)
def _(t):
    text = t.polygons.select("location_id", geom_to_geojson(F.col("geometry")).alias("g"))
    return text.select(
        "location_id",
        json_path(F.col("g"), "$.type", "string").alias("kind"),
        F.round(json_path(F.col("g"), "$.coordinates[0][0][0]", "double"), 6).alias("first_x"),
        F.round(json_path(F.col("g"), "$.coordinates[0][0][1]", "double"), 6).alias("first_y"),
    )


@query(
    "boundary_points",
    """SELECT location_id, k AS pos, round(x1, 9) AS long, round(y1, 9) AS lat FROM fx_edge
       UNION ALL SELECT location_id, CAST(max(k) + 1 AS INTEGER), round(arg_min(x1, k), 9), round(arg_min(y1, k), 9) FROM fx_edge GROUP BY location_id""",
    ["fx_edge"],
)
def _(t):
    out = spatial.boundary_points(t.polygons, keep=["location_id"])
    return out.select("location_id", "pos", F.round("long", 9).alias("long"), F.round("lat", 9).alias("lat"))


@query(
    "closed_rings",
    "SELECT location_id, CAST(count(*) + 2 AS INTEGER) AS n_points, TRUE AS is_closed FROM fx_edge GROUP BY location_id",
    ["fx_edge"],
)
def _(t):
    ring = close_ring(F.col("geometry")[0][0])
    return t.polygons.select(
        "location_id", F.size(ring).alias("n_points"), (F.element_at(ring, 1) == F.element_at(ring, -1)).alias("is_closed")
    )


def _parsed_feature(text):
    return geojson_to_geom(json_path(text, "$.geometry.type", "string"), json_path(text, "$.geometry.coordinates", "string"))


@query(
    "geojson_features",
    """SELECT neighborhood_name, city, TRUE AS has_geometry, neighborhood_name = 'NATION_2' AS is_selected, sqmiles FROM fx_location""",
    ["fx_location"],
)
def _(t):
    """Feature texts per area, parsed back; the texts hold every property, nulls too."""
    props = {"neighborhood_name": F.col("neighborhood_name"), "city": F.col("city"), "sqmiles": F.col("sqmiles")}
    feats = features(t.polygons, props, selected="NATION_2")
    text = F.col("feature")
    return feats.select(
        "neighborhood_name",
        json_path(text, "$.properties.city", "string").alias("city"),
        (F.size(_parsed_feature(text)) > 0).alias("has_geometry"),
        json_path(text, "$.properties.is_selected", "boolean").alias("is_selected"),
        json_path(text, "$.properties.sqmiles", "double").alias("sqmiles"),
    )


@query(
    "feature_collection",
    """SELECT city, 'FeatureCollection' AS kind, string_agg(neighborhood_name, ',' ORDER BY neighborhood_name) AS names,
       string_agg(CAST(location_id % 2 AS VARCHAR), ',' ORDER BY neighborhood_name) AS shapes FROM fx_location GROUP BY city""",
    ["fx_location"],
)
def _(t):
    """One document per city, parsed back: its features in order, and which of the two shapes each draws."""
    feats = features(t.polygons, {"name": F.col("neighborhood_name")}, keep=["city"])
    doc = feature_collection(feats, "city")
    form = "struct<properties:struct<name:string>,geometry:struct<coordinates:array<array<array<double>>>>>"
    parsed = F.from_json("geojson", f"type string, features array<{form}>")
    corners = lambda f: F.when(F.size(f["geometry"]["coordinates"][0]) == 7, F.lit("1")).otherwise(F.lit("0"))
    return doc.select(
        "city", parsed["type"].alias("kind"),
        F.array_join(F.transform(parsed["features"], lambda f: f["properties"]["name"]), ",").alias("names"),
        F.array_join(F.transform(parsed["features"], corners), ",").alias("shapes"),
    )


@query(
    "assign_ids",
    """SELECT name, row_number() OVER (ORDER BY src, pos) AS location_id FROM (
       SELECT 0 AS src, c_custkey AS pos, c_name AS name FROM customer UNION ALL SELECT 1, s_suppkey, s_name FROM supplier)""",
)
def _(t):
    sources = [
        t.customer.select(F.col("c_custkey").alias("pos"), F.col("c_name").alias("name")),
        t.supplier.select(F.col("s_suppkey").alias("pos"), F.col("s_name").alias("name")),
    ]
    return spatial.assign_ids(sources, "pos").select("name", "location_id")


@query(
    "collect_geometry",
    """SELECT city, CAST(pos AS INTEGER) AS pos, round(x0, 6) AS first_x, round(y0, 6) AS first_y FROM (
         SELECT *, row_number() OVER (PARTITION BY city ORDER BY location_id) - 1 AS pos FROM fx_location)""",
    ["fx_location"],
)
def _(t):
    """The parts of each city in the order of their ids, by the first corner of each part."""
    merged = spatial.collect_geometry(t.polygons, ["city"], "location_id")
    parts = merged.select("city", F.posexplode("geometry").alias("pos", "part"))
    corner = F.col("part")[0][0]
    return parts.select("city", "pos", F.round(corner["x"], 6).alias("first_x"), F.round(corner["y"], 6).alias("first_y"))


@query(
    "map_center",
    """SELECT round(avg(centroid_lat), 6) AS center_lat, round(avg(centroid_long), 6) AS center_long FROM centroids""",
    ["fx_location", "fx_edge"],
    CENTROIDS,
)
def _(t):
    center = spatial.map_center(spatial.with_centroid(t.polygons))
    return center.select(F.round("center_lat", 6).alias("center_lat"), F.round("center_long", 6).alias("center_long"))


_TURN = "(atan2(e.ay - e.by_, e.ax - e.bx) - atan2(f.by_ - f.ay, f.bx - f.ax))"
DISSOLVED = {
    "d": "SELECT city, round(x1, 9) AS x1, round(y1, 9) AS y1, round(x2, 9) AS x2, round(y2, 9) AS y2 FROM fx_edge e JOIN fx_location l ON e.location_id = l.location_id",
    "corner": "SELECT city, x1 AS x, y1 AS y FROM d UNION SELECT city, x2, y2 FROM d",
    "cut": """SELECT d.*, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS t, x, y FROM d JOIN corner c ON c.city = d.city
AND abs((x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)) < 1e-9 * (pow(x2 - x1, 2) + pow(y2 - y1, 2)) AND least(x1, x2) <= x AND x <= greatest(x1, x2) AND least(y1, y2) <= y AND y <= greatest(y1, y2)""",
    "piece": "SELECT city, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM cut WINDOW w AS (PARTITION BY city, x1, y1, x2, y2 ORDER BY t)",
    "edge": """SELECT row_number() OVER () AS id, p.* FROM piece p WHERE bx IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM piece q WHERE q.city = p.city AND q.ax = p.bx AND q.ay = p.by_ AND q.bx = p.ax AND q.by_ = p.ay)""",
    "follow": f"""SELECT e.id, arg_min(f.id, CASE WHEN {_TURN} - 2 * pi() * floor({_TURN} / (2 * pi())) < 1e-9 THEN 2 * pi() ELSE {_TURN} - 2 * pi() * floor({_TURN} / (2 * pi())) END) AS next
FROM edge e JOIN edge f ON f.city = e.city AND f.ax = e.bx AND f.ay = e.by_ GROUP BY e.id""",
    "walk": "SELECT id AS start, next AS here FROM follow UNION SELECT w.start, f.next FROM walk w JOIN follow f ON f.id = w.here",
    "ring": "SELECT start AS id, min(here) AS ring FROM walk GROUP BY start",
    "rings": "SELECT city, ring, sum(ax * by_ - bx * ay) / 2 AS area, sum(sqrt(pow(bx - ax, 2) + pow(by_ - ay, 2))) AS length, count(*) AS n FROM edge JOIN ring USING (id) GROUP BY city, ring",
}


@query(
    "dissolve",
    """SELECT city, count(*) FILTER (area > 0) AS n_polygons, count(*) FILTER (area < 0) AS n_holes, sum(n)::BIGINT AS n_points,
       round(sum(area), 7) AS area, round(sum(length), 7) AS perimeter FROM rings GROUP BY city""",
    ["fx_location", "fx_edge"],
    DISSOLVED,
)
def _(t):
    """One outline per city from its areas, squares and Ls that share half borders; described by its rings."""
    merged = dissolve(t.polygons, "city")
    rings = merged.select("city", F.explode("geometry").alias("p")).select("city", F.posexplode("p").alias("at", "r"))
    length = F.aggregate(geom_edges(F.array(F.array("r"))), F.lit(0.0), lambda s, e: s + F.sqrt(F.pow(e["x2"] - e["x1"], 2) + F.pow(e["y2"] - e["y1"], 2)))
    return rings.groupBy("city").agg(
        F.count_if(F.col("at") == 0).alias("n_polygons"), F.count_if(F.col("at") > 0).alias("n_holes"), F.sum(F.size("r") - 1).cast("long").alias("n_points"),
        F.round(F.sum(signed_area(F.col("r"))), 7).alias("area"), F.round(F.sum(length), 7).alias("perimeter"),
    )
