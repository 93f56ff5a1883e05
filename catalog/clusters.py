"""Density clustering."""

from pyspark.sql import functions as F

from catalog import query
from catalog.places import geo_facilities, located_incidents, located_stores
from catalog.sqltext import GEO_FACILITY, GEO_FACILITY_NEEDS, LOCATED, LOCATED_NEEDS, LOCATED_STORE, LOCATED_STORE_NEEDS
from placestats import constants as K
from placestats.fixtures import Tables
from placestats.operators.aggregates import true_share, type_breakdown
from placestats.operators.cluster import (
    bin_clusters, cluster_kpis, cluster_stats, connected_components, dbscan, dbscan_multi, dbscan_nested,
)
from placestats.plans import crime, grocery, healthcare
from placestats.functions.numbers import haversine_km
from placestats.session import materialize

FINE, COARSE, WIDE = (0.06, 4), (0.09, 9), (0.2, 3)


def distance(a: str, b: str) -> str:
    half_lat = f"sin((radians({b}.lat) - radians({a}.lat)) / 2)"
    half_lon = f"sin((radians({b}.long) - radians({a}.long)) / 2)"
    chord = f"{half_lat} * {half_lat} + cos(radians({a}.lat)) * cos(radians({b}.lat)) * {half_lon} * {half_lon}"
    return f"asin(sqrt(least({chord}, 1.0))) * {2 * K.EARTH_KM}"


def dbscan_ctes(p: str, points: str, group: list[str], id: str, eps: float, least: int) -> dict[str, str]:
    """Brute-force DBSCAN in SQL: all pairs, recursive reach, lowest root. Ends in `{p}label`."""
    same = " AND ".join(f"a.{g} = b.{g}" for g in group)
    groups = ", ".join(group)
    return {
        f"{p}pt": f"SELECT {id} AS id, {groups}, lat, long FROM {points} WHERE lat IS NOT NULL AND long IS NOT NULL",
        f"{p}pair": f"SELECT a.id AS a, b.id AS b FROM {p}pt a JOIN {p}pt b ON {same} WHERE {distance('a', 'b')} <= {eps}",
        f"{p}core": f"SELECT a AS id FROM {p}pair GROUP BY a HAVING count(*) >= {least}",
        f"{p}link": f"SELECT a, b FROM {p}pair JOIN {p}core c ON c.id = a JOIN {p}core d ON d.id = b",
        f"{p}reach(id, root)": f"SELECT id, id FROM {p}core UNION SELECT l.b, r.root FROM {p}reach r JOIN {p}link l ON l.a = r.id",
        f"{p}root": f"SELECT id, min(root) AS root FROM {p}reach GROUP BY id",
        f"{p}cluster": f"""SELECT r.id, CAST(dense_rank() OVER (PARTITION BY {groups} ORDER BY root) - 1 AS INTEGER) AS cluster_id
FROM {p}root r JOIN {p}pt t ON t.id = r.id""",
        f"{p}border": f"SELECT e.a AS id, min(c.cluster_id) AS cluster_id FROM {p}pair e JOIN {p}cluster c ON c.id = e.b GROUP BY e.a",
        f"{p}label": f"""SELECT t.*, coalesce(c.cluster_id, b.cluster_id, -1) AS cluster_id, c.id IS NOT NULL AS is_core,
coalesce(c.cluster_id, b.cluster_id, -1) = -1 AS is_noise
FROM {p}pt t LEFT JOIN {p}cluster c ON c.id = t.id LEFT JOIN {p}border b ON b.id = t.id""",
    }


def stats_sql(label: str, group: str) -> str:
    noise = "count(*) FILTER (is_noise)::DOUBLE / count(*) * 100"
    return f"""SELECT {group}, count(*) AS total, count(DISTINCT cluster_id) FILTER (cluster_id >= 0) AS n_clusters,
round_even(100.0::DOUBLE - {noise}, 1) AS clustered_pct, round_even({noise}, 1) AS noise_pct FROM {label} GROUP BY {group}"""


def points(t: Tables):
    return t.fx_cluster_point


def labels(t: Tables, scale):
    return dbscan(points(t), "location_id", "id", eps_km=scale[0], min_samples=scale[1])


_FINE = dbscan_ctes("f_", "fx_cluster_point", ["location_id"], "id", *FINE)
_COARSE = dbscan_ctes("c_", "fx_cluster_point", ["location_id"], "id", *COARSE)
_WIDE = dbscan_ctes("w_", "fx_cluster_point", ["location_id"], "id", *WIDE)
_COLS = "id, location_id, lat, long, cluster_id, is_core, is_noise"


@query("dbscan_labels", f"SELECT {_COLS} FROM f_label", ["fx_cluster_point"], _FINE)
def _(t):
    return labels(t, FINE)


@query("dbscan_border", f"SELECT {_COLS} FROM c_label", ["fx_cluster_point"], _COARSE)
def _(t):
    return labels(t, COARSE)


@query("dbscan_stats", stats_sql("w_label", "location_id"), ["fx_cluster_point"], _WIDE)
def _(t):
    return cluster_stats(labels(t, WIDE), "location_id")


@query(
    "dbscan_small_groups",
    """SELECT id, p.g, cluster_id FROM s_label p JOIN (SELECT g FROM s_pt GROUP BY g HAVING count(*) >= 9) k ON p.g = k.g""",
    ["fx_cluster_point"],
    {
        "grouped": "SELECT id, CASE WHEN id % 4 = 0 THEN 1000 + CAST(floor(id / 20.0) AS INTEGER) ELSE location_id END AS g, lat, long FROM fx_cluster_point",
        **dbscan_ctes("s_", "grouped", ["g"], "id", 0.5, 9),
    },
)
def _(t):
    """Every fourth point sits in a group of at most five, below the gate; the areas lie above it."""
    g = F.when(F.col("id") % 4 == 0, F.lit(1000) + F.floor(F.col("id") / F.lit(20.0)).cast("int")).otherwise(F.col("location_id"))
    rows = points(t).select("id", g.alias("g"), "lat", "long")
    return dbscan(rows, "g", "id", eps_km=0.5, min_samples=9, small_group="skip").select("id", "g", "cluster_id")


@query(
    "dbscan_two_scale",
    """SELECT f.id, f.location_id, f.cluster_id AS fine_id, c.cluster_id AS coarse_id FROM f_label f JOIN c_label c ON f.id = c.id""",
    ["fx_cluster_point"],
    {**_FINE, **_COARSE},
)
def _(t):
    runs = dbscan_multi(materialize(points(t)), {"fine": FINE, "coarse": COARSE}, group="location_id", id="id")
    fine = runs["fine"].select("id", "location_id", F.col("cluster_id").alias("fine_id"))
    return fine.join(runs["coarse"].select("id", F.col("cluster_id").alias("coarse_id")), "id")


@query(
    "dbscan_nested",
    """SELECT w.id, w.location_id, w.cluster_id AS macro_id, coalesce(n.cluster_id, -1) AS micro_id
       FROM w_label w LEFT JOIN n_label n ON w.id = n.id""",
    ["fx_cluster_point"],
    {
        **_WIDE,
        "macro": "SELECT id, location_id, cluster_id AS macro_id, lat, long FROM w_label WHERE cluster_id >= 0",
        **dbscan_ctes("n_", "macro", ["location_id", "macro_id"], "id", *FINE),
    },
)
def _(t):
    out = dbscan_nested(points(t), "location_id", "id", WIDE, FINE)
    return out.select("id", "location_id", "macro_id", "micro_id")


@query(
    "cluster_kpis",
    """SELECT location_id, count(DISTINCT cluster_id) FILTER (NOT is_noise) AS map_cluster_count,
       count(*) FILTER (NOT is_noise) AS hotspot_points, count(*) FILTER (is_noise) AS dispersed_points,
       round_even(count(*) FILTER (NOT is_noise) * 100.0::DOUBLE / count(*), 1) AS map_hotspot_pct FROM f_label GROUP BY location_id""",
    ["fx_cluster_point"],
    _FINE,
)
def _(t):
    return cluster_kpis(labels(t, FINE), "location_id")


@query(
    "components",
    """SELECT node, min(root) AS root FROM reach GROUP BY node""",
    [],
    {
        "ends": "SELECT o_orderkey * 10 AS u, o_custkey * 10 + 1 AS v FROM orders",
        "twoway": "SELECT u, v FROM ends UNION SELECT v, u FROM ends",
        "reach(node, root)": "SELECT u, u FROM twoway UNION SELECT e.v, r.root FROM reach r JOIN twoway e ON e.u = r.node",
    },
)
def _(t):
    """Orders and customers as a graph: one component per customer with orders."""
    ends = t.orders.select((F.col("o_orderkey") * 10).alias("u"), (F.col("o_custkey") * 10 + 1).alias("v"))
    return connected_components(ends)


@query(
    "great_circle",
    f"SELECT a.id, round({distance('a', 'b')}, 6) AS km FROM fx_cluster_point a JOIN fx_cluster_point b ON b.id = a.id + 1",
    ["fx_cluster_point"],
)
def _(t):
    a, b = points(t).alias("a"), points(t).select("id", "lat", "long").alias("b")
    km = haversine_km(F.col("a.lat"), F.col("a.long"), F.col("b.lat"), F.col("b.long"))
    return a.join(b, F.col("b.id") == F.col("a.id") + 1).select("a.id", F.round(km, 6).alias("km"))


# --- incidents: figures at a fine scale, points at a coarse one ------------------
HOT, MAP = (0.5, 6), (0.9, 12)
_HOT = dbscan_ctes("h_", "located", ["neighborhood_name"], "load_seq", *HOT)
_BIG = {**LOCATED, **_HOT, "big": "SELECT neighborhood_name FROM h_pt GROUP BY neighborhood_name HAVING count(*) >= 6"}


def crime_points(t: Tables):
    return located_incidents(t).select(
        "load_seq", "neighborhood_name", "lat", "long", F.col("occurred_on_date").cast("date").alias("crime_date"),
        F.col("offense_description").alias("crime_description"),
    )


def recent(t: Tables):
    return materialize(crime.recent_incidents(crime_points(t), least=HOT[1]))


@query(
    "crime_hotspots",
    stats_sql("h_label", "neighborhood_name").replace(" total,", " total_crimes,").replace("n_clusters", "n_hotspot_clusters")
    .replace("clustered_pct", "hotspot_crime_share_pct").replace("noise_pct", "noise_crime_pct"),
    LOCATED_NEEDS,
    _BIG,
)
def _(t):
    return crime.hotspot_figures(recent(t), "load_seq", HOT)


@query(
    "crime_cluster_points",
    """SELECT m.neighborhood_name, m.lat, m.long, m.cluster_id, m.is_noise, strftime(l.occurred_on_date, '%Y-%m-%d') AS crime_date,
       l.offense_description AS crime_description FROM m_label m JOIN (SELECT DISTINCT load_seq, occurred_on_date, offense_description FROM located) l
       ON m.id = l.load_seq JOIN big b ON m.neighborhood_name = b.neighborhood_name""",
    LOCATED_NEEDS,
    {**_BIG, **dbscan_ctes("m_", "located", ["neighborhood_name"], "load_seq", *MAP)},
)
def _(t):
    return crime.hotspot_points(recent(t), "load_seq", MAP)


# --- ids as they are in the mart: unique per incident and offence only ---------------
SHARED = (0.5, 4)


def node_ctes(p: str, points: str, scale, group: str = "neighborhood_name", id: str = "incident_number") -> dict[str, str]:
    """DBSCAN in SQL over merged positions, numbered by (least id, position). Ends in `{p}label`: the rows of `points` with labels."""
    return {
        f"{p}ranked": f"""SELECT *, dense_rank() OVER (PARTITION BY {group} ORDER BY least_id, lat, long) AS node FROM (
SELECT *, min({id}) OVER (PARTITION BY {group}, lat, long) AS least_id FROM {points} WHERE lat IS NOT NULL AND long IS NOT NULL)""",
        f"{p}pt": f"SELECT {group}, node, any_value(lat) AS lat, any_value(long) AS long, count(*) AS w FROM {p}ranked GROUP BY {group}, node",
        f"{p}pair": f"SELECT a.{group} AS g, a.node AS a, b.node AS b, b.w FROM {p}pt a JOIN {p}pt b ON a.{group} = b.{group} WHERE {distance('a', 'b')} <= {scale[0]}",
        f"{p}core": f"SELECT g, a AS node FROM {p}pair GROUP BY g, a HAVING sum(w) >= {scale[1]}",
        f"{p}link": f"SELECT p.g, p.a, p.b FROM {p}pair p JOIN {p}core c ON c.g = p.g AND c.node = p.a JOIN {p}core d ON d.g = p.g AND d.node = p.b",
        f"{p}reach(g, node, root)": f"SELECT g, node, node FROM {p}core UNION SELECT l.g, l.b, r.root FROM {p}reach r JOIN {p}link l ON l.g = r.g AND l.a = r.node",
        f"{p}root": f"SELECT g, node, min(root) AS root FROM {p}reach GROUP BY g, node",
        f"{p}cluster": f"SELECT g, node, CAST(dense_rank() OVER (PARTITION BY g ORDER BY root) - 1 AS INTEGER) AS cluster_id FROM {p}root",
        f"{p}border": f"SELECT p.g, p.a AS node, min(c.cluster_id) AS cluster_id FROM {p}pair p JOIN {p}cluster c ON c.g = p.g AND c.node = p.b GROUP BY p.g, p.a",
        f"{p}label": f"""SELECT r.*, coalesce(c.cluster_id, b.cluster_id, -1) AS cluster_id, c.node IS NOT NULL AS is_core, coalesce(c.cluster_id, b.cluster_id, -1) = -1 AS is_noise
FROM {p}ranked r LEFT JOIN {p}cluster c ON c.g = r.{group} AND c.node = r.node LEFT JOIN {p}border b ON b.g = r.{group} AND b.node = r.node""",
    }


@query(
    "dbscan_shared_ids",
    "SELECT load_seq, neighborhood_name, cluster_id, is_core FROM n_label",
    LOCATED_NEEDS,
    {**LOCATED, **node_ctes("n_", "located", SHARED)},
)
def _(t):
    """Located incidents by incident number, which repeats within and between areas."""
    rows = located_incidents(t).select("load_seq", "incident_number", "neighborhood_name", "lat", "long")
    out = dbscan(rows, "neighborhood_name", "incident_number", eps_km=SHARED[0], min_samples=SHARED[1])
    return out.select("load_seq", "neighborhood_name", "cluster_id", "is_core")


# --- stores ----------------------------------------------------------------------
STORE_SCALE = (0.9, 3)
_groups = ", ".join(
    f"count(*) FILTER (store_type IN ({', '.join(repr(x) for x in v)})) AS {k}" for k, v in K.STORE_COUNT_GROUPS.items()
)
GROCERY_PROFILE = {
    **LOCATED_STORE,
    **dbscan_ctes("g_", "newest_store", ["neighborhood_name"], "objectid", *STORE_SCALE),
    "store_counts": f"""
SELECT neighborhood_name, arg_min(city, objectid) AS city, count(*) AS total_stores, count(*) FILTER (is_essential_food_source) AS essential_store_count,
  {_groups} FROM newest_store GROUP BY neighborhood_name""",
    "store_noise": """
SELECT neighborhood_name, count(DISTINCT cluster_id) FILTER (cluster_id >= 0) AS n, round_even(count(*) FILTER (is_noise)::DOUBLE / count(*) * 100, 1) AS noise
FROM g_label GROUP BY neighborhood_name""",
    "grocery_profile": f"""
SELECT c.neighborhood_name, city, total_stores, essential_store_count,
  round_even(essential_store_count * 100.0::DOUBLE / total_stores, 1) AS essential_store_pct, {', '.join(K.STORE_COUNT_GROUPS)},
  n AS n_store_clusters, round_even(100.0::DOUBLE - noise, 1) AS clustered_store_share_pct, noise AS isolated_store_pct,
  CASE WHEN essential_store_count <= 2 THEN 'LOW_ACCESS' WHEN essential_store_count <= 5 THEN 'FAIR_ACCESS'
       WHEN essential_store_count <= 10 THEN 'GOOD_ACCESS' ELSE 'HIGH_ACCESS' END AS access_tier
FROM store_counts c JOIN store_noise s ON c.neighborhood_name = s.neighborhood_name""",
}


def grocery_profile(t: Tables):
    return grocery.area_profile(materialize(grocery.newest_stores(located_stores(t))), STORE_SCALE)


@query("grocery_profile", "SELECT * FROM grocery_profile", LOCATED_STORE_NEEDS, GROCERY_PROFILE)
def _(t):
    return grocery_profile(t)


@query(
    "type_breakdown",
    f"SELECT neighborhood_name, {_groups}, count(*) AS n FROM located_store GROUP BY neighborhood_name",
    LOCATED_STORE_NEEDS,
    LOCATED_STORE,
)
def _(t):
    return type_breakdown(located_stores(t), ["neighborhood_name"], "store_type", K.STORE_COUNT_GROUPS, n=F.count(F.lit(1)))


@query(
    "true_share",
    """SELECT neighborhood_name, count(*) FILTER (is_large_format) AS n_true, count(*) AS n,
       round_even(count(*) FILTER (is_large_format) * 100.0::DOUBLE / count(*), 1) AS true_pct FROM located_store GROUP BY neighborhood_name""",
    LOCATED_STORE_NEEDS,
    LOCATED_STORE,
)
def _(t):
    return true_share(located_stores(t), ["neighborhood_name"], "is_large_format")


# --- bins --------------------------------------------------------------------------
BINS = {
    "bin": """
SELECT f.location_id, CAST(round(CAST(p.lat AS DECIMAL(28,12)), 2) AS DECIMAL(18,2)) AS la, CAST(round(CAST(p.long AS DECIMAL(28,12)), 2) AS DECIMAL(18,2)) AS lo,
  count(*) AS n FROM fx_facility f JOIN fx_cluster_point p ON f.facility_id = p.id WHERE f.location_id IS NOT NULL GROUP BY 1, 2, 3""",
    "bin_total": """
SELECT location_id, CAST(sum(n) AS BIGINT) AS total, count(*) FILTER (n >= 2) AS n_clusters,
  round(coalesce(sum(n) FILTER (n >= 2), 0) * 100.0::DOUBLE / sum(n), 1) AS clustered_pct,
  round(coalesce(sum(n) FILTER (n = 1), 0) * 100.0::DOUBLE / sum(n), 1) AS isolated_pct FROM bin GROUP BY location_id""",
}
BIN_NEEDS = ["fx_facility", "fx_cluster_point"]


def binned(t: Tables):
    spots = points(t).select(F.col("id").alias("facility_id"), "lat", "long")
    return t.fx_facility.select("facility_id", "location_id").join(spots, "facility_id")


@query("bin_clusters", "SELECT * FROM bin_total", BIN_NEEDS, BINS)
def _(t):
    return bin_clusters(binned(t), ["location_id"])


@query(
    "healthcare_hotspots",
    """SELECT location_id, neighborhood_name, city, CAST(sum(n) AS BIGINT) AS total_facilities, count(*) FILTER (n >= 2) AS n_healthcare_clusters,
       round(coalesce(sum(n) FILTER (n >= 2), 0) * 100.0::DOUBLE / sum(n), 1) AS clustered_facility_share_pct,
       round(coalesce(sum(n) FILTER (n = 1), 0) * 100.0::DOUBLE / sum(n), 1) AS isolated_facility_pct FROM (
         SELECT location_id, neighborhood_name, city, round(CAST(lat AS DECIMAL(28,12)), 2) AS la, round(CAST(long AS DECIMAL(28,12)), 2) AS lo, count(*) AS n
         FROM located_facility WHERE location_id IS NOT NULL AND neighborhood_name IS NOT NULL GROUP BY 1, 2, 3, 4, 5)
       GROUP BY location_id, neighborhood_name, city""",
    GEO_FACILITY_NEEDS,
    GEO_FACILITY,
)
def _(t):
    return healthcare.hotspot_bins(healthcare.facility_mart(geo_facilities(t), t.polygons))
