"""Dashboard queries."""

from pyspark.sql import functions as F

from catalog import query
from catalog.clusters import GROCERY_PROFILE, HOT, MAP, dbscan_ctes, grocery_profile, recent
from catalog.places import ADJACENT, ADJACENT_NEEDS, CENTROIDS, located_incidents, located_stores
from catalog.scores import HEALTH, HEALTH_NEEDS, SAFETY, health_profile, safety
from catalog.sqltext import LOCATED, LOCATED_NEEDS, LOCATED_STORE, LOCATED_STORE_NEEDS
from catalog.texts import (
    CRIME_STORY, CRIME_STORY_NEEDS, HEALTH_STORY, HEALTH_STORY_NEEDS, crime_story, health_clusters,
)
from placestats import constants as K
from placestats.fixtures import AS_OF, Tables
from placestats.functions.geometry import geom_edges
from placestats.functions.nested import json_path
from placestats.operators.ranking import bottom_k, top_k
from placestats.operators.spatial import with_centroid
from placestats.plans import board, crime

_AREA = "NATION_12"


def rgba_text(col):
    return F.array_join(F.transform(col, lambda v: v.cast("string")), ",")


def color_case(col: str, table: dict, other: list) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{','.join(map(str, v))}'" for k, v in table.items())
    return f"CASE {col} {whens} ELSE '{','.join(map(str, other))}' END"


def areas(t: Tables):
    """Areas with geometry and centroid."""
    return with_centroid(t.polygons)


@query(
    "offense_breakdown",
    f"""SELECT offense_description, CASE WHEN is_violent_crime THEN 'Violent' WHEN is_property_crime THEN 'Property' END AS crime_category, count(*) AS crime_count
       FROM located WHERE valid_location AND occurred_on_date >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL 12 MONTH AND (is_violent_crime OR is_property_crime)
       AND neighborhood_name = '{_AREA}' GROUP BY 1, 2 ORDER BY crime_count DESC, offense_description, crime_category LIMIT 5""",
    LOCATED_NEEDS,
    LOCATED,
)
def _(t):
    return board.offense_breakdown(located_incidents(t), _AREA, AS_OF)


@query(
    "monthly_history",
    f"""SELECT neighborhood_name, CAST(date_trunc('month', occurred_on_date) AS DATE) AS month, count(*) AS y FROM located
       WHERE valid_location AND occurred_on_date >= TIMESTAMP '2023-01-01' AND date_trunc('month', occurred_on_date) < date_trunc('month', TIMESTAMP '{AS_OF}')
       GROUP BY 1, 2""",
    LOCATED_NEEDS,
    LOCATED,
)
def _(t):
    return board.monthly_history(located_incidents(t), 2023, AS_OF)


@query(
    "load_incidents",
    f"""SELECT incident_number AS incident_id, city, offense_description AS crime_description, CAST(occurred_on_date AS DATE) AS crime_date,
       CAST(date_trunc('month', occurred_on_date) AS DATE) AS year_month, CAST(extract(year FROM occurred_on_date) AS INTEGER) AS crime_year,
       CAST(extract(month FROM occurred_on_date) AS INTEGER) AS crime_month, lat, long, location_id, neighborhood_name FROM located
       WHERE valid_location AND occurred_on_date >= TIMESTAMP '2023-01-01' AND occurred_on_date < date_trunc('month', TIMESTAMP '{AS_OF}')""",
    LOCATED_NEEDS,
    LOCATED,
)
def _(t):
    return crime.load_incidents(located_incidents(t), 2023, AS_OF)


@query(
    "boundary_of_area",
    f"""SELECT pos, round(long, 9) AS long, round(lat, 9) AS lat FROM (SELECT e.location_id, k AS pos, x1 AS long, y1 AS lat FROM fx_edge e
       UNION ALL SELECT location_id, CAST(max(k) + 1 AS INTEGER), arg_min(x1, k), arg_min(y1, k) FROM fx_edge GROUP BY location_id) b
       JOIN fx_location l ON b.location_id = l.location_id WHERE neighborhood_name = '{_AREA}'""",
    ADJACENT_NEEDS,
)
def _(t):
    out = board.boundary(t.polygons, _AREA)
    return out.select("pos", F.round("long", 9).alias("long"), F.round("lat", 9).alias("lat"))


@query(
    "points_with_street",
    """SELECT p.neighborhood_name, p.lat, p.long, p.cluster_id, p.is_noise, p.crime_date, s.street FROM (
         SELECT * FROM (SELECT m.neighborhood_name, m.lat, m.long, m.cluster_id, m.is_noise, strftime(l.occurred_on_date, '%Y-%m-%d') AS crime_date,
           row_number() OVER (PARTITION BY m.lat, m.long, strftime(l.occurred_on_date, '%Y-%m-%d') ORDER BY m.cluster_id, m.is_noise) AS rn
           FROM m_label m JOIN (SELECT DISTINCT load_seq, occurred_on_date FROM located) l ON m.id = l.load_seq
           JOIN big b ON m.neighborhood_name = b.neighborhood_name) WHERE rn = 1) p
       LEFT JOIN (SELECT lat, long, strftime(occurred_on_date, '%Y-%m-%d') AS d, arg_max(street, load_seq) AS street FROM located GROUP BY 1, 2, 3) s
       ON p.lat = s.lat AND p.long = s.long AND p.crime_date = s.d""",
    LOCATED_NEEDS,
    {
        **LOCATED,
        **dbscan_ctes("m_", "located", ["neighborhood_name"], "load_seq", *MAP),
        "big": f"SELECT neighborhood_name FROM m_pt GROUP BY neighborhood_name HAVING count(*) >= {HOT[1]}",
    },
)
def _(t):
    labelled = crime.hotspot_points(recent(t), "load_seq", MAP)
    return board.points_with_street(labelled, located_incidents(t)).drop("crime_description")


@query(
    "safety_map",
    f"""SELECT s.neighborhood_name, c.centroid_lat, c.centroid_long, s.safety_score, s.safety_grade, round(s.incidents / 12.0::DOUBLE, 6) AS avg_monthly_incidents,
       {color_case('s.safety_grade', K.SAFETY_COLORS, K.SAFETY_COLOR_OTHER)} AS color, CAST(CASE WHEN l.location_id % 2 = 0 THEN 5 ELSE 7 END AS INTEGER) AS n_points
       FROM safety_graded s JOIN fx_location l ON l.location_id = s.location_id JOIN centroids c ON c.location_id = l.location_id
       WHERE l.city IN ('AFRICA', 'ASIA') AND l.granularity = 'NEIGHBORHOOD' AND s.incidents >= 30""",
    LOCATED_NEEDS,
    {**SAFETY, **CENTROIDS},
)
def _(t):
    scored = safety(t).withColumns(
        {"insufficient_data": F.col("incidents") < 30, "avg_monthly_incidents": F.round(F.col("incidents") / 12.0, 6)}
    )
    out = board.safety_map(areas(t), scored, ["AFRICA", "ASIA"])
    return out.select(
        "neighborhood_name", "centroid_lat", "centroid_long", "safety_score", "safety_grade", "avg_monthly_incidents",
        rgba_text(F.col("fill_color")).alias("color"),
        F.size(F.from_json(json_path(F.col("geojson"), "$.coordinates[0]", "string"), "array<array<double>>")).alias("n_points"),
    )


_tier_words = "CASE access_tier " + " ".join(
    f"WHEN '{k}' THEN '{k.replace('_', ' ').title()}'" for k in K.TIER_COLORS
) + " END"


@query(
    "grocery_board",
    f"""SELECT neighborhood_name, total_stores, essential_store_count, access_tier, {_tier_words} AS tier_label,
       {color_case('access_tier', K.TIER_COLORS, K.TIER_COLOR_OTHER)} AS color FROM grocery_profile""",
    LOCATED_STORE_NEEDS,
    GROCERY_PROFILE,
)
def _(t):
    out = board.grocery_board(grocery_profile(t))
    return out.select(
        "neighborhood_name", "total_stores", "essential_store_count", "access_tier", "tier_label", rgba_text(F.col("fill_color")).alias("color")
    )


@query(
    "grocery_map",
    """SELECT p.neighborhood_name, p.total_stores, p.access_tier, p.n_store_clusters, l.location_id, c.centroid_lat, c.centroid_long
       FROM grocery_profile p JOIN fx_location l ON upper(p.neighborhood_name) = upper(l.neighborhood_name) JOIN centroids c ON c.location_id = l.location_id""",
    LOCATED_STORE_NEEDS,
    {**GROCERY_PROFILE, **CENTROIDS},
)
def _(t):
    out = board.grocery_map(grocery_profile(t), areas(t))
    return out.select(
        "neighborhood_name", "total_stores", "access_tier", "n_store_clusters", "location_id", "centroid_lat", "centroid_long"
    )


@query(
    "store_list",
    "SELECT objectid, store_name, street_address, zip_code, store_type, naics_category, data_year, neighborhood_name, city FROM newest_store",
    LOCATED_STORE_NEEDS,
    LOCATED_STORE,
)
def _(t):
    out = board.store_list(located_stores(t))
    return out.select(
        "objectid", "store_name", "street_address", "zip_code", "store_type", "naics_category", "data_year", "neighborhood_name", "city"
    )


@query(
    "healthcare_table",
    """SELECT neighborhood_name, city, healthcare_score, healthcare_grade, total_facilities, density_score, n_healthcare_clusters,
       clustered_facility_share_pct, 'Score ' || CAST(healthcare_score AS VARCHAR) AS healthcare_narrative FROM health_row""",
    HEALTH_STORY_NEEDS,
    HEALTH_STORY,
)
def _(t):
    profile = health_profile(t)
    names = t.fx_location.select("location_id", F.lower("neighborhood_name").alias("neighborhood_name"))
    hot = health_clusters(t).join(names, "location_id")
    told = profile.select(
        F.lower("neighborhood_name").alias("neighborhood_name"),
        F.concat(F.lit("Score "), F.col("healthcare_score").cast("string")).alias("healthcare_narrative"),
    )
    return board.healthcare_table(profile, hot, told).select(
        "neighborhood_name", "city", "healthcare_score", "healthcare_grade", "total_facilities", "density_score",
        "n_healthcare_clusters", "clustered_facility_share_pct", "healthcare_narrative",
    )


_health_color = "CASE " + " ".join(
    f"WHEN healthcare_score >= {at} THEN '{','.join(map(str, c))}'" for at, c in K.HEALTH_SCORE_COLORS
) + f" ELSE '{','.join(map(str, K.HEALTH_SCORE_COLOR_LOW))}' END"


@query(
    "healthcare_map",
    f"""SELECT h.location_id, h.healthcare_score, h.n_healthcare_clusters, h.clustered_facility_share_pct, c.centroid_lat, c.centroid_long, {_health_color} AS color,
       CAST(CASE WHEN h.location_id % 2 = 0 THEN 4 ELSE 6 END AS INTEGER) AS n_edges FROM health_row h JOIN centroids c ON c.location_id = h.location_id""",
    [*HEALTH_STORY_NEEDS, "fx_edge"],
    {**HEALTH_STORY, **CENTROIDS},
)
def _(t):
    out = board.healthcare_map(health_profile(t), health_clusters(t), areas(t))
    return out.select(
        "location_id", "healthcare_score", "n_healthcare_clusters", "clustered_facility_share_pct", "centroid_lat", "centroid_long",
        rgba_text(F.col("fill_color")).alias("color"), F.size(geom_edges(F.col("geometry"))).alias("n_edges"),
    )


@query(
    "forecast_board",
    """SELECT s.neighborhood_name, s.recent_trend, s.recent_avg_monthly, s.forecasted_count, s.reliability_flag, s.n_hotspot_clusters, s.hotspot_crime_share_pct,
       CASE WHEN forecasted_count > recent_avg_monthly * 1.05::DOUBLE THEN 'rising' WHEN forecasted_count < recent_avg_monthly * 0.95::DOUBLE THEN 'falling' ELSE 'flat' END AS outlook
       FROM story s WHERE recent_trend IN ('increasing', 'decreasing') AND reliability_flag IN ('HIGH', 'LOW')""",
    CRIME_STORY_NEEDS,
    CRIME_STORY,
)
def _(t):
    told, hot = crime_story(t)
    out = board.forecast_board(told, hot, ["increasing", "decreasing"], ["HIGH", "LOW"])
    return out.select(
        "neighborhood_name", "recent_trend", "recent_avg_monthly", "forecasted_count", "reliability_flag",
        "n_hotspot_clusters", "hotspot_crime_share_pct", "outlook",
    )


@query(
    "neighbours",
    f"""SELECT neighborhood_name, total_facilities, healthcare_score FROM health_profile
       WHERE neighborhood_name IN (SELECT b FROM adjacent_name WHERE a = '{_AREA}')""",
    [*HEALTH_NEEDS, *ADJACENT_NEEDS],
    {**HEALTH, **ADJACENT},
)
def _(t):
    pairs = board.adjacency_pairs(t.polygons)
    return board.neighbours_of(health_profile(t), pairs, _AREA).select("neighborhood_name", "total_facilities", "healthcare_score")


@query(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 12",
)
def _(t):
    return top_k(t.orders, 12, ("o_totalprice", "desc"), ("o_orderkey", "asc")).select("o_orderkey", "o_totalprice")


@query(
    "bottom_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice ASC NULLS FIRST, o_orderkey DESC LIMIT 5",
)
def _(t):
    return bottom_k(t.orders, 5, ("o_totalprice", "desc"), ("o_orderkey", "asc")).select("o_orderkey", "o_totalprice")


@query(
    "listing",
    "SELECT neighborhood_name, healthcare_score, healthcare_grade FROM health_profile",
    HEALTH_NEEDS,
    HEALTH,
)
def _(t):
    rows = health_profile(t).select("neighborhood_name", "healthcare_score", "healthcare_grade")
    return board.listing(rows, ("healthcare_score", "desc"), ("neighborhood_name", "asc"))


@query(
    "point_kinds",
    "SELECT CASE WHEN is_noise THEN 'Dispersed' ELSE 'Hotspot' END AS point_type, count(*) AS n FROM m_label m JOIN big b ON m.neighborhood_name = b.neighborhood_name GROUP BY 1",
    LOCATED_NEEDS,
    {
        **LOCATED,
        **dbscan_ctes("m_", "located", ["neighborhood_name"], "load_seq", *MAP),
        "big": f"SELECT neighborhood_name FROM m_pt GROUP BY neighborhood_name HAVING count(*) >= {HOT[1]}",
    },
)
def _(t):
    labelled = crime.hotspot_points(recent(t), "load_seq", MAP)
    return labelled.groupBy(board.point_kind(F.col("is_noise")).alias("point_type")).agg(F.count(F.lit(1)).alias("n"))
