"""Small helpers that write oracle SQL from the fixed word lists."""

from __future__ import annotations

from placestats import constants as K
from placestats.fixtures import AS_OF


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def like_words(col: str, words) -> str:
    return "(" + " OR ".join(f"{col} LIKE '%{w}%'" for w in words) + ")"


def ilike_any(col: str, patterns) -> str:
    return "(" + " OR ".join(f"{col} ILIKE '{p}'" for p in patterns) + ")"


def case(rules, default: str) -> str:
    """rules: (condition, value expression) pairs."""
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {default} END"


def clean(col: str) -> str:
    return f"coalesce(nullif(trim(upper({col})), ''), 'UNKNOWN')"


def squeezed(col: str) -> str:
    return f"coalesce(nullif(regexp_replace(trim(upper({col})), '\\s+', ' ', 'g'), ''), 'UNKNOWN')"


def fill(template: str, **overrides: str) -> str:
    """A {slot} template as a SQL concatenation."""
    import re

    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(f"CAST({overrides.get(piece, piece)} AS VARCHAR)")
        elif piece:
            parts.append("'" + piece.replace("'", "''") + "'")
    return " || ".join(parts)


_box = K.METRO_BOX
IN_BOX = f"coalesce(lat BETWEEN {_box[0]} AND {_box[1]} AND long BETWEEN {_box[2]} AND {_box[3]}, FALSE)"
_up = "upper(offense_description)"
_parts = case([(f"hour BETWEEN {a} AND {b}", f"'{n}'") for a, b, n in K.DAY_PARTS], "'UNKNOWN'")
_season = case([(f"month IN ({', '.join(map(str, ms))})", f"'{n}'") for n, ms in K.SEASONS.items()], "'UNKNOWN'")


def _tier(a, b, c) -> str:
    return case([(like_words(_up, K.SEVERITY_HIGH), a), (like_words(_up, K.SEVERITY_MEDIUM), b)], c)


CLEAN_INCIDENT = {
    "latest": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY incident_number, offense_code ORDER BY load_seq DESC NULLS LAST) AS rn
FROM fx_incident) WHERE rn = 1""",
    "clean_incident": f"""
SELECT incident_number, CAST(offense_code AS INTEGER) AS offense_code, {clean('offense_description')} AS offense_description,
  CASE WHEN upper(trim(i.district)) IN ({quoted(K.DISTRICT_CODES)}) THEN upper(trim(i.district)) ELSE 'UNKNOWN' END AS district,
  coalesce(d.district_name, 'UNKNOWN') AS district_name, {clean('reporting_area')} AS reporting_area, {clean('street')} AS street,
  CASE WHEN {IN_BOX} THEN lat ELSE -999.0 END AS lat, CASE WHEN {IN_BOX} THEN long ELSE -999.0 END AS long,
  {IN_BOX} AS valid_location, occurred_on_date, coalesce(year, -99) AS year, coalesce(month, -99) AS month,
  coalesce(hour, -99) AS hour, {clean('day_of_week')} AS day_of_week,
  coalesce(try_cast(shooting AS INTEGER) = 1, FALSE) AS is_shooting, {_parts} AS time_of_day,
  coalesce(upper(trim(day_of_week)) IN ({quoted(K.WEEKEND_DAYS)}), FALSE) AS is_weekend, {_season} AS season,
  coalesce(CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0'), 'UNKNOWN') AS year_month,
  {_tier('1', '2', '3')} AS crime_severity_tier, {_tier("'HIGH'", "'MEDIUM'", "'LOW'")} AS crime_severity_label,
  coalesce({like_words(_up, K.VIOLENT_WORDS)}, FALSE) AS is_violent_crime,
  coalesce({like_words(_up, K.PROPERTY_WORDS)}, FALSE) AS is_property_crime,
  coalesce({like_words(_up, K.DRUG_WORDS)}, FALSE) AS is_drug_related, load_seq
FROM latest i LEFT JOIN fx_district d ON upper(trim(i.district)) = upper(trim(d.district_code))
WHERE occurred_on_date IS NOT NULL AND occurred_on_date <= TIMESTAMP '{AS_OF}'""",
}
CLEAN_NEEDS = ["fx_incident", "fx_district"]

OVERLAID = {
    **CLEAN_INCIDENT,
    "geo_ok": f"""
SELECT incident_number, lat AS g_lat, long AS g_long FROM fx_geocode
WHERE geocode_status IN ({quoted(K.GEOCODE_OK_INCIDENT)}) AND lat IS NOT NULL AND lat <> -999 AND long IS NOT NULL AND long <> -999""",
    "overlaid": """
SELECT c.* EXCLUDE (lat, long, valid_location),
  CASE WHEN NOT c.valid_location AND g.g_lat IS NOT NULL THEN g.g_lat ELSE c.lat END AS lat,
  CASE WHEN NOT c.valid_location AND g.g_long IS NOT NULL THEN g.g_long ELSE c.long END AS long,
  c.valid_location OR g.g_lat IS NOT NULL AS valid_location
FROM clean_incident c LEFT JOIN geo_ok g ON c.incident_number = g.incident_number AND NOT c.valid_location""",
}
OVERLAY_NEEDS = [*CLEAN_NEEDS, "fx_geocode"]


def in_polygon(points: str, key: str, where: str = "TRUE") -> str:
    """(key, location_id) of points inside polygons, by edge crossing parity."""
    return f"""
SELECT p.{key} AS k, e.location_id FROM {points} p JOIN fx_edge e
  ON (e.y1 > p.lat) <> (e.y2 > p.lat) AND p.long < (e.x2 - e.x1) * (p.lat - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1
WHERE {where} GROUP BY p.{key}, e.location_id HAVING count(*) % 2 = 1"""


LOCATED = {
    **OVERLAID,
    "numbered": "SELECT *, row_number() OVER () AS rk FROM overlaid",
    "hits": in_polygon("numbered", "rk", "p.valid_location"),
    "located": """
SELECT n.* EXCLUDE (rk, rn_x), l.location_id, l.neighborhood_name, l.city, 'SPATIAL' AS resolution_method
FROM (SELECT *, 1 AS rn_x FROM numbered) n JOIN hits h ON n.rk = h.k JOIN fx_location l ON l.location_id = h.location_id""",
}
LOCATED_NEEDS = [*OVERLAY_NEEDS, "fx_location", "fx_edge"]

# --- stores -------------------------------------------------------------------
_type = "upper(trim(store_type))"
_types: dict[str, list[str]] = {}
for _raw, _label in K.STORE_TYPES.items():
    _types.setdefault(_label, []).append(_raw)
CLEAN_STORE = {
    "store_typed": f"""
SELECT try_cast(s.objectid AS INTEGER) AS objectid, upper(trim(coname)) AS store_name, upper(trim(staddr)) AS street_address,
  upper(trim(stcity)) AS city, CASE WHEN regexp_matches(trim(zip), '^[0-9]{{5}}$') AND trim(zip) <> '00000' THEN trim(zip) ELSE 'UNKNOWN' END AS zip_code,
  {case([(f"{_type} IN ({quoted(r)})", f"'{t}'") for t, r in _types.items()], "'OTHER'")} AS store_type,
  try_cast(year AS INTEGER) AS data_year, coalesce(g.lat, -999.0) AS lat, coalesce(g.long, -999.0) AS long,
  g.lat IS NOT NULL AS has_valid_location
FROM fx_store s JOIN fx_store_geocode g ON try_cast(s.objectid AS INTEGER) = g.objectid AND g.geocode_status = 'GEOCODED'
WHERE s.objectid IS NOT NULL""",
    "store_single": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY store_name, street_address, city, zip_code, data_year ORDER BY objectid) AS rn
FROM store_typed) WHERE rn = 1""",
    "clean_store": f"""
SELECT * , {case([(f"store_type = '{t}'", f"'{c}'") for t, c in K.STORE_CATEGORIES.items()], "'Other Retail'")} AS naics_category,
  {', '.join(f"store_type IN ({quoted(v)}) AS {k}" for k, v in K.STORE_FLAGS.items())},
  CASE WHEN data_year = 2021 THEN '2021 Survey' WHEN data_year = 2017 THEN '2017 Survey' ELSE 'UNKNOWN' END AS data_vintage,
  zip_code <> 'UNKNOWN' AS is_zip_valid
FROM store_single""",
}
STORE_NEEDS = ["fx_store", "fx_store_geocode"]
LOCATED_STORE = {
    **CLEAN_STORE,
    "store_hits": in_polygon("clean_store", "objectid", "p.has_valid_location"),
    "located_store": """
SELECT s.* EXCLUDE (city), l.location_id, coalesce(l.neighborhood_name, s.city) AS neighborhood_name, coalesce(l.city, s.city) AS city,
  CASE WHEN l.location_id IS NOT NULL THEN 'SPATIAL' ELSE 'CITY' END AS resolution_method
FROM clean_store s LEFT JOIN store_hits h ON s.objectid = h.k LEFT JOIN fx_location l ON l.location_id = h.location_id
WHERE s.objectid IS NOT NULL AND s.has_valid_location""",
    "newest_store": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY upper(trim(store_name)), upper(trim(street_address)), neighborhood_name
ORDER BY data_year DESC NULLS LAST, objectid) AS rn FROM located_store WHERE neighborhood_name IS NOT NULL) WHERE rn = 1""",
}
LOCATED_STORE_NEEDS = [*STORE_NEEDS, "fx_location", "fx_edge"]

# --- facilities ---------------------------------------------------------------
_kind = "trim(facility_type)"


def _count(col: str) -> str:
    return (
        f"coalesce(CASE WHEN upper(trim({col})) NOT IN ({quoted(K.COUNT_NULL_TOKENS)}) THEN try_cast(trim({col}) AS INTEGER) END, -99)"
    )


def _digits(col: str) -> str:
    return f"regexp_replace(coalesce({col}, ''), '[^0-9]', '', 'g')"


CLEAN_FACILITY_COLS = f"""
  facility_id, {squeezed('facility_name')} AS facility_name, {clean('facility_type')} AS facility_type,
  {case([(f"coalesce({_kind}, '') = ''", "'UNKNOWN'")] + [(ilike_any(_kind, p), f"'{v}'") for p, v in K.FACILITY_CANONICAL], f"upper({_kind})")} AS facility_type_canonical,
  {case([(ilike_any(_kind, p), f"'{v}'") for p, v in K.FACILITY_GROUPS], "'OTHER'")} AS facility_type_group,
  {squeezed('street')} AS street, {squeezed('city')} AS city,
  lpad({_digits('zip_code')}, 5, '0') AS zip_code,
  coalesce(nullif({_digits('telephone')}, ''), 'UNKNOWN') AS phone, length({_digits('telephone')}) >= 10 AS has_valid_phone,
  {_count('bed_count')} AS bed_count, {_count('adult_day_health_capacity')} AS adult_day_health_capacity,
  upper(trim(coalesce(city, ''))) IN ({quoted(K.METRO_AREA_NAMES)}) AS is_boston_area,
  {', '.join(f"coalesce({ilike_any(_kind, p)}, FALSE) AS {n}" for n, p in K.FACILITY_FLAGS.items())}"""
CLEAN_FACILITY = {
    "clean_facility": f"SELECT {CLEAN_FACILITY_COLS}, location_id FROM fx_facility WHERE facility_id IS NOT NULL"
}
GEO_FACILITY = {
    "raw_facility": """
SELECT f.* EXCLUDE (location_id), coalesce(g.lat, -999.0) AS lat, coalesce(g.long, -999.0) AS long,
  g.lat IS NOT NULL AND g.long IS NOT NULL AS has_valid_location
FROM fx_facility f JOIN fx_facility_geocode g ON f.facility_id = g.facility_id AND g.geocode_status = 'GEOCODED'""",
    "geo_facility": f"SELECT {CLEAN_FACILITY_COLS}, lat, long, has_valid_location FROM raw_facility",
    "facility_hits": in_polygon("geo_facility", "facility_id", "p.has_valid_location"),
    "located_facility": """
SELECT f.*, coalesce(s.location_id, c.location_id) AS location_id,
  coalesce(s.neighborhood_name, c.neighborhood_name, f.city) AS neighborhood_name, coalesce(s.city, c.city, f.city) AS city_name,
  CASE WHEN s.location_id IS NOT NULL THEN 'SPATIAL' WHEN c.location_id IS NOT NULL THEN 'CITY_MASTER' ELSE 'CITY' END AS resolution_method
FROM geo_facility f LEFT JOIN facility_hits h ON f.facility_id = h.k LEFT JOIN fx_location s ON s.location_id = h.location_id
LEFT JOIN fx_location c ON upper(c.granularity) = 'CITY' AND upper(trim(f.city)) = upper(trim(c.city))""",
}
GEO_FACILITY_NEEDS = ["fx_facility", "fx_facility_geocode", "fx_location", "fx_edge"]
