"""Descriptions, prompts, reports and web pages."""

from pyspark.sql import functions as F

from catalog import query
from catalog.pagesql import MARKDOWN, PAGES
from catalog.clusters import FINE, GROCERY_PROFILE, binned, dbscan_ctes, grocery_profile, labels
from catalog.places import ADJACENT, geo_facilities, located_incidents, located_stores
from catalog.scores import HEALTH, HEALTH_NEEDS, health_profile
from catalog.series import NEEDS as SERIES_NEEDS
from catalog.series import SNAIVE, YOY, series
from catalog.sqltext import (
    GEO_FACILITY, GEO_FACILITY_NEEDS, LOCATED, LOCATED_NEEDS, LOCATED_STORE, LOCATED_STORE_NEEDS, fill,
)
from placestats import constants as K
from placestats.fixtures import Tables
from placestats.functions.text import rewrite_counts
from placestats.operators.cluster import bin_clusters, cluster_stats
from placestats.operators.forecast import forecast
from placestats.operators.narrative import (
    describe_incident, parse_code_names, prompt_context, rows_as_csv, text_report,
)
from placestats.operators.pages import extract_headings, pages_to_markdown
from placestats.plans import board, crime, grocery, healthcare


def flags_sql(flags) -> str:
    return " || ".join(f"CASE WHEN {c} THEN '{s}' ELSE '' END" for c, s in flags)


_month = "CASE month " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(K.MONTH_NAMES, 1)) + " ELSE 'UNKNOWN' END"
_incident_text = (
    f"{fill(K.INCIDENT_TEXT, offense_lower='lower(offense_description)')} || "
    f"CASE WHEN street IS NOT NULL AND street <> 'N/A' THEN {fill(K.INCIDENT_STREET)} ELSE '' END || "
    f"{fill(K.INCIDENT_WHEN, month_name=_month)} || {flags_sql(K.INCIDENT_FLAGS)}"
)
_store_text = (
    f"{fill(K.STORE_TEXT, type_words=chr(32).join(['lower(replace(store_type,', repr('_'), ',', repr(' '), '))']))} || "
    f"{flags_sql(K.STORE_FLAG_TEXT)} || {fill(K.STORE_SOURCE)}"
)


def _known(col: str, template: str) -> str:
    return f"CASE WHEN {col} IS NOT NULL AND {col} <> -99 THEN {fill(template)} ELSE '' END"


_facility_text = (
    fill(
        K.FACILITY_TEXT, type_words="lower(coalesce(facility_type, 'healthcare facility'))",
        area_words="coalesce(neighborhood_name, 'an unknown neighborhood')", city_words="coalesce(city_name, city, 'Boston')",
    )
    + f" || CASE WHEN facility_type_group IS NOT NULL THEN {fill(K.FACILITY_GROUP_TEXT, group_words='lower(facility_type_group)')} ELSE '' END || "
    + f"{_known('bed_count', K.FACILITY_BEDS)} || {_known('adult_day_health_capacity', K.FACILITY_CAPACITY)} || {flags_sql(K.FACILITY_FLAG_TEXT)}"
)


@query("describe_incident", f"SELECT load_seq, location_id, {_incident_text} AS row_description FROM located", LOCATED_NEEDS, LOCATED)
def _(t):
    return describe_incident(located_incidents(t)).select("load_seq", "location_id", "row_description")


@query("describe_store", f"SELECT objectid, {_store_text} AS row_description FROM located_store", LOCATED_STORE_NEEDS, LOCATED_STORE)
def _(t):
    return located_stores(t).select("objectid", "row_description")


@query(
    "describe_facility",
    f"SELECT facility_id, location_id, {_facility_text} AS row_description FROM located_facility",
    GEO_FACILITY_NEEDS,
    GEO_FACILITY,
)
def _(t):
    return healthcare.facility_mart(geo_facilities(t), t.polygons).select("facility_id", "location_id", "row_description")


# --- narratives ------------------------------------------------------------------
_FINE = dbscan_ctes("f_", "fx_cluster_point", ["location_id"], "id", *FINE)
CRIME_STORY = {
    **SNAIVE, **YOY, **_FINE,
    "hot": """SELECT location_id, count(DISTINCT cluster_id) FILTER (cluster_id >= 0) AS n_hotspot_clusters,
round_even(100.0::DOUBLE - count(*) FILTER (is_noise)::DOUBLE / count(*) * 100, 1) AS hotspot_crime_share_pct FROM f_label GROUP BY location_id""",
    "told": """SELECT l.neighborhood_name, y.recent_trend, y.recent_avg, y.prev_year_avg, y.n_months, y.total, s.forecast_month, s.forecasted_count,
m.train_mape, h.n_hotspot_clusters, h.hotspot_crime_share_pct
FROM yoy y JOIN fx_location l ON y.location_id = l.location_id JOIN snaive s ON s.location_id = y.location_id AND s.step = 1
LEFT JOIN mape m ON m.location_id = y.location_id LEFT JOIN hot h ON h.location_id = y.location_id WHERE y.n_months >= 3""",
    "story": f"""SELECT *, {fill(K.CRIME_FALLBACK)} AS safety_narrative, round_even(recent_avg, 1) AS recent_avg_monthly,
CASE WHEN train_mape > 50 OR n_months < 12 OR total < 500 THEN 'LOW' ELSE 'HIGH' END AS reliability_flag FROM told""",
}
CRIME_STORY_NEEDS = [*SERIES_NEEDS, "fx_cluster_point", "fx_location"]
_crime_prompt = fill(
    K.CRIME_PROMPT,
    recent_avg_text="printf('%.0f', round_even(recent_avg, 0))",
    prev_avg_text="printf('%.0f', round_even(prev_year_avg, 0))",
    mape_text="coalesce(CAST(train_mape AS VARCHAR), 'None')",
    clusters_text="coalesce(CAST(n_hotspot_clusters AS VARCHAR), 'unknown')",
    share_text="coalesce(CAST(hotspot_crime_share_pct AS VARCHAR), 'unknown')",
)


def crime_story(t: Tables):
    """Narratives per area: order counts as the series, customer points as the clusters."""
    names = t.fx_location.select("location_id", "neighborhood_name")
    past = series(t).join(names, "location_id").select("neighborhood_name", "month", "y")
    ahead = forecast(past, "neighborhood_name", model="snaive")
    hot = cluster_stats(labels(t, FINE), "location_id").join(names, "location_id").select(
        "neighborhood_name", F.col("n_clusters").alias("n_hotspot_clusters"), F.col("clustered_pct").alias("hotspot_crime_share_pct")
    )
    return crime.narratives(past, ahead, hot), hot


@query(
    "crime_narratives",
    f"""SELECT neighborhood_name, recent_trend, recent_avg_monthly, forecast_month, forecasted_count, train_mape, n_hotspot_clusters,
        safety_narrative, reliability_flag, {_crime_prompt} AS prompt FROM story""",
    CRIME_STORY_NEEDS,
    CRIME_STORY,
)
def _(t):
    return crime_story(t)[0]


_grocery_prompt = fill(
    K.GROCERY_PROMPT, data_year_text="coalesce(CAST(data_year AS VARCHAR), 'unknown')", tier_label="lower(replace(access_tier, '_', ' '))"
)
GROCERY_STORY = {
    **GROCERY_PROFILE,
    "year_of": "SELECT neighborhood_name, max(data_year) AS data_year FROM newest_store GROUP BY neighborhood_name",
    "grocery_row": "SELECT p.*, y.data_year FROM grocery_profile p LEFT JOIN year_of y ON p.neighborhood_name = y.neighborhood_name",
}


@query(
    "grocery_narratives",
    f"""SELECT neighborhood_name, city, access_tier, total_stores, essential_store_count, essential_store_pct, n_store_clusters, data_year,
        {fill(K.GROCERY_FALLBACK, tier_label="lower(replace(access_tier, '_', ' '))")} AS food_access_narrative,
        CASE WHEN total_stores < 5 THEN 'LOW' ELSE 'HIGH' END AS reliability_flag, {_grocery_prompt} AS prompt FROM grocery_row""",
    LOCATED_STORE_NEEDS,
    GROCERY_STORY,
)
def _(t):
    stores = grocery.newest_stores(located_stores(t))
    return grocery.narratives(grocery_profile(t), stores)


HEALTH_STORY = {
    **HEALTH,
    "health_bin": """
SELECT f.location_id, round(CAST(p.lat AS DECIMAL(28,12)), 2) AS la, round(CAST(p.long AS DECIMAL(28,12)), 2) AS lo, count(*) AS n
FROM fx_facility f JOIN fx_cluster_point p ON f.facility_id = p.id WHERE f.location_id IS NOT NULL GROUP BY 1, 2, 3""",
    "health_hot": """
SELECT location_id, count(*) FILTER (n >= 2) AS n_healthcare_clusters, round(coalesce(sum(n) FILTER (n >= 2), 0) * 100.0::DOUBLE / sum(n), 1) AS clustered_facility_share_pct,
  round(coalesce(sum(n) FILTER (n = 1), 0) * 100.0::DOUBLE / sum(n), 1) AS isolated_facility_pct FROM health_bin GROUP BY location_id""",
    "health_row": """
SELECT p.*, coalesce(h.n_healthcare_clusters, 0) AS n_healthcare_clusters, coalesce(h.clustered_facility_share_pct, 0) AS clustered_facility_share_pct,
  coalesce(h.isolated_facility_pct, 0) AS isolated_facility_pct FROM health_profile p LEFT JOIN health_hot h ON p.location_id = h.location_id""",
}
HEALTH_STORY_NEEDS = [*HEALTH_NEEDS, "fx_cluster_point"]


def health_clusters(t: Tables):
    rows = bin_clusters(binned(t), ["location_id"])
    return rows.select(
        "location_id", F.col("n_clusters").alias("n_healthcare_clusters"),
        F.col("clustered_pct").alias("clustered_facility_share_pct"), F.col("isolated_pct").alias("isolated_facility_pct"),
    )


@query(
    "healthcare_prompts",
    f"""SELECT location_id, neighborhood_name, healthcare_score, n_healthcare_clusters, clustered_facility_share_pct, isolated_facility_pct,
        {fill(K.HEALTHCARE_PROMPT)} AS prompt FROM health_row""",
    HEALTH_STORY_NEEDS,
    HEALTH_STORY,
)
def _(t):
    out = healthcare.narratives(health_profile(t), health_clusters(t))
    return out.select(
        "location_id", "neighborhood_name", "healthcare_score", "n_healthcare_clusters", "clustered_facility_share_pct",
        "isolated_facility_pct", "prompt",
    )


# --- reports -----------------------------------------------------------------------
_facts = fill(
    K.CONTEXT_FACTS,
    avg_text="printf('%.0f', round_even(recent_avg_monthly, 0))",
    mape_text="coalesce(printf('%.1f', round_even(train_mape, 1)), 'N/A')",
    reliability_text="coalesce(reliability_flag, 'N/A')",
    summary_text="coalesce(safety_narrative, 'N/A')",
)


@query(
    "prompt_context",
    f"""SELECT substr(string_agg({fill(K.CONTEXT_HEAD)} || {_facts}, chr(10) || chr(10) ORDER BY neighborhood_name), 1, 10000) AS report FROM story""",
    CRIME_STORY_NEEDS,
    CRIME_STORY,
)
def _(t):
    return prompt_context(crime_story(t)[0])


_SELECTED = "NATION_12"


@query(
    "prompt_context_selected",
    f"""SELECT substr(string_agg({fill(K.CONTEXT_HEAD_TAGGED, tag="CASE WHEN neighborhood_name = '%s' THEN '%s' ELSE '%s' END" % (_SELECTED, K.CONTEXT_SELECTED, K.CONTEXT_ADJACENT))}
        || {_facts}, chr(10) || chr(10) ORDER BY neighborhood_name) || {fill(K.CONTEXT_TAIL, selected=repr(_SELECTED), neighbours="(SELECT string_agg(b, ', ' ORDER BY b) FROM adjacent_name WHERE a = '%s')" % _SELECTED)}, 1, 10000) AS report
        FROM story WHERE neighborhood_name = '{_SELECTED}' OR neighborhood_name IN (SELECT b FROM adjacent_name WHERE a = '{_SELECTED}')""",
    [*CRIME_STORY_NEEDS, "fx_edge"],
    {**CRIME_STORY, **ADJACENT},
)
def _(t):
    pairs = board.adjacency_pairs(t.polygons)
    return prompt_context(crime_story(t)[0], _SELECTED, pairs)


@query(
    "area_report",
    """SELECT city, string_agg(neighborhood_name || ': ' || CAST(total_facilities AS VARCHAR) || ' facilities', chr(10) ORDER BY neighborhood_name) AS report
       FROM health_profile GROUP BY city""",
    HEALTH_NEEDS,
    HEALTH,
)
def _(t):
    line = F.concat(F.col("neighborhood_name"), F.lit(": "), F.col("total_facilities").cast("string"), F.lit(" facilities"))
    return text_report(health_profile(t), line, ["neighborhood_name"], sep="\n", by=["city"])


@query(
    "rows_as_csv",
    """SELECT 'neighborhood_name,city,total_facilities,healthcare_score' || chr(10) || string_agg(
         neighborhood_name || ',' || city || ',' || CAST(total_facilities AS VARCHAR) || ',' || CAST(healthcare_score AS VARCHAR), chr(10)
         ORDER BY healthcare_score DESC, neighborhood_name) || chr(10) AS csv
       FROM (SELECT * FROM health_profile ORDER BY healthcare_score DESC, neighborhood_name LIMIT 20)""",
    HEALTH_NEEDS,
    HEALTH,
)
def _(t):
    cols = ["neighborhood_name", "city", "total_facilities", "healthcare_score"]
    order = [F.col("healthcare_score").desc_nulls_last(), F.col("neighborhood_name").asc_nulls_last()]
    return rows_as_csv(health_profile(t), cols, 20, order)


@query(
    "rewrite_counts",
    r"""SELECT c_custkey, regexp_replace(regexp_replace(
          'Area ' || CAST(c_custkey AS VARCHAR) || ' has ' || CAST(c_custkey % 30 AS VARCHAR) || CASE c_custkey % 3 WHEN 0 THEN ' dense crime Clusters' WHEN 1 THEN ' hotspot' ELSE ' very dense hotspots' END
            || ' and 41.' || CAST(c_custkey % 10 AS VARCHAR) || '% of all reported crimes happen there.',
          '\d+\s+(?:[A-Za-z\-]+\s+){0,4}(?:clusters?|hotspots?)', CAST(c_custkey % 4 AS VARCHAR) || ' hotspot cluster' || CASE WHEN c_custkey % 4 = 1 THEN '' ELSE 's' END, 'gi'),
          '[\d.]+%\s+of\s+(?:[A-Za-z\-]+\s+){0,3}crimes\s+\w+', CAST((c_custkey % 100) / 2.0::DOUBLE AS VARCHAR) || '% of crimes occur', 'gi') AS narrative
        FROM customer""",
)
def _(t):
    key = F.col("c_custkey")
    words = F.when(key % 3 == 0, F.lit(" dense crime Clusters")).when(key % 3 == 1, F.lit(" hotspot")).otherwise(F.lit(" very dense hotspots"))
    text = F.concat(
        F.lit("Area "), key.cast("string"), F.lit(" has "), (key % 30).cast("string"), words, F.lit(" and 41."),
        (key % 10).cast("string"), F.lit("% of all reported crimes happen there."),
    )
    return t.customer.select("c_custkey", rewrite_counts(text, key % 4, (key % 100) / F.lit(2.0)).alias("narrative"))


# --- headings and pages ----------------------------------------------------------------
@query(
    "parse_code_names",
    r"""SELECT code, name FROM (SELECT code, name, row_number() OVER (PARTITION BY code ORDER BY pos, i) AS rn FROM (
         SELECT pos, i, trim(codes[i]) AS code, coalesce(CASE WHEN i <= len(names) THEN trim(names[i]) END, whole) AS name
         FROM (SELECT pos, codes, names, whole, unnest(range(1, len(codes) + 1)) AS i FROM (
           SELECT pos, string_split(trim(split_part(text, '(', 1)), '&') AS codes, string_split(upper(trim(replace(split_part(text, '(', 2), ')', ''))), '&') AS names,
             upper(trim(replace(split_part(text, '(', 2), ')', ''))) AS whole FROM fx_heading WHERE text LIKE '%(%' AND text LIKE '%)%')))
       WHERE code <> '') WHERE rn = 1""",
    ["fx_heading"],
)
def _(t):
    return parse_code_names(t.fx_heading)


@query(
    "extract_headings",
    r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, text FROM (SELECT page_id, unnest(range(1, len(h) + 1)) AS i,
         replace(replace(replace(replace(replace(replace(trim(regexp_replace(unnest(h), '<[^>]*>', '', 'g')), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS text
       FROM (SELECT page_id, regexp_extract_all(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1) AS h FROM pages)) WHERE text <> ''""",
)
def _(t):
    return extract_headings(t.pages, "h1")


@query("pages_markdown", MARKDOWN, [], PAGES)
def _(t):
    return pages_to_markdown(t.pages).select("page_id", "url", "markdown")
