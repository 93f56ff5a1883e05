"""Dashboard cards, scorecards, top and bottom lists, and listings of the incident tables."""

from pyspark.sql import functions as F

from catalog import query
from catalog.analysis import ANALYSIS, analysis
from catalog.clusters import GROCERY_PROFILE, grocery_profile
from catalog.scores import health_profile
from catalog.sqltext import LOCATED_NEEDS, LOCATED_STORE_NEEDS
from catalog.texts import HEALTH_STORY, HEALTH_STORY_NEEDS, health_clusters
from placestats.fixtures import Tables
from placestats.operators.aggregates import kpis
from placestats.operators.joins import left_fill
from placestats.operators.ranking import top_k
from placestats.plans import board


def health_rows(t: Tables):
    zero = {"n_healthcare_clusters": 0, "clustered_facility_share_pct": 0.0, "isolated_facility_pct": 0.0}
    return left_fill(health_profile(t), health_clusters(t), "location_id", zero)


HEALTH_CARD = [
    "neighborhood_name", "city", "total_facilities", "hospital_count", "clinic_count", "facilities_per_sqmile", "pct_core_care", "pct_valid_phone",
    "healthcare_score", "healthcare_grade", "n_healthcare_clusters", "clustered_facility_share_pct",
]
BEST = [("healthcare_score", "desc"), ("total_facilities", "desc"), ("neighborhood_name", "asc")]
WORST = [("healthcare_score", "asc"), ("total_facilities", "desc"), ("neighborhood_name", "asc")]
DENSEST = [("n_healthcare_clusters", "desc"), ("clustered_facility_share_pct", "desc"), ("neighborhood_name", "asc")]
SUPPLIED = [("essential_store_count", "desc"), ("neighborhood_name", "asc")]
LEAST_SUPPLIED = [("essential_store_count", "asc"), ("neighborhood_name", "asc")]


def ordered(keys) -> str:
    return ", ".join(f"{c} {d} NULLS LAST" for c, d in keys)


@query("health_scorecard", f"SELECT {', '.join(HEALTH_CARD)} FROM health_row", HEALTH_STORY_NEEDS, HEALTH_STORY)
def _(t):
    return board.listing(health_rows(t).select(*HEALTH_CARD), *BEST)


_HEALTH_SHORT = ["neighborhood_name", "healthcare_score", "healthcare_grade", "total_facilities"]
for _name, _k, _keys in (("health_top", 12, BEST), ("health_top_five", 5, BEST), ("health_bottom", 3, WORST), ("health_bottom_five", 5, WORST)):

    @query(_name, f"SELECT {', '.join(_HEALTH_SHORT)} FROM health_row ORDER BY {ordered(_keys)} LIMIT {_k}", HEALTH_STORY_NEEDS, HEALTH_STORY)
    def _(t, k=_k, keys=_keys):
        return top_k(health_rows(t).select(*_HEALTH_SHORT), k, *keys)


@query(
    "health_densest",
    f"SELECT neighborhood_name, n_healthcare_clusters, clustered_facility_share_pct, healthcare_score FROM health_row ORDER BY {ordered(DENSEST)} LIMIT 12",
    HEALTH_STORY_NEEDS,
    HEALTH_STORY,
)
def _(t):
    return top_k(health_rows(t), 12, *DENSEST).select("neighborhood_name", "n_healthcare_clusters", "clustered_facility_share_pct", "healthcare_score")


@query(
    "health_cards",
    """SELECT round_even(avg(healthcare_score), 1) AS avg_score, CAST(sum(total_facilities) AS BIGINT) AS facilities, round_even(avg(facilities_per_sqmile), 1) AS avg_density,
       CAST(sum(hospital_count) AS BIGINT) AS hospitals FROM health_row""",
    HEALTH_STORY_NEEDS,
    HEALTH_STORY,
)
def _(t):
    return kpis(health_rows(t), {
        "avg_score": F.bround(F.avg("healthcare_score"), 1), "facilities": F.sum("total_facilities"),
        "avg_density": F.bround(F.avg("facilities_per_sqmile"), 1), "hospitals": F.sum("hospital_count"),
    })


GROCERY_CARD = [
    "neighborhood_name", "city", "total_stores", "essential_store_count", "essential_store_pct", "supermarket_count", "convenience_store_count",
    "specialty_store_count", "n_store_clusters", "access_tier",
]


@query("grocery_scorecard", f"SELECT {', '.join(GROCERY_CARD)} FROM grocery_profile", LOCATED_STORE_NEEDS, GROCERY_PROFILE)
def _(t):
    return board.listing(grocery_profile(t).select(*GROCERY_CARD), *SUPPLIED)


for _name, _keys in (("grocery_top_five", SUPPLIED), ("grocery_bottom_five", LEAST_SUPPLIED)):

    @query(_name, f"SELECT neighborhood_name, essential_store_count, access_tier FROM grocery_profile ORDER BY {ordered(_keys)} LIMIT 5", LOCATED_STORE_NEEDS, GROCERY_PROFILE)
    def _(t, keys=_keys):
        return top_k(grocery_profile(t).select("neighborhood_name", "essential_store_count", "access_tier"), 5, *keys)


@query(
    "grocery_cards",
    """SELECT count(DISTINCT neighborhood_name) AS areas, CAST(sum(total_stores) AS BIGINT) AS stores, count(*) FILTER (access_tier = 'LOW_ACCESS') AS low_access,
       round_even(avg(essential_store_pct), 1) AS avg_essential_pct FROM grocery_profile""",
    LOCATED_STORE_NEEDS,
    GROCERY_PROFILE,
)
def _(t):
    return kpis(grocery_profile(t), {
        "areas": F.count_distinct("neighborhood_name"), "stores": F.sum("total_stores"), "low_access": F.count_if(F.col("access_tier") == "LOW_ACCESS"),
        "avg_essential_pct": F.bround(F.avg("essential_store_pct"), 1),
    })


# --- listings of the three incident tables, whole, in the order of the page -----
@query(
    "forecast_listing",
    "SELECT neighborhood_name, forecast_month, forecasted_count FROM an_forecast",
    LOCATED_NEEDS,
    ANALYSIS,
)
def _(t):
    rows = analysis(t, "forecast").select("neighborhood_name", "forecast_month", "forecasted_count")
    return board.listing(rows, ("neighborhood_name", "asc"), ("forecast_month", "asc"))


@query(
    "hotspot_listing",
    "SELECT * FROM an_clusters",
    LOCATED_NEEDS,
    ANALYSIS,
)
def _(t):
    return board.listing(analysis(t, "clusters"), ("hotspot_crime_share_pct", "desc"), ("neighborhood_name", "asc"))


@query(
    "trend_listing",
    """SELECT y.neighborhood_name, recent_trend, round_even(recent_avg, 1) AS recent_avg FROM an_trend y""",
    LOCATED_NEEDS,
    ANALYSIS,
)
def _(t):
    from placestats.operators.series import yoy_recent

    rows = yoy_recent(analysis(t, "series"), "neighborhood_name").where("n_months >= 3")
    rows = rows.select("neighborhood_name", "recent_trend", F.bround("recent_avg", 1).alias("recent_avg"))
    return board.listing(rows, ("neighborhood_name", "asc"))
