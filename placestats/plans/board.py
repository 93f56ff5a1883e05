"""Dashboard queries, one function each. Only results of bounded size are sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats import constants as K
from placestats.functions.geometry import geom_to_geojson
from placestats.functions.rules import color_of, direction, grade, reversal
from placestats.functions.text import humanize
from placestats.operators import spatial
from placestats.operators.aggregates import collect_sorted, count_by, distribution, kpis
from placestats.operators.filters import complete_months, since_year, trailing_months
from placestats.operators.joins import left_fill, match_exact, neighbours_of
from placestats.operators.ranking import bottom_k, dedupe, order_by, top_k
from placestats.operators.series import monthly_counts
from placestats.plans.grocery import newest_stores

__all__ = ["bottom_k", "distribution", "kpis", "neighbours_of", "top_k"]


def listing(df: DataFrame, *keys: tuple[str, str]) -> DataFrame:
    return order_by(df, *keys)


def located(mart: DataFrame) -> DataFrame:
    return mart.where(F.col("valid_location") & F.col("neighborhood_name").isNotNull())


def monthly_history(mart: DataFrame, since: int = 2023, as_of: str | None = None) -> DataFrame:
    """Incidents per area and complete month."""
    ts = "occurred_on_date"
    rows = complete_months(since_year(located(mart), ts, since), ts, as_of)
    return monthly_counts(rows, "neighborhood_name", ts)


def boundary(polygons: DataFrame, name: str) -> DataFrame:
    chosen = polygons.where(F.col("neighborhood_name") == name)
    return spatial.boundary_points(chosen).orderBy("pos")


def points_with_street(points: DataFrame, incidents: DataFrame, name: str | None = None) -> DataFrame:
    """Cluster points with the street of the newest incident at the same place and day.

    One row per place and day. Incidents are reduced to that key before the join, so
    places with many incidents on a day do not multiply.
    """
    rows = points if name is None else points.where(F.col("neighborhood_name") == name)
    day = F.date_format("occurred_on_date", "yyyy-MM-dd")
    # the newest load that has a street row; ties by street keep the result stable
    newest = incidents.withColumn("_day", day).groupBy("lat", "long", F.col("_day").alias("crime_date")).agg(
        F.max(F.struct("load_seq", "street")).alias("_m")
    ).select("lat", "long", "crime_date", F.col("_m.street").alias("street"))
    single = dedupe(rows, ["lat", "long", "crime_date"], [F.col("cluster_id").asc_nulls_last(), F.col("is_noise").asc_nulls_last()])
    return match_exact(single, newest, ["lat", "long", "crime_date"], ["street"])


def offense_breakdown(mart: DataFrame, name: str | None = None, as_of: str | None = None, k: int = 5) -> DataFrame:
    """Top offences among violent and property crimes of the year that ends at `as_of`, today without one."""
    rows = located(trailing_months(mart, "occurred_on_date", 12, as_of, anchor="now"))
    if name is not None:
        rows = rows.where(F.col("neighborhood_name") == name)
    rows = rows.where(F.col("is_violent_crime") | F.col("is_property_crime"))
    category = F.when(F.col("is_violent_crime"), F.lit("Violent")).when(F.col("is_property_crime"), F.lit("Property"))
    counted = count_by(rows, ["offense_description", category.alias("crime_category")], "crime_count")
    return top_k(counted, k, ("crime_count", "desc"), ("offense_description", "asc"), ("crime_category", "asc"))


def safety_map(locations: DataFrame, safety: DataFrame, cities: Sequence[str], granularity: str = "NEIGHBORHOOD") -> DataFrame:
    """Map rows of scored areas with geometry."""
    areas = locations.where(
        F.col("city").isin(list(cities)) & (F.col("granularity") == granularity)
        & F.col("geometry").isNotNull() & F.col("centroid_lat").isNotNull()
    )
    scored = safety.where(~F.col("insufficient_data") & (F.col("safety_grade") != "INSUFFICIENT DATA"))
    side = scored.select(F.upper("neighborhood_name").alias("_k"), "safety_score", "safety_grade", "avg_monthly_incidents")
    joined = areas.join(side, F.upper("neighborhood_name") == F.col("_k"))
    return joined.select(
        "neighborhood_name", "centroid_lat", "centroid_long", geom_to_geojson(F.col("geometry")).alias("geojson"),
        "safety_score", "safety_grade", "avg_monthly_incidents",
        color_of(F.upper(F.trim("safety_grade")), K.SAFETY_COLORS, K.SAFETY_COLOR_OTHER).alias("fill_color"),
    )


def adjacency_pairs(locations: DataFrame, in_scope: Column | None = None) -> DataFrame:
    """Adjacent names (a, b) among the areas in scope."""
    scope = locations if in_scope is None else locations.where(in_scope)
    pairs = spatial.adjacency(scope)
    names = scope.select("location_id", "neighborhood_name")
    left = names.select(F.col("location_id").alias("a"), F.col("neighborhood_name").alias("_a"))
    right = names.select(F.col("location_id").alias("b"), F.col("neighborhood_name").alias("_b"))
    return pairs.join(left, "a").join(right, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def adjacency_lists(pairs: DataFrame) -> DataFrame:
    return collect_sorted(pairs, "a", "b", "neighbours")


def grocery_map(profile: DataFrame, locations: DataFrame) -> DataFrame:
    """Profile rows with the centroid and geometry of their area; areas without are left out."""
    areas = locations.where(F.col("geometry").isNotNull() & F.col("centroid_lat").isNotNull())
    side = areas.select(
        F.upper("neighborhood_name").alias("_k"), "location_id", "centroid_lat", "centroid_long", "geometry"
    )
    return profile.join(side, F.upper("neighborhood_name") == F.col("_k")).drop("_k")


def grocery_board(profile: DataFrame) -> DataFrame:
    """Profile with tier label and colour, best supplied areas first."""
    tier = F.col("access_tier")
    return order_by(
        profile.withColumns(
            {
                "tier_label": F.coalesce(humanize(tier, "title"), F.lit("Unknown")),
                "fill_color": color_of(tier, K.TIER_COLORS, K.TIER_COLOR_OTHER),
            }
        ),
        ("essential_store_count", "desc"),
        ("neighborhood_name", "asc"),
    )


def store_list(mart: DataFrame) -> DataFrame:
    return order_by(newest_stores(mart), ("neighborhood_name", "asc"), ("store_type", "asc"), ("objectid", "asc"))


def healthcare_table(profile: DataFrame, clusters: DataFrame, narratives: DataFrame) -> DataFrame:
    """Scores, components, hotspot figures and text per area, joined by name."""
    rows = left_fill(
        profile, clusters, "neighborhood_name", {"n_healthcare_clusters": 0, "clustered_facility_share_pct": 0.0}, norm=True
    )
    rows = left_fill(rows, narratives, "neighborhood_name", {"healthcare_narrative": None}, norm=True)
    return order_by(rows, ("healthcare_score", "desc"), ("neighborhood_name", "asc"))


def score_color(score: Column) -> Column:
    arrays = [(t, F.array(*[F.lit(v) for v in rgba])) for t, rgba in K.HEALTH_SCORE_COLORS]
    return grade(score, arrays, F.array(*[F.lit(v) for v in K.HEALTH_SCORE_COLOR_LOW]))


def healthcare_map(profile: DataFrame, clusters: DataFrame, locations: DataFrame) -> DataFrame:
    rows = left_fill(
        profile, clusters, "location_id", {"n_healthcare_clusters": 0, "clustered_facility_share_pct": 0.0}
    )
    areas = locations.where(
        F.col("geometry").isNotNull() & F.col("centroid_lat").isNotNull() & F.col("centroid_long").isNotNull()
    ).select("location_id", "centroid_lat", "centroid_long", "geometry")
    return rows.join(areas, "location_id").withColumn("fill_color", score_color(F.col("healthcare_score")))


def forecast_board(narratives: DataFrame, clusters: DataFrame, trends: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Narrative rows of the chosen trends and reliabilities with hotspot figures and outlook."""
    rows = narratives.where(F.col("recent_trend").isin(list(trends)) & F.col("reliability_flag").isin(list(flags)))
    rows = rows.drop("n_hotspot_clusters", "hotspot_crime_share_pct")
    rows = left_fill(rows, clusters, "neighborhood_name", {"n_hotspot_clusters": None, "hotspot_crime_share_pct": None})
    heading = direction(F.col("forecasted_count"), F.col("recent_avg_monthly"))
    rows = rows.withColumn("outlook", heading)
    rows = rows.withColumn("is_reversal", reversal(F.col("recent_trend"), F.col("outlook")))
    return order_by(rows, ("forecasted_count", "desc"), ("neighborhood_name", "asc"))


def point_kind(is_noise: Column) -> Column:
    return F.when(is_noise, F.lit("Dispersed")).otherwise(F.lit("Hotspot"))
