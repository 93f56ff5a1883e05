"""Facilities: raw rows to clean rows, located rows, access profiles and narratives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placestats import constants as K
from placestats.functions.numbers import fill_sentinel, parse_number
from placestats.functions.rules import flag_in, pattern_flag, pattern_map
from placestats.functions.text import clean_phone, clean_squeezed, clean_text, norm_text, padded_zip, valid_phone
from placestats.operators.aggregates import profile_by_area
from placestats.operators.cluster import bin_clusters
from placestats.operators.joins import keep_matched, left_fill
from placestats.operators.narrative import build_prompt, describe_facility, narrate
from placestats.operators.score import health_components
from placestats.operators.spatial import resolve_location


def clean_facilities(raw: DataFrame, geocoded: DataFrame | None = None) -> DataFrame:
    """Standardised facility rows; with `geocoded` only rows it knows, with coordinates."""
    rows = raw.where(F.col("facility_id").isNotNull())
    if geocoded is not None:
        found = geocoded.where(F.col("geocode_status").isin(K.GEOCODE_OK))
        rows = keep_matched(rows, found, "facility_id", ["lat", "long"])
        rows = rows.withColumn("has_valid_location", F.col("lat").isNotNull() & F.col("long").isNotNull())
        rows = fill_sentinel(rows, {"lat": K.MISSING_COORD, "long": K.MISSING_COORD})
    kind = F.trim("facility_type")
    blank = F.nullif(kind, F.lit("")).isNull()
    named = F.when(blank, F.lit(K.UNKNOWN)).otherwise(pattern_map(kind, K.FACILITY_CANONICAL, F.upper(kind)))
    derived = {
        "facility_type_canonical": named,
        "facility_type_group": pattern_map(kind, K.FACILITY_GROUPS, K.OTHER_FACILITY_GROUP),
        **{name: pattern_flag(kind, pats) for name, pats in K.FACILITY_FLAGS.items()},
        "phone": clean_phone(F.col("telephone")),
        "has_valid_phone": valid_phone(F.col("telephone")),
        "is_boston_area": flag_in(norm_text(F.coalesce("city", F.lit(""))), K.METRO_AREA_NAMES),
    }
    tidy = {
        "facility_name": clean_squeezed(F.col("facility_name")),
        "facility_type": clean_text(F.col("facility_type")),
        "street": clean_squeezed(F.col("street")),
        "city": clean_squeezed(F.col("city")),
        "zip_code": padded_zip(F.col("zip_code")),
        "bed_count": parse_number(F.col("bed_count"), K.COUNT_NULL_TOKENS, K.MISSING_INT),
        "adult_day_health_capacity": parse_number(F.col("adult_day_health_capacity"), K.COUNT_NULL_TOKENS, K.MISSING_INT),
    }
    return rows.withColumns(derived).withColumns(tidy).drop("telephone")


def facility_mart(facilities: DataFrame, locations: DataFrame, cell: float | None = None) -> DataFrame:
    """Facilities with their area (polygon, city row, own city) and a description.

    `locations` has location_id, neighborhood_name, city, granularity and geometry.
    """
    polygons = locations.where(F.col("geometry").isNotNull())
    cities = locations.where(F.upper("granularity") == "CITY")
    placed = resolve_location(facilities, polygons, cities, valid=F.col("has_valid_location"), cell=cell)
    return describe_facility(placed)


def access_counts(locations: DataFrame, facilities: DataFrame) -> DataFrame:
    """Facility counts of every area, zero where an area has none."""
    group = F.col("facility_type_group")
    counts = {
        "total_facilities": F.count("facility_id"),
        "hospital_count": F.count_if(F.col("is_hospital")),
        "clinic_count": F.count_if(F.col("is_clinic")),
        "valid_phone_count": F.count_if(F.col("has_valid_phone")),
        **{name: F.count_if(group == label) for name, label in K.PROFILE_GROUPS.items()},
        "facility_type_diversity": F.count_distinct(group),
    }
    rows = profile_by_area(locations, facilities, "location_id", ["neighborhood_name", "city", "sqmiles"], counts)
    return rows.fillna(0, subset=list(counts))


def access_profile(locations: DataFrame, facilities: DataFrame) -> DataFrame:
    return health_components(access_counts(locations, facilities))


def hotspot_bins(mart: DataFrame, digits: int = 2) -> DataFrame:
    """Concentration per area and city from rounded coordinates."""
    rows = bin_clusters(mart, ["location_id", "neighborhood_name", "city"], digits)
    return rows.select(
        "location_id", "neighborhood_name", "city",
        F.col("total").alias("total_facilities"),
        F.col("n_clusters").alias("n_healthcare_clusters"),
        F.col("clustered_pct").alias("clustered_facility_share_pct"),
        F.col("isolated_pct").alias("isolated_facility_pct"),
    )


def narratives(profile: DataFrame, clusters: DataFrame, model=None) -> DataFrame:
    """Profile with hotspot figures and a prompt.

    Clusters are joined on the area alone, so an area with several city spellings
    among its hotspots yields several rows.
    """
    fills = {"n_healthcare_clusters": 0, "clustered_facility_share_pct": 0.0, "isolated_facility_pct": 0.0}
    rows = build_prompt(left_fill(profile, clusters, "location_id", fills), "healthcare")
    rows = narrate(rows, "prompt", F.lit(None).cast("string"), "healthcare_narrative", model)
    return rows.select(
        "location_id", "neighborhood_name", "city", "total_facilities", "hospital_count", "clinic_count",
        "facility_type_diversity", "facilities_per_sqmile", "pct_core_care", "pct_valid_phone", *fills,
        "healthcare_score", "healthcare_grade", "healthcare_narrative", "prompt",
    )
