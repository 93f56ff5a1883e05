"""Stores: raw rows to clean rows, located rows, area profiles and narratives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placestats import constants as K
from placestats.functions.numbers import fill_sentinel, share_pct, to_int
from placestats.functions.rules import flag_in, grade, map_values
from placestats.functions.text import norm_text, valid_zip
from placestats.operators.aggregates import is_true_text, type_breakdown
from placestats.operators.cluster import cluster_stats, dbscan
from placestats.operators.joins import keep_matched
from placestats.operators.narrative import build_prompt, describe_store, fallback_text, grocery_reliability, narrate
from placestats.operators.ranking import dedupe, first_by
from placestats.operators.spatial import resolve_location


def classify_stores(df: DataFrame) -> DataFrame:
    """Store type, category, vintage and membership flags from the raw type and year."""
    typed = df.withColumn("store_type", map_values(norm_text(F.col("store_type")), K.STORE_TYPES, K.OTHER_STORE))
    typed = typed.withColumn("naics_category", map_values(F.col("store_type"), K.STORE_CATEGORIES, K.OTHER_CATEGORY))
    flags = {name: flag_in(F.col("store_type"), members) for name, members in K.STORE_FLAGS.items()}
    flags["is_pharmacy_or_drug_store"] = flags["is_pharmacy_or_drug_store"] | (
        F.col("naics_category") == K.PHARMACY_CATEGORY
    )
    return typed.withColumns(
        {
            **flags,
            "data_vintage": map_values(F.col("data_year"), K.DATA_VINTAGES, K.UNKNOWN),
            "is_zip_valid": F.col("zip_code") != K.UNKNOWN,
        }
    )


def clean_stores(raw: DataFrame, geocoded: DataFrame) -> DataFrame:
    """Cleaned, geocoded stores, one per (name, address, city, zip, year)."""
    found = geocoded.where(F.col("geocode_status").isin(K.GEOCODE_OK))
    located = keep_matched(raw.where(F.col("objectid").isNotNull()), found, "objectid", ["lat", "long"], tolerant="int")
    tidy = located.select(
        to_int(F.col("objectid")).alias("objectid"),
        norm_text(F.col("coname")).alias("store_name"),
        norm_text(F.col("staddr")).alias("street_address"),
        norm_text(F.col("stcity")).alias("city"),
        valid_zip(F.col("zip")).alias("zip_code"),
        "store_type",
        to_int(F.col("year")).alias("data_year"),
        "lat",
        "long",
        F.col("lat").isNotNull().alias("has_valid_location"),
    )
    single = dedupe(
        tidy, ["store_name", "street_address", "city", "zip_code", "data_year"], [F.col("objectid").asc_nulls_last()]
    )
    return fill_sentinel(classify_stores(single), {"lat": K.MISSING_COORD, "long": K.MISSING_COORD})


def store_mart(stores: DataFrame, polygons: DataFrame, cell: float | None = None) -> DataFrame:
    """Stores with their area (polygon, else their city text) and a description."""
    kept = stores.where(F.col("objectid").isNotNull() & F.col("has_valid_location"))
    placed = resolve_location(kept, polygons, valid=F.col("has_valid_location"), cell=cell)
    return describe_store(placed.withColumn("city", F.col("city_name")).drop("city_name"))


def newest_stores(mart: DataFrame) -> DataFrame:
    """One row per store name, address and area: the one of the newest survey."""
    rows = mart.where(F.col("has_valid_location") & F.col("neighborhood_name").isNotNull())
    keys = [norm_text(F.col("store_name")), norm_text(F.col("street_address")), F.col("neighborhood_name")]
    return dedupe(rows, keys, [F.col("data_year").desc_nulls_last(), F.col("objectid").asc_nulls_last()])


def access_tier(essential):
    return grade(essential, K.ACCESS_TIERS, K.ACCESS_TIER_TOP, op="<=")


def area_profile(stores: DataFrame, scale=K.GROCERY_SCALE) -> DataFrame:
    """Counts, shares, store clusters and access tier per area.

    Totals count stores with coordinates; type counts take every row of the area.
    """
    area = "neighborhood_name"
    labels = dbscan(stores, area, "objectid", eps_km=scale[0], min_samples=scale[1])
    stats = cluster_stats(labels, area).select(
        F.col(area).alias("_a"), F.col("n_clusters").alias("n"), F.col("noise_pct").alias("noise")
    )
    placed = F.col("lat").isNotNull() & F.col("long").isNotNull()
    counts = type_breakdown(
        stores, [area], "store_type", K.STORE_COUNT_GROUPS,
        city=F.min_by("city", "objectid"),
        total_stores=F.count_if(placed),
        essential_store_count=F.count_if(is_true_text(F.col("is_essential_food_source"))),
    )
    rows = counts.join(stats, F.col(area) == F.col("_a"), "left")
    isolated = F.coalesce("noise", F.lit(100.0))
    essential = F.col("essential_store_count")
    return rows.select(
        area,
        "city",
        "total_stores",
        "essential_store_count",
        share_pct(essential, F.col("total_stores"), even=True).alias("essential_store_pct"),
        *K.STORE_COUNT_GROUPS,
        F.coalesce("n", F.lit(0)).alias("n_store_clusters"),
        F.when(F.col("noise").isNull(), F.lit(0.0)).otherwise(F.bround(F.lit(100.0) - isolated, 1)).alias("clustered_store_share_pct"),
        isolated.alias("isolated_store_pct"),
        access_tier(essential).alias("access_tier"),
    )


def narratives(profile: DataFrame, stores: DataFrame, model=None) -> DataFrame:
    latest = first_by(stores, ["neighborhood_name"], ["data_year"], F.coalesce(-F.col("data_year"), F.lit(0)))
    rows = profile.join(latest, "neighborhood_name", "left")
    told = narrate(build_prompt(rows, "grocery"), "prompt", fallback_text("grocery"), "food_access_narrative", model)
    return told.select(
        "neighborhood_name", "city", "access_tier", "total_stores", "essential_store_count", "essential_store_pct",
        "n_store_clusters", "data_year", "food_access_narrative", grocery_reliability().alias("reliability_flag"), "prompt",
    )
