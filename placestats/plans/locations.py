"""The master list of areas, from boundary files and the fixed city table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placestats.constants import MISSING_COORD
from placestats.functions.geometry import geom_to_wkt
from placestats.operators.spatial import assign_ids, collect_geometry, with_centroid
from placestats.sources.readers import greater_cities


def neighbourhoods(features: DataFrame, city: str, sqmiles: str | None = None) -> DataFrame:
    """Feature rows as location rows; features without geometry get sentinel centroids."""
    rows = with_centroid(features)
    return rows.select(
        "pos",
        "name",
        F.lit(city).alias("city"),
        F.lit("MA").alias("state"),
        F.lit("NEIGHBORHOOD").alias("granularity"),
        F.coalesce("centroid_lat", F.lit(MISSING_COORD)).alias("centroid_lat"),
        F.coalesce("centroid_long", F.lit(MISSING_COORD)).alias("centroid_long"),
        (F.col(sqmiles).cast("double") if sqmiles else F.lit(None).cast("double")).alias("sqmiles"),
        "geometry",
    )


def cities(spark: SparkSession, features: DataFrame | None = None) -> DataFrame:
    """The fixed cities; features named like a city give its geometry and centroid."""
    table = greater_cities(spark).withColumn("pos", F.monotonically_increasing_id())
    if features is None:
        merged = table.withColumn("geometry", F.lit(None).cast("array<array<array<struct<x:double,y:double>>>>"))
    else:
        shapes = collect_geometry(features.where(F.col("geometry").isNotNull()), ["name"], "pos")
        merged = table.join(shapes, "name", "left")
    known = merged.withColumnsRenamed({"centroid_lat": "_lat", "centroid_long": "_long"})
    rows = with_centroid(known)
    return rows.select(
        "pos",
        "name",
        F.col("name").alias("city"),
        F.lit("MA").alias("state"),
        F.lit("CITY").alias("granularity"),
        F.coalesce("centroid_lat", "_lat").alias("centroid_lat"),
        F.coalesce("centroid_long", "_long").alias("centroid_long"),
        F.lit(None).cast("double").alias("sqmiles"),
        "geometry",
    )


def master_locations(sources: list[DataFrame]) -> DataFrame:
    """Sources numbered in order, with geometry text and flags."""
    rows = assign_ids(sources, "pos")
    return rows.drop("pos").withColumns(
        {
            "location_id": F.col("location_id").cast("int"),
            "geometry_wkt": geom_to_wkt(F.col("geometry")),
            "has_geometry": F.col("geometry").isNotNull(),
        }
    )
