"""Incidents: raw rows to clean rows, located rows, hotspots, forecasts and narratives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placestats import constants as K
from placestats.functions.dates import month_of, year_month_key
from placestats.functions.numbers import fill_sentinel, flag_eq, safe_ratio, to_int
from placestats.functions.rules import bucketize, flag_in, keyword_flag, keyword_tier, member_label, validate_code
from placestats.functions.text import clean_text, norm_text
from placestats.operators.aggregates import align, union_aligned
from placestats.operators.cluster import cluster_stats, dbscan
from placestats.operators.filters import as_timestamp, complete_months, drop_future, since_year, trailing_months, validate_bbox
from placestats.operators.forecast import forecast
from placestats.operators.joins import left_fill, lookup
from placestats.operators.narrative import build_prompt, crime_reliability, describe_incident, fallback_text, narrate
from placestats.operators.ranking import dedupe
from placestats.operators.series import first_forecast, monthly_series, yoy_recent
from placestats.operators.spatial import assign_location, overlay_coordinates, spatial_join
from placestats.session import materialize

MART_SCHEMA = {
    "incident_number": "string", "offense_code": "string", "offense_description": "string", "district": "string",
    "district_name": "string", "source_neighborhood": "string", "reporting_area": "string", "street": "string",
    "lat": "double", "long": "double", "valid_location": "boolean", "occurred_on_date": "timestamp_ntz",
    "year": "int", "month": "int", "hour": "int", "day_of_week": "string", "is_shooting": "boolean",
    "time_of_day": "string", "is_weekend": "boolean", "season": "string", "year_month": "string",
    "crime_severity_tier": "int", "crime_severity_label": "string", "is_violent_crime": "boolean",
    "is_property_crime": "boolean", "is_drug_related": "boolean", "source_city": "string",
}


def severity(df: DataFrame, text: str = "offense_description") -> DataFrame:
    """Severity tier and label, and the violent / property / drug flags, from keywords."""
    words = F.upper(text)
    return df.withColumns(
        {
            "crime_severity_tier": keyword_tier(words, [(K.SEVERITY_HIGH, 1), (K.SEVERITY_MEDIUM, 2)], 3),
            "crime_severity_label": keyword_tier(
                words, [(K.SEVERITY_HIGH, "HIGH"), (K.SEVERITY_MEDIUM, "MEDIUM")], "LOW"
            ),
            "is_violent_crime": keyword_flag(words, K.VIOLENT_WORDS),
            "is_property_crime": keyword_flag(words, K.PROPERTY_WORDS),
            "is_drug_related": keyword_flag(words, K.DRUG_WORDS),
        }
    )


def clean_incidents(raw: DataFrame, districts: DataFrame, as_of: str | None = None) -> DataFrame:
    """Cleaned incidents, the newest load per (incident, offence).

    `districts` (district_code, district_name) is joined on the raw code, whatever the
    code check says. Rows whose newest load has no date, or one after `as_of`, are
    dropped.
    """
    latest = dedupe(raw, ["incident_number", "offense_code"], [F.col("load_seq").desc_nulls_last()])
    latest = drop_future(latest, "occurred_on_date", as_of)
    named = lookup(
        latest, districts, "district", {"district_name": "district_name"}, "district_code",
        norm=True, defaults={"district_name": K.UNKNOWN},
    )
    placed = validate_bbox(named)
    hour, month, year = F.col("hour"), F.col("month"), F.col("year")
    day = F.col("day_of_week")
    flagged = severity(placed).withColumns(
        {
            "is_shooting": flag_eq(F.col("shooting"), 1),
            "time_of_day": bucketize(hour, K.DAY_PARTS, K.UNKNOWN),
            "is_weekend": flag_in(norm_text(day), K.WEEKEND_DAYS),
            "season": member_label(month, K.SEASONS, K.UNKNOWN),
            "year_month": year_month_key(year, month),
        }
    )
    tidy = flagged.withColumns(
        {
            "incident_number": F.col("incident_number").cast("string"),
            "offense_code": F.col("offense_code").cast("int"),
            "offense_description": clean_text(F.col("offense_description")),
            "district": validate_code(F.col("district"), K.DISTRICT_CODES, K.UNKNOWN),
            "reporting_area": clean_text(F.col("reporting_area")),
            "street": clean_text(F.col("street")),
            "day_of_week": clean_text(day),
            "year": to_int(year.cast("string")),
            "month": to_int(month.cast("string")),
            "hour": to_int(hour.cast("string")),
        }
    ).drop("shooting")
    return fill_sentinel(
        tidy,
        {"lat": K.MISSING_COORD, "long": K.MISSING_COORD, "year": K.MISSING_INT, "month": K.MISSING_INT, "hour": K.MISSING_INT},
    )


def union_cities(sources: dict[str, DataFrame]) -> DataFrame:
    """Several cities' incidents on one schema, tagged by city."""
    aligned = []
    for city, df in sources.items():
        constants = {"source_city": city}
        if "source_neighborhood" not in df.columns:
            constants["source_neighborhood"] = K.NO_SOURCE_AREA
        aligned.append(align(df, MART_SCHEMA, constants))
    return union_aligned(*aligned)


def locate_incidents(
    incidents: DataFrame, geocoded: DataFrame, polygons: DataFrame, unlocated: DataFrame | None = None, cell: float | None = None
) -> DataFrame:
    """Incidents with their area: geocoder overlay, then point in polygon.

    Rows outside every polygon are dropped. `unlocated` is a source without
    coordinates whose rows all belong to one city.
    """
    ok = geocoded.where(
        F.col("geocode_status").isin(K.GEOCODE_OK_INCIDENT)
        & F.col("lat").isNotNull() & (F.col("lat") != K.MISSING_COORD)
        & F.col("long").isNotNull() & (F.col("long") != K.MISSING_COORD)
    )
    filled = overlay_coordinates(incidents, ok, "incident_number")
    carry = {"location_id": "location_id", "neighborhood_name": "neighborhood_name", "city": "city"}
    spatial = spatial_join(filled, polygons, carry=carry, valid=F.col("valid_location"), cell=cell)
    spatial = spatial.withColumn("resolution_method", F.lit("SPATIAL"))
    if unlocated is None:
        return spatial
    return spatial.unionByName(assign_location(unlocated, K.CITY_ASSIGNED, "CITY_ASSIGNMENT"))


def incident_mart(incidents: DataFrame, geocoded: DataFrame, polygons: DataFrame, unlocated: DataFrame | None = None) -> DataFrame:
    return describe_incident(locate_incidents(incidents, geocoded, polygons, unlocated))


def load_incidents(mart: DataFrame, since: int = 2023, as_of: str | None = None) -> DataFrame:
    """Analysis input: located incidents of complete months with calendar columns."""
    rows = mart.where(
        F.col("valid_location") & F.col("neighborhood_name").isNotNull() & (F.col("neighborhood_name") != K.UNKNOWN)
    )
    rows = complete_months(since_year(rows, "occurred_on_date", since), "occurred_on_date", as_of)
    at = F.col("occurred_on_date")
    return rows.select(
        F.col("incident_number").alias("incident_id"), "city", F.col("offense_description").alias("crime_description"),
        at.cast("date").alias("crime_date"), month_of(at).alias("year_month"), F.year(at).alias("crime_year"),
        F.month(at).alias("crime_month"), "lat", "long", "location_id", "neighborhood_name",
    )


def recent_incidents(incidents: DataFrame, months: int = 12, least: int = K.CRIME_STATS_SCALE[1]) -> DataFrame:
    """Incidents of the last `months` months in areas with at least `least` located ones."""
    recent = trailing_months(incidents, "crime_date", months).where(F.col("lat").isNotNull() & F.col("long").isNotNull())
    sizes = recent.groupBy("neighborhood_name").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    return recent.join(sizes.select("neighborhood_name"), "neighborhood_name", "left_semi")


def hotspot_figures(recent: DataFrame, id: str, scale=K.CRIME_STATS_SCALE) -> DataFrame:
    """Cluster figures per area at the fine scale; `recent` comes from `recent_incidents`."""
    fine = dbscan(recent, "neighborhood_name", id, eps_km=scale[0], min_samples=scale[1])
    return cluster_stats(fine, "neighborhood_name").select(
        "neighborhood_name",
        F.col("total").alias("total_crimes"),
        F.col("n_clusters").alias("n_hotspot_clusters"),
        F.col("clustered_pct").alias("hotspot_crime_share_pct"),
        F.col("noise_pct").alias("noise_crime_pct"),
    )


def hotspot_points(recent: DataFrame, id: str, scale=K.CRIME_MAP_SCALE) -> DataFrame:
    """Labelled points at the coarse, independent scale used for maps."""
    return cluster_points(dbscan(recent, "neighborhood_name", id, eps_km=scale[0], min_samples=scale[1]))


def cluster_points(labels: DataFrame) -> DataFrame:
    return labels.select(
        "neighborhood_name", "lat", "long", "cluster_id", "is_noise",
        F.date_format("crime_date", "yyyy-MM-dd").alias("crime_date"), "crime_description",
    )


def narratives(series: DataFrame, forecasts: DataFrame, clusters: DataFrame, model=None) -> DataFrame:
    """Narrative row per forecast area: trend, first forecast, clusters, text, reliability."""
    first = first_forecast(forecasts, "neighborhood_name").select(
        "neighborhood_name", "forecast_month", "forecasted_count", "train_mape"
    )
    recent = yoy_recent(series, "neighborhood_name").where(F.col("n_months") >= 3)
    rows = first.join(recent, "neighborhood_name")
    rows = left_fill(rows, clusters, "neighborhood_name", {"n_hotspot_clusters": None, "hotspot_crime_share_pct": None})
    told = narrate(build_prompt(rows, "crime"), "prompt", fallback_text("crime"), "safety_narrative", model)
    return told.select(
        "neighborhood_name", "recent_trend", F.bround("recent_avg", 1).alias("recent_avg_monthly"), "forecast_month",
        "forecasted_count", "train_mape", "n_hotspot_clusters", "safety_narrative",
        crime_reliability().alias("reliability_flag"), "prompt",
    )


def analyse(mart: DataFrame, since: int = 2023, as_of: str | None = None, model: str = "seasonal", id: str = "incident_id",
            stats=K.CRIME_STATS_SCALE, points=K.CRIME_MAP_SCALE,
            parts: Sequence[str] = ("series", "forecast", "clusters", "points", "narratives")) -> dict[str, DataFrame]:
    """The whole analysis, or the chosen `parts` of it.

    Incident ids need not be unique: the mart is unique per incident and offence.
    """
    rows = load_incidents(mart, since, as_of)
    series = monthly_series(rows, "neighborhood_name", "year_month")
    out = {"series": series, "forecast": forecast(series, "neighborhood_name", model=model)}
    if {"clusters", "points", "narratives"} & set(parts):
        recent = materialize(recent_incidents(rows, least=stats[1]))
        if {"clusters", "narratives"} & set(parts):
            out["clusters"] = hotspot_figures(recent, id, stats)
        if "points" in parts:
            out["points"] = hotspot_points(recent, id, points)
        if "narratives" in parts:
            out["narratives"] = narratives(series, out["forecast"], out["clusters"])
    return {name: out[name] for name in parts}


def safety_signals(mart: DataFrame, areas: DataFrame, as_of: str | None = None) -> DataFrame:
    """The six raw signals per area over the last year, and the change against the year before.

    The signals' exact definitions are ours: shares of the year's incidents that are
    violent, property, high severity or at night; incidents per square mile; relative
    change on the previous twelve months.
    """
    at = F.col("occurred_on_date")
    end = F.date_trunc("month", as_timestamp(as_of)).cast("timestamp_ntz")
    year_ago = F.add_months(end, -12).cast("timestamp_ntz")
    two_ago = F.add_months(end, -24).cast("timestamp_ntz")
    now = (at >= year_ago) & (at < end)
    window = mart.where((at >= two_ago) & (at < end))
    counts = window.groupBy("location_id").agg(
        F.count_if(now).alias("n_now"),
        F.count_if(~now).alias("n_before"),
        F.count_if(now & F.col("is_violent_crime")).alias("n_violent"),
        F.count_if(now & F.col("is_property_crime")).alias("n_property"),
        F.count_if(now & (F.col("crime_severity_tier") == 1)).alias("n_high"),
        F.count_if(now & F.col("time_of_day").isin("NIGHT", "LATE NIGHT")).alias("n_night"),
    )
    n = F.col("n_now")
    return areas.select("location_id", "neighborhood_name", "sqmiles").join(counts, "location_id").select(
        "location_id",
        "neighborhood_name",
        n.alias("incidents"),
        safe_ratio(F.col("n_violent"), n, default=None).alias("violent_rate"),
        safe_ratio(n, F.col("sqmiles"), default=None).alias("crime_density"),
        safe_ratio(F.col("n_property"), n, default=None).alias("property_rate"),
        safe_ratio(F.col("n_high"), n, default=None).alias("high_severity"),
        safe_ratio(n - F.col("n_before"), F.col("n_before"), default=None).alias("yoy_trend"),
        safe_ratio(F.col("n_night"), n, default=None).alias("night_crime"),
    )
