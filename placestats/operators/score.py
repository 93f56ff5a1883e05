"""Composite scores as plain expressions over aggregated areas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.constants import (
    DENSITY_FULL_MARK,
    DIVERSITY_FULL_MARK,
    HEALTH_GRADE_LOW,
    HEALTH_GRADES,
    HEALTH_POINTS,
    SAFETY_GRADE_LOW,
    SAFETY_GRADES,
    SAFETY_WEIGHTS,
)
from placestats.functions.numbers import clamp, safe_ratio, share_pct
from placestats.functions.rules import grade
from placestats.session import materialize


def health_components(df: DataFrame) -> DataFrame:
    """Shares, four capped components, total and grade of a facility profile.

    Expects the counts of `plans.healthcare.access_counts`; an area without a known
    size has no density score.
    """
    total = F.col("total_facilities")
    core = F.col("hospital_count") + F.col("clinic_count")
    per_mile = safe_ratio(total, F.col("sqmiles"))
    top = HEALTH_POINTS
    scored = df.withColumns(
        {
            "facilities_per_sqmile": F.round(per_mile, 2),
            "pct_core_care": share_pct(core, total),
            "pct_valid_phone": share_pct(F.col("valid_phone_count"), total),
            "pct_inpatient_hospital": share_pct(F.col("inpatient_hospital_count"), total),
            "pct_outpatient_clinic": share_pct(F.col("outpatient_clinic_count"), total),
            "pct_public_health": share_pct(F.col("public_health_count"), total),
            "pct_specialty_other": share_pct(F.col("specialty_other_count"), total),
            "density_score": clamp(F.round(per_mile / DENSITY_FULL_MARK * top["density"], 1), hi=float(top["density"])),
            "core_care_score": F.round(safe_ratio(core, total) * top["core_care"], 1),
            "contact_quality_score": F.round(safe_ratio(F.col("valid_phone_count"), total) * top["contact"], 1),
            "diversity_score": clamp(
                F.round(F.col("facility_type_diversity") / DIVERSITY_FULL_MARK * top["diversity"], 1),
                hi=float(top["diversity"]),
            ),
        }
    )
    parts = ["density_score", "core_care_score", "contact_quality_score", "diversity_score"]
    summed = F.col(parts[0])
    for p in parts[1:]:
        summed = summed + F.col(p)
    return scored.withColumn("healthcare_score", clamp(F.round(summed, 1), hi=100.0)).withColumn(
        "healthcare_grade", grade(F.col("healthcare_score"), HEALTH_GRADES, HEALTH_GRADE_LOW)
    )


def min_max(df: DataFrame, cols: list[str]) -> DataFrame:
    """Scale columns to 0..100 over the whole frame; a constant column becomes 0.

    All extremes come from one pass as a single scalar row.
    """
    extremes = df.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in cols for f, n in ((F.min, "lo"), (F.max, "hi"))]).alias("x"))
    out = {}
    for c in cols:
        lo, hi = F.col(f"_x.lo_{c}"), F.col(f"_x.hi_{c}")
        scaled = F.when(hi > lo, (F.col(c) - lo) / (hi - lo) * 100).otherwise(F.lit(0.0))
        out[c] = F.when(F.col(c).isNotNull(), scaled)
    return df.withColumn("_x", extremes.scalar()).withColumns(out).drop("_x")


def weighted_penalty(signals: Mapping[str, Column], redistribute: bool = True) -> Column:
    """100 minus the weighted signals (each 0..100).

    With `redistribute` a missing signal hands its weight to the others in
    proportion; without it a missing signal costs nothing.
    """
    used, cost = F.lit(0.0), F.lit(0.0)
    for name, signal in signals.items():
        w = SAFETY_WEIGHTS[name]
        used = used + F.when(signal.isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
        cost = cost + F.coalesce(signal * w, F.lit(0.0))
    if redistribute:
        cost = cost / F.nullif(used, F.lit(0.0))
    return F.lit(100.0) - cost


def safety_score(df: DataFrame, redistribute: bool = True) -> DataFrame:
    """Score and grade from the six signals, min-max scaled over all areas.

    The signals (one row per area) are written out first, as they are read twice.
    """
    names = list(SAFETY_WEIGHTS)
    scaled = min_max(materialize(df), names)
    score = F.round(weighted_penalty({n: F.col(n) for n in names}, redistribute), 1)
    out = scaled.withColumn("safety_score", clamp(score, 0.0, 100.0))
    return out.withColumn("safety_grade", grade(F.col("safety_score"), SAFETY_GRADES, SAFETY_GRADE_LOW))
