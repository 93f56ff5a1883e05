"""Profiles, shares and scores."""

from pyspark.sql import functions as F

from catalog import query
from catalog.cleaning import incidents
from catalog.places import located_incidents
from catalog.sqltext import CLEAN_FACILITY, CLEAN_INCIDENT, CLEAN_NEEDS, LOCATED, LOCATED_NEEDS
from placestats import constants as K
from placestats.fixtures import AS_OF, Tables
from placestats.functions.numbers import share_pct
from placestats.functions.rules import grade
from placestats.operators.aggregates import conditional_counts, count_by, distribution, kpis, to_long, to_wide
from placestats.operators.score import safety_score
from placestats.plans import crime, healthcare

_per = "(total_facilities::DOUBLE / sqmiles)"
_counts = ", ".join(
    f"count(*) FILTER (facility_type_group = '{v}') AS {k}" for k, v in K.PROFILE_GROUPS.items()
)


def _pct(n: str) -> str:
    return f"CASE WHEN total_facilities > 0 THEN round(({n})::DOUBLE * 100 / total_facilities, 1) ELSE 0 END"


def _points(n: str, top: int) -> str:
    return f"CASE WHEN total_facilities > 0 THEN round(({n})::DOUBLE / total_facilities * {top}, 1) ELSE 0 END"


HEALTH = {
    **CLEAN_FACILITY,
    "area_count": f"""
SELECT location_id, count(facility_id) AS total_facilities, count(*) FILTER (is_hospital) AS hospital_count, count(*) FILTER (is_clinic) AS clinic_count,
  count(*) FILTER (has_valid_phone) AS valid_phone_count, {_counts}, count(DISTINCT facility_type_group) AS facility_type_diversity
FROM clean_facility WHERE location_id IS NOT NULL GROUP BY location_id""",
    "area_full": f"""
SELECT l.location_id, neighborhood_name, city, sqmiles, {', '.join(f"coalesce({c}, 0) AS {c}" for c in ['total_facilities', 'hospital_count', 'clinic_count', 'valid_phone_count', *K.PROFILE_GROUPS, 'facility_type_diversity'])}
FROM fx_location l LEFT JOIN area_count a ON l.location_id = a.location_id""",
    "area_part": f"""
SELECT *, CASE WHEN sqmiles > 0 THEN round({_per}, 2) ELSE 0 END AS facilities_per_sqmile,
  {_pct('hospital_count + clinic_count')} AS pct_core_care, {_pct('valid_phone_count')} AS pct_valid_phone,
  {_pct('inpatient_hospital_count')} AS pct_inpatient_hospital, {_pct('outpatient_clinic_count')} AS pct_outpatient_clinic,
  {_pct('public_health_count')} AS pct_public_health, {_pct('specialty_other_count')} AS pct_specialty_other,
  least(CASE WHEN sqmiles > 0 THEN round({_per} / 12.0 * 35, 1) ELSE 0 END, 35.0) AS density_score,
  {_points('hospital_count + clinic_count', 30)} AS core_care_score, {_points('valid_phone_count', 20)} AS contact_quality_score,
  least(round(facility_type_diversity / 4.0::DOUBLE * 15, 1), 15.0) AS diversity_score FROM area_full""",
    "area_total": """
SELECT *, least(round(density_score + core_care_score + contact_quality_score + diversity_score, 1), 100.0) AS healthcare_score FROM area_part""",
    "health_profile": """
SELECT *, CASE WHEN healthcare_score >= 75 THEN 'EXCELLENT' WHEN healthcare_score >= 50 THEN 'GOOD'
  WHEN healthcare_score >= 25 THEN 'MODERATE' ELSE 'LIMITED' END AS healthcare_grade FROM area_total""",
}
HEALTH_NEEDS = ["fx_facility", "fx_location"]


def health_profile(t: Tables):
    return healthcare.access_profile(t.fx_location, healthcare.clean_facilities(t.fx_facility))


@query("healthcare_profile", "SELECT * FROM health_profile", HEALTH_NEEDS, HEALTH)
def _(t):
    return health_profile(t)


@query(
    "severity_counts",
    """SELECT crime_severity_label, count(*) AS n, count(*) FILTER (is_violent_crime) AS violent, count(*) FILTER (is_drug_related) AS drug,
       count(DISTINCT incident_number) AS incidents, count(year) AS with_year FROM clean_incident GROUP BY crime_severity_label""",
    CLEAN_NEEDS,
    CLEAN_INCIDENT,
)
def _(t):
    return conditional_counts(
        incidents(t), ["crime_severity_label"],
        {"violent": F.col("is_violent_crime"), "drug": F.col("is_drug_related")},
        n=F.count(F.lit(1)), incidents=F.count_distinct("incident_number"), with_year=F.count("year"),
    )


@query(
    "share_of_total",
    """SELECT season, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM clean_incident), 1) AS pct
       FROM clean_incident GROUP BY season""",
    CLEAN_NEEDS,
    CLEAN_INCIDENT,
)
def _(t):
    rows = incidents(t)
    total = rows.agg(F.count(F.lit(1))).scalar()
    return count_by(rows, ["season"]).withColumn("pct", share_pct(F.col("n"), total))


@query(
    "distribution",
    "SELECT healthcare_grade, count(*) AS n FROM health_profile GROUP BY healthcare_grade",
    HEALTH_NEEDS,
    HEALTH,
)
def _(t):
    return distribution(health_profile(t), "healthcare_grade")


@query(
    "kpis",
    """SELECT count(DISTINCT neighborhood_name) AS areas, round(avg(healthcare_score), 6) AS mean_score, CAST(sum(hospital_count) AS BIGINT) AS hospitals,
       count(*) FILTER (healthcare_grade = 'LIMITED') AS limited FROM health_profile""",
    HEALTH_NEEDS,
    HEALTH,
)
def _(t):
    return kpis(
        health_profile(t),
        {
            "areas": F.count_distinct("neighborhood_name"),
            "mean_score": F.round(F.avg("healthcare_score"), 6),
            "hospitals": F.sum("hospital_count"),
            "limited": F.count_if(F.col("healthcare_grade") == "LIMITED"),
        },
    )


_PARTS = ["density_score", "core_care_score", "contact_quality_score", "diversity_score"]


@query(
    "to_long",
    " UNION ALL ".join(f"SELECT neighborhood_name, '{p}' AS component, {p} AS value FROM health_profile" for p in _PARTS),
    HEALTH_NEEDS,
    HEALTH,
)
def _(t):
    return to_long(health_profile(t), ["neighborhood_name"], _PARTS)


@query(
    "to_wide",
    """SELECT location_id, count(*) FILTER (facility_type_group = 'HOSPICE') AS "HOSPICE", count(*) FILTER (facility_type_group = 'DIALYSIS') AS "DIALYSIS",
       count(*) FILTER (facility_type_group = 'RESEARCH') AS "RESEARCH" FROM clean_facility GROUP BY location_id""",
    ["fx_facility"],
    CLEAN_FACILITY,
)
def _(t):
    rows = healthcare.clean_facilities(t.fx_facility)
    return to_wide(rows, ["location_id"], "facility_type_group", ["HOSPICE", "DIALYSIS", "RESEARCH"], F.count(F.lit(1)))


_SIGNALS = list(K.SAFETY_WEIGHTS)


def _ratio(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN ({n})::DOUBLE / {d} END"


_used = " + ".join(f"CASE WHEN {s} IS NOT NULL THEN {w}::DOUBLE ELSE 0 END" for s, w in K.SAFETY_WEIGHTS.items())
_cost = " + ".join(f"coalesce({s} * {w}::DOUBLE, 0)" for s, w in K.SAFETY_WEIGHTS.items())
SAFETY = {
    **LOCATED,
    "area_signal": f"""
SELECT location_id, count(*) FILTER (now) AS n, count(*) FILTER (NOT now) AS n_before, count(*) FILTER (now AND is_violent_crime) AS n_violent,
  count(*) FILTER (now AND is_property_crime) AS n_property, count(*) FILTER (now AND crime_severity_tier = 1) AS n_high,
  count(*) FILTER (now AND time_of_day IN ('NIGHT', 'LATE NIGHT')) AS n_night
FROM (SELECT *, occurred_on_date >= TIMESTAMP '2023-02-01' AS now FROM located
      WHERE occurred_on_date >= TIMESTAMP '2022-02-01' AND occurred_on_date < TIMESTAMP '{AS_OF}') GROUP BY location_id""",
    "signal": f"""
SELECT l.location_id, l.neighborhood_name, n AS incidents, {_ratio('n_violent', 'n')} AS violent_rate, {_ratio('n', 'sqmiles')} AS crime_density,
  {_ratio('n_property', 'n')} AS property_rate, {_ratio('n_high', 'n')} AS high_severity, {_ratio('n - n_before', 'n_before')} AS yoy_trend,
  {_ratio('n_night', 'n')} AS night_crime FROM fx_location l JOIN area_signal a ON l.location_id = a.location_id""",
    "scaled": "SELECT location_id, neighborhood_name, incidents, "
    + ", ".join(
        f"CASE WHEN {s} IS NULL THEN NULL WHEN max({s}) OVER () > min({s}) OVER () THEN ({s} - min({s}) OVER ()) / (max({s}) OVER () - min({s}) OVER ()) * 100 ELSE 0.0 END AS {s}"
        for s in _SIGNALS
    )
    + " FROM signal",
    "safety": f"""
SELECT *, least(greatest(round(100.0::DOUBLE - ({_cost}) / ({_used}), 1), 0.0), 100.0) AS safety_score FROM scaled""",
    "safety_graded": """
SELECT *, CASE WHEN safety_score >= 75 THEN 'EXCELLENT' WHEN safety_score >= 50 THEN 'GOOD' WHEN safety_score >= 25 THEN 'MODERATE'
  ELSE 'HIGH CONCERN' END AS safety_grade FROM safety""",
}


def safety(t: Tables):
    return safety_score(crime.safety_signals(located_incidents(t), t.fx_location, AS_OF))


@query(
    "weighted_score",
    f"SELECT location_id, neighborhood_name, incidents, {', '.join(f'round({s}, 6) AS {s}' for s in _SIGNALS)}, safety_score, safety_grade FROM safety_graded",
    LOCATED_NEEDS,
    SAFETY,
)
def _(t):
    out = safety(t)
    return out.select(
        "location_id", "neighborhood_name", "incidents", *[F.round(s, 6).alias(s) for s in _SIGNALS], "safety_score", "safety_grade"
    )


@query(
    "account_grades",
    """SELECT CASE WHEN c_acctbal >= 7500 THEN 'EXCELLENT' WHEN c_acctbal >= 5000 THEN 'GOOD' WHEN c_acctbal >= 2500 THEN 'MODERATE' ELSE 'LIMITED' END AS band,
       count(*) AS n FROM customer GROUP BY 1""",
)
def _(t):
    bands = [(100 * at, label) for at, label in K.HEALTH_GRADES]
    return count_by(t.customer, [grade(F.col("c_acctbal"), bands, K.HEALTH_GRADE_LOW).alias("band")])
