"""Hand-written rows for the fixed lists and bands, so a wrong value cannot pass on both sides of an oracle."""

import pytest
from pyspark.sql import functions as F

from placestats import constants as K
from placestats.functions.rules import bucketize, flag_in, grade, map_values, member_label, pattern_flag, pattern_map, trend_class, validate_code
from placestats.operators.filters import trailing_months
from placestats.plans.crime import severity

OFFENSES = [
    ("ARMED ROBBERY", 1, "HIGH", True, False, False),
    ("aggravated assault - knife", 1, "HIGH", True, False, False),
    ("AUTO THEFT", 1, "HIGH", False, True, False),
    ("BURGLARY - RESIDENTIAL", 1, "HIGH", False, True, False),
    ("ARSON", 1, "HIGH", False, True, False),
    ("LARCENY SHOPLIFTING", 2, "MEDIUM", False, True, False),
    ("DRUG POSSESSION", 2, "MEDIUM", False, False, True),
    ("SIMPLE ASSAULT", 2, "MEDIUM", False, False, False),
    ("VANDALISM", 2, "MEDIUM", False, True, False),
    ("SICK ASSIST", 3, "LOW", False, False, False),
    (None, 3, "LOW", False, False, False),
]


def test_offense_words(spark):
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(OFFENSES)], "i int, offense_description string")
    got = severity(df).orderBy("i").collect()
    assert [
        (r.offense_description, r.crime_severity_tier, r.crime_severity_label, r.is_violent_crime, r.is_property_crime, r.is_drug_related) for r in got
    ] == OFFENSES


def values(spark, kind, rows, rule):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", rule(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "kind,rows,rule,want",
    [
        ("int", [0, 5, 6, 11, 12, 16, 17, 20, 21, 23, 24, None], lambda x: bucketize(x, K.DAY_PARTS, K.UNKNOWN),
         ["LATE NIGHT", "LATE NIGHT", "MORNING", "MORNING", "AFTERNOON", "AFTERNOON", "EVENING", "EVENING", "NIGHT", "NIGHT", "UNKNOWN", "UNKNOWN"]),
        ("int", [1, 3, 6, 9, 12, 13], lambda x: member_label(x, K.SEASONS, K.UNKNOWN), ["WINTER", "SPRING", "SUMMER", "FALL", "WINTER", "UNKNOWN"]),
        ("string", [" b2 ", "C11", "Z9", ""], lambda x: validate_code(x, K.DISTRICT_CODES, K.UNKNOWN), ["B2", "C11", "UNKNOWN", "UNKNOWN"]),
        ("string", ["SUPERMARKET OR OTHER GROCERY", "WINTER MARKETS", "GAS STATION"], lambda x: map_values(x, K.STORE_TYPES, K.OTHER_STORE), ["SUPERMARKET", "WINTER_MARKET", "OTHER"]),
        ("string", ["WAREHOUSE_CLUB", "DEPARTMENT_STORE", "OTHER"], lambda x: map_values(x, K.STORE_CATEGORIES, K.OTHER_CATEGORY),
         ["Warehouse & Department Stores", "Warehouse & Department Stores", "Other Retail"]),
        ("string", ["MEAT_MARKET", "PHARMACY", "DOLLAR_STORE"], lambda x: flag_in(x, K.STORE_FLAGS["is_essential_food_source"]), [True, False, False]),
        ("int", [0, 2, 3, 5, 6, 10, 11], lambda x: grade(x, K.ACCESS_TIERS, K.ACCESS_TIER_TOP, "<="),
         ["LOW_ACCESS", "LOW_ACCESS", "FAIR_ACCESS", "FAIR_ACCESS", "GOOD_ACCESS", "GOOD_ACCESS", "HIGH_ACCESS"]),
        ("double", [75.0, 74.9, 50.0, 25.0, 24.9], lambda x: grade(x, K.HEALTH_GRADES, K.HEALTH_GRADE_LOW), ["EXCELLENT", "GOOD", "GOOD", "MODERATE", "LIMITED"]),
        ("string", ["Ambulatory Surgical Ctr. 4", "renal dialysis (esrd) unit", "Clinic"], lambda x: pattern_map(x, K.FACILITY_CANONICAL, "none"),
         ["AMBULATORY SURGICAL CENTER", "RENAL DIALYSIS (ESRD)", "none"]),
        ("string", ["City Hospital", "Rest Home", "Hospice", "Other"], lambda x: pattern_map(x, K.FACILITY_GROUPS, K.OTHER_FACILITY_GROUP),
         ["INPATIENT / HOSPITAL", "LONG-TERM CARE", "HOSPICE", "OTHER"]),
        ("string", ["Walk-in clinic", "Nursing Home", None], lambda x: pattern_flag(x, K.FACILITY_FLAGS["is_clinic"]), [True, False, False]),
        ("double", [10.6, 10.5, 9.5, 9.4], lambda x: trend_class(x, F.lit(10.0)), ["increasing", "stable", "stable", "decreasing"]),
        ("double", [0.0, 1.0], lambda x: trend_class(x, F.lit(0.0)), ["stable", "increasing"]),
    ],
)
def test_rules(spark, kind, rows, rule, want):
    assert values(spark, kind, rows, rule) == want


def test_trailing_months_anchor(spark):
    df = spark.createDataFrame([("2001-01-01",), ("2001-12-31",), ("2000-01-01",)], "d string").select(F.to_date("d").alias("d"))
    assert trailing_months(df, "d", 12).count() == 2
    assert trailing_months(df, "d", 12, anchor="now").count() == 0
    assert trailing_months(df, "d", 12, "2001-06-01").count() == 2
    with pytest.raises(ValueError):
        trailing_months(df, "d", 12, anchor="then")
