"""Cleaning, classification and de-duplication."""

from pyspark.sql import functions as F

from catalog import query
from catalog.sqltext import CLEAN_FACILITY, CLEAN_INCIDENT, CLEAN_NEEDS, CLEAN_STORE, STORE_NEEDS, clean
from placestats.fixtures import AS_OF, ORDERS_AS_OF, Tables
from placestats.functions.dates import fmt_ts, month_name, month_of, shift_months
from placestats.functions.nested import explode_pos, json_path
from placestats.functions.numbers import clamp, flag_eq, parse_number, round_half_even, round_half_up, safe_ratio
from placestats.functions.text import (
    any_like, concat_strict, fixed, humanize, normalize_blank_runs, norm_text, squeeze_ws,
)
from placestats.operators.aggregates import upper_columns
from placestats.operators.filters import complete_months, drop_future, in_box, since_year, trailing_months
from placestats.operators.joins import lookup, update_where
from placestats.operators.ranking import dedupe
from placestats.plans.crime import clean_incidents
from placestats.plans.grocery import clean_stores
from placestats.plans.healthcare import clean_facilities

INCIDENT_COLS = [
    "incident_number", "offense_code", "offense_description", "district", "district_name", "reporting_area", "street",
    "lat", "long", "valid_location", "occurred_on_date", "year", "month", "hour", "day_of_week", "is_shooting",
    "time_of_day", "is_weekend", "season", "year_month", "crime_severity_tier", "crime_severity_label",
    "is_violent_crime", "is_property_crime", "is_drug_related", "load_seq",
]


def incidents(t: Tables):
    return clean_incidents(t.fx_incident, t.fx_district, AS_OF).select(*INCIDENT_COLS)


def stores(t: Tables):
    return clean_stores(t.fx_store, t.fx_store_geocode)


@query("clean_incidents", f"SELECT {', '.join(INCIDENT_COLS)} FROM clean_incident", CLEAN_NEEDS, CLEAN_INCIDENT)
def _(t):
    return incidents(t)


@query("clean_facilities", "SELECT * FROM clean_facility", ["fx_facility"], CLEAN_FACILITY)
def _(t):
    return clean_facilities(t.fx_facility)


@query("clean_stores", "SELECT * FROM clean_store", STORE_NEEDS, CLEAN_STORE)
def _(t):
    return stores(t)


@query(
    "dedupe_latest",
    """SELECT incident_number, offense_code, load_seq FROM (SELECT *, row_number() OVER (
       PARTITION BY incident_number, offense_code ORDER BY load_seq DESC NULLS LAST) AS rn FROM fx_incident) WHERE rn = 1""",
    ["fx_incident"],
)
def _(t):
    out = dedupe(t.fx_incident, ["incident_number", "offense_code"], [F.col("load_seq").desc_nulls_last()])
    return out.select("incident_number", "offense_code", "load_seq")


@query(
    "dedupe_lowest",
    """SELECT coname, staddr, zip, year, min(try_cast(objectid AS INTEGER)) AS objectid FROM fx_store
       GROUP BY coname, staddr, zip, year""",
    ["fx_store"],
)
def _(t):
    rows = t.fx_store.withColumn("objectid", F.col("objectid").try_cast("int"))
    out = dedupe(rows, ["coname", "staddr", "zip", "year"], [F.col("objectid").asc_nulls_last()])
    return out.select("coname", "staddr", "zip", "year", "objectid")


@query(
    "dedupe_newest_year",
    """SELECT coname, staddr, location_id, data_year, objectid FROM (
       SELECT *, try_cast(year AS INTEGER) AS data_year, row_number() OVER (PARTITION BY upper(trim(coname)), upper(trim(staddr)), location_id
       ORDER BY try_cast(year AS INTEGER) DESC NULLS LAST, objectid) AS rn FROM fx_store) WHERE rn = 1""",
    ["fx_store"],
)
def _(t):
    rows = t.fx_store.withColumn("data_year", F.col("year").try_cast("int"))
    keys = [norm_text(F.col("coname")), norm_text(F.col("staddr")), F.col("location_id")]
    out = dedupe(rows, keys, [F.col("data_year").desc_nulls_last(), F.col("objectid").asc_nulls_last()])
    return out.select("coname", "staddr", "location_id", "data_year", "objectid")


@query(
    "district_lookup",
    """SELECT load_seq, i.district, coalesce(d.district_name, 'UNKNOWN') AS district_name
       FROM fx_incident i LEFT JOIN fx_district d ON upper(trim(i.district)) = upper(trim(d.district_code))""",
    CLEAN_NEEDS,
)
def _(t):
    out = lookup(
        t.fx_incident, t.fx_district, "district", {"district_name": "district_name"}, "district_code",
        norm=True, defaults={"district_name": "UNKNOWN"},
    )
    return out.select("load_seq", "district", "district_name")


@query(
    "drop_future",
    """SELECT event_id, ts FROM events WHERE ts IS NOT NULL AND ts <= TIMESTAMP '2024-01-20 12:00:00'""",
)
def _(t):
    return drop_future(t.events, "ts", "2024-01-20 12:00:00").select("event_id", "ts")


@query(
    "complete_months",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND date_trunc('month', o_orderdate) < TIMESTAMP '2001-07-01'""",
)
def _(t):
    rows = complete_months(since_year(t.orders, "o_orderdate", 1998), "o_orderdate", "2001-07-15 10:00:00")
    return rows.select("o_orderkey", month_of(F.col("o_orderdate")).alias("month"))


@query(
    "trailing_year",
    """SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT max(CAST(o_orderdate AS DATE)) - INTERVAL 12 MONTH FROM orders)""",
)
def _(t):
    return trailing_months(t.orders, "o_orderdate", 12).select("o_orderkey")


@query(
    "trailing_year_as_of",
    f"SELECT o_orderkey FROM orders WHERE o_orderdate >= CAST(TIMESTAMP '{ORDERS_AS_OF}' AS DATE) - INTERVAL 12 MONTH",
)
def _(t):
    return trailing_months(t.orders, "o_orderdate", 12, ORDERS_AS_OF).select("o_orderkey")


@query(
    "json_props",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def _(t):
    return t.events.select("event_id", json_path(F.col("props"), "$.k", "bigint").alias("k"))


@query(
    "text_functions",
    r"""SELECT doc_id, CAST(length(regexp_replace(text, '\s+', ' ', 'g')) AS INTEGER) AS squeezed_length,
        lower(replace(upper(source), '_', ' ')) AS source_words,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, chr(13) || chr(10), chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'),
          '[ \t]{2,}', ' ', 'g'), '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS blank_runs,
        coalesce(text LIKE '%the%' OR text LIKE '%der%', FALSE) AS has_article,
        coalesce(text ILIKE '%LICENSE%', FALSE) AS has_license, lang || ':' || source AS tag,
        printf('%.1f', round_even(n_chars / 7.0::DOUBLE, 1)) AS chars_text
        FROM documents""",
)
def _(t):
    text = F.col("text")
    return t.documents.select(
        "doc_id",
        F.length(squeeze_ws(text)).alias("squeezed_length"),
        humanize(F.upper("source")).alias("source_words"),
        normalize_blank_runs(text).alias("blank_runs"),
        F.coalesce(any_like(text, ["%the%", "%der%"]), F.lit(False)).alias("has_article"),
        F.coalesce(any_like(text, ["%LICENSE%"], ci=True), F.lit(False)).alias("has_license"),
        concat_strict(F.col("lang"), ":", F.col("source")).alias("tag"),
        fixed(F.col("n_chars").cast("double") / 7.0, 1).alias("chars_text"),
    )


@query(
    "number_functions",
    """SELECT c_custkey, round(c_acctbal, 1) AS half_up, round_even(c_acctbal, 0) AS half_even,
       least(greatest(c_acctbal, 0.0), 999.0) AS clamped,
       CASE WHEN c_custkey % 7 > 0 THEN c_acctbal / (c_custkey % 7) ELSE 0.0 END AS ratio,
       CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(c_custkey AS INTEGER) WHEN 2 THEN NULL ELSE NULL END AS parsed,
       coalesce(try_cast(CAST(c_custkey % 3 AS VARCHAR) AS INTEGER) = 1, FALSE) AS flagged
       FROM customer""",
)
def _(t):
    bal = F.col("c_acctbal")
    third = (F.col("c_custkey") % 3).cast("string")
    key = F.col("c_custkey").cast("string")
    numeral = (
        F.when(F.col("c_custkey") % 4 == 0, F.lit(" n/a ")).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit(" "), key))
        .when(F.col("c_custkey") % 4 == 2, F.concat(key, F.lit("x"))).otherwise(F.lit(""))
    )
    return t.customer.select(
        "c_custkey",
        round_half_up(bal, 1).alias("half_up"),
        round_half_even(bal, 0).alias("half_even"),
        clamp(bal, 0.0, 999.0).alias("clamped"),
        safe_ratio(bal, F.col("c_custkey") % 7).alias("ratio"),
        parse_number(numeral, ["N/A", ""]).alias("parsed"),
        flag_eq(third, 1).alias("flagged"),
    )


@query(
    "date_functions",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp, upper(monthname(o_orderdate)) AS month_name,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS year_before, strftime(o_orderdate, '%Y-%m') AS month_key
       FROM orders""",
)
def _(t):
    at = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        fmt_ts(at).alias("stamp"),
        month_name(F.month(at)).alias("month_name"),
        shift_months(at.cast("date"), -12).alias("year_before"),
        fmt_ts(at, "yyyy-MM").alias("month_key"),
    )


@query(
    "update_where",
    f"""SELECT load_seq, CASE WHEN {clean('street')} = 'UNKNOWN' THEN 'NOT GIVEN' ELSE street END AS street FROM fx_incident""",
    ["fx_incident"],
)
def _(t):
    from placestats.functions.text import clean_text

    out = update_where(t.fx_incident, clean_text(F.col("street")) == "UNKNOWN", "street", F.lit("NOT GIVEN"))
    return out.select("load_seq", "street")


@query(
    "bbox_share",
    """SELECT district, count(*) AS n, count(*) FILTER (coalesce(lat BETWEEN 42.20 AND 42.55 AND long BETWEEN -71.35 AND -70.85, FALSE)) AS n_inside
       FROM fx_incident GROUP BY district""",
    ["fx_incident"],
)
def _(t):
    return t.fx_incident.groupBy("district").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(in_box(F.col("lat"), F.col("long"))).alias("n_inside")
    )


@query(
    "explode_words",
    """SELECT p_partkey, CAST(i - 1 AS INTEGER) AS pos, words[i] AS word FROM (
       SELECT p_partkey, words, unnest(range(1, len(words) + 1)) AS i FROM (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part))""",
)
def _(t):
    rows = t.part.select("p_partkey", F.split("p_name", " ").alias("words"))
    return explode_pos(rows, "words", "word")


@query("upper_columns", 'SELECT s_suppkey AS "S_SUPPKEY", s_name AS "S_NAME", s_acctbal AS "S_ACCTBAL" FROM supplier')
def _(t):
    return upper_columns(t.supplier.select("s_suppkey", "s_name", "s_acctbal"))
