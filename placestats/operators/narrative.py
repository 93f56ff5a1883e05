"""Text preparation: row descriptions, prompts, fallbacks, reports and map features."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats import constants as K
from placestats.functions.dates import month_name
from placestats.functions.geometry import geom_to_geojson
from placestats.functions.nested import get_or
from placestats.functions.rules import reliability
from placestats.functions.text import fill_template, fixed, humanize, split_trim, truncate_text
from placestats.operators.ranking import dedupe


def _when(cond: Column, sentence: Column | str) -> Column:
    text = F.lit(sentence) if isinstance(sentence, str) else sentence
    return F.when(cond, text).otherwise(F.lit(""))


def _flag_sentences(flags: Sequence[tuple[str, str]]) -> list[Column]:
    return [_when(F.col(name), sentence) for name, sentence in flags]


def describe_incident(df: DataFrame, name: str = "row_description") -> DataFrame:
    """One sentence group per incident; a null part blanks the whole text."""
    street = _when(F.col("street").isNotNull() & (F.col("street") != K.NO_SOURCE_AREA), fill_template(K.INCIDENT_STREET))
    text = F.concat(
        fill_template(K.INCIDENT_TEXT, offense_lower=F.lower("offense_description")),
        street,
        fill_template(K.INCIDENT_WHEN, month_name=month_name(F.col("month"))),
        *_flag_sentences(K.INCIDENT_FLAGS),
    )
    return df.withColumn(name, text)


def describe_store(df: DataFrame, name: str = "row_description") -> DataFrame:
    text = F.concat(
        fill_template(K.STORE_TEXT, type_words=humanize(F.col("store_type"))),
        *_flag_sentences(K.STORE_FLAG_TEXT),
        fill_template(K.STORE_SOURCE),
    )
    return df.withColumn(name, text)


def describe_facility(df: DataFrame, name: str = "row_description") -> DataFrame:
    def known(col: str) -> Column:
        return F.col(col).isNotNull() & (F.col(col) != K.MISSING_INT)

    text = F.concat(
        fill_template(
            K.FACILITY_TEXT,
            type_words=F.lower(F.coalesce("facility_type", F.lit(K.FACILITY_NO_TYPE))),
            area_words=F.coalesce("neighborhood_name", F.lit(K.FACILITY_NO_AREA)),
            city_words=F.coalesce("city_name", "city", F.lit(K.FACILITY_NO_CITY)),
        ),
        _when(
            F.col("facility_type_group").isNotNull(),
            fill_template(K.FACILITY_GROUP_TEXT, group_words=F.lower("facility_type_group")),
        ),
        _when(known("bed_count"), fill_template(K.FACILITY_BEDS)),
        _when(known("adult_day_health_capacity"), fill_template(K.FACILITY_CAPACITY)),
        *_flag_sentences(K.FACILITY_FLAG_TEXT),
    )
    return df.withColumn(name, text)


def _text_or(col: str, missing: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(missing))


def build_prompt(df: DataFrame, domain: str, name: str = "prompt") -> DataFrame:
    """Prompt column for `crime`, `grocery` or `healthcare` area rows."""
    if domain == "crime":
        text = fill_template(
            K.CRIME_PROMPT,
            recent_avg_text=fixed(F.col("recent_avg")),
            prev_avg_text=fixed(F.col("prev_year_avg")),
            mape_text=_text_or("train_mape", "None"),
            clusters_text=_text_or("n_hotspot_clusters", "unknown"),
            share_text=_text_or("hotspot_crime_share_pct", "unknown"),
        )
    elif domain == "grocery":
        text = fill_template(
            K.GROCERY_PROMPT, data_year_text=_text_or("data_year", "unknown"), tier_label=humanize(F.col("access_tier"))
        )
    elif domain == "healthcare":
        text = fill_template(K.HEALTHCARE_PROMPT)
    else:
        raise ValueError(f"no prompt for domain {domain!r}")
    return df.withColumn(name, text)


def fallback_text(domain: str) -> Column:
    """Deterministic narrative used when no model answers."""
    if domain == "crime":
        return fill_template(K.CRIME_FALLBACK)
    return fill_template(K.GROCERY_FALLBACK, tier_label=humanize(F.col("access_tier")))


def narrate(
    df: DataFrame, prompt_col: str, fallback: Column, name: str, model: Callable[[list[str]], list[str]] | None = None
) -> DataFrame:
    """Narrative column from a model callable, batch by batch, else the fallback.

    A batch the model fails on falls back as a whole and does not fail the job.
    """
    if model is None:
        return df.withColumn(name, fallback)

    @F.pandas_udf("string")
    def answer(prompts: pd.Series) -> pd.Series:
        try:
            return pd.Series([a.strip() if a else None for a in model(list(prompts))])
        except Exception:  # noqa: BLE001 - any model error means no answer
            return pd.Series([None] * len(prompts), dtype=object)

    return df.withColumn(name, F.coalesce(answer(F.col(prompt_col)), fallback))


def crime_reliability() -> Column:
    return reliability(
        F.col("train_mape") > K.MAPE_LOW_RELIABILITY,
        F.col("n_months") < K.MIN_MONTHS,
        F.col("total") < K.MIN_RELIABLE_TOTAL,
    )


def grocery_reliability() -> Column:
    return reliability(F.col("total_stores") < K.MIN_RELIABLE_STORES)


# --- reports ----------------------------------------------------------------


def text_report(
    df: DataFrame, block: Column, order: Sequence[str], sep: str = "\n\n", max_chars: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Blocks joined to one text per key `by`, in order, optionally cut to `max_chars`.

    A text over the whole table needs `max_chars`: a cut text can only hold so many
    separators, so no more than that many leading rows are brought together. Texts per
    key hold the rows of their key, however many keys there are.
    """
    if not by and max_chars is None:
        raise ValueError("give `by`, or `max_chars` for a text over all rows")
    rows = df.select(*by, *[c for c in order if c not in by], block.alias("_block")).where(F.col("_block").isNotNull())
    if not by:
        rows = rows.orderBy(*order).limit(math.ceil(max_chars / len(sep)) + 1)
    joined = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct(*order, "_block"))), lambda r: r["_block"]), sep
    )
    return rows.groupBy(*by).agg((joined if max_chars is None else truncate_text(joined, max_chars)).alias("report"))


def context_blocks(df: DataFrame, tagged: bool = False) -> Column:
    """The facts of one area as a text block."""
    facts = fill_template(
        K.CONTEXT_FACTS,
        avg_text=fixed(F.col("recent_avg_monthly")),
        mape_text=F.coalesce(fixed(F.col("train_mape"), 1), F.lit("N/A")),
        reliability_text=_text_or("reliability_flag", "N/A"),
        summary_text=_text_or("safety_narrative", "N/A"),
    )
    return F.concat(fill_template(K.CONTEXT_HEAD_TAGGED if tagged else K.CONTEXT_HEAD), facts)


def prompt_context(df: DataFrame, selected: str | None = None, pairs: DataFrame | None = None, max_chars: int = K.CONTEXT_CHARS) -> DataFrame:
    """Context text of all areas, or of one area, its neighbours and who borders it.

    `pairs` (a, b) holds adjacent names.
    """
    if selected is None:
        return text_report(df, context_blocks(df), ["neighborhood_name"], max_chars=max_chars)
    near = pairs.where(F.col("a") == selected).select("b").distinct()
    name = F.col("neighborhood_name")
    rows = df.join(near, name == F.col("b"), "left").where((name == selected) | F.col("b").isNotNull())
    tag = F.when(name == selected, F.lit(K.CONTEXT_SELECTED)).otherwise(F.lit(K.CONTEXT_ADJACENT))
    tagged = rows.withColumn("tag", tag)
    report = text_report(tagged, context_blocks(tagged, tagged=True), ["neighborhood_name"], max_chars=max_chars)
    names = F.array_join(F.sort_array(F.collect_set("b")), ", ")
    borders = near.agg(F.coalesce(F.nullif(names, F.lit("")), F.lit("None")).alias("n")).scalar()
    tail = fill_template(K.CONTEXT_TAIL, selected=F.lit(selected), neighbours=borders)
    return report.select(truncate_text(F.concat("report", tail), max_chars).alias("report"))


def rows_as_csv(df: DataFrame, cols: Sequence[str], n: int, order: Sequence[Column]) -> DataFrame:
    """The first `n` rows as CSV text with a header line."""
    options = {"escape": '"', "emptyValue": "", "nullValue": ""}
    line = F.to_csv(F.struct(*cols), options)
    head = df.orderBy(*order).limit(n)
    listed = head.select(line.alias("_line"), F.struct(*[F.col(c) for c in cols]).alias("_row"))
    numbered = listed.select(F.monotonically_increasing_id().alias("_i"), "_line")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("_i", "_line"))), lambda r: r["_line"])
    return numbered.agg(F.concat(F.lit(",".join(cols) + "\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("csv"))


# --- map features -------------------------------------------------------------


def features(df: DataFrame, props: Mapping[str, Column], geom: str = "geometry", selected: str | None = None,
             name: str = "neighborhood_name", keep: Sequence[str] = ()) -> DataFrame:
    """One GeoJSON Feature text per row, beside `keep`; rows without a usable geometry are left out."""
    shape = geom_to_geojson(F.col(geom))
    chosen = F.coalesce(F.col(name) == selected, F.lit(False)) if selected is not None else F.lit(False)
    fields = F.struct(*[c.alias(k) for k, c in props.items()], chosen.alias("is_selected"))
    body = F.to_json(fields, {"ignoreNullFields": "false"})
    rows = df.withColumns({"_shape": shape, "_props": body}).where(F.col("_shape").isNotNull())
    text = F.concat(F.lit('{"type":"Feature","geometry":'), F.col("_shape"), F.lit(',"properties":'), F.col("_props"), F.lit("}"))
    return rows.select(name, *keep, text.alias("feature"))


def feature_collection(feats: DataFrame, by: str, order: str = "neighborhood_name") -> DataFrame:
    """One FeatureCollection text per key (a city, a map tile) from feature rows.

    A collection is one document, so its key must bound it; the feature rows themselves
    are the form for sets of any size, one feature per line.
    """
    rows = F.transform(F.sort_array(F.collect_list(F.struct(order, "feature"))), lambda r: r["feature"])
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(rows, ","), F.lit("]}"))
    return feats.groupBy(by).agg(text.alias("geojson"))


# --- headings -------------------------------------------------------------------


def parse_code_names(headings: DataFrame, text: str = "text", order: Sequence[str] = ("pos",)) -> DataFrame:
    """Rows (code, name) from headings like `A1 & A15 (X & Y)`.

    Codes and names pair up by position; a code without a name of its own gets the
    whole name. The first heading that mentions a code wins.
    """
    col = F.col(text)
    inner = F.replace(F.split_part(col, F.lit("("), F.lit(2)), F.lit(")"), F.lit(""))
    parsed = headings.where(col.contains("(") & col.contains(")")).select(
        *order,
        split_trim(F.trim(F.split_part(col, F.lit("("), F.lit(1))), "&").alias("_codes"),
        F.upper(F.trim(inner)).alias("_whole"),
    )
    rows = parsed.withColumn("_names", split_trim(F.col("_whole"), "&")).select(
        *order, "_whole", "_names", F.posexplode("_codes").alias("_i", "code")
    )
    named = rows.where(F.col("code") != "").withColumn("name", get_or(F.col("_names"), F.col("_i"), F.col("_whole")))
    keys = [F.col(o).asc_nulls_last() for o in (*order, "_i")]
    return dedupe(named, ["code"], keys).select("code", "name")
