"""Operators that keep the caller's columns, tried with the names they would take themselves."""

from pyspark.sql import functions as F

from placestats.llm.common import free_names
from placestats.llm.exact_dedup import drop_duplicates
from placestats.llm.line_dedup import drop_repeated_lines
from placestats.llm.pii import replace_entities
from placestats.llm.quality import drop_low_quality, features, fit, labelled_features
from placestats.llm.simhash import drop_near_duplicates

NAMES = ["row", "ROW_", "entries", "key", "__key", "__copy", "copy", "starts", "fp", "Rank", "collided", "score", "__llm_key", "__llm_entries", "__llm_rank", "__llm_score", "lines_cut", "n", "whole", "first", "found", "least", "id"]
ROWS = [(1, "Mail me at jo@example.org now\nand then\nmore lines\nhere"), (2, "other words stand here\nwith lines\nthree of them"), (2, "other words stand here\nwith lines\nthree of them"), (None, None), (4, "")]


def wide(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.select("*", *[F.lit(f"kept {n}").alias(n) for n in NAMES])


def test_free_names(spark):
    df = spark.range(1).select(F.lit(1).alias("A"), F.lit(1).alias("a_"), F.lit(1).alias("b"))
    assert free_names(df, "a", "a", "B", "c") == ["a__", "a___", "B_", "c"]


def kept(out, df):
    rows = out.collect()
    assert out.columns == df.columns
    assert all(r[n] == f"kept {n}" for r in rows for n in NAMES)
    return rows


def test_columns_stay(spark):
    df = wide(spark)
    assert len(kept(replace_entities(df, b"k"), df)) == 5
    assert len(kept(drop_repeated_lines(df), df)) == 5
    assert len(kept(drop_duplicates(df), df)) == 3
    assert len(kept(drop_duplicates(df, primes=(2, 3)), df)) == 3
    assert len(kept(drop_near_duplicates(df), df)) == 3
    known = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    vectors = labelled_features(df, known)
    assert vectors.columns == ["label", "features"] and vectors.count() == 3
    assert {tuple(r.features) for r in vectors.collect()} <= {tuple(r.f) for r in df.select(features(F.coalesce("text", F.lit(""))).alias("f")).collect()}
    assert len(kept(drop_low_quality(df, fit(vectors), least=0.0), df)) == 5
