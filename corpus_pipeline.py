"""The corpus pipeline: quality, exact and near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its
result is written as Parquet to the folder in `spark.checkpoint.dir` and read again as
the docs of the next. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placestats.llm.common import whole_text
from placestats.llm.exact_dedup import drop_duplicates
from placestats.llm.packing import pack
from placestats.llm.pii import replace_entities
from placestats.llm.quality import drop_low_quality, features
from placestats.llm.queries import SURROGATE_KEY, quality_model
from placestats.llm.simhash import drop_near_duplicates
from placestats.session import materialize

LEAST_QUALITY = 0.3
ORACLE_SQL = None  # the model, the hash and the tokenizer have no SQL form; tests hold run() against plain Python


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; the label columns stay unread outside the fit."""
    vectors = materialize(docs.select("doc_id", features(whole_text("text")).alias("features")))
    return drop_low_quality(docs, quality_model(spark, sf_dir, vectors), "text", LEAST_QUALITY)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest id."""
    return drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked fingerprints, that of the least id."""
    return drop_near_duplicates(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; `n_chars`, where present, follows the new text."""
    out = replace_entities(docs, SURROGATE_KEY)
    if "n_chars" in out.columns:
        kind = dict(out.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("PII surrogates", surrogates),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
