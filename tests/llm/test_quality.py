"""Quadratic discriminant against its textbook form, and held-out accuracy."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from placestats.llm.quality import FEATURES, drop_low_quality, features, fit, from_moments, statistics


def plain_log_odds(x, y, pool, ridge):
    parts = []
    covs = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    shared = sum((y == k).sum() * c for k, c in enumerate(covs)) / len(y)
    for k in (0, 1):
        cov = (1 - pool) * covs[k] + pool * shared
        cov = (1 - ridge) * cov + ridge * np.diag(np.diag(cov)) + 1e-4 * np.eye(len(cov))
        diff = x - x[y == k].mean(axis=0)
        m = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)
        parts.append(np.log(((y == k).sum() + 1) / (len(y) + 2)) - 0.5 * (m + np.linalg.slogdet(cov)[1]))
    return parts[1] - parts[0]


def test_matches_the_definition():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 500)
    x = rng.normal(size=(500, 4)) * (1 + y[:, None]) + y[:, None]
    n = np.array([(y == k).sum() for k in (0, 1)], float)
    model = from_moments(n, np.array([x[y == k].sum(0) for k in (0, 1)]), np.array([x[y == k].T @ x[y == k] for k in (0, 1)]), 0.1, 0.05)
    assert np.allclose(model.log_odds(x), plain_log_odds(x, y, 0.1, 0.05))


@pytest.mark.parametrize("n", [(0, 0), (3, 0), (0, 50)])
def test_missing_classes(n):
    d = len(FEATURES)
    model = from_moments(np.array(n, float), np.zeros((2, d)), np.zeros((2, d, d)), 0.1, 0.05)
    assert np.isfinite(model.score(np.zeros((2, d)))).all()


def test_edge_texts(spark):
    texts = [None, "", " ", "\n\n", "a", "🙂" * 10, "x" * 500_000, "no no no no"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("Features", F.lit(1))
    got = df.select("doc_id", features(F.col("text")).alias("v")).orderBy("doc_id").collect()
    for r, t in zip(got, texts):
        assert r.v == pytest.approx([float(x) for x in statistics(t or "")])
        assert np.isfinite(r.v).all() and len(r.v) == len(FEATURES)
    model = fit(df.select(F.lit(1).alias("label"), features(F.col("text")).alias("features")))
    assert drop_low_quality(df, model).columns == df.columns
    assert drop_low_quality(df.limit(0), model).count() == 0


def test_held_out(spark):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in entry.queries()["op7_quality_discriminant"](spark, folder).collect()}
    labels = duckdb.connect().execute(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall()
    assert len(got) == duckdb.connect().execute(f"SELECT count(*) FROM '{folder}/documents.parquet'").fetchall()[0][0]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    held = [(q, got[i].predicted) for i, q in labels if got[i].held_out]
    assert np.mean([q == p for q, p in held]) > 0.95
