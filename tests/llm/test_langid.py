"""Language identification: held-out accuracy, gradients of the fold, edge texts."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from placestats.llm import langid
from placestats.llm.langid import GRAMS, fit, hash_limit, identify, prepared, sample, subwords, train


def plain_subwords(text, n):
    data = prepared(text).tobytes()
    return [data[i : i + n] for i in range(len(data) - n + 1) if b" " not in data[i + 1 : i + n - 1]]


@pytest.mark.parametrize("text", ["Hello, World", "", "a", "Ünï cödé 12", "x  y"])
def test_subwords(text):
    for n in GRAMS:
        grams = plain_subwords(text, n)
        codes = subwords(prepared(text), n, 1 << 16)
        assert len(codes) == len(grams)
        assert len({(g, c) for g, c in zip(grams, codes.tolist())}) == len(set(grams))


def rows(n=80):
    words = {"aa": ["the", "and", "of", "with"], "bb": ["und", "der", "nicht", "ein"], "cc": ["que", "les", "dans", "est"]}
    rng = np.random.default_rng(1)
    return [(" ".join(rng.choice(words[lang], 12)), lang) for lang in words for _ in range(n)]


def test_learns_and_rejects():
    model = train(rows(), buckets=1 << 12)
    assert all(model.predict(t)[0] == lang for t, lang in rows(20))
    assert model.predict("the and of with " * 20)[2] and 0.5 < model.predict("the and of with " * 20)[1] <= 1
    assert model.predict("zzz qqq xxx kkk")[1] < model.predict("the and of with the")[1]


def test_blocks_agree_with_one_pass(monkeypatch):
    model = train(rows(), buckets=1 << 12)
    text = "der nicht ein und " * 200
    whole = model.predict(text)
    monkeypatch.setattr(langid, "BLOCK", 18 * 4 * 5)  # cuts fall between words
    assert model.predict(text)[0] == whole[0] and model.predict(text)[1] == pytest.approx(whole[1], abs=0.01)


def test_edges(spark):
    texts = [(1, "the and of with", "aa"), (2, None, "aa"), (3, "", None), (4, "12 34 !!", "bb"), (None, "und der nicht", "bb"), (6, "the " * 300_000, None), (6, "の 言", "cc")]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string").withColumn("ID", F.lit(1)).withColumn("draw", F.lit(1)).withColumn("n", F.lit(2))
    got = df.select("doc_id", identify(F.col("text"), fit(df)).alias("f")).collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r.f for r in got}
    assert [by[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and all(by[i].score == 0 and not by[i].accepted for i in (2, 3, 4))
    assert all(r.f.lang_pred in ("aa", "bb", "cc", "und") and 0 <= r.f.score <= 1 for r in got)
    empty = fit(df.limit(0))
    assert [r.f.lang_pred for r in df.select(identify(F.col("text"), empty).alias("f")).collect()] == ["und"] * len(texts)


def test_held_out(spark):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in entry.queries()["op4_language_id"](spark, folder).collect()}
    truth = duckdb.connect().execute(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall()
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in truth)
    assert np.mean([got[i].lang_pred == lang for i, lang in truth if got[i].held_out and lang]) > 0.95


def test_hash_limit_never_closes():
    for n in (1, 59, 60, 61, 10**6, 61_000_000, 3 * 10**9, 10**15):
        passed = (hash_limit(60, n) + (1 << 63)) / (1 << 64)
        assert passed == pytest.approx(min(1, 60 / n)) and passed > 0


def test_every_language_is_sampled(spark):
    df = spark.createDataFrame([(i, f"the {i}", "aa") for i in range(5)], "doc_id long, text string, lang string")
    same = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("und der nicht").alias("text"), F.lit("bb").alias("lang"))
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("que les "), "id").alias("text"), F.lit("cc").alias("lang"))
    long = spark.createDataFrame([(i, "hund " * (4000 + i), "dd") for i in range(1, 4)], df.schema)
    rows = sample(df.unionAll(same).unionAll(many).unionAll(long), "doc_id", "text", "lang", rows=8).collect()
    got = {lang: sorted(r.text for r in rows if r.lang == lang) for lang in ("aa", "bb", "cc", "dd")}
    assert {lang: len(texts) for lang, texts in got.items()} == dict.fromkeys(got, 2)
    assert got["dd"] == ["hund " * 4000] * 2
    assert got["cc"] == sorted(r.text for r in many.orderBy(F.xxhash64("doc_id", "text")).limit(2).collect())
