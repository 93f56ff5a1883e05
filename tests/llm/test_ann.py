"""Collision counting against brute force."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from placestats.llm.ann import Block, directions, nearest, threshold


def brute(rows, queries, k=10):
    """query id -> list of (score, id), exact."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for qid, q in queries:
        d = np.sqrt(((vectors - np.array(q, dtype=np.float64)) ** 2).sum(axis=1))
        own = ids != qid
        order = np.lexsort((ids[own], d[own]))[:k]
        out[qid] = list(zip(d[own][order].tolist(), ids[own][order].tolist()))
    return out


def recall(got, want):
    return sum(len({i for _, i in got.get(q, [])} & {i for _, i in w}) for q, w in want.items()) / max(1, sum(map(len, want.values())))


def collect(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("spread", [0.0, 0.3])
def test_block(spread):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(3000, 24)) * (1 + 9 * (rng.random((3000, 1)) < spread))
    planes = directions(24, 64, 1)
    block = Block(np.arange(3000), vectors, planes)
    rows = list(enumerate(vectors))
    want = brute(rows, rows[:60])
    got = {q: block.search(v, block.ids == q, v @ planes, 10, 2.0, threshold()) for q, v in rows[:60]}
    assert recall(got, want) > 0.9


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    table = pq.read_table(f"{folder}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"]) for r in table]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0])
    got = collect(entry.queries()["op6_collision_counting_ann"](spark, folder))
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    assert recall(got, want) > 0.9
    exact = {q: dict((i, s) for s, i in brute(rows, [(q, dict(rows)[q])], k=len(rows))[q]) for q in list(got)[:3]}
    assert all(s == pytest.approx(exact[q][i], rel=1e-12) for q in exact for s, i in got[q])


def test_many_blocks_and_equal_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(1000 + i, [1.0] * 8) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("ID", F.lit(1)).withColumn("d", F.lit("x"))
    want = brute(rows, rows[::20])
    ids = [r[0] for r in rows[::20]]
    got = collect(nearest(df, df.where(F.col("vec_id").isin(ids)), row_block=64, query_block=7))
    assert recall(got, want) > 0.9
    equal = [i for i in ids if i >= 1000]
    assert all(got[i] == [(0.0, j) for j in range(1000, 1011) if j != i][:10] for i in equal)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collect(nearest(df, df))
    assert got == {1: [(np.sqrt(2.0), 2)], 2: [(np.sqrt(2.0), 1)]}
    assert nearest(df.limit(0), df).count() == 0 and nearest(df, df.limit(0)).count() == 0
