"""Exact de-duplication against grouping in Python, with fingerprints made to collide."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from placestats.llm.exact_dedup import CHUNK, PRIMES, Polynomial, drop_duplicates, duplicate_groups


def test_chunks_combine():
    data = np.random.default_rng(5).integers(0, 256, 1000, dtype=np.uint8).tobytes()
    small, one = Polynomial(3, chunk=64), Polynomial(3, chunk=4096)
    assert small.key(data) == one.key(data)
    for p, base, got in zip(PRIMES, one.bases, one.chunks(np.frombuffer(data, np.uint8))[0][0]):
        want = 0
        for b in data:
            want = (want * base + b) % p
        assert got == want
    for cut in (0, 1, 64, 999, 1000):
        parts = [one.chunks(np.frombuffer(x, np.uint8))[0] for x in (data[:cut], data[cut:])]
        assert one.combine(*parts) == one.chunks(np.frombuffer(data, np.uint8))[0]


ROWS = [
    (1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, " "), (7, "é"), (8, "é"), (9, "x" * (2 * CHUNK + 5)),
    (10, "x" * (2 * CHUNK + 5)), (11, "x" * (2 * CHUNK + 4) + "y"), (12, "ab"), (13, "ba"), (12, "ab"), (12, "ab"), (None, "ab"), (None, "lone"),
]


def want_rows():
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[t or ""].append(i)
    out, kept = [], set()
    for i, t in ROWS:
        members = groups[t or ""]
        keep = max((m for m in members if m is not None), default=None)
        stays = i == keep and (t or "") not in kept
        if stays:
            kept.add(t or "")
        out.append((str(i), str(keep), len(members), stays, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("primes", [PRIMES, (2, 3)])
def test_groups(spark, primes):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("FP", F.lit(1)).withColumn("kept", F.lit(1)).repartition(3)
    got = duplicate_groups(df, primes=primes).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == want_rows()


@pytest.mark.parametrize("primes", [PRIMES, (2, 3)])
def test_rows_that_stay(spark, primes):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("rank", F.lit(1))
    kept = drop_duplicates(df, primes=primes)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted({(w[1], t) for w, t in zip(want_of(), [t or "" for _, t in ROWS])})


def want_of():
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[t or ""].append(i)
    return [(i, str(max((m for m in groups[t or ""] if m is not None), default=None))) for i, t in ROWS]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert duplicate_groups(df).count() == 0
    assert drop_duplicates(df).count() == 0
