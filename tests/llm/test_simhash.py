"""SimHash near-duplicates against a plain double loop."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from placestats.llm.simhash import (
    drop_near_duplicates, fingerprint_classes, fingerprint_of, linked_classes, near_duplicates,
)


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius=4):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def same_classes(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("text", ["", " \n", "one", "A b\tC d", "É É É É é", "x y z " * 400, "a b c d e f", "word w q r s t u"])
def test_fingerprint(text):
    assert fingerprint_of(text) == slow_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c é")).alias("h")).first().h % 2**64 == xxhash.xxh64_intdigest("a b c é".encode(), 42)


def dense(rng, groups=4, size=60, lone=40):
    values = {rng.getrandbits(64) for _ in range(lone)}
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(size):
            v = centre
            for _ in range(rng.randrange(6)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    return sorted(values)


def test_tree_search_finds_every_link():
    values = dense(random.Random(1))
    fp = np.array(values, dtype=np.uint64)
    every = np.ones(len(fp), bool)
    assert same_classes(linked_classes(fp, np.zeros(len(fp), int), every, every, 4).tolist(), components(values))


@pytest.mark.parametrize("tree_rows", [2048, 7])
def test_classes(spark, tree_rows):
    values = dense(random.Random(2))
    signed = [v - 2**64 if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.fp: r.root for r in fingerprint_classes(df, tree_rows=tree_rows).collect()}
    assert same_classes([got[v] for v in signed], components(values))


def test_rows(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(300)) for _ in range(4)]
    rows = [(i, t + f" tail{i}") for i, t in enumerate(base * 3)] + [(50, None), (51, ""), (51, ""), (None, "lone words here"), (60, base[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("FP", F.lit(1)).withColumn("component_id", F.lit("x"))
    got = near_duplicates(df).collect()
    values = [slow_fingerprint(t or "") for _, t in rows]
    classes = components(values)
    want = sorted((i if i is not None else -1, min((r[0] for r, k in zip(rows, classes) if k == c and r[0] is not None), default=-1)) for (i, _), c in zip(rows, classes))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.component_id if r.component_id is not None else -1) for r in got) == want
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(classes))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({w for _, w in want if w != -1})


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).count() == 0
    assert drop_near_duplicates(df).count() == 0
