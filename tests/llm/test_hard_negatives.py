"""Hard negatives against plain Python over all pairs, and the parts of the scoring by themselves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from placestats.llm import hard_negatives
from placestats.llm.hard_negatives import bit_planes, mine, score_range, scores, subset_tables


def plain(rows, positives=5, negatives=10):
    """rows: (id, label, vector) that may hold nulls."""
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        kept[i] = min(kept.get(i, row), row)
    kept = {i: ((label + 1) % 10 if i % 7 == 0 else label, v) for i, (label, v) in kept.items()}
    out = set()
    for a, (la, va) in kept.items():
        if a % 100:
            continue
        s = {b: sum(x * y for x, y in zip(va, vb)) for b, (_, vb) in kept.items() if b != a and len(vb) == len(va)}
        first = sorted((b for b in s if kept[b][0] == la), key=lambda b: (-s[b], b))[:positives]
        for p in first:
            good = sorted((b for b in s if kept[b][0] != la and 30 * s[p] <= 100 * s[b] <= 90 * s[p]), key=lambda b: (-s[b], b))
            out |= {(a, p, n, b, s[p], s[b]) for n, b in enumerate(good[:negatives], 1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")


def result(df):
    got = df.collect()
    assert len({tuple(r) for r in got}) == len(got)
    return {tuple(r) for r in got}


@pytest.mark.parametrize("width", [0, 1, 7, 8, 9, 64])
def test_scores_are_inner_products(width):
    rng = np.random.default_rng(width)
    for top in (1, 255, 1 << 20, 1 << 28):
        rows, anchors = rng.integers(-top, top, (50, width)), rng.integers(-top, top, (7, width))
        assert (scores(bit_planes(rows), subset_tables(anchors)) == rows @ anchors.T).all()


def test_extreme_components():
    rows = np.array([[-(1 << 63), 1], [(1 << 63) - 1, -1], [0, 0], [-1, -1]])
    anchors = np.array([[1, 0], [0, 3]])
    assert (scores(bit_planes(rows), subset_tables(anchors)) == rows @ anchors.T).all()


@pytest.mark.parametrize("positive", [-100, -7, -1, 0, 1, 3, 10, 99, 10**18])
def test_score_range(positive):
    low, high = score_range(positive)
    fits = lambda s: 30 * positive <= 100 * s <= 90 * positive
    assert not fits(low - 1) and not fits(high + 1)
    assert (low <= high) == any(fits(s) for s in (low, high)) and (low > high or (fits(low) and fits(high)))


@pytest.mark.parametrize("blocks", [(8192, 2048), (37, 2)])
def test_against_all_pairs(spark, blocks, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CELLS", 100)
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(10, 12)) * 0.2
    rows = [(int(i), int(i % 10), [float(x) for x in middle[i % 10] + rng.normal(size=12) * 0.3]) for i in range(600)]
    rows += [(1000 + i, 3, rows[13][2]) for i in range(40)]  # a large group of one vector, half of it under other labels
    rows += [(2000 + i, i % 10, rows[13][2]) for i in range(40)]
    expected = plain(rows)
    assert len(expected) > 100
    assert result(mine(frame(spark, rows), row_block=blocks[0], anchor_block=blocks[1])) == expected


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (100, 1, [0.5, 0.5]), (101, 1, [0.5, 0.4]), (102, 1, [0.5, 0.4]), (103, 2, [0.3, 0.3]), (103, 2, [0.3, 0.3]), (103, 4, [0.9, 0.9]),
        (104, None, [0.3, 0.3]), (106, 2, None), (107, 2, [None, 0.3]), (108, 2, [nan, 0.3]), (109, 2, [inf, 0.3]), (None, 2, [0.3, 0.3]),
        (110, 2, [0.3]), (111, 2, []), (112, 1, [0.2, 0.2]), (200, 5, []), (201, 5, []), (202, 6, []), (300, 9, [1.0]), (0, 1, [-0.5, -0.5]),
        (-100, 1, [0.001, -0.001]),
    ]
    expected = plain(rows)
    assert any(r[0] == 100 for r in expected) and any(r[0] == 200 for r in expected)
    df = frame(spark, rows)
    assert result(mine(df)) == expected
    clash = df.withColumn("id", F.lit("x")).withColumn("d", F.lit(1)).withColumn("v", F.lit(2)).withColumn("rb", F.lit(3)).withColumn("positives", F.lit(4))
    assert result(mine(clash)) == expected
    assert result(mine(df.limit(0))) == set()
    assert mine(df.limit(0)).dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
