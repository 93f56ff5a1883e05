"""Dissolved geometries against cells of a grid, and closed forms."""

import random

import pytest
from pyspark.sql import functions as F

from placestats.functions.geometry import centroid, contains, geom_edges, geom_to_wkt, wkt_to_geom
from placestats.operators.dissolve import dissolve, signed_area


def box(x, y, w=1.0, h=1.0, clockwise=False):
    pts = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in (reversed(pts) if clockwise else pts)) + "))"


def shapes(spark, rows):
    return spark.createDataFrame(rows, "k string, wkt string").withColumn("geometry", wkt_to_geom(F.col("wkt"))).drop("wkt")


def described(df):
    rings = df.select("k", F.explode_outer("geometry").alias("p")).select("k", F.posexplode_outer("p").alias("at", "r"))
    out = rings.groupBy("k").agg(F.count_if(F.col("at") == 0).alias("o"), F.count_if(F.col("at") > 0).alias("h"), F.round(F.sum(signed_area(F.col("r"))), 6).alias("area"))
    return {r.k: (r.o, r.h, r.area) for r in out.collect()}


def components(cells, steps):
    left, n = set(cells), 0
    while left:
        n += 1
        todo = [left.pop()]
        while todo:
            x, y = todo.pop()
            for dx, dy in steps:
                if (x + dx, y + dy) in left:
                    left.remove((x + dx, y + dy))
                    todo.append((x + dx, y + dy))
    return n


SIDES = [(1, 0), (-1, 0), (0, 1), (0, -1)]
AROUND = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]


def test_grids(spark):
    """Random cells, some joined to wider parts: areas of cells, rings of connected cells and gaps."""
    rng = random.Random(4)
    rows, want = [], {}
    for g in range(12):
        cells = {(x, y) for x in range(6) for y in range(6) if rng.random() < 0.2 + 0.06 * g}
        left = set(cells)
        for x, y in sorted(cells):
            if (x, y) in left and (x + 1, y) in left and rng.random() < 0.5:
                left -= {(x, y), (x + 1, y)}
                rows.append((f"g{g}", box(x, y, 2.0, 1.0, rng.random() < 0.5)))
        rows += [(f"g{g}", box(x, y, clockwise=rng.random() < 0.5)) for x, y in left]
        gaps = {(x, y) for x in range(-1, 7) for y in range(-1, 7)} - cells
        if cells:
            want[f"g{g}"] = (components(cells, SIDES), components(gaps, AROUND) - 1, float(len(cells)))
    rng.shuffle(rows)
    got = described(dissolve(shapes(spark, rows), "k"))
    assert got == want and any(h for _, h, _ in want.values())


def test_forms(spark):
    rows = [
        ("two", box(0, 0)), ("two", box(1, 0)),
        ("corner", box(0, 0)), ("corner", box(1, 1)),
        ("same", box(0, 0)), ("same", box(0, 0, clockwise=True)),
        ("lake", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1))"), ("lake", box(1.5, 1.5)),
        ("filled", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))"), ("filled", box(1, 1, 2.0, 2.0)),
        ("slanted", "POLYGON ((0 0, 3 1, 3 3, 0 0))"), ("slanted", "POLYGON ((0 0, 1.5 0.5, 3 0, 0 0))"),
        ("none", None), ("many", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((1 0, 2 0, 2 1, 1 1, 1 0)), ((5 5, 6 5, 6 6, 5 6, 5 5)))"),
    ]
    merged = dissolve(shapes(spark, rows), "k")
    assert described(merged) == {
        "two": (1, 0, 2.0), "corner": (2, 0, 2.0), "same": (1, 0, 1.0), "lake": (2, 1, 13.0), "filled": (1, 0, 16.0), "slanted": (1, 0, 3.75), "none": (0, 0, None), "many": (2, 0, 3.0),
    }
    text = {r.k: r.t for r in merged.select("k", geom_to_wkt(F.col("geometry")).alias("t")).collect()}
    assert text["two"] == "POLYGON ((0.0 0.0, 1.0 0.0, 2.0 0.0, 2.0 1.0, 1.0 1.0, 0.0 1.0, 0.0 0.0))"
    middle = merged.where("k = 'two'").select(centroid(F.col("geometry")).alias("c")).first().c
    assert (middle.x, middle.y) == (1.0, 0.5)
    held = merged.where("k = 'lake'").select(*[contains(geom_edges(F.col("geometry")), F.lit(x), F.lit(x)).alias(n) for n, x in (("land", 0.5), ("water", 1.2), ("island", 2.0))]).first()
    assert tuple(held) == (True, False, True)


def test_empty(spark):
    none = shapes(spark, [("a", None)])
    assert [tuple(r) for r in dissolve(none, "k").collect()] == [("a", None)]
    assert dissolve(none.limit(0), "k").count() == 0


@pytest.mark.parametrize("n", [700])
def test_long_ring(spark, n):
    """A row of many squares: one long outline, put in order over several rounds."""
    rows = [("row", box(i, 0)) for i in range(n)]
    merged = dissolve(shapes(spark, rows), "k")
    assert described(merged) == {"row": (1, 0, float(n))}
    assert merged.select(F.size(F.col("geometry")[0][0])).first()[0] == 2 * n + 3
