"""Geometry expressions and spatial joins against closed forms and scalar code."""

import random

import pytest
from pyspark.sql import functions as F

from placestats.functions.geometry import centroid, geojson_to_geom, geom_edges, geom_to_geojson, geom_to_wkt, wkt_to_geom
from placestats.operators.spatial import _segments, adjacency, collect_geometry, cover_cells, segment_cells, spatial_join

SQUARE = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
HOLED = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))"
PARTS = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((2 0, 4 0, 4 2, 2 2, 2 0)))"


def polygons(spark, rows):
    return spark.createDataFrame(rows, "location_id int, wkt string").withColumn("geometry", wkt_to_geom(F.col("wkt")))


def test_wkt_forms(spark):
    rows = [(1, SQUARE), (2, HOLED), (3, PARTS), (4, "POINT (1 2)"), (5, None), (6, " polygon((-1.5e-1 2,3 4,5 6,-1.5e-1 2)) ")]
    out = {r["location_id"]: r for r in polygons(spark, rows).select("location_id", "geometry", geom_to_wkt(F.col("geometry")).alias("t")).collect()}
    assert [len(p) for p in out[2]["geometry"]] == [2]
    assert len(out[3]["geometry"]) == 2
    assert out[4]["geometry"] is None and out[5]["geometry"] is None
    assert out[6]["geometry"][0][0][0]["x"] == -0.15
    assert out[1]["t"] == "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 4.0, 0.0 0.0))"
    assert out[3]["t"].startswith("MULTIPOLYGON (((0.0 0.0")


def test_geojson_forms(spark):
    df = polygons(spark, [(1, SQUARE), (3, PARTS)]).withColumn("g", geom_to_geojson(F.col("geometry")))
    kind, coords = F.get_json_object("g", "$.type"), F.get_json_object("g", "$.coordinates")
    back = df.select("location_id", kind.alias("k"), (geojson_to_geom(kind, coords) == F.col("geometry")).alias("same")).collect()
    assert {r["location_id"]: r["k"] for r in back} == {1: "Polygon", 3: "MultiPolygon"}
    assert all(r["same"] for r in back)


def test_centroid_closed_forms(spark):
    clockwise = "POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0))"
    rows = [(1, SQUARE), (2, HOLED), (3, PARTS), (4, clockwise), (5, None)]
    out = polygons(spark, rows).select("location_id", centroid(F.col("geometry")).alias("c"))
    got = {r["location_id"]: r["c"] and (r["c"]["x"], r["c"]["y"]) for r in out.collect()}
    assert got[1] == got[4] == (2.0, 2.0)
    assert got[2] == (round((16 * 2 - 1.5) / 15, 6), round((16 * 2 - 1.5) / 15, 6))
    assert got[3] == (round((0.5 + 4 * 3) / 5, 6), round((0.5 + 4 * 1) / 5, 6))
    assert got[5] is None or got[5] == (None, None)


def inside(edges, x, y):
    odd = False
    for x1, y1, x2, y2 in edges:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


@pytest.mark.parametrize("cell", [0.3, 1.0, 25.0])
def test_spatial_join_equals_ray_casting(spark, cell):
    """Random star-shaped polygons, one with a hole; cells small and large."""
    import math

    rnd = random.Random(1)
    rows = [(0, HOLED)]
    for i in range(1, 12):
        cx, cy, n = rnd.uniform(-5, 5), rnd.uniform(-5, 5), rnd.randint(3, 14)
        pts = []
        for k in range(n):
            r, a = rnd.uniform(0.3, 3), 2 * math.pi * k / n
            pts.append((cx + r * math.cos(a), cy + r * math.sin(a)))
        pts.append(pts[0])
        rows.append((i, "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in pts) + "))"))
    polys = polygons(spark, rows)
    points = [(i, rnd.uniform(-8, 8), rnd.uniform(-8, 8)) for i in range(1500)] + [(9000, None, 1.0)]
    df = spark.createDataFrame(points, "id int, long double, lat double")
    edges = {r["location_id"]: [tuple(e) for e in r["e"]] for r in polys.select("location_id", geom_edges(F.col("geometry")).alias("e")).collect()}
    want = {(i, p) for i, x, y in points if x is not None for p, es in edges.items() if inside(es, x, y)}
    got = spatial_join(df, polys, cell=cell)
    assert {(r["id"], r["location_id"]) for r in got.collect()} == want
    left = spatial_join(df, polys, cell=cell, how="left", valid=F.col("id") % 2 == 0)
    rows = {(r["id"], r["location_id"]) for r in left.collect()}
    assert {r for r in rows if r[1] is not None} == {w for w in want if w[0] % 2 == 0}
    assert {r[0] for r in rows} == {p[0] for p in points}


def test_spatial_join_plan_has_no_nested_loop(spark):
    df = spark.range(10).selectExpr("id", "id * 1.0D as long", "id * 1.0D as lat")
    joined = spatial_join(df, polygons(spark, [(1, SQUARE)]))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_adjacency(spark):
    rows = [
        (1, SQUARE),
        (2, "POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))"),  # shares a border with 1
        (3, "POLYGON ((8 4, 9 4, 9 5, 8 5, 8 4))"),  # touches 2 in a corner
        (4, "POLYGON ((1 1, 2 1, 2 2, 1 2, 1 1))"),  # lies inside 1
        (5, "POLYGON ((20 20, 21 20, 21 21, 20 20))"),  # far away
    ]
    got = {(r["a"], r["b"]) for r in adjacency(polygons(spark, rows)).collect()}
    assert got == {(1, 2), (2, 1), (2, 3), (3, 2), (1, 4), (4, 1)}


def test_collect_geometry(spark):
    rows = polygons(spark, [(1, SQUARE), (1, PARTS), (2, HOLED)])
    got = {r["location_id"]: len(r["geometry"]) for r in collect_geometry(rows.withColumn("at", F.monotonically_increasing_id()), ["location_id"], "at").collect()}
    assert got == {1: 3, 2: 1}


def test_one_wide_polygon_among_many_small(spark):
    """One polygon a thousand times wider: no polygon covers many cells, and all containments are found."""
    square = lambda x, y, w: f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + w}, {x} {y + w}, {x} {y}))"
    rows = [(0, square(-5.0, -5.0, 10.0))] + [(i, square(0.02 * (i % 20), 0.02 * (i // 20), 0.01)) for i in range(1, 200)]
    polygons = spark.createDataFrame(rows, "location_id int, w string").withColumn("geometry", wkt_to_geom(F.col("w"))).drop("w")
    per = cover_cells(polygons, "geometry").groupBy("location_id").count().agg(F.max("count")).first()[0]
    assert per < 200
    rnd = random.Random(1)
    points = [(i, rnd.uniform(-0.1, 0.5), rnd.uniform(-0.1, 0.3)) for i in range(300)] + [(300, 9.0, 9.0), (301, None, 1.0)]
    df = spark.createDataFrame(points, "id int, long double, lat double")
    want = set()
    for i, x, y in points:
        found = [0] if x is not None and -5 <= x < 5 and -5 <= y < 5 else []
        for j in range(1, 200):
            a, b = 0.02 * (j % 20), 0.02 * (j // 20)
            if x is not None and a <= x < a + 0.01 and b <= y < b + 0.01:
                found.append(j)
        want |= {(i, j) for j in found} or {(i, None)}
    got = spatial_join(df, polygons, how="left").select("id", "location_id").collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    inner = spatial_join(df, polygons).select("id", "location_id").collect()
    assert set(map(tuple, inner)) == {w for w in want if w[1] is not None}
    lowest = spatial_join(df, polygons, how="left", one_match="location_id", point_key=["id"]).select("id", "location_id").collect()
    assert set(map(tuple, lowest)) == {(i, min((j for k, j in want if k == i and j is not None), default=None)) for i, _, _ in points}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_points_shuffle_once_whatever_the_sizes(spark, how):
    """Four sizes of polygons, no broadcast: the rows of the points pass one exchange."""
    square = lambda x, y, w: f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + w}, {x} {y + w}, {x} {y}))"
    rows = [(i, square(-0.5 * 10**i, -0.5 * 10**i, 1.0 * 10**i)) for i in range(4)]
    points = spark.range(200).selectExpr("id", "(id - 100) * 7.3D as long", "(id - 100) * -3.1D as lat", "uuid() as payload")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spatial_join(points, polygons(spark, rows), how=how)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        got = {(r.id, r.location_id) for r in joined.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("SortMergeJoin") == 1 and "NestedLoop" not in plan
    assert plan.count("hashpartitioning(_kx") == 2  # the points, and the cells they are looked up in
    want = {(i, p) for i in range(200) for p in range(4) if abs((i - 100) * 7.3) < 0.5 * 10**p and abs((i - 100) * 3.1) < 0.5 * 10**p}
    assert want and {g for g in got if g[1] is not None} == want
    assert {g[0] for g in got} == (set(range(200)) if how == "left" else {w[0] for w in want})


def test_no_polygon_at_all(spark):
    points = spark.range(3).selectExpr("id", "1.0D as long", "1.0D as lat")
    none = polygons(spark, [(1, None)])
    assert spatial_join(points, none).count() == 0
    assert [r.location_id for r in spatial_join(points, none, how="left").collect()] == [None] * 3
    assert adjacency(none).count() == 0


def touch(a, b):
    """Two axis-parallel segments with a common point."""
    return max(a[0], b[0]) <= min(a[2], b[2]) and max(a[1], b[1]) <= min(a[3], b[3])


def test_adjacency_of_very_different_lengths(spark):
    """A polygon a thousand times wider adds no more rows per segment than any other."""
    square = lambda x, y, w: f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + w}, {x} {y + w}, {x} {y}))"
    small = [(i, round(0.37 * (i % 15), 2), round(0.25 * (i // 15), 2), 0.25) for i in range(1, 120)]
    rows = [(0, square(-100.0, 1.0, 250.0)), *[(i, square(x, y, w)) for i, x, y, w in small]]
    polys = polygons(spark, rows)
    cells = segment_cells(_segments(polys, "location_id", "geometry", 9))
    assert cells.groupBy("location_id", "e").count().agg(F.max("count")).first()[0] <= 4
    sides = {i: [(x, y, x + w, y), (x + w, y, x + w, y + w), (x, y + w, x + w, y + w), (x, y, x, y + w)] for i, x, y, w in [(0, -100.0, 1.0, 250.0), *small]}
    sides = {i: [tuple(round(v, 9) for v in s) for s in ss] for i, ss in sides.items()}
    want = {(a, b) for a in sides for b in sides if a != b and any(touch(s, t) for s in sides[a] for t in sides[b])}
    inside = {i for i, x, y, w in small if 1.0 <= y}  # within the wide one
    want |= {(0, i) for i in inside} | {(i, 0) for i in inside}
    assert {(r["a"], r["b"]) for r in adjacency(polys).collect()} == want
