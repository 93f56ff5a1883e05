"""DBSCAN against brute force, and its parts."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from placestats import session
from placestats.operators import cluster
from placestats.operators.cluster import connected_components, dbscan


def brute_force(points, eps, least):
    """points: (id, lat, lon) in id order -> {id: (cluster, is_core)}"""
    ids = [p[0] for p in points]
    lat, lon = np.radians([p[1] for p in points]), np.radians([p[2] for p in points])
    chord = np.sin((lat[:, None] - lat) / 2) ** 2 + np.cos(lat[:, None]) * np.cos(lat) * np.sin((lon[:, None] - lon) / 2) ** 2
    near = np.arcsin(np.sqrt(np.minimum(chord, 1))) * 2 * 6371.0 <= eps
    core = near.sum(1) >= least
    label = [-1] * len(ids)
    cluster_no = 0
    for i in range(len(ids)):
        if not core[i] or label[i] != -1:
            continue
        stack = [i]
        label[i] = cluster_no
        while stack:
            a = stack.pop()
            for b in np.flatnonzero(near[a]):
                if label[b] == -1:
                    label[b] = cluster_no
                    if core[b]:
                        stack.append(b)
        cluster_no += 1
    return {i: (label[k], bool(core[k])) for k, i in enumerate(ids)}


def run(spark, points, eps, least, parts=3):
    df = spark.createDataFrame([(i, "g", a, b) for i, a, b in points], "id long, g string, lat double, long double")
    out = dbscan(df.repartition(parts), "g", "id", eps_km=eps, min_samples=least)
    return {r["id"]: (r["cluster_id"], r["is_core"]) for r in out.collect()}


def scatter(seed, n, lat, lon, spread):
    rnd = random.Random(seed)
    return [(i, lat + rnd.gauss(0, spread), lon + rnd.gauss(0, spread)) for i in range(n)]


@pytest.mark.parametrize("eps,least", [(0.05, 3), (0.3, 40)])
def test_scattered_points(spark, eps, least):
    points = scatter(1, 700, 42.35, -71.06, 0.006)
    assert run(spark, points, eps, least) == brute_force(points, eps, least)


@pytest.mark.parametrize("leaf", [2, 48])
def test_dense_cells_are_split_exactly(spark, monkeypatch, leaf):
    """Cells with many points, lone points around them, several levels of splitting."""
    monkeypatch.setattr(cluster, "LEAF", leaf)
    points = scatter(2, 900, 42.35, -71.06, 0.0004)
    points += [(900 + i, p[1], p[2]) for i, p in enumerate(scatter(3, 250, 42.35, -71.06, 0.002))]
    assert run(spark, points, 0.04, 25) == brute_force(points, 0.04, 25)


def test_pruned_pairs_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(cluster, "LEAF", 3)
    points = scatter(11, 700, 42.35, -71.06, 0.0008)
    assert run(spark, points, 0.03, 6) == brute_force(points, 0.03, 6)


def test_two_dense_blobs_just_out_of_reach(spark, monkeypatch):
    """Facing borders a hair more, then a hair less, than the radius apart."""
    monkeypatch.setattr(cluster, "LEAF", 4)
    eps = 0.05
    rnd = random.Random(4)
    for gap, want in [(1.0001, 2), (0.9999, 1)]:
        step = math.degrees(eps * gap / 6371.0)
        left = [(i, 10 - rnd.random() * 1e-4, 20 + rnd.random() * 4e-4) for i in range(150)]
        right = [(200 + i, 10 + step + rnd.random() * 1e-4, 20 + rnd.random() * 4e-4) for i in range(150)]
        points = left + [(150, 10.0, 20.0002)] + right + [(400, 10.0 + step, 20.0002)]
        got = run(spark, points, eps, 6)
        assert got == brute_force(points, eps, 6)
        assert len({c for c, _ in got.values()} - {-1}) == want


def test_hot_coordinate_and_hot_cell(spark):
    """A third of all rows at one place, another third inside one cell."""
    rnd = random.Random(5)
    points = [(i, 42.36, -71.05) for i in range(600)]
    points += [(600 + i, 42.37 + rnd.random() * 1e-5, -71.05 + rnd.random() * 1e-5) for i in range(600)]
    points += [(1200 + i, a, b) for i, a, b in scatter(6, 600, 42.365, -71.05, 0.01)]
    assert run(spark, points, 0.075, 20) == brute_force(points, 0.075, 20)


@pytest.mark.parametrize("lat,lon", [(0.0, 179.9999), (89.9995, 10.0)])
def test_anywhere_on_the_globe(spark, lat, lon):
    rnd = random.Random(7)
    points = []
    for i in range(250):
        a = max(-90.0, min(90.0, lat + rnd.gauss(0, 0.002)))
        b = lon + rnd.gauss(0, 0.002 if abs(lat) < 80 else 60)
        points.append((i, a, (b + 180.0) % 360.0 - 180.0))
    assert run(spark, points, 0.05, 4) == brute_force(points, 0.05, 4)


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), parts=st.integers(1, 7), least=st.integers(1, 9))
def test_any_order_and_partitioning(spark, seed, parts, least):
    points = scatter(seed, 160, 42.35, -71.06, 0.002)
    want = brute_force(points, 0.08, least)
    shuffled = points[:]
    random.Random(seed).shuffle(shuffled)
    assert run(spark, shuffled, 0.08, least, parts) == want


def test_groups_do_not_mix_and_missing_coordinates_are_left_out(spark):
    rows = [(1, "a", 1.0, 1.0), (2, "a", 1.0, 1.0), (3, "b", 1.0, 1.0), (4, "a", None, 1.0), (5, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, g string, lat double, long double")
    got = {r["id"]: r["cluster_id"] for r in dbscan(df, "g", "id", eps_km=1.0, min_samples=2).collect()}
    assert got == {1: 0, 2: 0, 3: -1}
    skipped = dbscan(df, "g", "id", eps_km=1.0, min_samples=2, small_group="skip")
    assert {r["id"] for r in skipped.collect()} == {1, 2}


def test_ids_may_repeat(spark):
    """Group A: four points in a row, ids 1-4; group B: two lone points that reuse ids 1 and 2."""
    step = 0.3 / 1000 / 111.195  # 0.3 m in degrees of latitude
    rows = [("A", i + 1, 42.0 + i * step, -71.0) for i in range(4)] + [("B", 1, 42.0, -71.0), ("B", 2, 43.0, -71.0)]
    df = spark.createDataFrame(rows, "g string, id int, lat double, long double")
    got = dbscan(df, "g", "id", eps_km=0.35 / 1000, min_samples=3).collect()
    assert len(got) == 6
    assert {(r.g, r.id): r.cluster_id for r in got} == {("A", i): 0 for i in (1, 2, 3, 4)} | {("B", 1): -1, ("B", 2): -1}
    assert {r.id for r in got if r.is_core} == {2, 3}


def test_one_id_for_all(spark):
    rows = [(7, 42.0 + (i % 2), -71.0 + 1e-7 * i) for i in range(8)]
    df = spark.createDataFrame([("A", *r) for r in rows], "g string, id int, lat double, long double")
    got = dbscan(df, "g", "id", eps_km=0.01, min_samples=4).collect()
    assert len(got) == 8 and {(round(r.lat), r.cluster_id) for r in got} == {(42, 0), (43, 1)}


def test_connected_dense_cells_are_not_split(spark, monkeypatch):
    """A field of dense cells: contacts of cells side by side connect all of them, so the pairs farther off need no parts."""
    rnd = random.Random(12)
    grid = cluster._Grid(0.05)
    columns = math.ceil(360.0 / grid.height)
    inside = lambda: 0.1 + 0.8 * rnd.random()
    cells = [(y, x) for y in range(8) for x in range(8)]
    places = [(round(90.0 / grid.height) + y + inside(), columns // 2 + x + inside()) for y, x in cells for _ in range(8)]
    points = [(i, a * grid.height - 90.0, b * 360.0 / columns - 180.0) for i, (a, b) in enumerate(places)]
    written = []
    monkeypatch.setattr(session, "on_plan", lambda df: written.append(df.columns))
    assert run(spark, points, 0.05, 4) == brute_force(points, 0.05, 4)
    assert not [c for c in written if "child" in c]
