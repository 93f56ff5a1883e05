"""Dissolve: the parts of a place become one geometry without inner borders.

Rings are turned so that the inside lies to the left, edges are cut where a corner of
another part lies on them, and edges that run both ways cancel. What is left is chained
into rings: at a corner the next edge is the first one clockwise from the way back, so
parts that only touch in a corner stay rings of their own. Rings are found and put in
order by pointer jumping, in as many joins as the longest outline has binary digits; no
place is handled by one task, and no pairs within a place are formed.

Parts of a place may touch, repeat or lie inside holes of each other, but not overlap.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.functions.geometry import GEOM_TYPE, ring_edges
from placestats.operators.spatial import segment_cells, spatial_join
from placestats.session import materialize, observed, release

ON_EDGE = 1e-9  # distance from an edge, as a share of its length, at which a corner lies on it


def signed_area(ring: Column) -> Column:
    """Area of a ring, positive if it runs counter-clockwise; relative to its first point."""

    def cross(total: Column, e: Column) -> Column:
        o = F.element_at(ring, 1)
        return total + ((e["x1"] - o["x"]) * (e["y2"] - o["y"]) - (e["x2"] - o["x"]) * (e["y1"] - o["y"])) / 2

    return F.aggregate(ring_edges(ring), F.lit(0.0), cross)


def directed_edges(df: DataFrame, keys: Sequence[str], geom: str, snap: int) -> DataFrame:
    """(keys, e): the edges of all rings with the inside to the left, coordinates rounded to `snap` digits."""
    rounded = F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda p: F.struct(F.round(p["x"], snap).alias("x"), F.round(p["y"], snap).alias("y")))))
    rings = df.select(*keys, F.explode(rounded).alias("poly")).select(*keys, F.posexplode("poly").alias("at", "ring")).where(F.size("ring") > 2)
    outer, left = F.col("at") == 0, signed_area(F.col("ring")) > 0
    turned = F.when(outer == left, F.col("ring")).otherwise(F.reverse("ring"))
    edges = rings.select(*keys, F.explode(ring_edges(turned)).alias("e"))
    return edges.where((F.col("e.x1") != F.col("e.x2")) | (F.col("e.y1") != F.col("e.y2")))


def cut_edges(edges: DataFrame, keys: Sequence[str], snap: int) -> DataFrame:
    """Edges of a place cut at the corners of the place that lie on them: (keys, a, b, n), `n` times each."""
    counted = edges.groupBy(*keys, "e").agg(F.count(F.lit(1)).alias("n"))
    cells, told = observed(segment_cells(counted, snap), sizes=F.collect_set("size"))
    sizes = F.array(*[F.lit(float(s)) for s in sorted(told.get("sizes") or [])]).cast("array<double>")
    corners = counted.select(*keys, F.explode(F.array(F.struct(F.col("e.x1").alias("x"), F.col("e.y1").alias("y")), F.struct(F.col("e.x2").alias("x"), F.col("e.y2").alias("y")))).alias("p")).distinct()
    looks = corners.select(*keys, "p", F.explode(sizes).alias("size"))
    looks = looks.withColumns({"cx": F.floor(F.col("p.x") / F.col("size")), "cy": F.floor(F.col("p.y") / F.col("size"))})
    e, p = F.col("e"), F.col("p")
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    square = dx * dx + dy * dy
    along = ((p["x"] - e["x1"]) * dx + (p["y"] - e["y1"]) * dy) / square
    off = F.abs((p["x"] - e["x1"]) * dy - (p["y"] - e["y1"]) * dx) / square
    inside = (along > ON_EDGE) & (along < 1 - ON_EDGE) & (off <= ON_EDGE)
    met = cells.join(looks, [*keys, "size", "cx", "cy"]).where(inside).select(*keys, "e", F.struct(along.alias("t"), "p").alias("cut")).distinct()
    cuts = met.groupBy(*keys, "e").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    held = counted.alias("c").join(cuts.alias("k"), [*[F.col(f"c.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys], F.col("c.e") == F.col("k.e")], "left")
    first = F.struct(F.col("c.e.x1").alias("x"), F.col("c.e.y1").alias("y"))
    last = F.struct(F.col("c.e.x2").alias("x"), F.col("c.e.y2").alias("y"))
    middle = F.coalesce(F.transform("cuts", lambda c: c["p"]), F.array().cast("array<struct<x:double,y:double>>"))
    points = held.select(*[F.col(f"c.{k}") for k in keys], "n", F.concat(F.array(first), middle, F.array(last)).alias("points"))
    pairs = F.transform(F.slice("points", 1, F.size("points") - 1), lambda x, i: F.struct(x.alias("a"), F.get("points", i + 1).alias("b")))
    return points.select(*keys, "n", F.explode(pairs).alias("s")).select(*keys, "s.a", "s.b", "n")


def border(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, a, b): the pieces that no piece the other way cancels, once each."""
    ahead = F.col("a") < F.col("b")
    net = pieces.groupBy(*keys, F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.sum(F.when(ahead, F.col("n")).otherwise(-F.col("n"))).alias("net"))
    forth = F.col("net") > 0
    kept = net.where("net != 0")
    return kept.select(*keys, F.when(forth, F.col("lo")).otherwise(F.col("hi")).alias("a"), F.when(forth, F.col("hi")).otherwise(F.col("lo")).alias("b"))


def _angle(a: Column, b: Column) -> Column:
    return F.atan2(b["y"] - a["y"], b["x"] - a["x"])


def following(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(id, next): the edge that follows each edge along its ring."""
    out = edges.select(*keys, F.col("a").alias("at"), F.col("b").alias("far"), F.col("id").alias("next"))
    met = edges.select(*keys, "a", F.col("b").alias("at"), "id").join(out, [*keys, "at"])
    turn = F.pmod(_angle(F.col("at"), F.col("a")) - _angle(F.col("at"), F.col("far")), F.lit(2 * pi))
    turn = F.when(turn < 1e-9, 2 * pi).otherwise(turn)  # straight back only if nothing else is left
    return met.groupBy("id").agg(F.min_by("next", F.struct(turn.alias("t"), "next")).alias("next"))


def jump(state: DataFrame, rounds: int, join) -> DataFrame:
    """`rounds` of pointer jumping; join(s, t) makes the next state from rows and the rows they point to."""
    for _ in range(rounds):
        after = materialize(join(state.alias("s"), state.alias("t")))
        release(state)
        state = after
    return state


def ordered_rings(edges: DataFrame, keys: Sequence[str], longest: int) -> DataFrame:
    """(keys, ring): rings of points in order, not closed, from their least point on."""
    rounds = max(1, longest - 1).bit_length()
    succ = materialize(following(edges, keys))
    same = F.col("s.next") == F.col("t.id")

    def least(s: DataFrame, t: DataFrame) -> DataFrame:
        return s.join(t, same).select("s.id", "t.next", F.least("s.ring", "t.ring").alias("ring"))

    def steps(s: DataFrame, t: DataFrame) -> DataFrame:
        return s.join(t, same, "left").select("s.id", "t.next", "s.ring", (F.col("s.left") + F.coalesce("t.left", F.lit(0))).alias("left"))

    labelled = jump(materialize(succ.select("id", "next", F.col("id").alias("ring"))), rounds, least).select("id", "ring")
    # the walk from an edge to the last before the first one of its ring
    cut = succ.join(labelled, "id").select("id", F.when(F.col("next") != F.col("ring"), F.col("next")).alias("next"), "ring")
    placed = jump(materialize(cut.withColumn("left", F.when(F.col("next").isNotNull(), 1).otherwise(0))), rounds, steps).select("id", "ring", "left")
    listed = edges.join(placed, "id").groupBy(*keys, "ring").agg(F.collect_list(F.struct((-F.col("left")).alias("at"), "a")).alias("l"))
    points = listed.select(*keys, F.transform(F.array_sort("l"), lambda x: x["a"]).alias("points"))
    start = F.array_position("points", F.array_min("points")).cast("int")
    return points.select(*keys, F.concat(F.slice("points", start, F.size("points")), F.slice("points", F.lit(1), start - 1)).alias("ring"))


def dissolve(df: DataFrame, key: str | Sequence[str], geom: str = "geometry", snap: int = 9) -> DataFrame:
    """(key, geometry): one geometry per key from the parts of all its rows, without inner borders.

    Rings are closed and start at their least point, outer rings counter-clockwise; polygons
    are in order. A key without any ring has a null geometry.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = df.select(*keys, F.col(geom).cast(GEOM_TYPE).alias(geom))
    pieces = border(cut_edges(directed_edges(parts, keys, geom, snap), keys, snap), keys)
    edges = materialize(pieces.withColumn("id", F.monotonically_increasing_id()))
    longest = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    whole = parts.select(*keys).distinct()
    if not longest:
        return whole.withColumn(geom, F.lit(None).cast(GEOM_TYPE))
    rings = ordered_rings(edges, keys, longest)
    rings = materialize(rings.withColumn("area", signed_area(F.col("ring"))).withColumn("id", F.monotonically_increasing_id()))
    outer = rings.where("area > 0").select(F.struct(*keys).alias("own"), "id", "area", F.array(F.array("ring")).alias(geom))
    holes = rings.where("area < 0").select(F.struct(*keys).alias("place"), "ring")
    # a point just left of a hole's first edge lies in the polygon that has the hole
    a, b = F.get("ring", F.lit(0)), F.get("ring", F.lit(1))
    holes = holes.withColumns({
        "long": (a["x"] + b["x"]) / 2 - (b["y"] - a["y"]) * 1e-6,
        "lat": (a["y"] + b["y"]) / 2 + (b["x"] - a["x"]) * 1e-6,
    })
    carry = {"own": "own", "id": "id", "area": "area"}
    held = spatial_join(holes, outer, geom=geom, carry=carry).where(F.col("place") == F.col("own"))
    nearest = held.groupBy("place", "ring").agg(F.min_by("id", "area").alias("id"))
    closed = lambda r: F.concat(r, F.slice(r, 1, 1))
    within = nearest.groupBy("id").agg(F.sort_array(F.collect_list(closed(F.col("ring")))).alias("holes"))
    none = F.array().cast("array<array<struct<x:double,y:double>>>")
    polygons = rings.where("area > 0").join(within, "id", "left").select(*keys, F.concat(F.array(closed(F.col("ring"))), F.coalesce("holes", none)).alias("polygon"))
    merged = polygons.groupBy(*keys).agg(F.sort_array(F.collect_list("polygon")).alias(geom))
    return whole.join(merged, keys, "left")
