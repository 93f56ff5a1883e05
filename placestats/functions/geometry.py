"""Planar geometry as native expressions.

A geometry is `array<array<array<struct<x,y>>>>`: polygons, each a list of rings
(outer ring first, then holes), each a closed list of points. Containment is
planar ray casting with the half-open rule, so a point on a boundary may fall on
either side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placestats.functions.nested import let

GEOM_TYPE = "array<array<array<struct<x:double,y:double>>>>"
EDGE_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"


def wkt_to_geom(wkt: Column) -> Column:
    """POLYGON or MULTIPOLYGON text to a geometry; anything else is null."""
    text = F.upper(F.trim(wkt))
    points = F.regexp_replace(text, rf"({NUMBER})\s+({NUMBER})", r'{"x":$1,"y":$2}')
    body = F.translate(F.regexp_replace(points, r"^(MULTI)?POLYGON\s*", ""), "()", "[]")
    nested = F.when(text.startswith("MULTIPOLYGON"), body).when(
        text.startswith("POLYGON"), F.concat(F.lit("["), body, F.lit("]"))
    )
    return F.from_json(nested, GEOM_TYPE)


def geom_to_wkt(geom: Column) -> Column:
    def ring_text(ring: Column) -> Column:
        pts = F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
        return F.concat(F.lit("("), F.array_join(pts, ", "), F.lit(")"))

    def poly_text(rings: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(rings, ring_text), ", "), F.lit(")"))

    many = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(geom, poly_text), ", "), F.lit(")"))
    one = F.concat(F.lit("POLYGON "), poly_text(F.get(geom, F.lit(0))))
    return F.when(F.size(geom) == 1, one).when(F.size(geom) > 1, many)


def geojson_to_geom(kind: Column, coordinates: Column) -> Column:
    """Geometry from a GeoJSON type and the JSON text of its coordinates."""
    nested = F.when(kind == "MultiPolygon", coordinates).when(
        kind == "Polygon", F.concat(F.lit("["), coordinates, F.lit("]"))
    )
    numbers = F.from_json(nested, "array<array<array<array<double>>>>")
    return F.transform(
        numbers,
        lambda poly: F.transform(
            poly,
            lambda ring: F.transform(
                ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
            ),
        ),
    )


def geom_to_geojson(geom: Column) -> Column:
    """GeoJSON geometry text; null for a null or empty geometry."""

    def rings(poly: Column) -> Column:
        return F.transform(poly, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))

    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), rings(F.get(geom, F.lit(0))).alias("coordinates")))
    many = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.transform(geom, rings).alias("coordinates")))
    return F.when(F.size(geom) == 1, one).when(F.size(geom) > 1, many)


def ring_edges(ring: Column) -> Column:
    """Edges of one ring, closed if its last point is not its first."""

    def pair_up(points: Column) -> Column:
        n = F.greatest(F.size(points) - 1, F.lit(0))
        return F.zip_with(
            F.slice(points, F.lit(1), n),
            F.slice(points, F.lit(2), n),
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
        )

    is_closed = F.element_at(ring, 1) == F.element_at(ring, -1)
    return let(F.when(is_closed, ring).otherwise(F.concat(ring, F.slice(ring, 1, 1))), pair_up)


def geom_edges(geom: Column) -> Column:
    rings = F.filter(F.flatten(geom), lambda r: F.size(r) > 0)
    return F.flatten(F.transform(rings, ring_edges))


def bbox(edges: Column) -> dict[str, Column]:
    return {
        "min_x": F.array_min(F.transform(edges, lambda e: F.least(e["x1"], e["x2"]))),
        "max_x": F.array_max(F.transform(edges, lambda e: F.greatest(e["x1"], e["x2"]))),
        "min_y": F.array_min(F.transform(edges, lambda e: F.least(e["y1"], e["y2"]))),
        "max_y": F.array_max(F.transform(edges, lambda e: F.greatest(e["y1"], e["y2"]))),
    }


def contains(edges: Column, x: Column, y: Column) -> Column:
    """Crossing parity of a ray to the right; holes and parts cancel by themselves."""

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        rise = F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return spans & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / rise + e["x1"])

    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != crosses(e))


def centroid(geom: Column, digits: int | None = 6) -> Column:
    """Area-weighted centroid as struct<x,y>; holes count negative."""

    def triple(a: Column, mx: Column, my: Column) -> Column:
        return F.struct(a.alias("a"), mx.alias("mx"), my.alias("my"))

    zero = triple(F.lit(0.0), F.lit(0.0), F.lit(0.0))

    def moments(ring: Column, sign: Column) -> Column:
        # relative to the first point, which keeps the sums well conditioned
        origin = F.element_at(ring, 1)

        def step(acc: Column, e: Column) -> Column:
            ax, ay, bx, by = e["x1"] - origin["x"], e["y1"] - origin["y"], e["x2"] - origin["x"], e["y2"] - origin["y"]
            return let(
                ax * by - bx * ay,
                lambda cross: triple(acc["a"] + cross / 2, acc["mx"] + (ax + bx) * cross / 6, acc["my"] + (ay + by) * cross / 6),
            )

        return F.aggregate(
            ring_edges(ring),
            zero,
            step,
            lambda t: let(
                F.signum(t["a"]) * sign,
                lambda turn: triple(
                    t["a"] * turn, (t["mx"] + t["a"] * origin["x"]) * turn, (t["my"] + t["a"] * origin["y"]) * turn
                ),
            ),
        )

    def of_polygon(poly: Column) -> Column:
        rings = F.filter(poly, lambda r: F.size(r) > 0)
        return F.transform(rings, lambda ring, i: moments(ring, F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))))

    def finish(t: Column) -> Column:
        area = F.nullif(t["a"], F.lit(0.0))
        x, y = t["mx"] / area, t["my"] / area
        if digits is not None:
            x, y = F.round(x, digits), F.round(y, digits)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.aggregate(
        F.flatten(F.transform(geom, of_polygon)),
        zero,
        lambda acc, m: triple(acc["a"] + m["a"], acc["mx"] + m["mx"], acc["my"] + m["my"]),
        finish,
    )


def segments_touch(a: Column, b: Column, tol: float = 1e-12) -> Column:
    """Do two segments share a point? Collinear overlap and end points count."""

    def side(p: Column, q: Column, x: Column, y: Column) -> Column:
        """-1, 0, 1: on which side of the line p-q the point lies."""
        turn = (q[0] - p[0]) * (y - p[1]) - (q[1] - p[1]) * (x - p[0])
        return F.when(F.abs(turn) <= tol, F.lit(0.0)).otherwise(F.signum(turn))

    a1, a2, b1, b2 = (a["x1"], a["y1"]), (a["x2"], a["y2"]), (b["x1"], b["y1"]), (b["x2"], b["y2"])
    boxes = (
        (F.greatest(a["x1"], a["x2"]) >= F.least(b["x1"], b["x2"]))
        & (F.greatest(b["x1"], b["x2"]) >= F.least(a["x1"], a["x2"]))
        & (F.greatest(a["y1"], a["y2"]) >= F.least(b["y1"], b["y2"]))
        & (F.greatest(b["y1"], b["y2"]) >= F.least(a["y1"], a["y2"]))
    )
    b_straddles = side(a1, a2, *b1) * side(a1, a2, *b2) <= 0
    a_straddles = side(b1, b2, *a1) * side(b1, b2, *a2) <= 0
    return boxes & b_straddles & a_straddles
