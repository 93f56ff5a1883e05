"""Spatial joins through nested grids.

Each polygon is cut into cells of a size that fits its own extent, a power of four, so
no polygon covers more than some eighty of them, whatever the others look like. Cells of
all sizes nest, as on a space-filling curve: the cell of the finest size that a point lies
in tells its cells of all sizes. So points meet polygons in one equality join. Cells
wholly inside a polygon need no test at all; the others carry just the edges that can
matter for a point of that cell. Boundaries meet in the same way, segment by segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.functions.geometry import bbox, centroid, contains, geom_edges, segments_touch
from placestats.functions.text import norm_text
from placestats.operators.ranking import number_rows
from placestats.session import materialize, observed


def _extent(box: dict[str, Column]) -> Column:
    return F.greatest(box["max_x"] - box["min_x"], box["max_y"] - box["min_y"])


def own_cell(extent: Column) -> Column:
    """Cell size for a polygon of that extent: the power of four from an eighth to a half of it."""
    return F.pow(F.lit(4.0), F.ceil(F.log2(F.greatest(extent, F.lit(1e-9)) / 8) / 2))


def cover_cells(polygons: DataFrame, geom: str, cell: float | None = None) -> DataFrame:
    """One row per polygon and grid cell it may reach: _cell (its size), _cx, _cy, _inside, _edges.

    Without `cell` each polygon gets the size that fits it.
    """
    boxed = polygons.withColumn("_all", geom_edges(F.col(geom))).where(F.size("_all") > 0)
    boxed = boxed.withColumns({f"_{k}": v for k, v in bbox(F.col("_all")).items()})
    fitting = own_cell(_extent({k: F.col(f"_{k}") for k in ("min_x", "max_x", "min_y", "max_y")}))
    boxed = boxed.withColumn("_cell", F.lit(float(cell)) if cell else fitting)
    c, pad = F.col("_cell"), F.col("_cell") * 1e-6
    xs = F.sequence(F.floor((F.col("_min_x") - pad) / c), F.floor((F.col("_max_x") + pad) / c))
    ys = F.sequence(F.floor((F.col("_min_y") - pad) / c), F.floor((F.col("_max_y") + pad) / c))
    cells = boxed.withColumn("_cx", F.explode(xs)).withColumn("_cy", F.explode(ys))

    left, right = F.col("_cx") * c - pad, (F.col("_cx") + 1) * c + pad
    low, high = F.col("_cy") * c - pad, (F.col("_cy") + 1) * c + pad
    # an edge below, above or left of the cell never meets a ray cast to the right
    near = F.filter(
        "_all",
        lambda e: (F.greatest(e["y1"], e["y2"]) >= low)
        & (F.least(e["y1"], e["y2"]) <= high)
        & (F.greatest(e["x1"], e["x2"]) >= left),
    )
    cut = F.exists("_edges", lambda e: F.least(e["x1"], e["x2"]) <= right)
    middle = contains(F.col("_edges"), (F.col("_cx") + 0.5) * c, (F.col("_cy") + 0.5) * c)
    return (
        cells.withColumn("_edges", near)
        .withColumn("_cut", cut)
        .withColumn("_inside", ~F.col("_cut") & middle)
        .where(F.col("_cut") | F.col("_inside"))
        .withColumn("_edges", F.when(F.col("_cut"), F.col("_edges")))
        .drop("_all", "_cut", "_min_x", "_max_x", "_min_y", "_max_y")
    )


def _found(keyed: DataFrame, cells: DataFrame, sizes: list[float]) -> DataFrame:
    """(_kx, _ky, _hold): for each cell of the finest size with points in it, the cells of all sizes around it.

    Sizes are powers of four, so a cell lies in exactly one cell of every coarser size. Only
    distinct cells take part: a cell with a third of all points is one row here.
    """
    fine = sizes[0]
    keys = keyed.where("_kx is not null and _ky is not null").select("_kx", "_ky").distinct()
    around = F.array(
        *[F.struct(F.lit(s).alias("_cell"), F.floor(F.col("_kx") * F.lit(fine / s)).alias("_cx"), F.floor(F.col("_ky") * F.lit(fine / s)).alias("_cy")) for s in sizes]
    )
    placed = keys.select("_kx", "_ky", F.explode(around).alias("_a")).select("_kx", "_ky", "_a.*")
    return materialize(placed.join(cells, ["_cell", "_cx", "_cy"]).select("_kx", "_ky", "_hold"))


def spatial_join(
    points: DataFrame,
    polygons: DataFrame,
    lon: str = "long",
    lat: str = "lat",
    geom: str = "geometry",
    carry: dict[str, str] | None = None,
    how: str = "inner",
    valid: Column | None = None,
    cell: float | None = None,
    one_match: str | None = None,
    point_key: list[str] | None = None,
) -> DataFrame:
    """Join points to the polygons that contain them.

    `carry` maps polygon columns to output names. `valid` keeps rows without usable
    coordinates away from the geometry; with `how="left"` they stay unmatched. A
    point in several polygons appears once per polygon unless `one_match` names the
    polygon column whose lowest value wins, per `point_key`.

    The points meet the polygons in one join on their cell of the finest size in use,
    however many sizes there are; which coarser cells lie around is found before, for
    the distinct cells only.
    """
    carry = carry or {"location_id": "location_id"}
    if one_match and not point_key:
        raise ValueError("one_match needs point_key, the columns that identify a point")
    small = polygons.select(*[F.col(k).alias(v) for k, v in carry.items()], geom)
    held = F.struct(*carry.values(), "_inside", "_edges")
    # written out once: its true size decides whether it is broadcast
    cells, told = observed(cover_cells(small, geom, cell).select("_cell", "_cx", "_cy", held.alias("_hold")), sizes=F.collect_set("_cell"))
    sizes = sorted(told.get("sizes") or [])  # a few powers of four
    if not sizes:  # no polygon at all
        empty = points.withColumns({v: F.lit(None).cast(polygons.schema[k].dataType) for k, v in carry.items()})
        return empty if how == "left" else empty.where(F.lit(False))

    usable = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    if valid is not None:
        usable = usable & F.coalesce(valid, F.lit(False))
    fine = F.lit(sizes[0])
    keyed = points.withColumns({"_kx": F.when(usable, F.floor(F.col(lon) / fine)), "_ky": F.when(usable, F.floor(F.col(lat) / fine))})
    near = cells.select(F.col("_cx").alias("_kx"), F.col("_cy").alias("_ky"), "_hold") if len(sizes) == 1 else _found(keyed, cells, sizes)
    x, y = F.col(lon), F.col(lat)

    def holds(h: Column) -> Column:
        return h["_inside"] | contains(h["_edges"], x, y)

    own, carried = [F.col(c) for c in points.columns], [F.col(f"_hold.{v}").alias(v) for v in carry.values()]
    if how == "inner" and not one_match:
        return keyed.join(near, ["_kx", "_ky"]).where(holds(F.col("_hold"))).select(*own, *carried)
    lists = near.groupBy("_kx", "_ky").agg(F.collect_list("_hold").alias("_holds"))
    hits = F.filter("_holds", holds)
    if one_match:
        name = carry[one_match]
        hits = F.slice(F.array_sort(hits, lambda a, b: F.when(a[name] < b[name], -1).when(a[name] > b[name], 1).otherwise(0)), 1, 1)
    explode = F.explode if how == "inner" else F.explode_outer
    return keyed.join(lists, ["_kx", "_ky"], how).select(*own, explode(hits).alias("_hold")).select(*own, *carried)


def resolve_location(
    points: DataFrame,
    polygons: DataFrame,
    cities: DataFrame | None = None,
    city: str = "city",
    valid: Column | None = None,
    cell: float | None = None,
) -> DataFrame:
    """Area of each row: by polygon, else by its city's own row, else its city text.

    Adds location_id, neighborhood_name, city_name and resolution_method. Without
    `cities` the middle step is left out.
    """
    carry = {"location_id": "_s_id", "neighborhood_name": "_s_name", "city": "_s_city"}
    out = spatial_join(points, polygons, carry=carry, how="left", valid=valid, cell=cell)
    ids, names, towns = [F.col("_s_id")], [F.col("_s_name")], [F.col("_s_city")]
    method = F.when(F.col("_s_id").isNotNull(), F.lit("SPATIAL"))
    if cities is not None:
        by_city = cities.select(
            norm_text(F.col("city")).alias("_c_key"),
            F.col("location_id").alias("_c_id"),
            F.col("neighborhood_name").alias("_c_name"),
            F.col("city").alias("_c_city"),
        )
        out = out.join(by_city, norm_text(F.col(city)) == F.col("_c_key"), "left")
        ids.append(F.col("_c_id"))
        names.append(F.col("_c_name"))
        towns.append(F.col("_c_city"))
        method = method.when(F.col("_c_id").isNotNull(), F.lit("CITY_MASTER"))
    resolved = out.withColumns(
        {
            "location_id": F.coalesce(*ids),
            "neighborhood_name": F.coalesce(*names, F.col(city)),
            "city_name": F.coalesce(*towns, F.col(city)),
            "resolution_method": method.otherwise(F.lit("CITY")),
        }
    )
    return resolved.drop("_s_id", "_s_name", "_s_city", "_c_key", "_c_id", "_c_name", "_c_city")


def assign_location(df: DataFrame, values: dict, method: str) -> DataFrame:
    """Constant area for a source without coordinates."""
    return df.withColumns({**{k: F.lit(v) for k, v in values.items()}, "resolution_method": F.lit(method)})


def overlay_coordinates(df: DataFrame, geocoded: DataFrame, key: str, valid: str = "valid_location") -> DataFrame:
    """Fill coordinates from a geocoder, only on rows that have no valid ones."""
    geo = geocoded.select(F.col(key).alias("_g_key"), F.col("lat").alias("_g_lat"), F.col("long").alias("_g_long"))
    joined = df.join(geo, (F.col(key) == F.col("_g_key")) & ~F.col(valid), "left")
    fill = ~F.col(valid) & F.col("_g_lat").isNotNull()
    return joined.withColumns(
        {
            "lat": F.when(fill, F.col("_g_lat")).otherwise(F.col("lat")),
            "long": F.when(fill & F.col("_g_long").isNotNull(), F.col("_g_long")).otherwise(F.col("long")),
            valid: F.col(valid) | F.col("_g_lat").isNotNull(),
        }
    ).drop("_g_key", "_g_lat", "_g_long")


def _segments(polygons: DataFrame, key: str, geom: str, snap: int) -> DataFrame:
    rows = polygons.select(F.col(key), F.explode(geom_edges(F.col(geom))).alias("e"))
    snapped = F.struct(*[F.round(F.col(f"e.{n}"), snap).alias(n) for n in ("x1", "y1", "x2", "y2")])
    return rows.select(key, snapped.alias("e"))


def segment_cells(segments: DataFrame, snap: int = 9) -> DataFrame:
    """Adds `size` (the least power of four that a segment fits in) and its cells `cx`, `cy`: at most two each way."""
    reach = F.greatest(F.abs(F.col("e.x1") - F.col("e.x2")), F.abs(F.col("e.y1") - F.col("e.y2")), F.lit(10.0**-snap))
    sized = segments.withColumn("size", F.pow(F.lit(4.0), F.ceil(F.log2(reach) / 2)))

    def span(a: str, b: str) -> Column:
        lo, hi = F.least(f"e.{a}", f"e.{b}"), F.greatest(f"e.{a}", f"e.{b}")
        return F.explode(F.sequence(F.floor(lo / F.col("size")), F.floor(hi / F.col("size"))))

    return sized.withColumn("cx", span("x1", "x2")).withColumn("cy", span("y1", "y2"))


def touching_pairs(segments: DataFrame, key: str, snap: int = 9) -> DataFrame:
    """Pairs a < b of different keys with segments (key, e) that share a point.

    A segment lives in the cells of its own length and looks for segments of its own or a
    greater length in those cells and the cells around them, one of each greater size in
    use. Cells of powers of four nest, so two segments that touch meet in the longer one's
    cell. Rows per segment are bounded by the number of sizes, whatever the other lengths.
    """
    cells, told = observed(segment_cells(segments, snap), sizes=F.collect_set("size"))
    sizes = sorted(told.get("sizes") or [])
    up = F.filter(F.array(*[F.lit(float(s)) for s in sizes]).cast("array<double>"), lambda s: s >= F.col("size"))
    looks = cells.withColumn("at", F.explode(up))
    shrink = F.col("size") / F.col("at")
    looks = looks.select(
        F.col(key).alias("k"), F.col("e").alias("f"), F.col("at").alias("size"), F.floor(F.col("cx") * shrink).alias("cx"), F.floor(F.col("cy") * shrink).alias("cy")
    ).distinct()
    met = cells.join(looks, ["size", "cx", "cy"]).where((F.col(key) != F.col("k")) & segments_touch(F.col("e"), F.col("f")))
    return met.select(F.least(key, "k").alias("a"), F.greatest(key, "k").alias("b")).distinct()


def adjacency(polygons: DataFrame, key: str = "location_id", geom: str = "geometry", snap: int = 9) -> DataFrame:
    """Pairs (a, b), both ways, of different polygons that share a point.

    Boundaries are compared segment by segment (see `touching_pairs`); polygons that
    hold another without touching it are found by looking up one vertex per ring.
    Coordinates are rounded to `snap` digits so that shared borders agree.
    """
    touching = touching_pairs(_segments(polygons, key, geom, snap), key, snap)
    corners = polygons.select(F.col(key).alias("a"), F.explode(F.flatten(F.col(geom))).alias("_ring")).select(
        "a", F.col("_ring")[0]["x"].alias("long"), F.col("_ring")[0]["y"].alias("lat")
    )
    held = spatial_join(corners, polygons, geom=geom, carry={key: "b"}).where(F.col("a") != F.col("b"))
    held = held.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = touching.unionByName(held).distinct()
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def collect_geometry(df: DataFrame, key: list[str], order: str, geom: str = "geometry") -> DataFrame:
    """Merge the features of one place into one multi-part geometry, parts in `order`.

    Parts are kept side by side, not dissolved; containment is true in any part.
    """
    listed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("_at"), F.col(geom).alias("_g"))))
    return df.groupBy(*key).agg(F.flatten(F.transform(listed, lambda p: p["_g"])).alias(geom))


def boundary_points(polygons: DataFrame, geom: str = "geometry", keep: list[str] | None = None) -> DataFrame:
    """Outer ring of the first polygon as ordered points."""
    ring = F.get(F.get(F.col(geom), F.lit(0)), F.lit(0))
    out = polygons.select(*(keep or []), F.posexplode(ring).alias("pos", "pt"))
    return out.select(*(keep or []), "pos", F.col("pt.x").alias("long"), F.col("pt.y").alias("lat"))


def spatial_bin(df: DataFrame, digits: int = 2, lat: str = "lat", lon: str = "long") -> DataFrame:
    """Rounded coordinates as exact decimals, so equal bins compare equal."""
    kind = f"decimal(18,{digits})"
    exact = "decimal(28,12)"
    return df.withColumns(
        {
            "lat_bin": F.round(F.col(lat).cast(exact), digits).cast(kind),
            "long_bin": F.round(F.col(lon).cast(exact), digits).cast(kind),
        }
    )


def with_centroid(df: DataFrame, geom: str = "geometry") -> DataFrame:
    """Adds centroid_lat and centroid_long rounded to six digits."""
    placed = df.withColumn("_c", centroid(F.col(geom)))
    return placed.withColumns({"centroid_lat": F.col("_c.y"), "centroid_long": F.col("_c.x")}).drop("_c")


def assign_ids(sources: list[DataFrame], order: str, id_col: str = "location_id") -> DataFrame:
    """Number the rows of several sources 1, 2, 3 ... in source order, then by `order`."""
    ranked = [s.withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return number_rows(out, ["_src", order], name=id_col).drop("_src")


def map_center(df: DataFrame, selected: str | None = None, name: str = "neighborhood_name") -> DataFrame:
    """Centre of a map: the selected row's centroid, else the mean of all."""
    if selected is not None:
        df = df.where(F.col(name) == selected)
    return df.agg(F.avg("centroid_lat").alias("center_lat"), F.avg("centroid_long").alias("center_long"))
