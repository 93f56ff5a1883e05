"""Density clustering (DBSCAN) on the sphere, exact, as DataFrame jobs.

Points are laid on a grid whose cells are so small that two points of one cell are
always within the radius. Then:

* a cell that holds `min_samples` points is *dense*: all its points are cores of one
  cluster, and no pair inside it is ever looked at;
* a point of any other cell has fewer than `min_samples` cell mates, so comparing
  such points with those of the surrounding cells stays linear;
* what remains (a lone point against a dense cell, two dense cells against each
  other) is decided on summaries: a cell stands for its points by one of them and a
  bound on how far the others are. Undecided summaries are split into smaller ones,
  level by level, until everything is decided. The work grows with the length of the
  border between cells, not with the product of their sizes.

Identical coordinates are collapsed to one weighted point first. Clusters are the
connected components of the core graph, found by alternating large-star and
small-star steps (Kiveris et al., 2014).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.constants import EARTH_KM
from placestats.functions.nested import let
from placestats.functions.numbers import arc_km, share_pct
from placestats.operators.ranking import number_rows
from placestats.operators.spatial import spatial_bin
from placestats.session import materialize, observed, release, spread

SLACK = 1e-3  # relative shrink of the cell side; covers curvature and rounding
SPLIT = 4  # children per side when a summary is split
LEAF = 48  # a summary of at most this many points splits straight into its points
NOISE = -1


class _Grid:
    """Cell arithmetic for one radius, in plain column expressions."""

    def __init__(self, eps_km: float):
        self.eps = eps_km
        self.reach = math.degrees(eps_km / EARTH_KM)
        self.height = self.reach / math.sqrt(2) * (1 - SLACK)

    def row(self, lat: Column) -> Column:
        return F.floor((lat + 90.0) / self.height)

    def _row_cos(self, iy: Column, widest: bool) -> Column:
        """Cosine of the row's latitude nearest to (or farthest from) the equator."""
        low, high = iy * self.height - 90.0, (iy + 1) * self.height - 90.0
        if widest:
            edge = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(high)))
        else:
            edge = F.least(F.greatest(F.abs(low), F.abs(high)), F.lit(90.0))
        return F.cos(F.radians(edge))

    def columns(self, iy: Column) -> Column:
        """How many cells go round the globe in this row."""
        return F.greatest(F.ceil(F.lit(360.0 / self.height) * self._row_cos(iy, True)), F.lit(1))

    def width(self, iy: Column) -> Column:
        return F.lit(360.0) / self.columns(iy)

    def column(self, iy: Column, lon: Column) -> Column:
        return F.pmod(F.floor((lon + 180.0) / self.width(iy)), self.columns(iy))

    def spread(self, iy: Column, level: Column) -> Column:
        """Bound in km on the distance of two points in a level-`level` part of a cell."""
        tall = F.lit(math.radians(self.height))
        wide = F.radians(self.width(iy)) * self._row_cos(iy, True)
        return (tall + wide) * (EARTH_KM * (1 + 1e-6)) / F.pow(F.lit(float(SPLIT)), level)

    def part(self, iy: Column, ix: Column, lat: Column, lon: Column, level: int) -> tuple[Column, Column]:
        """Row and column of a point inside its cell at the given level."""
        n = SPLIT**level
        down = (lat + 90.0 - iy * self.height) / self.height
        across = (lon + 180.0) / self.width(iy)
        across = across - F.floor(across)
        clip = lambda f: F.least(F.greatest(F.floor(f * n), F.lit(0)), F.lit(n - 1)).cast("long")
        return clip(down), clip(across)

    def around(self, iy: Column, ix: Column) -> Column:
        """All cells that may hold a point within the radius of some point of this cell."""
        lat_far = F.greatest(F.abs(iy * self.height - 90.0), F.abs((iy + 1) * self.height - 90.0))
        cosine = F.cos(F.radians(F.least(lat_far, F.lit(90.0))))
        sine = F.lit(math.sin(self.eps / EARTH_KM)) / F.greatest(cosine, F.lit(1e-12))
        swing = F.when((lat_far + self.reach >= 90.0) | (sine >= 1.0), F.lit(360.0)).otherwise(
            F.degrees(F.asin(F.least(sine, F.lit(1.0)))) * (1 + 1e-6)
        )
        span = F.struct((ix * self.width(iy) - swing).alias("a"), ((ix + 1) * self.width(iy) + swing).alias("b"))
        steps = math.ceil(self.reach / self.height)
        rows = F.sequence(iy - steps, iy + steps)

        def cells(span: Column, ny: Column, n: Column) -> Column:
            first, last = F.floor(span["a"] * n / 360.0), F.floor(span["b"] * n / 360.0)
            return F.transform(
                F.sequence(first, F.least(last, first + n - 1)),
                lambda nx: F.struct(ny.alias("ky"), F.pmod(nx, n).alias("kx")),
            )

        def row_cells(span: Column) -> Column:
            return F.transform(rows, lambda ny: let(self.columns(ny), lambda n: cells(span, ny, n)))

        return F.flatten(let(span, row_cells))


def _star_round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (greater, lesser) edges.

    A lesser end without a lesser neighbour of its own stays the centre it is: its edges
    need no aggregate by that centre, so a component with a third of all nodes never meets
    in one task.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    large = edges.join(low.select(F.col("u").alias("v"), "m"), "v", "left").select("u", F.coalesce("m", "v").alias("v"))
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of an undirected graph; the root is its least node.

    Each round replaces the edges by shorter ones (large star, then small star) and writes
    them out, so lineage stays flat and lost executors cost one round only. It ends when a
    round leaves the edges as they were, which their writes tell; the files of a round are
    deleted once the next is written.
    """
    ends = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(F.col("u") != F.col("v"))
    told = {"n": F.count(F.lit(1)), "sum": F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))}
    first = materialize(ends)  # a round reads its edges several times
    cur, now = observed(_star_round(first), **told)
    release(first)
    while now["n"]:
        new, after = observed(_star_round(cur), **told)
        release(cur)
        cur, before, now = new, now, after
        if now == before:
            break
    roots = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _distinct_points(df: DataFrame, group: Sequence[str], id_col: str, lat: str, lon: str) -> DataFrame:
    """One weighted point per group and position. `pid` names it: the least id there, for the
    order of clusters, then group and position, which no other point shares."""
    placed = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    for g in group:
        placed = placed.where(F.col(g).isNotNull())
    merged = placed.groupBy(*group, (F.col(lat) + 0.0).alias("lat"), (F.col(lon) + 0.0).alias("lon")).agg(
        F.count(F.lit(1)).alias("w"), F.min(id_col).alias("_least")
    )
    return merged.withColumn("pid", F.struct("_least", *group, "lat", "lon")).drop("_least")


def _node(n: Column, w: Column, lat: Column, lon: Column, reach: Column, owner: Column, **cell: Column) -> Column:
    """A summary: `n` points of total weight `w`, one of them at (lat, lon), the others
    no farther from it than `reach`; `owner` is the point or dense cell it belongs to.
    The position is kept in radians with its cosine, ready for many distances."""
    far = F.when(n > 1, reach).otherwise(F.lit(0.0))
    at = {"phi": F.radians(lat), "lam": F.radians(lon), "cos": F.cos(F.radians(lat))}
    parts = {"owner": owner, "n": n, "w": w, "far": far, **at, **cell}
    return F.struct(*[c.alias(k) for k, c in parts.items()])


def _children(dense: DataFrame, parents: DataFrame, group: list[str], grid: _Grid, level: int) -> DataFrame:
    """Split parent summaries of `level` into those of the next level, one list per parent."""
    key = [*group, "iy", "ix", "sy", "sx"]
    iy, ix, lat, lon = F.col("iy"), F.col("ix"), F.col("lat"), F.col("lon")
    sy, sx = grid.part(iy, ix, lat, lon, level)
    inside = dense.withColumns({"sy": sy, "sx": sx}).join(parents, key)
    ny, nx = grid.part(iy, ix, lat, lon, level + 1)
    whole = F.col("n") <= LEAF  # positions differ, so every larger summary comes apart at some level
    inside = inside.withColumns({"cy": ny, "cx": nx, "leaf": F.when(whole, F.col("pid"))})
    parts = inside.groupBy(*key, "cy", "cx", "leaf").agg(
        F.count(F.lit(1)).alias("cn"),
        F.sum("w").alias("cw"),
        F.min(F.struct("lat", "lon")).alias("at"),
        F.first("owner").alias("owner"),
    )
    child = _node(
        F.col("cn"), F.col("cw"), F.col("at.lat"), F.col("at.lon"),
        grid.spread(iy, F.lit(float(level + 1))), F.col("owner"),
        iy=iy, ix=ix, sy=F.col("cy"), sx=F.col("cx"),
    )
    # at most SPLIT*SPLIT parts or LEAF points per parent
    return parts.select(*key, child.alias("child"))


def _split_side(pairs: DataFrame, side: str, kids: DataFrame, group: list[str]) -> DataFrame:
    """Replace the summaries on one side by their children; single points stay."""
    cell = ("iy", "ix", "sy", "sx")
    found = kids.select(*[F.col(c).alias(f"_{c}") for c in (*group, *cell, "child")])
    on = [F.col(g) == F.col(f"_{g}") for g in group]
    on += [F.when(F.col(f"{side}.n") > 1, F.col(f"{side}.{k}")) == F.col(f"_{k}") for k in cell]
    split = pairs.join(found, reduce(lambda p, q: p & q, on), "left")
    return split.withColumn(side, F.coalesce("_child", side)).select(*pairs.columns)


def _judge(pairs: DataFrame, eps: float) -> DataFrame:
    """Distance of the two stand-ins and what it proves.

    touch: some point of one side is within the radius of some point of the other.
    inner: every point of b is within the radius of the single point a.
    open: neither proven nor ruled out.
    """
    half_lat, half_lon = F.sin((F.col("b.phi") - F.col("a.phi")) / 2), F.sin((F.col("b.lam") - F.col("a.lam")) / 2)
    d = arc_km(half_lat * half_lat + F.col("a.cos") * F.col("b.cos") * half_lon * half_lon)
    far = F.col("a.far") + F.col("b.far")
    judged = pairs.withColumn("d", d).where(F.col("d") <= eps * (1 + 1e-9) + far)
    inner = F.when(far == 0, F.col("d") <= eps).otherwise(F.col("d") + far <= eps * (1 - 1e-9))
    judged = judged.withColumns({"touch": F.col("d") <= eps, "inner": inner})
    return judged.withColumn("open", ~F.col("inner") & (far > 0)).where(F.col("touch") | F.col("open")).drop("d")


def _across_components(unsettled: DataFrame, proven: DataFrame) -> DataFrame:
    """Drop undecided pairs of dense cells that proven contacts already connect."""
    roots = connected_components(proven.where(F.col("a_dense")).select("u", "v"))
    pairs = unsettled.where(F.col("a_dense"))
    for side in ("a", "b"):
        found = roots.select(F.col("node").alias(f"_{side}n"), F.col("root").alias(f"_{side}r"))
        pairs = pairs.join(found, F.col(f"{side}.owner") == F.col(f"_{side}n"), "left")
    apart = F.coalesce("_ar", F.col("a.owner")) != F.coalesce("_br", F.col("b.owner"))
    return unsettled.where(~F.col("a_dense")).unionByName(pairs.where(apart).select(*unsettled.columns))


def dbscan(
    df: DataFrame,
    group: str | Sequence[str],
    id: str,
    lat: str = "lat",
    lon: str = "long",
    eps_km: float = 0.075,
    min_samples: int = 20,
    small_group: str = "isolated",
) -> DataFrame:
    """Cluster labels per group: adds cluster_id, is_core and is_noise.

    A point is a core if at least `min_samples` points, itself included, lie within
    `eps_km`. Clusters are numbered from 0 per group by their least core id; a border
    point joins the lowest-numbered cluster in reach; noise is -1. `id` only orders the
    clusters: it may repeat, within a group and between groups (ties go by position).
    Rows without coordinates or group are left out, and with `small_group="skip"` so
    are groups of fewer than `min_samples` rows.
    """
    group = [group] if isinstance(group, str) else list(group)
    grid = _Grid(eps_km)
    points = _distinct_points(df, group, id, lat, lon)
    points = points.withColumn("iy", grid.row(F.col("lat")))
    points = points.withColumn("ix", grid.column(F.col("iy"), F.col("lon")))

    cell_key = [*group, "iy", "ix"]
    full = points.groupBy(*cell_key).agg(F.sum("w").alias("cw"), F.min("pid").alias("owner"))
    full = full.where(F.col("cw") >= min_samples).select(*cell_key, "owner")
    flagged, told = observed(points.join(full, cell_key, "left"), rows=F.count(F.lit(1)))
    dense = flagged.where(F.col("owner").isNotNull())
    lone = flagged.where(F.col("owner").isNull())
    dense_cells = materialize(
        dense.groupBy(*cell_key, "owner").agg(
            F.sum("w").alias("cw"), F.count(F.lit(1)).alias("cn"), F.min(F.struct("lat", "lon")).alias("at")
        )
    )

    zero = F.lit(0).cast("long")
    iy, ix = F.col("iy"), F.col("ix")
    cell_node = _node(
        F.col("cn"), F.col("cw"), F.col("at.lat"), F.col("at.lon"), grid.spread(iy, F.lit(0.0)),
        F.col("owner"), iy=iy, ix=ix, sy=zero, sx=zero,
    )
    lone_node = _node(
        F.lit(1).cast("long"), F.col("w"), F.col("lat"), F.col("lon"), F.lit(0.0),
        F.col("pid"), iy=iy, ix=ix, sy=zero, sx=zero,
    )
    seekers = lone.select(*group, lone_node.alias("a"), F.lit(False).alias("a_dense"), "iy", "ix").unionByName(
        dense_cells.select(*group, cell_node.alias("a"), F.lit(True).alias("a_dense"), "iy", "ix")
    )
    targets = lone.select(
        *group, lone_node.alias("b"), F.lit(False).alias("b_dense"), iy.alias("ky"), ix.alias("kx")
    ).unionByName(
        dense_cells.select(*group, cell_node.alias("b"), F.lit(True).alias("b_dense"), iy.alias("ky"), ix.alias("kx"))
    )
    reach = spread(seekers, told["rows"]).withColumn("k", F.explode(grid.around(iy, ix))).select(
        *group, "a", "a_dense", F.col("k.ky").alias("ky"), F.col("k.kx").alias("kx")
    )
    # every unordered pair once, except that a lone point counts its neighbours itself
    once = (~F.col("a_dense") & ~F.col("b_dense")) | (~F.col("a_dense") & F.col("b_dense")) | (
        F.col("a_dense") & F.col("b_dense") & (F.col("a.owner") < F.col("b.owner"))
    )
    pairs = reach.join(targets, [*group, "ky", "kx"]).where(once).drop("ky", "kx")
    # one proof of contact settles a pair of dense cells
    is_open = F.col("open") & ~(F.col("touch") & F.col("a_dense"))
    undecided = {"open": F.count_if(is_open), "open_dense": F.count_if(is_open & F.col("a_dense"))}
    judged, told = observed(_judge(pairs, eps_km), **undecided)

    proven = []
    level = 0
    while True:
        facts = judged.where(F.col("touch")).select(
            *group, "a_dense", "b_dense", F.col("a.owner").alias("u"), F.col("b.owner").alias("v"),
            F.when(F.col("inner"), F.col("b.w")).otherwise(F.lit(0)).alias("w"),
        )
        proven.append(facts)
        if not told["open"]:
            break
        unsettled = judged.where(is_open).select(*group, "a", "a_dense", "b", "b_dense")
        if told["open_dense"]:  # pairs of dense cells that contacts connect already need no further proof
            unsettled = _across_components(unsettled, reduce(DataFrame.unionByName, proven))
            unsettled, told = observed(unsettled, open=F.count(F.lit(1)))
            if not told["open"]:
                break
        # a pair becomes up to SPLIT^4 or LEAF^2 pairs, which its bytes don't show
        unsettled = spread(unsettled, told["open"], per_task=5_000, least=50)
        parents = reduce(
            DataFrame.unionByName,
            [
                unsettled.where(F.col(f"{s}.n") > 1).select(*group, f"{s}.iy", f"{s}.ix", f"{s}.sy", f"{s}.sx", f"{s}.n")
                for s in ("a", "b")
            ],
        ).distinct()
        kids = materialize(_children(dense, parents, group, grid, level))
        split = _split_side(_split_side(unsettled, "b", kids, group), "a", kids, group)
        judged, told = observed(_judge(split, eps_km), **undecided)
        release(kids)
        level += 1
    contacts = materialize(
        reduce(DataFrame.unionByName, proven).groupBy(*group, "a_dense", "b_dense", "u", "v").agg(F.sum("w").alias("w"))
    )

    # cores among the lone points, counted over everything in reach (itself included)
    weight = contacts.where(~F.col("a_dense")).groupBy("u").agg(F.sum("w").alias("weight"))
    cores = materialize(weight.where(F.col("weight") >= min_samples).select(F.col("u").alias("core")))
    from_core = contacts.where(~F.col("a_dense")).join(cores, F.col("u") == F.col("core"), "left_semi")
    to_core = from_core.where(F.col("b_dense")).unionByName(
        from_core.where(~F.col("b_dense") & (F.col("u") > F.col("v"))).join(cores, F.col("v") == F.col("core"), "left_semi")
    )
    links = contacts.where(F.col("a_dense")).unionByName(to_core).select("u", "v")
    members = dense_cells.select(*group, F.col("owner").alias("node")).unionByName(
        lone.join(cores, F.col("pid") == F.col("core"), "left_semi").select(*group, F.col("pid").alias("node"))
    )
    roots = connected_components(links)
    rooted = materialize(
        members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    )
    owners = rooted.join(_number_clusters(rooted, group), "root").select("node", "cluster_id")

    # border points: lowest cluster among the cores and dense cells they touch
    loose = contacts.where(~F.col("a_dense")).join(cores, F.col("u") == F.col("core"), "left_anti")
    border = loose.join(owners, F.col("v") == F.col("node")).groupBy(F.col("u").alias("node")).agg(
        F.min("cluster_id").alias("cluster_id")
    )
    lone_label = owners.withColumn("is_core", F.lit(True)).unionByName(border.withColumn("is_core", F.lit(False)))
    labels = flagged.withColumn("node", F.coalesce("owner", "pid")).join(lone_label, "node", "left").select(
        *[F.col(g).alias(f"_{g}") for g in group], F.col("lat").alias("_lat"), F.col("lon").alias("_lon"),
        F.coalesce("cluster_id", F.lit(NOISE)).alias("cluster_id"),
        F.coalesce("is_core", F.lit(False)).alias("is_core"),
    )
    if small_group == "skip":
        sizes = flagged.groupBy(*group).agg(F.sum("w").alias("_size")).where(F.col("_size") >= min_samples)
        big = sizes.select(*[F.col(g).alias(f"_{g}") for g in group])
        labels = labels.join(big, [f"_{g}" for g in group], "left_semi")
    on = [df[g] == F.col(f"_{g}") for g in group] + [df[lat] == F.col("_lat"), df[lon] == F.col("_lon")]
    out = df.join(labels, reduce(lambda p, q: p & q, on))
    return out.select(*[df[c] for c in df.columns], "cluster_id", "is_core").withColumn(
        "is_noise", F.col("cluster_id") == NOISE
    )


def _number_clusters(rooted: DataFrame, group: list[str]) -> DataFrame:
    """(root, cluster_id): clusters of a group numbered from 0 by their root, spread over ranges."""
    numbered = number_rows(rooted.select(*group, "root").distinct(), ["root"], group)
    return numbered.select("root", (F.col("rn") - 1).cast("int").alias("cluster_id"))


def dbscan_multi(df: DataFrame, scales: dict[str, tuple[float, int]], **kw) -> dict[str, DataFrame]:
    """Independent runs over the same points at several scales."""
    return {name: dbscan(df, eps_km=eps, min_samples=least, **kw) for name, (eps, least) in scales.items()}


def dbscan_nested(
    df: DataFrame, group: str, id: str, outer: tuple[float, int], inner: tuple[float, int], **kw
) -> DataFrame:
    """A coarse pass, then a fine pass inside each coarse cluster.

    Adds macro_id and micro_id; micro_id is -1 outside the coarse clusters.
    """
    macro = dbscan(df, group, id, eps_km=outer[0], min_samples=outer[1], **kw)
    macro = materialize(macro.withColumnRenamed("cluster_id", "macro_id").drop("is_core", "is_noise"))
    dense = macro.where(F.col("macro_id") >= 0)
    micro = dbscan(dense, [group, "macro_id"], id, eps_km=inner[0], min_samples=inner[1], **kw)
    micro = micro.withColumnRenamed("cluster_id", "micro_id").drop("is_core", "is_noise")
    rest = macro.where(F.col("macro_id") < 0).withColumn("micro_id", F.lit(NOISE))
    return micro.unionByName(rest)


def cluster_stats(labels: DataFrame, group: str | Sequence[str]) -> DataFrame:
    """Per group: total points, clusters, clustered share and noise share in percent."""
    group = [group] if isinstance(group, str) else list(group)
    in_cluster = F.when(F.col("cluster_id") >= 0, F.col("cluster_id"))
    agg = labels.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(in_cluster).alias("n_clusters"),
        F.count_if(F.col("cluster_id") == NOISE).alias("_noise"),
    )
    noise = F.col("_noise").cast("double") / F.col("total") * 100
    return agg.withColumns(
        {"clustered_pct": F.bround(F.lit(100.0) - noise, 1), "noise_pct": F.bround(noise, 1)}
    ).drop("_noise")


def cluster_kpis(labels: DataFrame, group: str | Sequence[str]) -> DataFrame:
    """Distinct clusters and share of clustered points, as a map caption shows them."""
    group = [group] if isinstance(group, str) else list(group)
    in_cluster = F.when(~F.col("is_noise"), F.col("cluster_id"))
    return (
        labels.groupBy(*group)
        .agg(
            F.count_distinct(in_cluster).alias("map_cluster_count"),
            F.count_if(~F.col("is_noise")).alias("hotspot_points"),
            F.count_if(F.col("is_noise")).alias("dispersed_points"),
        )
        .withColumn(
            "map_hotspot_pct",
            share_pct(F.col("hotspot_points"), F.col("hotspot_points") + F.col("dispersed_points"), even=True),
        )
    )


def bin_clusters(
    df: DataFrame, group: Sequence[str], digits: int = 2, min_count: int = 2, lat: str = "lat", lon: str = "long"
) -> DataFrame:
    """Concentration without distances: bins of rounded coordinates with enough rows."""
    rows = df
    for c in (*group, lat, lon):
        rows = rows.where(F.col(c).isNotNull())
    bins = spatial_bin(rows, digits, lat, lon).groupBy(*group, "lat_bin", "long_bin").agg(F.count(F.lit(1)).alias("n"))
    full = F.col("n") >= min_count
    per_area = bins.groupBy(*group).agg(
        F.sum("n").alias("total"),
        F.count_if(full).alias("n_clusters"),
        F.sum(F.when(full, F.col("n")).otherwise(0)).alias("_clustered"),
        F.sum(F.when(F.col("n") == 1, F.col("n")).otherwise(0)).alias("_isolated"),
    )
    return per_area.withColumns(
        {
            "clustered_pct": share_pct(F.col("_clustered"), F.col("total")),
            "isolated_pct": share_pct(F.col("_isolated"), F.col("total")),
        }
    ).drop("_clustered", "_isolated")

