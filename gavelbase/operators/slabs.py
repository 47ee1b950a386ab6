"""Points near other points or inside regions, by trapezoidal decomposition.

Method: the boundary edges of all regions of a cell are cut at every vertex and crossing into ordered slabs; within a slab the
edges don't cross, so they have one order from bottom to top, and each gap between two edges lies in a fixed set of
regions. A point is located by a binary search for its slab and another among the slab's edges. A circle on the sphere is
located by a polygon drawn around it and then checked exactly by the great-circle distance.

The plane is divided into cells (a strip of longitude by a band of latitude); a region belongs to each cell its box touches.
If the edges number at most ``BROADCAST_EDGES``, the slabs are sent to all tasks and the points aren't shuffled at all; beyond
that, points and regions meet by cell, with the points of a cell spread over salted groups.

Defined results: points or regions with a missing, infinite or unreadable coordinate are in no pair; a point on a boundary
counts as inside a region that includes its edge on its left or below; repeated points give their own rows; an empty side
gives no rows. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
#: At most so many edges are broadcast (40 bytes each, and a few times that for their slabs: some 50 MB).
BROADCAST_EDGES = 200_000
#: Regions decomposed together.
LAYER = 64
#: Points of a cell in one salted group.
GROUP_POINTS = 200_000
_EDGES = "region_id bigint, x1 double, y1 double, x2 double, y2 double"


class Slabs:
    """The decomposition of one set of region boundaries. Each row of edges: region number, x1, y1, x2, y2."""

    def __init__(self, region: np.ndarray, edges: np.ndarray):
        swap = edges[:, 0] > edges[:, 2]
        e = np.where(swap[:, None], edges[:, [2, 3, 0, 1]], edges)
        keep = (e[:, 0] < e[:, 2]) & np.isfinite(e).all(axis=1)
        self.e, self.region = e[keep], region[keep]
        self.slope = (self.e[:, 3] - self.e[:, 1]) / (self.e[:, 2] - self.e[:, 0])
        xs = np.unique(np.concatenate([self.e[:, 0], self.e[:, 2]])) if len(self.e) else np.zeros(0)
        xs = np.unique(np.concatenate([xs, self._crossings(xs)]))
        self.xs = xs
        slab, edge = self._active(xs)
        middle = (xs[slab] + xs[slab + 1]) / 2 if len(slab) else np.zeros(0)
        order = np.lexsort((self._y(edge, middle), slab))
        slab, edge = slab[order], edge[order]
        self.edge = edge
        self.first = np.searchsorted(slab, np.arange(len(xs) + 1))
        self._faces(slab)

    def _y(self, edge: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self.e[edge, 1] + self.slope[edge] * (x - self.e[edge, 0])

    def _active(self, xs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slab and edge of each edge that spans a slab."""
        lo, hi = np.searchsorted(xs, self.e[:, 0]), np.searchsorted(xs, self.e[:, 2])
        n = hi - lo
        edge = np.repeat(np.arange(len(n)), n)
        slab = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[edge]
        return slab, edge

    def _crossings(self, xs: np.ndarray) -> np.ndarray:
        if len(xs) < 2:
            return np.zeros(0)
        slab, edge = self._active(xs)
        order = np.argsort(slab, kind="stable")
        slab, edge = slab[order], edge[order]
        bounds, out = np.searchsorted(slab, np.arange(len(xs))), []
        for k in range(len(xs) - 1):
            own = edge[bounds[k] : bounds[k + 1]]
            if len(own) < 2:
                continue
            left, right = self._y(own, np.full(len(own), xs[k])), self._y(own, np.full(len(own), xs[k + 1]))
            place = np.argsort(left, kind="stable")
            own, left, right = own[place], left[place], right[place]
            # only edges whose right ends are out of order cross; each falls behind the running maximum or ahead of the running minimum
            behind = np.maximum.accumulate(right) > right
            ahead = np.minimum.accumulate(right[::-1])[::-1] < right
            part = np.flatnonzero(behind | ahead)
            if len(part) < 2:
                continue
            a, b = np.triu_indices(len(part), 1)
            a, b = part[a], part[b]
            crossed = (left[a] < left[b]) & (right[a] > right[b])
            a, b = a[crossed], b[crossed]
            t = (left[b] - left[a]) / ((left[b] - left[a]) + (right[a] - right[b]))
            out.append(xs[k] + t * (xs[k + 1] - xs[k]))
        return np.concatenate(out) if out else np.zeros(0)

    def _faces(self, slab: np.ndarray) -> None:
        """The regions above each edge of a slab, up to the next: those with an odd number of edges at or below it."""
        starts, regions = np.zeros(len(slab) + 1, np.int64), []
        open_: set[int] = set()
        last = -1
        for k, (s, edge) in enumerate(zip(slab.tolist(), self.edge.tolist())):
            if s != last:
                open_, last = set(), s
            open_ ^= {int(self.region[edge])}
            regions.extend(open_)
            starts[k + 1] = starts[k] + len(open_)
        self.face_start, self.face_region = starts, np.array(regions, np.int64)

    def locate(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the point and region number of each pair."""
        none = np.zeros(0, np.int64)
        if len(self.xs) < 2 or not len(x):
            return none, none
        slab = np.searchsorted(self.xs, x, side="right") - 1
        point = np.flatnonzero((slab >= 0) & (slab < len(self.xs) - 1) & np.isfinite(y))
        slab, px, py = slab[point], x[point], y[point]
        lo, hi = self.first[slab], self.first[slab + 1]
        low, high = lo.copy(), hi.copy()
        while True:  # all points search at once: the number of edges at or below each
            go = low < high
            if not go.any():
                break
            middle = (low + high) // 2
            under = np.zeros(len(point), bool)
            under[go] = self._y(self.edge[middle[go]], px[go]) <= py[go]
            low, high = np.where(go & under, middle + 1, low), np.where(go & ~under, middle, high)
        point, face = point[low > lo], low[low > lo] - 1
        n = self.face_start[face + 1] - self.face_start[face]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.face_start[face], n)
        return np.repeat(point, n), self.face_region[at]


class Layers:
    """Decompositions of ``LAYER`` regions each: regions that lie over one another cut each other's slabs, so their number together is bounded.

    Regions are taken from west to east, so a layer is a strip of longitude and only the points within it are looked for there.
    """

    def __init__(self, ids: np.ndarray, edges: np.ndarray):
        self.ids, number = np.unique(ids, return_inverse=True)
        west = np.full(len(self.ids), np.inf)
        np.minimum.at(west, number, np.minimum(edges[:, 0], edges[:, 2]))
        layer = np.empty(len(self.ids), np.int64)
        layer[np.argsort(west, kind="stable")] = np.arange(len(self.ids)) // LAYER
        order = np.argsort(layer[number], kind="stable")
        cuts = np.searchsorted(layer[number][order], np.arange(-(-len(self.ids) // LAYER) + 1))
        self.layers = [Slabs(number[order[a:b]], edges[order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]

    def locate(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the point and region id of each pair."""
        order = np.argsort(x, kind="stable")
        sorted_x = x[order]
        points, regions = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for layer in self.layers:
            if len(layer.xs) < 2:
                continue
            own = order[np.searchsorted(sorted_x, layer.xs[0]) : np.searchsorted(sorted_x, layer.xs[-1])]
            p, r = layer.locate(x[own], y[own])
            points.append(own[p])
            regions.append(r)
        region = np.concatenate(regions)
        return np.concatenate(points), self.ids[region] if len(self.ids) else region


def read_number(c: Column) -> Column:
    """A coordinate: a number as it stands after trimming; words, nan and infinity give null."""
    from gavelbase.functions.text import strip

    s = strip(c.cast("string"))
    return F.when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), s.try_cast("double"))


def great_circle_m(lat1, lon1, lat2, lon2):
    """Metres on a sphere of radius EARTH_M, for numpy arrays."""
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.clip(h, 0, 1)))


def great_circle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), F.lit(2)) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(F.greatest(h, F.lit(0.0)), F.lit(1.0))))


def circle_edges(lat: float, lon: float, radius_m: float, sides: int = 16) -> list[tuple[float, float, float, float]]:
    """A polygon in degrees around a circle on the sphere; near a pole or for a wide circle its box. Parts across 180 degrees come once on each side."""
    r = min(radius_m / EARTH_M, math.pi) * 1.0000001 + 1e-12
    dlat = math.degrees(r)
    top = abs(lat) + dlat
    if top < 90 and math.sin(r) < math.cos(math.radians(lat)):
        dlon = math.degrees(math.asin(math.sin(r) / math.cos(math.radians(lat))))
    else:
        dlon = 180.0
    if radius_m <= 50_000 and abs(lat) <= 60 and dlon < 90:
        grow = 1.02 / math.cos(math.pi / sides)
        ring = [(lon + dlon * grow * math.cos(2 * math.pi * (k + 0.5) / sides), lat + dlat * grow * math.sin(2 * math.pi * (k + 0.5) / sides)) for k in range(sides)]
    elif dlon >= 180:
        ring = [(-180.5, lat - dlat), (180.5, lat - dlat), (180.5, lat + dlat), (-180.5, lat + dlat)]
        return [(*ring[k], *ring[(k + 1) % 4]) for k in range(4)]
    else:
        dlon *= 1.0000001
        ring = [(lon - dlon, lat - dlat), (lon + dlon, lat - dlat), (lon + dlon, lat + dlat), (lon - dlon, lat + dlat)]
    out = [(*ring[k], *ring[(k + 1) % len(ring)]) for k in range(len(ring))]
    for shift in (360.0, -360.0):
        if min(p[0] for p in ring) + shift < 180.5 and max(p[0] for p in ring) + shift > -180.5:
            out += [(a + shift, b, c + shift, d) for a, b, c, d in out[: len(ring)]]
    return out


def _edges_of_circles(centres: DataFrame) -> DataFrame:
    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            rows = [(r, *e) for r, a, b, m in zip(x["_rid"], x["_rlat"], x["_rlon"], x["_m"]) for e in circle_edges(a, b, m)]
            yield pd.DataFrame(rows, columns=["region_id", "x1", "y1", "x2", "y2"])

    return centres.select("_rid", "_rlat", "_rlon", "_m").mapInPandas(draw, _EDGES)


def locate(points: DataFrame, edges: DataFrame, cell_degrees: float = 0.25, broadcast_edges: int = BROADCAST_EDGES) -> DataFrame:
    """pid, x, y and region_id of each point inside a region. points: pid, x, y; edges: region_id, x1, y1, x2, y2."""
    spark = points.sparkSession
    n_edges = edges.limit(broadcast_edges + 1).count()
    schema = "pid bigint, x double, y double, region_id bigint"
    if n_edges <= broadcast_edges:
        rows = edges.toPandas()
        shared = spark.sparkContext.broadcast(Layers(rows["region_id"].to_numpy(np.int64), rows[["x1", "y1", "x2", "y2"]].to_numpy(float).reshape(-1, 4)))

        def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for x in frames:
                at, region = shared.value.locate(x["x"].to_numpy(float), x["y"].to_numpy(float))
                yield x.iloc[at].assign(region_id=region)

        return points.select("pid", "x", "y").mapInPandas(find, schema)

    def cells(low_x: Column, high_x: Column, low_y: Column, high_y: Column) -> Column:
        cut = lambda c: F.floor(c / cell_degrees)
        return F.explode(F.flatten(F.transform(F.sequence(cut(low_x), cut(high_x)), lambda i: F.transform(F.sequence(cut(low_y), cut(high_y)), lambda j: F.struct(i.alias("i"), j.alias("j"))))))

    box = edges.groupBy("region_id").agg(F.min(F.least("x1", "x2")).alias("ax"), F.max(F.greatest("x1", "x2")).alias("bx"), F.min(F.least("y1", "y2")).alias("ay"), F.max(F.greatest("y1", "y2")).alias("by"))
    parts = box.select("region_id", cells(F.col("ax"), F.col("bx"), F.col("ay"), F.col("by")).alias("c")).join(edges, "region_id").select(F.col("c.i").alias("i"), F.col("c.j").alias("j"), "region_id", "x1", "y1", "x2", "y2")
    # equal rows are located once
    placed = points.where("x is not null and y is not null").groupBy("pid", "x", "y").agg(F.count("*").alias("n")).select(F.floor(F.col("x") / cell_degrees).alias("i"), F.floor(F.col("y") / cell_degrees).alias("j"), "pid", "x", "y", "n")
    groups = placed.groupBy("i", "j").agg(F.ceil(F.count("*") / GROUP_POINTS).cast("int").alias("salts"))
    left = placed.join(groups, ["i", "j"]).withColumn("salt", F.pmod(F.xxhash64("pid", "x", "y"), F.col("salts").cast("bigint")).cast("int")).select("i", "j", "salt", "pid", "x", "y", "n")
    spread = parts.join(groups.toDF("gi", "gj", "n"), (F.col("i") == F.col("gi")) & (F.col("j") == F.col("gj")))
    right = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("i", "j", "salt", "region_id", "x1", "y1", "x2", "y2").toDF("ri", "rj", "rsalt", "region_id", "x1", "y1", "x2", "y2")

    def meet(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        layers = Layers(right["region_id"].to_numpy(np.int64), right[["x1", "y1", "x2", "y2"]].to_numpy(float).reshape(-1, 4))
        at, region = layers.locate(left["x"].to_numpy(float), left["y"].to_numpy(float))
        return left[["pid", "x", "y", "n"]].iloc[at].assign(region_id=region)

    met = left.groupBy("i", "j", "salt").cogroup(right.groupBy("ri", "rj", "rsalt")).applyInPandas(meet, "pid bigint, x double, y double, n bigint, region_id bigint")
    return met.select("pid", "x", "y", "region_id", F.explode(F.sequence(F.lit(1), "n"))).drop("col")


def within_distance(points: DataFrame, centres: DataFrame, radius_m: float | str, point: tuple[str, str, str], centre: tuple[str, str, str], cell_degrees: float = 0.25, broadcast_edges: int = BROADCAST_EDGES) -> DataFrame:
    """Pairs of a point and a centre at most radius_m apart, with their distance: point_id, centre_id, distance_m.

    radius_m: metres, or the name of the centres' column that holds them; a centre with a missing radius, or one below zero, reaches nothing.

    point, centre: the names of the id, latitude and longitude columns. A centre with several positions gives a pair for each.
    """
    pid, plat, plon = (f"`{c}`" for c in point)
    cid, clat, clon = (f"`{c}`" for c in centre)
    own = points.select(F.col(pid).cast("bigint").alias("pid"), F.col(plon).cast("double").alias("x"), F.col(plat).cast("double").alias("y")).where("abs(y) <= 90 and abs(x) <= 180")
    spots = centres.select(F.col(cid).cast("bigint").alias("centre_id"), F.col(clat).cast("double").alias("_rlat"), F.col(clon).cast("double").alias("_rlon"), (F.col(f"`{radius_m}`").cast("double") if isinstance(radius_m, str) else F.lit(float(radius_m))).alias("_m")).where("abs(_rlat) <= 90 and abs(_rlon) <= 180 and _m >= 0")
    spots = spots.dropDuplicates().withColumn("_rid", F.xxhash64("centre_id", "_rlat", "_rlon", "_m"))
    hits = locate(own, _edges_of_circles(spots), cell_degrees, broadcast_edges)
    near = hits.join(spots, F.col("region_id") == F.col("_rid")).select(F.col("pid").alias("point_id"), "centre_id", great_circle(F.col("y"), F.col("x"), F.col("_rlat"), F.col("_rlon")).alias("distance_m"), "_m")
    return near.where("distance_m <= _m").drop("_m")


def points_in_regions(points: DataFrame, regions: DataFrame, point: tuple[str, str, str], region: tuple[str, str], cell_degrees: float = 0.25, broadcast_edges: int = BROADCAST_EDGES) -> DataFrame:
    """point_id and region_id of each point inside a region. region: the id column and a column of rings, array<array<struct<lon, lat>>>; a ring inside another is a hole."""
    pid, plat, plon = (f"`{c}`" for c in point)
    rid, rings = (f"`{c}`" for c in region)
    own = points.select(F.col(pid).cast("bigint").alias("pid"), F.col(plon).cast("double").alias("x"), F.col(plat).cast("double").alias("y")).where("x is not null and y is not null")
    ring = regions.select(F.col(rid).cast("bigint").alias("region_id"), F.explode(F.col(rings)).alias("ring")).where(F.size("ring") >= 3)
    side = ring.select("region_id", F.posexplode("ring").alias("k", "a"), F.col("ring")).select("region_id", "a", F.element_at("ring", F.pmod(F.col("k") + 1, F.size("ring")) + 1).alias("b"))
    edges = side.select("region_id", F.col("a.lon").alias("x1"), F.col("a.lat").alias("y1"), F.col("b.lon").alias("x2"), F.col("b.lat").alias("y2"))
    return locate(own, edges, cell_degrees, broadcast_edges).select(F.col("pid").alias("point_id"), "region_id")
