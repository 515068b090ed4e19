"""Problem 3: points within a distance of places, or inside polygons.

Everything is done with unit vectors on the sphere, so the poles and the
antimeridian are no special cases. A region (a polygon, or the polygon drawn
around a circle) is projected gnomonically about its middle, where great
circles are straight lines, and cut into triangles by ear clipping on the
executors. Triangles and points are routed to cubes of space: a region goes to the
cubes of its own size that its triangles meet, eight at most each, a point to one
cube of every size in use. Points of cubes without a region go no further. Blocks of cubes are
worked on together, and a block of very many points is split. In each part a
bounding-volume hierarchy of 3-D boxes is built over the block's triangles; points
descend it in batches,
candidate triangles are tested exactly by triple products, and a point on a shared
side is assigned to its region once. The plan is the same for any number of regions.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almazara.runtime import materialize

#: Radius of the sphere, metres (fixed value).
EARTH_M = 6_371_008.8
#: Corners of the polygon drawn around a circle.
CORNERS = 8
#: Children of a node of the hierarchy.
WIDTH = 16
#: Slack of boxes and side tests, in units of the sphere's radius (about 6 mm).
SLACK = 1e-9
#: Halvings of the smallest cubes: sides of 2 / 2 ** LEVELS radii, some 50 km.
LEVELS = 8
#: Halvings between a cube and the block of cubes whose triangles make one hierarchy.
BLOCK = 4
#: Points of a block from which it is split into parts.
PART_POINTS = 100_000


def unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """(n, 3) unit vectors of degrees."""
    la, lo = np.radians(lat), np.radians(lon)
    c = np.cos(la)
    return np.stack([c * np.cos(lo), c * np.sin(lo), np.sin(la)], axis=1)


def _frame(middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two directions that with ``middle`` make a right-handed frame."""
    a = np.eye(3)[np.argmin(np.abs(middle))]
    e1 = np.cross(a, middle)
    e1 /= np.linalg.norm(e1)
    return e1, np.cross(middle, e1)


def ear_clip(xy: np.ndarray) -> list[tuple[int, int, int]]:
    """Triangles (corner numbers) of a simple polygon; none for fewer than 3 distinct corners."""
    area = lambda a, b, c: (xy[b][0] - xy[a][0]) * (xy[c][1] - xy[a][1]) - (xy[b][1] - xy[a][1]) * (xy[c][0] - xy[a][0])
    left = [i for i in range(len(xy)) if not np.array_equal(xy[i], xy[i - 1])]
    if len(left) < 3:
        return []
    if sum(xy[left[i - 1]][0] * xy[left[i]][1] - xy[left[i]][0] * xy[left[i - 1]][1] for i in range(len(left))) < 0:
        left.reverse()
    out = []
    while len(left) > 3:
        for k in range(len(left)):
            a, b, c = left[k - 1], left[k], left[(k + 1) % len(left)]
            turn = area(a, b, c)
            if turn < 0:
                continue
            if turn == 0 or not any(area(a, b, p) >= 0 and area(b, c, p) >= 0 and area(c, a, p) >= 0 for p in left if p not in (a, b, c) and not any(np.array_equal(xy[p], xy[q]) for q in (a, b, c))):
                if turn > 0:
                    out.append((a, b, c))
                left.pop(k)
                break
        else:  # corners that cross: the rest is fanned, so no area is lost
            out += [(left[0], left[i], left[i + 1]) for i in range(1, len(left) - 1)]
            return out
    if area(*left) != 0:
        out.append(tuple(left))
    return out


@lru_cache(maxsize=1)
def _round() -> tuple[np.ndarray, np.ndarray]:
    """(corners, triangles) of the regular polygon about a circle of radius 1."""
    turn = 2 * np.pi * np.arange(CORNERS) / CORNERS
    xy = np.stack([np.cos(turn), np.sin(turn)], axis=1)
    return xy / math.cos(math.pi / CORNERS), np.array(ear_clip(xy))


def circle_triangles(lat: np.ndarray, lon: np.ndarray, radius_m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """((k, 3, 3) triangles, (k) number of the circle) whose unions hold the circles.

    All circles are cut alike, as their polygons differ in size only. Circles
    beyond an eighth of the sphere's girth take the eight octants.
    """
    angle = np.asarray(radius_m, float) / EARTH_M * (1 + 1e-9) + SLACK
    small = np.flatnonzero(angle < math.pi / 4)
    m = unit_vectors(np.asarray(lat, float)[small], np.asarray(lon, float)[small])
    axis = np.eye(3)[np.abs(m).argmin(axis=1)] if len(m) else np.zeros((0, 3))
    e1 = np.cross(axis, m)
    e1 /= np.linalg.norm(e1, axis=1, keepdims=True)
    e2 = np.cross(m, e1)
    xy, cut = _round()
    r = np.tan(angle[small])[:, None, None]
    v = m[:, None] + r * (xy[:, :1] * e1[:, None] + xy[:, 1:] * e2[:, None])
    v /= np.linalg.norm(v, axis=2, keepdims=True)
    tri, owner = v[:, cut].reshape(-1, 3, 3), np.repeat(small, len(cut))
    large = np.flatnonzero(angle >= math.pi / 4)
    octants = np.array([np.diag([x, y, z]) for x in (1.0, -1.0) for y in (1.0, -1.0) for z in (1.0, -1.0)])
    return np.concatenate([tri, np.tile(octants, (len(large), 1, 1))]), np.concatenate([owner, np.repeat(large, 8)])


def polygon_triangles(lat: list[float], lon: list[float]) -> np.ndarray:
    """(k, 3, 3) triangles of a polygon of great-circle sides; none for one that doesn't fit in a hemisphere or has a corner that is at no place."""
    corners = np.array([lat, lon], float)
    if not (np.isfinite(corners).all() and (np.abs(corners[0]) <= 90).all() and (np.abs(corners[1]) <= 180).all()):
        return np.zeros((0, 3, 3))
    v = unit_vectors(*corners)
    m = v.mean(axis=0)
    m /= max(np.linalg.norm(m), 1e-12)
    d = v @ m
    if d.min() <= 1e-6:
        return np.zeros((0, 3, 3))
    e1, e2 = _frame(m)
    return _lift(np.stack([v @ e1 / d, v @ e2 / d], axis=1), m, e1, e2)


def _lift(xy: np.ndarray, m: np.ndarray, e1: np.ndarray, e2: np.ndarray) -> np.ndarray:
    v = m + xy[:, :1] * e1 + xy[:, 1:] * e2
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    tri = ear_clip(xy)
    return np.array([[v[a], v[b], v[c]] for a, b, c in tri]).reshape(-1, 3, 3)


def boxes(triangles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest corners of the boxes of spherical triangles: their corners, and the bulge of the sphere over the flat triangle."""
    low, high = triangles.min(axis=1), triangles.max(axis=1)
    side = np.linalg.norm(triangles - np.roll(triangles, 1, axis=1), axis=2).max(axis=1) if len(triangles) else np.zeros(0)
    bulge = np.minimum(side * side / 2, 1.0)[:, None] + SLACK
    return low - bulge, high + bulge


class Hierarchy:
    """Bounding-volume hierarchy over spherical triangles, ``WIDTH`` children a node."""

    def __init__(self, triangles: np.ndarray, owner: np.ndarray) -> None:
        low, high = boxes(triangles)
        # Along a space-filling order of the middles, neighbours share nodes.
        mid = ((low + high) / 2 + 1) / 2
        key = np.zeros(len(mid), np.int64)
        q = np.clip((mid * 2**20).astype(np.int64), 0, 2**20 - 1)
        for bit in range(20):
            for axis in range(3):
                key |= ((q[:, axis] >> bit) & 1) << (3 * bit + axis)
        order = np.argsort(key, kind="stable")
        self.triangles, self.owner = triangles[order], owner[order]
        a, b, c = (self.triangles[:, i] for i in range(3))
        sign = np.sign(np.einsum("ij,ij->i", np.cross(a, b), c))[:, None]
        normals = np.stack([np.cross(a, b), np.cross(b, c), np.cross(c, a)], axis=1) * sign[:, None]
        self.normals = normals / np.maximum(np.linalg.norm(normals, axis=2, keepdims=True), 1e-300)
        self.levels = [(low[order], high[order])]
        while len(self.levels[0][0]) > WIDTH:
            lo, hi = self.levels[0]
            starts = np.arange(0, len(lo), WIDTH)
            self.levels.insert(0, (np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts)))

    def find(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point number, owner) of each pair, every pair once."""
        p = np.repeat(np.arange(len(points)), len(self.levels[0][0]))
        node = np.tile(np.arange(len(self.levels[0][0])), len(points))
        for depth, (lo, hi) in enumerate(self.levels):
            x = points[p]
            inside = ((x >= lo[node]) & (x <= hi[node])).all(axis=1)
            p, node = p[inside], node[inside]
            if depth + 1 < len(self.levels):
                n = len(self.levels[depth + 1][0])
                p = np.repeat(p, WIDTH)
                node = (node[:, None] * WIDTH + np.arange(WIDTH)).ravel()
                p, node = p[node < n], node[node < n]
        x = points[p]
        sides = np.einsum("nij,nj->ni", self.normals[node], x)
        forward = np.einsum("nj,nj->n", self.triangles[node].sum(axis=1), x) > 0
        hit = (sides >= -SLACK).all(axis=1) & forward
        pairs = np.unique(np.stack([p[hit], self.owner[node[hit]]], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]


def good_coordinates(lat: Column, lon: Column) -> Column:
    """True where both are numbers in range; null, NaN and out-of-range coordinates are at no place."""
    ok = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return ok & lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2.0))
    return F.asin(F.least(F.lit(1.0), F.sqrt(a))) * (2 * EARTH_M)


_XYZ = [f"{axis}{i}" for i in (1, 2, 3) for axis in "xyz"]
_REGION = ["rid", "rlat", "rlon", "radius_m"]


def _routed_triangles(frames):
    """Regions to rows of (cube, region, triangle): each triangle once for each cube of its region's size that its box meets."""
    for frame in frames:
        is_round = frame["radius_m"].notna().to_numpy()
        at = np.flatnonzero(is_round)
        tri, owner = circle_triangles(*(frame[c].to_numpy(float)[at] for c in ("rlat", "rlon", "radius_m")))
        cut = [(polygon_triangles(list(frame["lats"].iloc[i]), list(frame["lons"].iloc[i])), i) for i in np.flatnonzero(~is_round)]
        tri = np.concatenate([tri, *[t for t, _ in cut]])
        owner = np.concatenate([at[owner], *[np.full(len(t), i) for t, i in cut]]).astype(np.int64)
        if not len(tri):
            continue
        low, high = boxes(tri)
        extent = np.zeros(len(frame))
        np.maximum.at(extent, owner, (high - low).max(axis=1))
        level = np.clip(np.floor(np.log2(2 / np.maximum(extent, 1e-12))), 0, LEVELS).astype(np.int64)[owner]
        first, last = (np.floor((np.clip(c, -1, 1) + 1) * 2.0 ** level[:, None] / 2).astype(np.int64) for c in (low, high))
        # A box is no wider than a cube of its size: it meets two at most along each axis.
        for step in np.ndindex(2, 2, 2):
            place = first + step
            meets = (place <= last).all(axis=1)
            i, j, k = place[meets].T
            region = frame.iloc[owner[meets]]
            rows = pd.DataFrame(tri[meets].reshape(-1, 9), columns=_XYZ)
            rows.insert(0, "cube", ((level[meets] * 1024 + i) * 1024 + j) * 1024 + k)
            for n, c in enumerate(_REGION):
                rows.insert(n + 1, c, region[c].to_numpy())
            if len(rows):
                yield rows


def _cube(level: Column) -> Column:
    """Number of the cube of a level that holds the unit vector (px, py, pz)."""
    side = lambda c: F.floor((F.col(c) + 1) * F.pow(F.lit(2.0), level) / 2)
    return ((level.cast("long") * 1024 + side("px")) * 1024 + side("py")) * 1024 + side("pz")


def _test_part(points: pd.DataFrame, regions: pd.DataFrame, batch: int = 4096) -> pd.DataFrame:
    """(rid, pid) of a part of a block, each pair once: the hierarchy, then the exact distance where a region has a radius."""
    if not len(points) or not len(regions):
        return pd.DataFrame({"rid": np.zeros(0, np.int64), "pid": np.zeros(0, np.int64)})
    regions = regions.drop_duplicates(["rid", *_XYZ])
    ids, owner = np.unique(regions["rid"].to_numpy(), return_inverse=True)
    tree = Hierarchy(regions[_XYZ].to_numpy(float).reshape(-1, 3, 3), owner)
    one = regions.drop_duplicates("rid").set_index("rid").loc[ids]
    lat, lon, radius = (one[c].to_numpy(float) for c in ("rlat", "rlon", "radius_m"))
    rids, pids = [], []
    for at in range(0, len(points), batch):
        part = points.iloc[at : at + batch]
        la, lo = part["lat"].to_numpy(), part["lon"].to_numpy()
        p, k = tree.find(unit_vectors(la, lo))
        a1, a2 = np.radians(la[p]), np.radians(lat[k])
        h = np.sin((a2 - a1) / 2) ** 2 + np.cos(a1) * np.cos(a2) * np.sin(np.radians(lon[k] - lo[p]) / 2) ** 2
        near = np.isnan(radius[k]) | (2 * EARTH_M * np.arcsin(np.minimum(1.0, np.sqrt(h))) <= radius[k])
        rids.append(ids[k[near]])
        pids.append(part["pid"].to_numpy()[p[near]])
    return pd.DataFrame({"rid": np.concatenate(rids), "pid": np.concatenate(pids)}).drop_duplicates()


def region_pairs(points: DataFrame, regions: DataFrame, *, part_points: int = PART_POINTS) -> DataFrame:
    """(rid, pid) of every point in a region, each pair once.

    ``points``: pid long, lat, lon, good coordinates only. ``regions``: rid long,
    rlat, rlon, radius_m (null for polygons), lats, lons (arrays). A region lies in
    cubes of one size and a point in one of them, so no pair is found twice; rows
    of one pid come into one part. The cubes in use, their blocks and the parts of
    these are small tables written down: Catalyst knows their size and sends them to
    the points where it is under its threshold, else shuffles.
    """
    spark = points.sparkSession
    schema = "cube long, rid long, rlat double, rlon double, radius_m double, " + ", ".join(f"{c} double" for c in _XYZ)
    triangles = materialize(regions.repartition("rid").mapInPandas(_routed_triangles, schema), "triangles")
    level = F.shiftright("cube", 30)
    # At most LEVELS + 1 numbers.
    levels = sorted(r[0] for r in triangles.select(level.cast("int").alias("level")).distinct().collect())
    if not levels:
        return spark.createDataFrame([], "rid long, pid long")
    la, lo = F.radians("lat"), F.radians("lon")
    p = points.select("pid", "lat", "lon", (F.cos(la) * F.cos(lo)).alias("px"), (F.cos(la) * F.sin(lo)).alias("py"), F.sin(la).alias("pz"))
    p = p.select("pid", "lat", "lon", F.explode(F.array(*[_cube(F.lit(n)) for n in levels])).alias("cube"))
    used = materialize(triangles.groupBy("cube").agg(F.count("*").alias("triangles")).select("cube").coalesce(1), "cubes")
    held = p.join(used, "cube").groupBy("cube").agg(F.count("*").alias("n"))
    coarse = lambda shift: F.shiftright(F.shiftright("cube", shift).bitwiseAND(1023), BLOCK)
    held = materialize(held.select("cube", "n", (((level * 1024 + coarse(20)) * 1024 + coarse(10)) * 1024 + coarse(0)).alias("block")).coalesce(1), "held")
    parts = held.groupBy("block").agg(F.ceil(F.sum("n") / part_points).cast("int").alias("parts"))
    parts = materialize(held.select("cube", "block").join(parts, "block").coalesce(1), "parts")
    routed = p.join(parts, "cube").select("block", F.pmod(F.xxhash64("pid"), F.col("parts")).cast("int").alias("part"), "pid", "lat", "lon")
    spread = triangles.join(parts, "cube").select((F.col("block") + 0).alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *_REGION, *_XYZ)
    return routed.groupBy("block", "part").cogroup(spread.groupBy("block", "part")).applyInPandas(lambda a, b: _test_part(a, b), "rid long, pid long")


def _point_rows(points: DataFrame, point_id: str, latitude: str, longitude: str) -> DataFrame:
    good = good_coordinates(F.col(latitude), F.col(longitude)) & F.col(point_id).isNotNull()
    return points.where(good).select(F.col(point_id).cast("long").alias("pid"), F.col(latitude).alias("lat"), F.col(longitude).alias("lon"))


def near_places(points: DataFrame, places: DataFrame, *, point_id: str, place_id: str, latitude: str = "latitude", longitude: str = "longitude", radius_m: str = "radius_m", part_points: int = PART_POINTS) -> DataFrame:
    """(place_id, point_id) of points at most ``radius_m`` metres from a place.

    Candidates come from the triangles drawn around each circle; the exact
    great-circle distance decides, in the worker that holds the candidate. Ids
    are whole numbers. Points and places with null, NaN or out-of-range
    coordinates, and places with a null or negative radius, are at no place.
    Copies of a point row give one pair, as do repeated rows of a place; rows of a
    place that differ are all tried. Other columns are ignored.
    """
    ok = good_coordinates(F.col(latitude), F.col(longitude)) & (F.col(radius_m) >= 0) & ~F.isnan(radius_m) & F.col(place_id).isNotNull()
    circle = places.where(ok).select(F.col(place_id).cast("long").alias("place"), F.col(latitude).alias("rlat"), F.col(longitude).alias("rlon"), F.col(radius_m).cast("double").alias("radius_m")).distinct()
    # Circles are numbered by what they are, so a place may have several.
    circle = circle.withColumn("rid", F.xxhash64("place", "rlat", "rlon", "radius_m"))
    none = F.lit(None).cast("array<double>")
    found = region_pairs(_point_rows(points, point_id, latitude, longitude), circle.select("rid", "rlat", "rlon", "radius_m", none.alias("lats"), none.alias("lons")), part_points=part_points)
    names = materialize(circle.select("rid", "place").coalesce(1), "places")
    several = names.groupBy("place").agg(F.count("*").alias("n")).where(F.col("n") > 1).isEmpty()
    out = found.join(names, "rid").select(F.col("place").alias(place_id), F.col("pid").alias(point_id))
    return out if several else out.distinct()


def regions_of(points: DataFrame, polygons: DataFrame, *, point_id: str, region_id: str, latitude: str = "latitude", longitude: str = "longitude", lats: str = "lats", lons: str = "lons", part_points: int = PART_POINTS) -> DataFrame:
    """(point_id, region_id): the polygon that holds each point; on a shared side, the smallest region id.

    Polygons are arrays of corner latitudes and longitudes with great-circle
    sides; those with a null or short array, a null, NaN or out-of-range corner, or
    wider than a hemisphere hold nothing.
    """
    whole = (F.size(lats) >= 3) & (F.size(lats) == F.size(lons)) & ~F.exists(lats, lambda x: x.isNull()) & ~F.exists(lons, lambda x: x.isNull())
    no = F.lit(None).cast("double")
    reg = polygons.where(whole & F.col(region_id).isNotNull()).select(F.col(region_id).cast("long").alias("rid"), no.alias("rlat"), no.alias("rlon"), no.alias("radius_m"), F.col(lats).cast("array<double>").alias("lats"), F.col(lons).cast("array<double>").alias("lons"))
    found = region_pairs(_point_rows(points, point_id, latitude, longitude), reg, part_points=part_points)
    return found.groupBy(F.col("pid").alias(point_id)).agg(F.min("rid").alias(region_id))
