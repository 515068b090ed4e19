import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from almazara.operators import spatial

P = "measurement_id long, latitude double, longitude double"
S = "site_id long, latitude double, longitude double, radius_m double"


def brute(points, sites):
    out = set()
    for pid, la, lo in points:
        if la is None or lo is None or math.isnan(la) or math.isnan(lo) or abs(la) > 90 or abs(lo) > 180:
            continue
        for sid, sa, so, r in sites:
            h = math.sin(math.radians(sa - la) / 2) ** 2 + math.cos(math.radians(la)) * math.cos(math.radians(sa)) * math.sin(math.radians(so - lo) / 2) ** 2
            if 2 * spatial.EARTH_M * math.asin(min(1, math.sqrt(h))) <= r:
                out.add((sid, pid))
    return out


def cases():
    rng = np.random.default_rng(5)
    sites = [(1, 90.0, 0.0, 5000.0), (2, -89.99, 120.0, 3000.0), (3, 0.0, 180.0, 4000.0), (4, 10.0, -179.99, 4000.0), (5, 40.0, -3.0, 1000.0), (6, 40.0, -3.0, 0.0), (7, 45.0, 9.0, 9_000_000.0), (8, 40.001, -3.001, 1500.0)]
    points, n = [], 0
    for _, la, lo, r in sites:
        for _ in range(40):
            n += 1
            d = min(r, 2e5) / 111_000 * 1.5
            a = float(np.clip(la + rng.uniform(-d, d), -90, 90))
            o = lo + rng.uniform(-d, d) / max(math.cos(math.radians(a)), 1e-3)
            points.append((n, a, float((o + 180) % 360 - 180)))
    points += [(900, None, 1.0), (901, float("nan"), 1.0), (902, 91.0, 0.0), (903, 0.0, 181.0), (904, 40.0, -3.0), (905, 90.0, 77.0), (906, 0.0, -180.0)]
    return points, sites


@pytest.mark.parametrize("part_points", [100_000, 25])
def test_against_brute_force(spark, part_points):
    points, sites = cases()
    p = spark.createDataFrame(points + points[:5], P).withColumn("rid", F.lit("clash")).withColumn("cube", F.lit("clash"))
    s = spark.createDataFrame(sites + [(70, None, 0.0, 1.0), (71, 0.0, 0.0, None), (72, 0.0, 0.0, -1.0)], S)
    out = spatial.near_places(p, s, point_id="measurement_id", place_id="site_id", part_points=part_points)
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(points, sites)


def test_empty(spark):
    p, s = spark.createDataFrame([], P), spark.createDataFrame([], S)
    assert spatial.near_places(p, s, point_id="measurement_id", place_id="site_id").count() == 0
    assert spatial.near_places(spark.createDataFrame([(1, 0.0, 0.0)], P), s, point_id="measurement_id", place_id="site_id").count() == 0


def test_ear_clipping_keeps_the_area():
    rng = np.random.default_rng(1)
    for n in (3, 4, 9, 30):
        turn = np.sort(rng.uniform(0, 2 * np.pi, n))
        r = rng.uniform(0.3, 1.0, n)
        xy = np.stack([r * np.cos(turn), r * np.sin(turn)], axis=1)
        if np.max(np.diff(np.r_[turn, turn[0] + 2 * np.pi])) > np.pi:
            continue
        area = abs(sum(xy[i - 1][0] * xy[i][1] - xy[i][0] * xy[i - 1][1] for i in range(n))) / 2
        tri = sum(abs((xy[b][0] - xy[a][0]) * (xy[c][1] - xy[a][1]) - (xy[b][1] - xy[a][1]) * (xy[c][0] - xy[a][0])) / 2 for a, b, c in spatial.ear_clip(xy))
        assert abs(area - tri) < 1e-12
    assert spatial.ear_clip(np.array([[0, 0], [1, 1], [1, 1]])) == []


@pytest.mark.parametrize("part_points", [100, 1])
def test_polygons_with_a_shared_side(spark, part_points):
    polygons = spark.createDataFrame([(1, [0.0, 0.0, 1.0, 1.0], [179.5, 180.0, 180.0, 179.5]), (2, [0.0, 0.0, 1.0, 1.0], [-180.0, -179.5, -179.5, -180.0]), (3, [5.0, 5.0], [1.0, 2.0]), (4, None, None), (5, [0.0, 0.0, 0.0, 1.0], [0.0, 120.0, -120.0, 0.0]), (6, [0.0, None, 1.0], [0.0, 1.0, 2.0]), (7, [0.0, float("nan"), 1.0], [0.0, 1.0, 2.0])], "region long, lats array<double>, lons array<double>")
    points = spark.createDataFrame([(1, 0.5, 179.7), (2, 0.5, -179.7), (3, 0.5, 180.0), (4, 0.5, -180.0), (5, 3.0, 180.0), (6, None, 1.0)], P)
    out = {r.measurement_id: r.region for r in spatial.regions_of(points, polygons, point_id="measurement_id", region_id="region", part_points=part_points).collect()}
    assert out == {1: 1, 2: 2, 3: 1, 4: 1}


def test_very_many_places_take_the_same_plan(spark):
    # A hundred thousand and one places: a grid of small circles, points on every tenth.
    n = 100_001
    places = spark.range(n).select(F.col("id").alias("site_id"), (F.floor(F.col("id") / 500) * 0.5 - 60).alias("latitude"), ((F.col("id") % 500) * 0.7 - 175).alias("longitude"), F.lit(900.0).alias("radius_m"))
    points = places.where(F.col("site_id") % 10 == 0).select(F.col("site_id").alias("measurement_id"), (F.col("latitude") + 0.004).alias("latitude"), "longitude")
    out = spatial.near_places(points, places, point_id="measurement_id", place_id="site_id")
    assert out.where(F.col("site_id") == F.col("measurement_id")).count() == out.count() == 10_001


def test_a_place_of_several_circles(spark):
    p = spark.createDataFrame([(1, 40.0, -3.0), (2, 10.0, 10.0), (3, 40.001, -3.0)], P)
    s = spark.createDataFrame([(5, 40.0, -3.0, 500.0), (5, 40.0, -3.0, 500.0), (5, 10.0, 10.0, 9.0), (5, 40.001, -3.0, 500.0)], S)
    assert sorted(tuple(r) for r in spatial.near_places(p, s, point_id="measurement_id", place_id="site_id").collect()) == [(5, 1), (5, 2), (5, 3)]
