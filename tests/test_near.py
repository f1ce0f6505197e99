"""Nearest points and buffers against all pairs, anywhere on the globe."""

import math
import random

import pytest

from lattica.functions import geo
from lattica.operators import model, near, screen


def km(a, b, c, d):
    half = math.sin(math.radians(d - b) / 2) ** 2 + math.cos(math.radians(b)) * math.cos(math.radians(d)) * math.sin(math.radians(c - a) / 2) ** 2
    return 2 * geo.EARTH_KM * math.asin(min(1.0, math.sqrt(half)))


@pytest.mark.parametrize(("seed", "within"), [(1, 16.0), (2, 700.0)])
def test_nearest_is_exact_near_and_far(spark, seed, within):
    """Clusters, the antimeridian, both poles, one far anchor, a tie and rows without a place."""
    rnd = random.Random(seed)
    anchors = [(139 + rnd.random() / 5, 35 + rnd.random() / 5) for _ in range(80)] + [(179.99, 0.0), (-70.0, -89.5), (10.0, 89.9), (20.0, 50.0), (22.0, 50.0), (None, 1.0)]
    points = [(rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for _ in range(60)] + [(139.1, 35.1), (-179.99, 0.0), (0.0, 90.0), (100.0, -90.0), (21.0, 50.0), (139.0, 35.0), (None, 3.0)]
    got = {r["k"]: r["km"] for r in near.nearest(spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "k int, lon double, lat double"), spark.createDataFrame(anchors, "x double, y double"), "k", within=within).collect()}
    want = {i: min(km(*p, *a) for a in anchors if a[0] is not None) for i, p in enumerate(points) if p[0] is not None}
    assert set(got) == set(want) and all(got[i] == pytest.approx(want[i], abs=1e-6) for i in want)


def test_nearest_without_anchors(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "k int, lon double, lat double")
    assert near.nearest(points, spark.createDataFrame([], "x double, y double"), "k").count() == 0
    assert near.nearest(points.limit(0), spark.createDataFrame([(0.0, 0.0)], "x double, y double"), "k").count() == 0


@pytest.mark.parametrize("lat0", [0.0, 35.0, 71.0, -89.9])
def test_buffers_and_collisions(spark, lat0):
    rnd = random.Random(6)
    wide = 0.03 / max(math.cos(math.radians(lat0)), 0.01)
    spot = lambda: (rnd.uniform(0, wide), lat0 + rnd.uniform(0, 0.03))
    points, stations = [spot() for _ in range(150)], [spot() for _ in range(12)]
    got = {r["s"]: (r["within_400m"], r["within_1200m"]) for r in model.buffer_sums(spark.createDataFrame([(*p, 1) for p in points], "lon double, lat double, v int"), spark.createDataFrame([(i, *s) for i, s in enumerate(stations)], "s int, lon double, lat double"), "s", "v", [0.4, 1.2]).collect()}
    assert got == {i: tuple(sum(km(*s, *p) <= r for p in points) for r in (0.4, 1.2)) for i, s in enumerate(stations)}
    rows = [(i, "n", str(i), *p) for i, p in enumerate(points[:60])]
    flat = lambda a, b: math.hypot((b[0] - a[0]) * 111.32 * math.cos(math.radians((a[1] + b[1]) / 2)), (b[1] - a[1]) * 111.32)
    pairs = {(r["a"], r["b"]) for r in screen.near_collisions(spark.createDataFrame(rows, "k int, name string, g string, lon double, lat double"), "k", "name", "g", "lon", "lat", 0.3).collect()}
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if flat(points[i], points[j]) <= 0.3}
    assert pairs == want
