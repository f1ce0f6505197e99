"""Lines cut at rectangles against a walk in small steps, and by hand."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lattica.operators.clip import clip_sections, line_feature

SECTION = "id long, operator string, points array<struct<lon:double,lat:double>>"
BOXES = "route string, operator string, min_lon double, min_lat double, max_lon double, max_lat double"


def clipped(spark, lines, boxes, **more):
    got = clip_sections(spark.createDataFrame(lines, SECTION), spark.createDataFrame(boxes, BOXES), "id", "points", "route", ["operator"], **more)
    return {r["id"]: (list(r["boxes"]), [[tuple(p) for p in part] for part in r["parts"]]) for r in got.collect()}


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_by_hand(spark, cell):
    box = [("a", "x", 0.0, 0.0, 2.0, 2.0), ("b", "x", 2.0, 0.0, 3.0, 2.0), ("c", "y", 0.0, 0.0, 9.0, 9.0), ("d", "x", 7.0, 7.0, 8.0, 8.0), ("n", "x", None, 0.0, 1.0, 1.0)]
    lines = [
        (1, "x", [(-1.0, 1.0), (1.0, 1.0), (1.0, 3.0), (1.5, 3.0), (1.5, 1.0)]),  # leaves and returns
        (2, "x", [(1.0, 1.0), (2.5, 1.0), (4.0, 1.0)]),  # over an edge that two boxes share
        (3, "x", [(0.5, 0.5), (1.0, 0.5), (1.0, 0.5), (1.0, 1.0)]),  # a point twice, all inside
        (4, "x", [(-1.0, 3.0), (1.0, 1.0)]),  # in by a corner
        (5, "x", [(-1.0, 1.0), (1.0, -1.0)]),  # touches the corner alone
        (6, "x", [(-1.0, 2.0), (5.0, 2.0)]),  # along an edge
        (7, "z", [(1.0, 1.0), (1.5, 1.0)]), (8, "x", [(1.0, 1.0)]), (9, "x", []), (10, "x", None), (None, "x", [(0.0, 0.0), (1.0, 1.0)]), (11, None, [(0.0, 0.0), (1.0, 1.0)]),
        (12, "x", [(1.0, 1.0), (1.0, 1.0)]), (13, "x", [(2.5, 3.0), (2.5, 2.0), (2.5, 3.0), (2.5, 1.0)]),
    ]
    assert clipped(spark, lines, box, cell=cell) == {
        1: (["a"], [[(0.0, 1.0), (1.0, 1.0), (1.0, 2.0)], [(1.5, 2.0), (1.5, 1.0)]]),
        2: (["a", "b"], [[(1.0, 1.0), (2.5, 1.0), (3.0, 1.0)]]),
        3: (["a"], [[(0.5, 0.5), (1.0, 0.5), (1.0, 1.0)]]),
        4: (["a"], [[(0.0, 2.0), (1.0, 1.0)]]),
        6: (["a", "b"], [[(0.0, 2.0), (3.0, 2.0)]]),
        13: (["b"], [[(2.5, 2.0), (2.5, 1.0)]]),
    }


def test_random_lines_are_cut_where_a_walk_says(spark):
    rnd = random.Random(4)
    boxes = [(f"r{i}", "x", x, y, x + rnd.random(), y + rnd.random()) for i in range(6) for x, y in [(rnd.uniform(-2, 2), rnd.uniform(-2, 2))]]
    lines = [(i, "x", [(rnd.uniform(-3, 3), rnd.uniform(-3, 3)) for _ in range(rnd.randrange(2, 7))]) for i in range(60)]
    got = clipped(spark, lines, boxes, cell=0.4)
    for i, _, points in lines:
        inside, steps, total = 0, 2000, 0.0
        for (x0, y0), (x1, y1) in zip(points, points[1:], strict=False):
            length = ((x1 - x0) ** 2 + (y1 - y0) ** 2) ** 0.5
            inside = sum(any(a <= x0 + (x1 - x0) * k / steps <= c and b <= y0 + (y1 - y0) * k / steps <= d for _, _, a, b, c, d in boxes) for k in range(steps))
            total += length * inside / steps
        parts = got.get(i, ([], []))[1]
        assert sum(((q[0] - p[0]) ** 2 + (q[1] - p[1]) ** 2) ** 0.5 for part in parts for p, q in zip(part, part[1:], strict=False)) == pytest.approx(total, abs=0.02)
        assert all(len(part) > 1 for part in parts)


def test_features_and_nothing(spark):
    one = clip_sections(spark.createDataFrame([(1, "x", [(-1.0, 1.0), (1.0, 1.0), (1.0, 3.0), (1.5, 3.0), (1.5, 1.0)]), (2, "x", [(0.0, 0.0), (1.0, 1.0)])], SECTION), spark.createDataFrame([("a", "x", 0.0, 0.0, 2.0, 2.0)], BOXES), "id", "points", "route", ["operator"])
    made = {f["properties"]["id"]: f for f in (json.loads(r["f"]) for r in one.select(line_feature(F.col("parts"), F.struct("id", "boxes")).alias("f")).collect())}
    assert made[2]["geometry"] == {"type": "LineString", "coordinates": [[0.0, 0.0], [1.0, 1.0]]} and made[1]["geometry"]["type"] == "MultiLineString"
    assert made[1]["properties"] == {"id": 1, "boxes": ["a"]}
    assert clipped(spark, [(1, "x", [(0.0, 0.0), (1.0, 1.0)])], []) == clipped(spark, [], [("a", "x", 0.0, 0.0, 2.0, 2.0)]) == {}
