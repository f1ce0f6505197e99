"""Densities, peaks, merge trees and basins against plain loops over a small grid."""

import random

import pytest
from pyspark.sql import functions as F

from lattica.operators import surface


def grid(spark, heights):
    return spark.createDataFrame([(x, y, h) for (x, y), h in heights.items()], "x int, y int, h long")


def near(cell):
    return [(cell[0] + dx, cell[1] + dy) for dx, dy in surface.AROUND]


def sweep(heights):
    """Peaks with the level at which they drown and the peak that stands then, by adding cells from the highest down."""
    parent, out = {}, {}
    rank = lambda c: (heights[c], c)

    def find(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for cell in sorted(heights, key=rank, reverse=True):
        parent[cell] = cell
        roots = {find(n) for n in near(cell) if n in parent} - {cell}
        if not roots:
            out[cell] = (None, None)
            continue
        top = max(roots, key=rank)
        for r in roots - {top}:
            out[r] = (heights[cell], top)
            parent[r] = top
        parent[cell] = top
    return out


@pytest.fixture(scope="module")
def heights():
    rnd = random.Random(8)
    made = {(x, y): rnd.randrange(40) for x in range(12) for y in range(9) if rnd.random() < 0.85}
    return made | {(x + 40, y): rnd.randrange(9) for x in range(4) for y in range(4)} | {(90, 90): 5}


def test_density_is_the_weighted_sum_about_a_cell(spark, heights):
    got = {(r["x"], r["y"]): (r["a"], r["b"]) for r in surface.density(grid(spark, heights), "h", {"a": 0.8, "b": 1.7}).collect()}
    for name, band in enumerate((0.8, 1.7)):
        k = surface.kernel(band)
        assert {c: v[name] for c, v in got.items()} == {(x, y): sum(w * heights.get((x - dx, y - dy), 0) for (dx, dy), w in k.items()) for x, y in heights}
    flat = surface.density(grid(spark, {c: 7 for c in heights}), "h", {"a": 1.7}, even=True)
    assert all(r["a"] == pytest.approx(7) for r in flat.collect())


def test_merge_tree_and_watershed(spark, heights):
    told = surface.basins(grid(spark, heights), "h")
    tree = surface.merge_tree(told)
    at = lambda p: None if p is None else (p["x"], p["y"])
    got = {at(r["peak"]): (r["saddle"], at(r["parent"])) for r in tree.collect()}
    want = sweep(heights)
    assert {p: s for p, (s, _) in got.items()} == {p: s for p, (s, _) in want.items()}
    alone = [s for s, _ in want.values() if s is not None]
    # where several drown at one level the sweep may name another of those that stand
    assert all(got[p][1] == want[p][1] for p in want if alone.count(want[p][0]) == 1) and sum(s is None for s, _ in got.values()) == 3
    home = {(r["x"], r["y"]): (r["peak_x"], r["peak_y"]) for r in surface.watershed(told, tree, prominence=6).collect()}
    counts = {p for p, (s, _) in got.items() if s is None or heights[p] - s >= 6}
    assert set(home) == set(heights) and set(home.values()) == counts

    def settled(p):
        while p not in counts:
            p = got[p][1]
        return p

    assert all(home[at(r["cell"])] == settled(at(r["peak"])) for r in told.collect())
    trimmed = surface.watershed(told, tree, support=20.0)
    assert {(r["x"], r["y"]) for r in trimmed.collect()} == {c for c, h in heights.items() if h >= 20}


def test_markers_choose_basins_and_highest_peaks_stay(spark, heights):
    told = surface.basins(grid(spark, heights), "h")
    tree = surface.merge_tree(told)
    peaks = sorted((x, y) for x, y in sweep(heights))
    marked = peaks[:3]
    got = surface.watershed(told, tree, spark.createDataFrame(marked, "x int, y int"))
    roots = {p for p, (s, _) in sweep(heights).items() if s is None}
    assert {(r["peak_x"], r["peak_y"]) for r in got.collect()} <= set(marked) | roots and got.count() == len(heights)


def test_lasting_peaks(spark):
    found = spark.createDataFrame([(0, 0, 0, 1.0), (1, 1, 1, 1.0), (0, 5, 5, 1.0), (1, 7, 7, 1.0), (2, 20, 20, 1.0), (0, 30, 30, 1.0), (2, 30, 30, 1.0)], "scale int, x int, y int, height double")
    got = {(r["scale"], r["x"], r["persists"], r["anchored"]) for r in surface.lasting_peaks(found, 1, spark.createDataFrame([(21, 21)], "x int, y int")).collect()}
    assert got == {(0, 0, True, False), (1, 1, True, False), (2, 20, False, True)}
    assert surface.lasting_peaks(found, 2).count() == 4


def test_one_cell_and_none(spark):
    one = surface.basins(grid(spark, {(3, 4): 2}), "h")
    assert [(r["saddle"], r["parent"]) for r in surface.merge_tree(one).collect()] == [(None, None)]
    none = grid(spark, {(3, 4): 2}).limit(0)
    assert surface.merge_tree(surface.basins(none, "h")).count() == 0 and surface.density(none, "h", {"a": 1.0}).count() == 0
    flat = surface.basins(grid(spark, {(x, 0): 1 for x in range(50)}), "h")
    assert {r["peak"]["x"] for r in flat.select("peak").distinct().collect()} == {49}
    assert surface.merge_tree(flat).where(F.col("saddle").isNotNull()).count() == 0
