"""Points near each other: cells of a grid through the globe, so that neither longitude nor poles matter.

A point is its place in kilometres from the earth's centre.  Straight distances
there are never longer than those over the surface and grow with them, so a
cell no narrower than a distance, with its 26 neighbours, holds all within it,
and boxes bound distances from both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

#: By how much each level's cells are wider than the next one's, and how far bounds are widened against rounding, in km.
FACTOR, SLACK = 4, 1e-6


def place(lon: Column, lat: Column) -> Column:
    """struct<x, y, z> in km from the earth's centre."""
    a, b = F.radians(lon), F.radians(lat)
    r = geo.EARTH_KM
    return F.struct((r * F.cos(b) * F.cos(a)).alias("x"), (r * F.cos(b) * F.sin(a)).alias("y"), (r * F.sin(b)).alias("z"))


def cell(at: Column, km: float) -> Column:
    return F.struct(*[F.floor(at[k] / km).cast("long").alias(k) for k in "xyz"])


def around(c: Column) -> Column:
    """A cell and its 26 neighbours."""
    steps = (-1, 0, 1)
    return F.array(*[F.struct((c["x"] + i).alias("x"), (c["y"] + j).alias("y"), (c["z"] + k).alias("z")) for i in steps for j in steps for k in steps])


def _bounds(at: Column, c: Column, km: float) -> tuple[Column, Column]:
    """Squares of the least and the greatest distance of a place to a cell."""
    low, high = F.lit(0.0), F.lit(0.0)
    for k in "xyz":
        under, over = c[k] * km - at[k], at[k] - (c[k] + 1) * km
        low = low + F.pow(F.greatest(under, over, F.lit(0.0)), 2)
        high = high + F.pow(F.greatest(-under, -over), 2)
    return low, high


def nearest(points: DataFrame, anchors: DataFrame, key: str, lon: str = "lon", lat: str = "lat", anchor_lon: str = "x", anchor_lat: str = "y", within: float = 16.0) -> DataFrame:
    """key, km: the distance over the surface from each point to its nearest anchor; exact, whatever the distance.

    Points and anchors within ``within`` km of each other meet in cells.  The
    points left go down a tree of the cells that hold anchors, from cells as wide
    as the globe: at each level a point keeps the cells that may hold its
    nearest, as bounded by the others, and meets the anchors of the last ones.
    ``key`` is unique.  A point without a place, and every point where there
    are no anchors, is left out; an anchor without a place is none.
    """
    p = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(key, F.col(lon).alias("__lon"), F.col(lat).alias("__lat"), place(F.col(lon), F.col(lat)).alias("__at"))
    a = anchors.where(F.col(anchor_lon).isNotNull() & F.col(anchor_lat).isNotNull()).select(F.col(anchor_lon).alias("__x"), F.col(anchor_lat).alias("__y")).distinct().withColumn("cell", cell(place(F.col("__x"), F.col("__y")), within))
    km = geo.haversine_km(F.col("__lon"), F.col("__lat"), F.col("__x"), F.col("__y"))
    here = p.withColumn("cell", cell(F.col("__at"), within))
    spread = a.select("__x", "__y", F.explode(around(F.col("cell"))).alias("cell"))
    near = here.join(spread, "cell").groupBy(key).agg(F.min(km).alias("km")).where(F.col("km") <= within - SLACK)
    left = p.join(near.select(key), key, "left_anti")
    levels = [within]
    while levels[-1] < 2 * geo.EARTH_KM:
        levels.append(levels[-1] * FACTOR)
    occupied = [a.select("cell").distinct()]
    for _ in levels[1:]:
        up = F.struct(*[F.floor(F.col(f"cell.{k}") / FACTOR).cast("long").alias(k) for k in "xyz"])
        occupied.append(occupied[-1].select(up.alias("cell")).distinct())
    # the widest cells that hold anchors are eight at most, about the earth's centre
    every = F.array(*[F.struct(F.lit(i).cast("long").alias("x"), F.lit(j).cast("long").alias("y"), F.lit(k).cast("long").alias("z")) for i in (-1, 0) for j in (-1, 0) for k in (-1, 0)])
    kept = left.select(key, "__lon", "__lat", "__at", F.explode(every).alias("cell")).join(occupied[-1], "cell", "left_semi")
    of_point = Window.partitionBy(key)
    for width, below in zip(levels[-2::-1], occupied[-2::-1], strict=True):
        up = F.struct(*[F.floor(F.col(f"inner.{k}") / FACTOR).cast("long").alias(k) for k in "xyz"])
        children = below.select(F.col("cell").alias("inner")).select("inner", up.alias("cell"))
        low, high = _bounds(F.col("__at"), F.col("cell"), width)
        kept = kept.join(children, "cell").select(key, "__lon", "__lat", "__at", F.col("inner").alias("cell")).withColumns({"__low": low, "__high": high})
        kept = kept.withColumn("__most", F.min("__high").over(of_point)).where(F.sqrt("__low") <= F.sqrt("__most") + SLACK).drop("__low", "__high", "__most")
    far = kept.join(a, "cell").groupBy(key).agg(F.min(km).alias("km"))
    return near.unionByName(far)


def within_cells(a: DataFrame, b: DataFrame, at_a: tuple[str, str], at_b: tuple[str, str], km: float, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of rows of ``a`` and ``b`` that may be within ``km`` of each other over the surface, and have equal ``on``; a caller measures them.

    Neither side is broadcast: ``b`` is 27 times as large as its files let Spark guess.
    """
    left = a.withColumn("__cell", cell(place(F.col(at_a[0]), F.col(at_a[1])), km))
    right = b.withColumn("__cell", F.explode(around(cell(place(F.col(at_b[0]), F.col(at_b[1])), km))))
    return left.hint("merge").join(right, [*on, "__cell"]).drop("__cell")
