"""Lines cut at rectangles: a spatial join of segments on a grid, then the parts that lie inside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The columns of a rectangle, as ``functions.geo.padded_box`` names them.
BOX = ("min_lon", "min_lat", "max_lon", "max_lat")


def segments(sections: DataFrame, section: str, points: str, keep: Sequence[str] = ()) -> DataFrame:
    """section, ``keep``, i, x0, y0, x1, y1: the segments of each line, from 0; points that repeat the one before are passed over."""
    ends = F.transform(F.slice(F.col(points), 2, F.greatest(F.size(points) - 1, F.lit(0))), lambda q, i: F.struct(F.get(F.col(points), i).alias("p"), q.alias("q")))
    one = sections.where(F.size(points) > 1).select(section, *keep, F.posexplode(ends).alias("i", "e"))
    return one.select(section, *keep, "i", *[F.col(f"e.{end}.{axis}").alias(f"{name}{k}") for k, end in enumerate("pq") for axis, name in (("lon", "x"), ("lat", "y"))])


def _cells(df: DataFrame, low: dict[str, Column], high: dict[str, Column], cell: float, tag: str) -> DataFrame:
    """One row for each grid cell that a row's extent meets; ``lx``, ``ly`` name its first."""
    at = lambda v: F.floor(v / cell).cast("long")
    first = df.withColumns({f"{tag}lx": at(low["x"]), f"{tag}ly": at(low["y"])})
    across = F.explode(F.sequence(F.col(f"{tag}lx"), at(high["x"]))).alias("gx")
    up = F.explode(F.sequence(F.col(f"{tag}ly"), at(high["y"]))).alias("gy")
    return first.select("*", across).select("*", up)


def clip_intervals(seg: DataFrame, boxes: DataFrame, on: Sequence[str], cell: float) -> DataFrame:
    """``seg`` by every rectangle that it meets, with t0 <= t1: from which to which share of its length it is inside.

    Both are dealt into the grid's cells and met by equal keys and cells; a pair
    that meets in several counts in the first common one alone.
    """
    x, y = (F.least("x0", "x1"), F.greatest("x0", "x1")), (F.least("y0", "y1"), F.greatest("y0", "y1"))
    a = _cells(seg, {"x": x[0], "y": y[0]}, {"x": x[1], "y": y[1]}, cell, "__s")
    b = _cells(boxes, {"x": F.col(BOX[0]), "y": F.col(BOX[1])}, {"x": F.col(BOX[2]), "y": F.col(BOX[3])}, cell, "__b")
    first = (F.col("gx") == F.greatest("__slx", "__blx")) & (F.col("gy") == F.greatest("__sly", "__bly"))
    met = a.join(b, [*on, "gx", "gy"]).where(first)
    enter, leave = [F.lit(0.0)], [F.lit(1.0)]
    for p, q, low, high in (("x0", "x1", BOX[0], BOX[2]), ("y0", "y1", BOX[1], BOX[3])):
        run = F.col(q) - F.col(p)
        met = met.where((run != 0) | F.col(p).between(F.col(low), F.col(high)))
        # one that runs along the axis is inside all the way, which greatest and least pass over as a null
        sides = [F.when(run != 0, (F.col(side) - F.col(p)) / run) for side in (low, high)]
        enter.append(F.least(*sides))
        leave.append(F.greatest(*sides))
    return met.withColumn("t0", F.greatest(*enter)).withColumn("t1", F.least(*leave)).where("t0 <= t1").drop("gx", "gy", "__slx", "__sly", "__blx", "__bly")


def _at(points: str, place: Column) -> Column:
    """The point of a line at ``place``: struct of segment and share."""
    p, q = F.get(F.col(points), place["i"]), F.get(F.col(points), place["i"] + 1)
    mix = lambda axis: F.when(place["t"] == 0, p[axis]).otherwise(p[axis] + (q[axis] - p[axis]) * place["t"]).alias(axis)
    return F.struct(mix("lon"), mix("lat"))


def alike_boxes(boxes: DataFrame, box: str, on: Sequence[str] = ()) -> DataFrame:
    """box, ``on``, the rectangle, and ``__first``: the smallest id of those with the same keys and rectangle; ids that are null are left out."""
    own = boxes.where(F.col(box).isNotNull()).select(box, *on, *BOX).distinct()
    return own.join(own.groupBy(*on, *BOX).agg(F.min(box).alias("__first")), [*on, *BOX])


def clip_sections(sections: DataFrame, boxes: DataFrame, section: str, points: str, box: str, on: Sequence[str] = (), cell: float = 0.1, every: bool = True) -> DataFrame:
    """The parts of each line inside the rectangles of its keys: section, ``boxes``, ``parts``.

    ``points``: array<struct<lon, lat>>.  ``boxes`` has the id ``box``, the keys
    ``on`` that a line must share, and a rectangle; a line is held against the
    union of those.  A part begins where the line comes in and ends where it
    leaves, so one that returns has several, in the line's order; rectangles
    that overlap or share an edge do not cut it.  The edge is inside, but a
    touch in a single point makes no part, and a line without parts is left
    out.  ``boxes`` of the result are the sorted ids of all that the line
    meets, touches included.  A line of fewer than two points, a null id or
    key, and a rectangle with a null meet nothing; a section's id is its own.

    Rectangles that are alike are met once.  Without ``every``, the smallest id
    of each stands for all in ``boxes``, and ``n_boxes`` counts them all, so
    that the result does not grow with their copies; ``alike_boxes`` tells whom
    each id stands for.
    """
    clean = F.filter(F.col(points), lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(F.col(points), i - 1)))
    lines = sections.where(F.col(section).isNotNull()).select(section, *on, clean.alias(points))
    members = alike_boxes(boxes, box, on)
    classes = members.groupBy("__first", *on, *BOX).agg(F.count("*").alias("__n"))
    met = clip_intervals(segments(lines, section, points, on), classes, on, cell).select(section, "__first", "__n", *on, *BOX, "i", "t0", "t1")
    start = F.struct(F.col("i"), F.col("t0").alias("t"))
    # the end of a segment is the start of the next one
    end = F.when(F.col("t1") == 1.0, F.struct((F.col("i") + 1).alias("i"), F.lit(0.0).alias("t"))).otherwise(F.struct(F.col("i"), F.col("t1").alias("t")))
    placed = met.where("t0 < t1").select(section, start.alias("start"), end.alias("end"))
    order = Window.partitionBy(section).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("__new", F.when(F.col("start") <= reached, 0).otherwise(1))
    placed = placed.withColumn("part", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = placed.groupBy(section, "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy(section).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    once = met.select(section, "__first", "__n", *on, *BOX).distinct()
    if every:
        own = members.select(F.col(box).alias("__id"), "__first", *on, *BOX)
        ids = once.drop("__n").join(own, ["__first", *on, *BOX]).groupBy(section).agg(F.array_sort(F.collect_set("__id")).alias("boxes"))
    else:
        ids = once.groupBy(section).agg(F.array_sort(F.collect_set("__first")).alias("boxes"), F.sum("__n").alias("n_boxes"))

    def drawn(span: Column) -> Column:
        last = F.when(span["end"]["t"] > 0, F.array(_at(points, span["end"]))).otherwise(F.slice(F.col(points), 1, 0))
        return F.concat(F.array(_at(points, span["start"])), F.slice(F.col(points), span["start"]["i"] + 2, span["end"]["i"] - span["start"]["i"]), last)

    return lines.join(spans, section).join(ids, section).select(section, *ids.columns[1:], F.transform("spans", drawn).alias("parts"))


def line_feature(parts: Column, properties: Column) -> Column:
    """A GeoJSON feature as text: a LineString, or a MultiLineString of several parts."""
    pair = lambda points: F.transform(points, lambda p: F.array(p["lon"], p["lat"]))
    text = lambda kind, coordinates: F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry")))
    return F.when(F.size(parts) == 1, text("LineString", pair(F.get(parts, F.lit(0))))).otherwise(text("MultiLineString", F.transform(parts, pair)))
