"""Density surfaces on cells, their lasting peaks, and basins about them: joins of neighbouring cells, no task holds a grid."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checkpoints import checkpointed

#: The eight neighbours of a cell, and the half of them that meets each pair once.
AROUND = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if (dx, dy) != (0, 0)]
HALF = [(1, 0), (0, 1), (1, 1), (1, -1)]


def kernel(bandwidth: float, scale: int = 1_000) -> dict[tuple[int, int], int]:
    """Whole weights of a Gaussian of ``bandwidth`` cells, out to three of them; whole, so that sums are exact in any order."""
    reach = math.ceil(3 * bandwidth)
    weights = {(dx, dy): round(scale * math.exp(-(dx * dx + dy * dy) / (2 * bandwidth * bandwidth))) for dx in range(-reach, reach + 1) for dy in range(-reach, reach + 1)}
    return {k: w for k, w in weights.items() if w}


def density(cells: DataFrame, value: str, bandwidths: Mapping[str, float], even: bool = False) -> DataFrame:
    """x, y and a column for each bandwidth: every cell's kernel-weighted sum of ``value`` about it.

    ``cells``: x, y, one row each; a null value counts as none.  A cell's row
    goes to the cells within reach and is summed before it moves.  ``even``:
    sums are divided by the weight that falls on cells of the table, which
    evens out edges.  Only cells of the table are in the result.
    """
    weights = {name: kernel(b) for name, b in bandwidths.items()}
    steps = sorted({k for w in weights.values() for k in w})
    sent = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), *[F.lit(weights[n].get((dx, dy), 0)).cast("long").alias(n) for n in weights]) for dx, dy in steps])
    out = cells.select("x", "y", F.coalesce(F.col(value), F.lit(0)).alias("__v"), F.explode(sent).alias("k"))
    out = out.select((F.col("x") + F.col("k.dx")).alias("x"), (F.col("y") + F.col("k.dy")).alias("y"), "__v", "k")
    sums = out.groupBy("x", "y").agg(*[F.sum(F.col("__v") * F.col(f"k.{n}")).alias(n) for n in weights], *[F.sum(F.col(f"k.{n}")).alias(f"__w_{n}") for n in weights])
    shown = [(F.col(n) / F.col(f"__w_{n}") if even else F.col(n)).alias(n) for n in weights]
    return cells.select("x", "y").join(sums, ["x", "y"]).select("x", "y", *shown)


def _order(height: str) -> Column:
    """What makes one cell higher than another: its height, then its place, so that no two are alike."""
    return F.struct(F.col(height).alias("h"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"))


def upward(surface: DataFrame, height: str) -> DataFrame:
    """cell, to: the highest of each cell and its neighbours, as structs of h, x, y; a peak points to itself."""
    own = surface.where(F.col(height).isNotNull()).select(_order(height).alias("cell"))
    step = F.array(*[F.struct((F.col("cell.x") + dx).alias("x"), (F.col("cell.y") + dy).alias("y")) for dx, dy in [(0, 0), *AROUND]])
    top = own.select(F.explode(step).alias("at"), "cell").groupBy("at").agg(F.max("cell").alias("to"))
    return own.withColumn("at", F.struct("cell.x", "cell.y")).join(top, "at").select("cell", "to")


def basins(surface: DataFrame, height: str) -> DataFrame:
    """cell, peak: the peak that each cell's steepest way up ends at; pointers jump, so rounds grow with the logarithm of the way."""
    at = checkpointed(upward(surface, height))
    while True:
        hop = at.select(F.col("cell").alias("to"), F.col("to").alias("further"))
        at = checkpointed(at.join(hop, "to").select("cell", F.col("further").alias("to"), (F.col("further") != F.col("to")).alias("moved")))
        if at.where("moved").isEmpty():
            return at.select("cell", F.col("to").alias("peak"))
        at = at.drop("moved")


def saddles(told: DataFrame) -> DataFrame:
    """a, b, saddle: peaks whose basins touch, a the lower one, and the highest pass between them."""
    here = told.select(F.struct("cell.x", "cell.y").alias("at"), F.col("cell.h").alias("h"), "peak")
    step = F.array(*[F.struct((F.col("at.x") + dx).alias("x"), (F.col("at.y") + dy).alias("y")) for dx, dy in HALF])
    sent = here.select(F.explode(step).alias("at"), F.col("h").alias("__h"), F.col("peak").alias("__peak"))
    j = here.join(sent, "at").where("peak <> __peak")
    return j.groupBy(F.least("peak", "__peak").alias("a"), F.greatest("peak", "__peak").alias("b")).agg(F.max(F.least("h", "__h")).alias("saddle"))


def merge_tree(told: DataFrame) -> DataFrame:
    """peak, saddle, parent: where each peak drowns as the level falls, and in which higher one; a highest peak has neither.

    A peak whose highest pass leads to a higher one ends at that pass.  All
    such end at once, their passes go to the one they ended in, and so on.
    Each round ends at least the lower side of the highest pass that is left.
    """
    peaks = checkpointed(told.select("peak").distinct())
    edges = checkpointed(saddles(told))
    dead = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("p"), F.col("b").alias("q"), "saddle").unionByName(edges.select(F.col("b").alias("p"), F.col("a").alias("q"), "saddle"))
        best = both.groupBy("p").agg(F.max(F.struct("saddle", "q")).alias("m"))
        ended = checkpointed(best.where(F.col("m.q") > F.col("p")).select(F.col("p").alias("peak"), F.col("m.saddle").alias("saddle"), F.col("m.q").alias("parent")))
        dead = ended if dead is None else dead.unionByName(ended)
        # a peak that ended in one that ended, too, goes to where that went
        goes = ended.select("peak", F.col("parent").alias("to"))
        while True:
            hop = goes.select(F.col("peak").alias("to"), F.col("to").alias("further"))
            goes = checkpointed(goes.join(hop, "to", "left").select("peak", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
            if goes.where("moved").isEmpty():
                break
            goes = goes.drop("moved")
        for side in ("a", "b"):
            edges = edges.join(goes.select(F.col("peak").alias(side), F.col("to").alias("__to")), side, "left").withColumn(side, F.coalesce("__to", side)).drop("__to")
        edges = edges.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("saddle").alias("saddle"))
        edges = checkpointed(edges)
    if dead is None:
        return peaks.select("peak", F.lit(None).cast("double").alias("saddle"), F.lit(None).cast(peaks.schema["peak"].dataType).alias("parent"))
    # the parent is what stands above the pass when the peak drowns: not one that drowned higher up
    dead = checkpointed(dead)
    while True:
        above = dead.select(F.col("peak").alias("parent"), F.col("saddle").alias("__s"), F.col("parent").alias("__p"))
        j = dead.join(above, "parent", "left").withColumn("moved", F.coalesce((F.col("__s") > F.col("saddle")) | (F.col("__s") == F.col("saddle")) & (F.col("parent") < F.col("peak")), F.lit(False)))
        dead = checkpointed(j.select("peak", "saddle", F.when(F.col("moved"), F.col("__p")).otherwise(F.col("parent")).alias("parent"), "moved"))
        if dead.where("moved").isEmpty():
            break
        dead = dead.drop("moved")
    return peaks.join(dead.drop("moved"), "peak", "left")


def watershed(told: DataFrame, tree: DataFrame, markers: DataFrame | None = None, prominence: float = 0, support: float | None = None) -> DataFrame:
    """x, y, height, peak_x, peak_y: basins of the peaks that count; those of others fall to the peak they drown in.

    A peak counts if it stands ``prominence`` above its pass or has none, and,
    if ``markers`` (x, y) are given, is one of them; a highest peak always
    counts, so that no basin is lost.  Cells below ``support`` are trimmed.
    """
    counts = F.col("saddle").isNull() | (F.col("peak.h") - F.col("saddle") >= prominence)
    t = tree
    if markers is not None:
        t = t.join(markers.select(F.struct(F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")).alias("__m")).distinct(), F.struct("peak.x", "peak.y") == F.col("__m"), "left")
        counts = F.col("saddle").isNull() | counts & F.col("__m").isNotNull()
    goes = checkpointed(t.select("peak", F.when(counts, F.col("peak")).otherwise(F.col("parent")).alias("to")))
    while True:
        hop = goes.select(F.col("peak").alias("to"), F.col("to").alias("further"))
        goes = checkpointed(goes.join(hop, "to").select("peak", F.col("further").alias("to"), (F.col("further") != F.col("to")).alias("moved")))
        if goes.where("moved").isEmpty():
            break
        goes = goes.drop("moved")
    out = told.join(goes.select("peak", "to"), "peak")
    out = out if support is None else out.where(F.col("cell.h") >= support)
    return out.select(F.col("cell.x").alias("x"), F.col("cell.y").alias("y"), F.col("cell.h").alias("height"), F.col("to.x").alias("peak_x"), F.col("to.y").alias("peak_y"))


def peaks(surface: DataFrame, scales: Sequence[str]) -> DataFrame:
    """scale, x, y, height: the cells of each scale that no neighbour is higher than."""
    one = [upward(surface, s).where("cell = to").select(F.lit(i).alias("scale"), F.col("cell.x").alias("x"), F.col("cell.y").alias("y"), F.col("cell.h").cast("double").alias("height")) for i, s in enumerate(scales)]
    return reduce(DataFrame.unionByName, one)


def lasting_peaks(found: DataFrame, reach: int = 1, anchors: DataFrame | None = None) -> DataFrame:
    """scale, x, y, height, persists, anchored: which peaks an adjacent scale shares within ``reach`` cells, or an anchor (x, y) bears out; others go.

    Peaks are dealt to the cells within reach and meet by equal cells.
    """
    step = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(-reach, reach + 1) for dy in range(-reach, reach + 1)])).alias("k")
    near = lambda df, *keep: df.select(*keep, "x", "y", step).select(*keep, (F.col("x") + F.col("k.dx")).alias("x"), (F.col("y") + F.col("k.dy")).alias("y")).distinct()
    other = near(found.select((F.explode(F.array(F.col("scale") - 1, F.col("scale") + 1))).alias("scale"), "x", "y"), "scale").withColumn("persists", F.lit(True))
    j = found.join(other, ["scale", "x", "y"], "left")
    held = near(anchors.select(F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"))).withColumn("anchored", F.lit(True)) if anchors is not None else None
    j = j.join(held, ["x", "y"], "left") if held is not None else j.withColumn("anchored", F.lit(False))
    told = [F.coalesce(c, F.lit(False)).alias(c) for c in ("persists", "anchored")]
    return j.select("scale", "x", "y", "height", *told).where("persists or anchored")
