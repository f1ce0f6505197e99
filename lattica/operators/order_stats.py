"""Exact order statistics without a sort: ranges that hold the wanted ranks are cut finer until each is one value."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges into which each pass cuts the one that holds a wanted rank.
CUTS = 2_048


def order_statistics(df: DataFrame, value: Column, ranks: Sequence[int]) -> list[float]:
    """The values of the given ranks (from 0) among all that are neither null nor NaN.

    Each pass counts the values of at most ``CUTS`` ranges a rank, with their
    smallest and largest, so tasks hold sums and the driver gets at most
    ``CUTS`` rows a rank; a range's ends stand alone, so every pass gains.  A rank that is not there is a fault.
    """
    rows = df.select(value.cast("double").alias("v")).where("v is not null and not isnan(v)")
    n, low, high = rows.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if any(not 0 <= r < n for r in ranks):
        raise ValueError(f"ranks {list(ranks)} of {n} values")
    known: dict[int, float] = {}
    #: of each rank: the range that holds it, and how many values are below that
    held = {r: (low, high, 0) for r in set(ranks)}
    while True:
        known |= {r: lo for r, (lo, hi, _) in held.items() if lo == hi}
        held = {r: x for r, x in held.items() if r not in known}
        if not held:
            return [known[r] for r in ranks]
        ranges = sorted({(lo, hi) for lo, hi, _ in held.values()})
        v = F.col("v")
        in_range = [F.when(v.between(lo, hi), F.struct(F.lit(i).alias("i"), F.when(v <= lo, 0).when(v >= hi, CUTS + 1).otherwise(1 + F.least(F.lit(CUTS - 1), F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * CUTS).cast("int"))).alias("cut"))) for i, (lo, hi) in enumerate(ranges)]
        cut = rows.select("v", F.explode(F.array_compact(F.array(*in_range))).alias("c"))
        counts: dict[int, list] = {}
        for r in cut.groupBy("c").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
            counts.setdefault(r["c"]["i"], []).append((r["lo"], r["hi"], r["n"]))
        for rank, (lo, hi, below) in list(held.items()):
            for a, b, size in sorted(counts[ranges.index((lo, hi))]):
                if rank < below + size:
                    held[rank] = (a, b, below)
                    break
                below += size


def quantiles(df: DataFrame, value: Column, shares: Sequence[float]) -> list[float] | None:
    """Quantiles between the two nearest ranks; none where there are no values."""
    n = df.where(value.isNotNull() & ~F.isnan(value.cast("double"))).count()
    if not n:
        return None
    at = [s * (n - 1) for s in shares]
    ends = [math.floor(x) for x in at] + [math.ceil(x) for x in at]
    found = order_statistics(df, value, ends)
    return [lo + (hi - lo) * (x - math.floor(x)) for x, lo, hi in zip(at, found[: len(at)], found[len(at) :], strict=True)]


def percent_scale(df: DataFrame, value: str, train: Column, knots: int = 21, name: str = "score") -> DataFrame:
    """A monotone scale from 0 to 100, fitted on the training rows alone.

    The training quantiles at ``knots`` even shares score their share; between
    two the scale is straight, beyond the ends it stays.  A value that holds
    several quantiles scores their mean.  Null and NaN have no score; neither
    does any row where the training rows have no value.
    """
    shares = [k / (knots - 1) for k in range(knots)]
    cuts = quantiles(df.where(train), F.col(value), shares)
    if cuts is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    held: dict[float, list[float]] = {}
    for cut, share in zip(cuts, shares, strict=True):
        held.setdefault(cut, []).append(100 * share)
    points = [(cut, sum(s) / len(s)) for cut, s in held.items()]
    v = F.col(value).cast("double")
    score = F.when(v <= points[0][0], F.lit(points[0][1]))
    for (a, p), (b, q) in zip(points, points[1:], strict=False):
        score = score.when(v < b, p + (q - p) * ((v - a) / (b - a)))
    return df.withColumn(name, F.when(v.isNotNull() & ~F.isnan(v), score.otherwise(F.lit(points[-1][1]))))
