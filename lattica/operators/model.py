"""Specified surfaces and scores: robust scaling, activity, buffers, connected cells, percentile gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .checkpoints import ensure_folder
from .near import within_cells
from .order_stats import quantiles
from .ranking import competition_rank


def robust_scale(df: DataFrame, value: str, train: Column, low: float = 0.01, high: float = 0.99, name: str = "scaled") -> DataFrame:
    """Winsorised at the training rows' quantiles, centred on their median, in units of their MAD.

    The quantiles are exact and found by counting; without training values, or with a MAD of zero, all are null.
    """
    t, v = df.where(train), F.col(value)
    cuts = quantiles(t, v, (low, high, 0.5))
    if cuts is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    lo, hi, med = cuts
    clipped = F.when(v.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), v)))
    mad = quantiles(t, F.abs(clipped - med), (0.5,))[0]
    return df.withColumn(name, (clipped - med) / mad if mad else F.lit(None).cast("double"))


def activity(e: Column, n: Column, alpha: float = 0.6) -> Column:
    """Weighted sum of log-scaled employment and establishments."""
    return alpha * F.log1p(e) + (1 - alpha) * F.log1p(n)


def buffer_sums(points: DataFrame, stations: DataFrame, station: str, value: str, radii: Sequence[float]) -> DataFrame:
    """Sum of ``value`` of the points within each radius (km) of each station; both have lon and lat.

    Points and stations meet in cells no narrower than the largest radius.
    """
    most = max(radii)
    p = points.select(F.col("lon").alias("__x"), F.col("lat").alias("__y"), F.col(value).alias("__v"))
    met = within_cells(p, stations.select(station, "lon", "lat"), ("__x", "__y"), ("lon", "lat"), most)
    j = met.withColumn("km", geo.haversine_km(F.col("lon"), F.col("lat"), F.col("__x"), F.col("__y"))).where(F.col("km") <= most)
    sums = [F.coalesce(F.sum(F.when(F.col("km") <= r, F.col("__v"))), F.lit(0)).alias(f"within_{int(r * 1000)}m") for r in radii]
    near = j.groupBy(station).agg(*sums)
    filled = [F.coalesce(F.col(f"within_{int(r * 1000)}m"), F.lit(0)).alias(f"within_{int(r * 1000)}m") for r in radii]
    return stations.select(station).join(near, station, "left").select(station, *filled)


def connected_cells(cells: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Components of cells that share an edge: each cell with its component's smallest (x, y) as ``component``.

    Each round, all cells of one label take the smallest label that any of them
    meets, and the one that takes in its turn, to the end; until a round changes
    nothing.  Each step is written to the checkpoint folder.
    """
    ensure_folder(cells.sparkSession)
    at = F.struct(F.col(x).cast("long").alias("x"), F.col(y).cast("long").alias("y"))
    lab = cells.select(at.alias("cell"), at.alias("component")).distinct()
    step = F.array(*[F.struct((F.col("cell.x") + dx).alias("x"), (F.col("cell.y") + dy).alias("y")) for dx, dy in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))])
    while True:
        spread = lab.select(F.explode(step).alias("cell"), F.col("component").alias("met")).groupBy("cell").agg(F.min("met").alias("met"))
        hooks = lab.join(spread, "cell").groupBy("component").agg(F.min("met").alias("met")).checkpoint()
        if hooks.where("component <> met").isEmpty():
            break
        while True:
            # jump: a label takes the label of its label
            hop = hooks.toDF("met", "further")
            hooks = hooks.join(hop, "met").select("component", F.col("further").alias("met"), (F.col("further") != F.col("met")).alias("moved")).checkpoint()
            done = hooks.where("moved").isEmpty()
            hooks = hooks.drop("moved")
            if done:
                break
        lab = lab.join(hooks, "component").select("cell", F.col("met").alias("component")).checkpoint()
    return lab.select(F.col("cell.x").alias(x), F.col("cell.y").alias(y), F.concat_ws(":", "component.x", "component.y").alias("component"))


def percentile_gap(df: DataFrame, a: str, b: str) -> DataFrame:
    """Difference of two percentile ranks over all rows that have both."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    n = both.count()
    for c in (a, b):
        both = competition_rank(both, c, descending=False, name="__rank")
        both = both.withColumn(f"{c}_rank", (F.col("__rank") - 1) / max(n - 1, 1)).drop("__rank")
    return both.withColumn("gap", F.col(f"{a}_rank") - F.col(f"{b}_rank"))


def core_scale(m: Column, e: Column, i: Column) -> Column:
    return 0.5 * m + 0.3 * e + 0.2 * i


def sensitivity(df: DataFrame, distance: str, thresholds: Sequence[float]) -> DataFrame:
    """Rows within each threshold: the thresholds are exploded next to each row, no join needed."""
    t = df.withColumn("threshold", F.explode(F.array(*[F.lit(float(x)) for x in thresholds])))
    return t.groupBy("threshold").agg(F.count_if(F.col(distance) <= F.col("threshold")).alias("within"), F.count("*").alias("rows"))


def leave_one_out(df: DataFrame, key: str, weights: dict[str, float], thresholds: Sequence[float]) -> DataFrame:
    """How a weighted score holds without each of its features: variant, threshold, rows, kept, gained, lost, mean_shift, most_shift.

    ``all`` is the whole score; ``-x`` leaves feature x out, the other weights
    scaled to their sum.  Kept, gained and lost compare the rows at or above a
    threshold with those of the whole score; shifts are differences of
    competition ranks.  A row without one of the features has no score and
    takes no part.  Ranks come from counts of distinct values; all else is one pass.
    """
    whole = sum(weights.values())
    variants = {"all": weights} | {f"-{x}": {k: w for k, w in weights.items() if k != x} for x in weights}
    there = df.where(" and ".join(f"{c} is not null" for c in weights)).select(key, *weights)
    scored = there.select(key, *[sum((F.col(k) * (w * whole / sum(ws.values())) for k, w in ws.items()), F.lit(0.0)).alias(f"__s{i}") for i, ws in enumerate(variants.values())])
    for i in range(len(variants)):
        scored = competition_rank(scored, f"__s{i}", name=f"__r{i}")
    one = lambda i, name: F.struct(F.lit(name).alias("variant"), F.col(f"__s{i}").alias("score"), F.abs(F.col(f"__r{i}") - F.col("__r0")).alias("shift"))
    stacked = scored.select(F.col("__s0").alias("base"), F.explode(F.array(*[one(i, name) for i, name in enumerate(variants)])).alias("v")).select("base", "v.*")
    stacked = stacked.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    now, then = F.col("score") >= F.col("threshold"), F.col("base") >= F.col("threshold")
    return stacked.groupBy("variant", "threshold").agg(
        F.count("*").alias("rows"), F.count_if(now & then).alias("kept"), F.count_if(now & ~then).alias("gained"), F.count_if(~now & then).alias("lost"), F.avg("shift").alias("mean_shift"), F.max("shift").alias("most_shift"),
    )
