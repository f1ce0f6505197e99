"""Complete-case totals, competition ranks with the unavailable last, medians and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import NUMERIC


#: Ranges into which the values of a table that is ranked as a whole are cut.
RANGES = 64


def _counts_before(values: DataFrame, keys: list[str], value: str, descending: bool) -> DataFrame:
    """``values`` (keys, value, __n) with ``__before``: the sum of __n of the values that come earlier.

    Without keys the values are cut at approximate quantiles; sums of the ranges
    (at most ``RANGES`` + 1 rows) and sums inside a range add up, so that no task orders all values.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    earlier = lambda *by: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    if keys:
        return values.withColumn("__before", F.coalesce(F.sum("__n").over(earlier(*keys)), F.lit(0)))
    cuts = values.agg(F.percentile_approx(value, F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)]), F.lit(10_000)).alias("c"))
    held = values.select("*", cuts.scalar().alias("__cuts")).withColumn("__range", F.size(F.filter("__cuts", lambda q: q < F.col(value)))).drop("__cuts")
    over = Window.orderBy(F.col("__range").desc() if descending else F.col("__range").asc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.groupBy("__range").agg(F.sum("__n").alias("__all")).select("__range", F.coalesce(F.sum("__all").over(over), F.lit(0)).alias("__offset"))
    held = held.join(F.broadcast(offsets), "__range")
    return held.withColumn("__before", F.col("__offset") + F.coalesce(F.sum("__n").over(earlier("__range")), F.lit(0))).drop("__range", "__offset")


def competition_rank(df: DataFrame, value: str, descending: bool = True, by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """1, 1, 3 in the chosen direction; a null value has no rank.

    Ranks come from counts of the distinct values, so no task holds all rows of a
    table that is ranked as a whole.
    """
    keys = list(by)
    values = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    ranks = _counts_before(values, keys, value, descending)
    renamed = [*keys, value]
    right = ranks.select(*[F.col(k).alias(f"__{k}") for k in renamed], (F.col("__before") + 1).cast("int").alias(name))
    match = F.lit(True)
    for k in keys:
        match = match & df[k].eqNullSafe(F.col(f"__{k}"))
    match = match & (df[value] == F.col(f"__{value}"))
    return df.join(right, match, "left").select(*[df[c] for c in df.columns], name)


def places(df: DataFrame, value: str, tie: str, descending: bool = True, name: str = "place") -> DataFrame:
    """Place of each row in the order by value, the unavailable last in both directions, ties by ``tie`` (unique, null at most once)."""
    known, lost = df.where(F.col(value).isNotNull()), df.where(F.col(value).isNull())
    inside = F.row_number().over(Window.partitionBy(value).orderBy(tie))
    placed = competition_rank(known, value, descending, name="__rank").withColumn(name, (F.col("__rank") - 1 + inside).cast("int")).drop("__rank")
    # ties are unique, so the rank of a tie is a place; rows without one stand behind
    there, tied = known.agg(F.count("*").alias("n")), lost.agg(F.count(tie).alias("n"))
    behind = competition_rank(lost, tie, descending=False, name="__rank")
    behind = behind.withColumn(name, (there.scalar() + F.coalesce(F.col("__rank"), tied.scalar() + 1)).cast("int")).drop("__rank")
    return placed.unionByName(behind)


def nulls_last(value: str, descending: bool, *ties: str) -> list[Column]:
    """Sort order: nulls at the end in both directions, then the source's own order."""
    return [F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last(), *map(F.col, ties)]


def unpivot_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(keys, metric, value, status) rows of ``<metric>_value`` and ``<metric>_status`` columns."""
    items = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}_value").alias("value"), F.col(f"{m}_status").alias("status")) for m in metrics])
    return df.select(*keys, F.explode(items).alias("i")).select(*keys, "i.*")


def roster_faults(roster: DataFrame, members: DataFrame, area: str, member: str) -> DataFrame:
    """(area, blocked): an area is blocked by an empty roster, an unknown, repeated or ambiguous id, or one that another area has too."""
    in_area, anywhere = Window.partitionBy(area, member), Window.partitionBy(member)
    matches = members.groupBy(F.col(member).alias("__m")).agg(F.count("*").alias("__matches"))
    marked = roster.withColumn("__same", F.count(F.lit(1)).over(in_area)).withColumn("__areas", F.size(F.collect_set(area).over(anywhere)))
    marked = marked.join(matches, marked[member] == F.col("__m"), "left")
    fault = F.col(member).isNull() | (F.col("__same") > 1) | (F.col("__areas") > 1) | (F.coalesce("__matches", F.lit(0)) != 1)
    return marked.groupBy(area).agg(F.bool_or(fault).alias("blocked"))


def area_totals(roster: DataFrame, members: DataFrame, area: str, member: str, value: str, status: str, allowed: Sequence[str] = NUMERIC) -> DataFrame:
    """Complete-case totals of rosters; blocked areas have no total; eligible ones are ranked."""
    faults = roster_faults(roster, members, area, member)
    rows = roster.where(F.col(member).isNotNull()).distinct().join(members.select(member, value, status), member, "left")
    ok = F.coalesce(F.col(status).isin(*allowed), F.lit(False))
    sums = rows.groupBy(area).agg(F.count_if(ok).alias("observed"), F.count("*").alias("expected"), F.sum(F.when(ok, F.col(value))).alias("__sum"))
    out = faults.join(sums, area, "left").select(area, "blocked", F.coalesce("observed", F.lit(0)).alias("observed"), F.coalesce("expected", F.lit(0)).alias("expected"), "__sum")
    total = F.when(~F.col("blocked") & (F.col("observed") == F.col("expected")), F.col("__sum"))
    return competition_rank(out.withColumn("total", total).drop("__sum"), "total")


def route_medians(df: DataFrame, route: str, cell: str, metric: str, value: str) -> DataFrame:
    """Median over distinct cells of a route, with how many have a value and how many there are."""
    cells = df.groupBy(route, metric, cell).agg(F.max(value).alias("v"))
    return cells.groupBy(route, metric).agg(F.median("v").alias("median"), F.count("v").alias("with_value"), F.count("*").alias("cells"))


def mean_rank(medians: DataFrame, route: str, metric: str, coverage: float = 0.9, metrics: int = 3) -> DataFrame:
    """Mean of a route's ranks, withheld unless every metric has a median and enough coverage."""
    ranked = competition_rank(medians, "median", True, [metric])
    ok = F.col("median").isNotNull() & (F.col("with_value") >= F.lit(coverage) * F.col("cells"))
    full = (F.count("*") == metrics) & F.bool_and(ok)
    return ranked.groupBy(route).agg(F.when(full, F.avg("rank")).alias("mean_rank"), F.min(F.col("with_value") / F.col("cells")).alias("least_coverage"))


def composition(a: str, b: str) -> list[Column]:
    """Shares of two parts; null if either is missing or both are zero."""
    whole = F.nullif(F.col(a) + F.col(b), F.lit(0))
    return [(F.col(a) * 100.0 / whole).alias(f"{a}_share"), (F.col(b) * 100.0 / whole).alias(f"{b}_share")]


def guarded_share(numerator: str, denominator: str, *guards: Column) -> Column:
    """A percentage where every guard holds, the denominator is positive and not below the numerator."""
    ok = (F.col(denominator) > 0) & (F.col(numerator) <= F.col(denominator))
    for g in guards:
        ok = ok & g
    return F.when(ok, F.col(numerator) * 100.0 / F.col(denominator))


def top_k(df: DataFrame, by: Sequence[str], k: int, *order: Column) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def page(df: DataFrame, number: int, size: int, *order: Column) -> DataFrame:
    """Page ``number`` (from 1); the last one may be short."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def pins(ids: Column, known: Column, most: int = 4) -> Column:
    """Known ids in their order, each once, at most ``most``."""
    return F.slice(F.array_distinct(F.filter(ids, lambda x: F.array_contains(known, x))), 1, most)


def board_rows(df: DataFrame, selected: Column, pinned: Column, cell: str, *order: Column) -> DataFrame:
    """The selected row first, then pinned ones, then one row for each further cell."""
    priority = F.when(selected, 0).when(pinned, 1).otherwise(2)
    rows = df.withColumn("priority", priority)
    w = Window.partitionBy(cell).orderBy("priority", *order)
    return rows.withColumn("__n", F.row_number().over(w)).where((F.col("__n") == 1) | (F.col("priority") < 2)).drop("__n")


def quantity_radius(value: Column, most: Column, k: float = 20.0) -> Column:
    """Radius whose area is in proportion to the value; null and zero have none."""
    return F.when(value > 0, F.sqrt(value / most) * k).otherwise(F.lit(0.0))


def fill_label(df: DataFrame, by: str, order: str, label: str, name: str) -> DataFrame:
    """Each row with the last label seen at or before it in its group."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(label, ignorenulls=True).over(w))
