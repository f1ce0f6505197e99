"""Corridors: ordered chains of registered stations, screened against a pool of source records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from . import screen
from .constraints import GateError
from .near import within_cells


def outside_same_station(records: DataFrame, chain: DataFrame, corridor: str, name: str, lon: str, lat: str, km: float = 0.5) -> DataFrame:
    """Records that are no other entry of a station of their corridor: none of that name lies within ``km``.

    The places of a name in a corridor are held against each other, each once, by cells.
    """
    at = ["__c", "__name", "__x", "__y"]
    distinct = lambda df, *names: df.select(*[F.col(c).alias(n) for c, n in zip((corridor, name, lon, lat), names, strict=True)]).distinct()
    # a little wider, as the planar distance falls short of the true one
    met = within_cells(distinct(records, *at), distinct(chain, "__c", "__name", "__sx", "__sy"), ("__x", "__y"), ("__sx", "__sy"), max(km, 1e-6) * 1.02, ["__c", "__name"])
    near = met.where(geo.approx_km(F.col("__x"), F.col("__y"), F.col("__sx"), F.col("__sy"), geo.LAT_KM_SCREEN) <= km).select(*at).distinct()
    same = [F.col(c) == F.col(n) for c, n in zip((corridor, name, lon, lat), at, strict=True)]
    return records.join(near, same, "left_anti")


def corridor_gaps(records: DataFrame, chain: DataFrame, corridor: str, key: str, name: str, seq: str, lon: str, lat: str, most: float, km: float = 0.5) -> DataFrame:
    """Records that seem to be missing from a chain: corridor, key, ratio, and the stations ``after`` and ``before`` which they would stand.

    A record is screened in its own corridor.  Left out are records whose key is
    in the chain, and those within ``km`` of a station of their name.
    """
    new = records.join(chain.select(corridor, key), [corridor, key], "left_anti")
    new = outside_same_station(new, chain, corridor, name, lon, lat, km)
    placed = chain.select(corridor, seq, F.col(lon).alias("lon"), F.col(lat).alias("lat"), F.col(name).alias("name"))
    edge = screen.edges(placed, corridor, seq, "lon", "lat", "name").withColumn("edge_index", F.row_number().over(Window.partitionBy(corridor).orderBy(seq)) - 1)
    one = new.select(corridor, F.struct(corridor, key).alias("__record"), F.col(lon).alias("__lon"), F.col(lat).alias("__lat"))
    found = screen.detour_screen(one, edge, corridor, "__record", "__lon", "__lat", most)
    ends = edge.select(F.col(corridor).alias("__e"), F.col("edge_index").alias("__i"), F.col("name").alias("after"), F.col("next_name").alias("before"))
    found = found.join(ends, (F.col(f"__record.{corridor}") == F.col("__e")) & (F.col("edge_index") == F.col("__i")))
    return found.select(f"__record.{corridor}", f"__record.{key}", "ratio", "after", "before")


def unexplained_gaps(gaps: DataFrame, explained: DataFrame, corridor: str, key: str) -> DataFrame:
    """Gaps that no auxiliary row, exclusion or pending insertion of their corridor stands for."""
    return gaps.join(explained.select(corridor, key), [corridor, key], "left_anti")


def filter_misses(chain: DataFrame, filters: DataFrame, on: Sequence[str], overridden: Column | None = None) -> DataFrame:
    """Stations of a chain that their own corridor's filter does not match: a filter that misses them would screen nothing."""
    asked = chain if overridden is None else chain.where(~F.coalesce(overridden, F.lit(False)))
    return asked.join(filters.select(*on).distinct(), list(on), "left_anti")


def insertion_faults(chain: DataFrame, blocks: DataFrame, corridor: str, seq: str, name: str) -> DataFrame:
    """Applied insertions that do not stand in order: corridor, after, reason.

    ``blocks``: corridor, after, stations (array), before.  The chain must read
    after, stations, before, from the first station called ``after``.
    """
    anchors = blocks.select(corridor, "after", F.concat(F.array("after"), "stations", F.array("before")).alias("__want")).withColumn("__size", F.size("__want"))
    placed = chain.select(corridor, F.col(name).alias("__name"), F.row_number().over(Window.partitionBy(corridor).orderBy(seq)).alias("__at"))
    firsts = placed.groupBy(corridor, F.col("__name").alias("after")).agg(F.min("__at").alias("__first"))
    started = anchors.join(firsts, [corridor, "after"], "left")
    p = placed.withColumnRenamed(corridor, "__c")
    reached = started.join(p, (F.col(corridor) == F.col("__c")) & (F.col("__at") >= F.col("__first")) & (F.col("__at") < F.col("__first") + F.col("__size")), "left")
    read = reached.groupBy(corridor, "after", "__want", "__first").agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__name"))), lambda x: x["__name"]).alias("__got"))
    reason = F.when(F.col("__first").isNull(), "anchor_missing").when(F.col("__got") != F.col("__want"), "not_in_order")
    return read.select(corridor, "after", reason.alias("reason")).where("reason is not null")


def count_drift(chain: DataFrame, specs: DataFrame, corridor: str, pending: Column) -> DataFrame:
    """Corridors whose counts do not add up: corridor, reasons.

    ``specs``: corridor, locked_count_before, inserted, corrected_count.
    """
    n = chain.groupBy(corridor).agg(F.count("*").alias("__n"))
    j = specs.join(n, corridor, "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    reasons = F.array_compact(F.array(
        F.when(~F.col("corrected_count").eqNullSafe(F.col("locked_count_before") + F.col("inserted")), "arithmetic"),
        F.when(pending & ~F.col("locked_count_before").eqNullSafe(F.col("__n")), "locked_count"),
        F.when(~pending & ~F.col("corrected_count").eqNullSafe(F.col("__n")), "corrected_count"),
    ))
    return j.select(corridor, F.array_join(reasons, "+").alias("reasons")).where("reasons <> ''")


def upto_named(df: DataFrame, corridor: str, seq: str, name: str, which, anchor: str, expected: int | None = None) -> DataFrame:
    """All other corridors whole, and corridor ``which`` up to its station ``anchor``, which must be there, at ``expected`` if given."""
    at = df.where((F.col(corridor) == which) & (F.col(name) == anchor)).agg(F.min(seq).alias("at")).first()["at"]
    if at is None or expected is not None and at != expected:
        raise GateError(f"{anchor} stands at {at} of {which}, not at {expected}")
    return df.where(~F.col(corridor).eqNullSafe(F.lit(which)) | (F.col(seq) <= at))


def line_slice(df: DataFrame, chain: str, seq: str, first: int, last: int) -> DataFrame:
    """The stations of each chain at places ``first`` to ``last``, both included, from 0; a station without a place is in no slice."""
    at = F.row_number().over(Window.partitionBy(chain).orderBy(seq)) - 1
    return df.where(F.col(seq).isNotNull()).withColumn("place", at).where(F.col("place").between(first, last))


def route_order(df: DataFrame, order: DataFrame, on: Sequence[str], route: str, position: str, name: str) -> DataFrame:
    """``df`` with ``display_rank`` in its route: by registered position, those without one behind, by name."""
    placed = df.join(order.select(*on, F.col(position).alias("__at")), list(on), "left")
    w = Window.partitionBy(route).orderBy(F.col("__at").asc_nulls_last(), F.col(name).asc_nulls_last(), *[F.col(c) for c in on])
    return placed.withColumn("display_rank", F.row_number().over(w)).drop("__at")
