"""What must hold before records are published: identities that are whole, hubs, approvals, mesh components, screens."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constraints import GateError, observation_faults

#: The state of a component's geometry, and whether a cell's components are to be summed by scope.
GEOMETRY, SINGLE, SEVERAL = "full_mesh_geometry_not_administrative_partition_clip", "single_prefecture_component", "requires_scope_aware_prefecture_component_sum"
#: Features of a key are dealt into so many parts, parts into so many tasks, and a part is cut into blocks of so many.  A task's
#: features fit one Parquet dictionary (131,072 longs) up to some 8 million of them, so that no value is written out each time.
PARTS, TASKS, BLOCK = 128, 64, 256


def _reasons(*reasons: Column) -> Column:
    return F.array_compact(F.array(*reasons))


def _no(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def identity_reasons(records: DataFrame, variants: Sequence[str], needed: Sequence[str], code: str, missing: str = "MISSING") -> DataFrame:
    """``records`` with ``reasons``: why an identity is not whole.

    ``variants``: arrays that must hold one value each.  ``needed``: texts that
    must be there and not empty.  A ``code`` that begins with ``missing``, or is
    null, was made up by the source.
    """
    one = F.lit(True)
    for v in variants:
        one = one & F.coalesce(F.size(v) == 1, F.lit(False))
    whole = F.lit(True)
    for c in needed:
        whole = whole & F.coalesce(F.col(c) != "", F.lit(False))
    whole = whole & ~F.coalesce(F.col(code).startswith(missing), F.lit(True))
    return records.withColumn("reasons", _reasons(F.when(~one, "ambiguous_source_identity"), F.when(~whole, "missing_identity_attribute")))


def publishable(records: DataFrame, inside: Column, kept: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(records to publish with their ``origin``, records that stop publication); ``records`` have ``reasons``.

    In scope are those ``inside``, and those whose key was published before
    (``kept``).  One unresolved record in scope stops all: a gate holds the second to be empty.
    """
    before = kept.select(key).distinct().withColumn("__before", F.lit(True))
    j = records.join(before, key, "left").withColumn("origin", F.when(inside, "candidate").when(F.col("__before"), "retained")).where("origin is not null").drop("__before")
    return j.where(F.size("reasons") == 0).drop("reasons"), j.where(F.size("reasons") > 0).select(key, F.array_join("reasons", "+").alias("reasons"))


def attach_hubs(rows: DataFrame, links: DataFrame, group: str = "station_group_id", hub: str = "hub_id") -> tuple[DataFrame, DataFrame]:
    """(rows with their group's hub, groups that are linked to several); a group without a link has none.

    Where a group has several, its rows get none: publication stops anyway.
    """
    told = links.where(F.col(group).isNotNull() & F.col(hub).isNotNull()).groupBy(group).agg(F.min(hub).alias(hub), F.max(hub).alias("__last"), F.count_distinct(hub).alias("hubs"))
    several = told.where("hubs > 1").select(group, "hubs")
    return rows.drop(hub).join(told.where("hubs = 1").select(group, hub), group, "left"), several


def approved_context(items: DataFrame, sources: DataFrame, source: str, approved: str, status: str) -> tuple[DataFrame, DataFrame]:
    """(items that may be shown, item and reasons of those that stop publication).

    ``items`` have ``item``.  An item must be approved and its source known; one
    whose symbol is unresolved is not shown, and stops nothing.
    """
    known = sources.select(source).distinct().withColumn("__known", F.lit(True))
    j = items.join(known, source, "left")
    reasons = _reasons(F.when(_no(F.col(approved)), "not_approved"), F.when(F.col("__known").isNull(), "source_missing"))
    j = j.withColumn("reasons", reasons).drop("__known")
    shown = j.where((F.size("reasons") == 0) & ~F.col(status).eqNullSafe(F.lit("symbol_unresolved"))).drop("reasons")
    return shown, j.where(F.size("reasons") > 0).select("item", F.array_join("reasons", "+").alias("reasons"))


def kept_assertions(assertions: DataFrame, allowed: DataFrame, key: str = "assertion_id", cases: str = "cases", case: str = "case_id") -> DataFrame:
    """Assertions all of whose cases are allowed; one that names a case outside goes whole, one without cases stays."""
    named = assertions.select(key, F.explode(cases).alias(case))
    outside = named.join(allowed.select(case).distinct(), case, "left_anti").select(key).distinct()
    return assertions.join(outside, key, "left_anti")


def feature_fan_out(features: DataFrame, crosswalk: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(each feature by every row of the crosswalk that has its key, keys of features that have none with their number).

    The rows grow with the square of a key's.  A block of up to ``BLOCK`` features of one key meets a row of the
    crosswalk at once, so that alike values stand together and a written result takes a fraction of the disk.
    """
    none = features.join(crosswalk.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.count("*").alias("features"))
    dealt = [F.col(f"`{c}`") for c, kind in features.dtypes if "map<" not in kind and "variant" not in kind]
    rows = features.select(key, F.pmod(F.xxhash64(*dealt), F.lit(PARTS)).alias("__part"), F.struct(*[f"`{c}`" for c in features.columns]).alias("__row"))
    parts = rows.repartition(TASKS, key, "__part").groupBy(key, "__part").agg(F.collect_list("__row").alias("__rows"))
    blocks = F.transform(F.sequence(F.lit(1), F.size("__rows"), F.lit(BLOCK)), lambda i: F.slice("__rows", i, BLOCK))
    met = parts.select(key, F.explode(blocks).alias("__block")).join(crosswalk, key).withColumn("__row", F.explode("__block"))
    # the key as the feature has it: a group has one for all its ways of writing (-0.0, collations)
    mine = [F.col("__row").getField(c).alias(c) for c in (key, *features.drop(key).columns)]
    return met.select(*mine, *[F.col(f"`{c}`") for c in crosswalk.drop(key).columns]), none


def station_points(crosswalk: DataFrame, stations: DataFrame, corridor: Column, station: str, lon: str, lat: str) -> DataFrame:
    """station, lon, lat of a corridor's stations; a station that is not known, or no station at all, fails."""
    asked = crosswalk.where(corridor).select(station).distinct()
    lost = asked.join(stations.select(station), station, "left_anti").limit(3).collect()
    found = asked.join(stations.select(station, lon, lat), station)
    if lost or found.isEmpty():
        raise GateError(f"stations without a point: {lost}" if lost else "a corridor without stations")
    return found


def screen_faults(chain: DataFrame, pool: DataFrame, filters: DataFrame, corridor: str, key: str, on: Sequence[str], overridden: Column | None = None) -> DataFrame:
    """corridor, key, reasons: stations of a chain that are not in the pool, or that their corridor's filter misses, so that it would screen nothing."""
    there = pool.select(key).distinct().withColumn("__pool", F.lit(True))
    hit = filters.select(*on).distinct().withColumn("__hit", F.lit(True))
    free = F.coalesce(overridden, F.lit(False)) if overridden is not None else F.lit(False)
    j = chain.join(there, key, "left").join(hit, list(on), "left")
    reasons = _reasons(F.when(F.col("__pool").isNull(), "not_in_pool"), F.when(F.col("__hit").isNull() & ~free, "filter_misses"))
    return j.select(corridor, key, F.array_join(reasons, "+").alias("reasons")).where("reasons <> ''")


def mesh_component_faults(rows: DataFrame, label: str, partitions: Sequence[str], metrics: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """observation_id, mesh, partition, reasons of components that are not as they must be.

    ``rows``: observation_id, mesh, partition (text of two digits), raw_key,
    record_key, geometry_status, rollup_status, reference_period, published_at,
    partition_count, partition_codes (JSON).  ``metrics``: name to columns of
    raw, value and status.  A cell's figures come from counts that combine
    before they move, so a frequent cell is in no single task.
    """
    cells = rows.groupBy("mesh").agg(F.count("*").alias("__n"), F.to_json(F.array_sort(F.collect_set("partition"))).alias("__codes"), F.count_distinct("partition").alias("__partitions"))
    again = rows.groupBy("observation_id").agg(F.count("*").alias("__copies"))
    j = rows.join(cells, "mesh", "left").join(again, "observation_id", "left")
    status = F.when(F.col("__n") > 1, SEVERAL).otherwise(SINGLE)
    named = lambda name: lambda reason: F.concat(F.lit(f"{name}:"), reason)
    told = [F.transform(observation_faults(F.col(raw), F.col(value), F.col(state)), named(name)) for name, (raw, value, state) in metrics.items()]
    own = _reasons(
        F.when(_no(F.col("mesh").rlike("^[0-9]{9}$")), "mesh_key"), F.when(_no(F.col("partition").isin(*partitions)), "partition"), F.when(_no(F.col("raw_key") == F.col("mesh")), "raw_key"),
        F.when(_no(F.col("record_key") == F.concat_ws(":", F.lit(label), "partition", "mesh")), "record_key"), F.when(_no(F.col("geometry_status") == GEOMETRY), "geometry_status"),
        F.when(_no(F.col("rollup_status") == status), "rollup_status"), F.when(_no(F.col("reference_period") != ""), "reference_period"), F.when(_no(F.col("published_at") != ""), "published_at"),
        F.when(_no(F.col("partition_count") == F.col("__n")), "partition_count"), F.when(_no(F.col("partition_codes") == F.col("__codes")), "partition_codes"),
        F.when(F.col("__partitions") < F.col("__n"), "partition_twice"), F.when(F.col("__copies") > 1, "observation_id"),
    )
    return j.select("observation_id", "mesh", "partition", F.array_join(F.concat(own, *told), "+").alias("reasons")).where("reasons <> ''")
