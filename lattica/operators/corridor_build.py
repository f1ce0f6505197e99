"""Corridors built from ordered names: each name's source record, the chain, its lock, and the state of its corrections."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ordered_hash
from . import corridor as gates
from . import screen
from .checkpoints import checkpointed

#: How a name was resolved, the states of a correction, the form of a decision's id, the bounds of the detour ratio.
RESOLUTIONS = ("confirmed_manual_extension", "confirmed_source_route", "confirmed_same_group_seed", "unresolved_no_match", "unresolved_ambiguous")
PENDING = ("PENDING_OWNER_DECISION", "PENDING_REGENERATION")
APPLIED = "APPLIED"
DECISION_ID = r"^(DEC-[0-9]{4}|OWNER-[0-9]{4}-[0-9]{2}-[0-9]{2}-[A-Z0-9-]+)$"
DETOUR_RATIOS = (1.25, 1.35)
LOCKED = "confirmed_exact_segment"


class Built(NamedTuple):
    """``chain``: corridor, place, name, source_key, group_code, lon, lat, resolution, cumulative_km.  ``lines``: one row a
    corridor with counts, ends and two hashes.  ``context``: records of auxiliary names.  ``reviews``: cases for people.
    """

    chain: DataFrame
    lines: DataFrame
    context: DataFrame
    reviews: DataFrame


def chosen_records(stops: DataFrame, records: DataFrame) -> DataFrame:
    """``stops`` with the source record that each one's name stands for, and why.

    ``stops``: corridor, place, name, operator, preferred (a route or null),
    routes (array), extended (whether an override names the operator or route).
    ``records``: source_key, operator, route, name, group_code, lon, lat.
    A record of the preferred route goes before those of the other routes.  Of
    several, the smallest key stands for all if they share one group; else none
    does, and ``candidates`` names them in order.  Adds source_key, group_code,
    lon, lat, resolution, candidates.
    """
    asked = stops.select("corridor", "place", "name", "operator", "preferred", "routes")
    r = records.select("source_key", F.col("operator").alias("__o"), "route", F.col("name").alias("__n"), F.coalesce("group_code", F.lit("")).alias("group_code"), "lon", "lat")
    met = asked.join(r, (F.col("operator") == F.col("__o")) & (F.col("name") == F.col("__n")) & (F.col("route").eqNullSafe(F.col("preferred")) | F.array_contains("routes", F.col("route"))))
    met = met.withColumn("tier", F.when(F.col("route").eqNullSafe(F.col("preferred")), 0).otherwise(1)).where("tier = 0 or array_contains(routes, route)")
    one = F.min(F.struct("source_key", "group_code", "lon", "lat")).alias("first")
    tiers = met.groupBy("corridor", "place", "name", "tier").agg(one, F.array_sort(F.collect_set("source_key")).alias("candidates"), F.count_distinct("group_code").alias("groups"), F.min(F.col("group_code") != "").alias("grouped"))
    best = tiers.groupBy("corridor", "place", "name").agg(F.min_by(F.struct("first", "candidates", "groups", "grouped"), "tier").alias("b"))
    j = stops.join(best, ["corridor", "place", "name"], "left")
    several = F.size("b.candidates") > 1
    alike = (F.col("b.groups") == 1) & F.col("b.grouped")
    resolution = (
        F.when(F.col("b").isNull(), RESOLUTIONS[3]).when(several & ~alike, RESOLUTIONS[4]).when(F.col("extended"), RESOLUTIONS[0]).when(several, RESOLUTIONS[2]).otherwise(RESOLUTIONS[1])
    )
    j = j.withColumn("resolution", resolution)
    found = F.col("resolution").startswith("confirmed")
    kept = [F.when(found, F.col(f"b.first.{c}")).alias(c) for c in ("source_key", "group_code", "lon", "lat")]
    return j.select(*stops.columns, *kept, "resolution", F.coalesce("b.candidates", F.array().cast("array<string>")).alias("candidates"))


def build_corridors(stops: DataFrame, corridors: DataFrame, records: DataFrame, overrides: DataFrame, auxiliary: DataFrame) -> Built:
    """Resolve every name of every corridor and put the chains together.

    ``stops``: corridor, place, name, preferred (a route or null); no place
    repeats in a corridor.  ``corridors``: corridor, operator, routes (array).
    ``overrides``: corridor, name, operator, route; where one is, its operator
    is asked, and its route if the stop prefers none.  ``auxiliary``: corridor,
    name; such records are context, never part of the chain, and a name
    without one is passed over.  An override's use is a resolved case, a name
    without record or with several an open one.  Source keys are texts.
    """
    o = overrides.select("corridor", "name", F.col("operator").alias("__operator"), F.col("route").alias("__route")).withColumn("__extended", F.lit(True))
    c = corridors.select("corridor", "operator", "routes")
    asked = stops.join(c, "corridor").join(o, ["corridor", "name"], "left")
    asked = asked.select(
        "corridor", "place", "name", F.coalesce("__operator", "operator").alias("operator"), F.coalesce("preferred", "__route").alias("preferred"), "routes", F.coalesce("__extended", F.lit(False)).alias("extended"),
    )
    chosen = chosen_records(asked, records)
    placed = chosen.where(F.col("source_key").isNotNull())
    chain = screen.cumulative_km(placed, "corridor", "place", "lon", "lat").withColumn("cumulative_km", F.round("cumulative_km", 6))
    chain = chain.select("corridor", "place", "name", "source_key", F.nullif("group_code", F.lit("")).alias("group_code"), "lon", "lat", "resolution", "cumulative_km")
    lines = chosen.groupBy("corridor").agg(
        F.count("source_key").alias("stations"), F.count_if(F.col("source_key").isNull()).alias("unresolved"), F.min_by("name", "place").alias("first_name"), F.max_by("name", "place").alias("last_name"),
        ordered_hash(F.col("place"), F.col("name")).alias("names_sha256"),
        F.sha2(F.to_json(F.transform(F.filter(F.array_sort(F.collect_list(F.struct(F.col("place").alias("p"), F.col("source_key").alias("k")))), lambda x: x["k"].isNotNull()), lambda x: x["k"])), 256).alias("keys_sha256"),
    )
    beside = auxiliary.select("corridor", "name").distinct().join(c, "corridor").withColumns({"place": F.lit(0), "preferred": F.lit(None).cast("string"), "extended": F.lit(False)})
    context = chosen_records(beside, records).where(F.col("source_key").isNotNull()).select("corridor", "name", "source_key", F.lit("context_only").alias("resolution"))
    none = F.array().cast("array<string>")
    case = lambda issue, status, key, candidates: [F.col("corridor"), key.alias("source_key"), F.lit(issue).alias("issue_type"), candidates.alias("candidates"), F.lit(status).alias("status")]
    named = F.concat_ws("|", F.col("corridor").cast("string"), F.col("name"))
    reviews = (
        chosen.where(F.col("resolution") == RESOLUTIONS[3]).select(*case("no_match", "open", named, none))
        .unionByName(chosen.where(F.col("resolution") == RESOLUTIONS[4]).select(*case("ambiguous_match", "open", named, F.col("candidates"))))
        .unionByName(placed.where("extended").select(*case("merge_candidate", "resolved", F.col("source_key"), F.array("source_key"))))
    ).distinct()
    return Built(chain, lines, context, reviews)


def lock_faults(lines: DataFrame, locks: DataFrame, hashes: DataFrame | None = None) -> DataFrame:
    """Corridors that differ from their lock: corridor, reasons.

    ``locks``: corridor, decision, endpoint_start, endpoint_end, station_count.
    ``hashes``: corridor, names_sha256, keys_sha256 as recorded before; a
    corridor that lacks there has no hash to agree with.
    """
    j = lines.join(locks.withColumn("__locked", F.lit(True)), "corridor", "full")
    if hashes is not None:
        j = j.join(hashes.select("corridor", F.col("names_sha256").alias("__names"), F.col("keys_sha256").alias("__keys")), "corridor", "left")
    differ = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    built = F.col("stations").isNotNull()
    reasons = [
        F.when(F.col("__locked").isNull(), "no_lock"), F.when(~built, "not_built"), F.when(F.col("__locked") & ~F.col("decision").eqNullSafe(F.lit(LOCKED)), "not_confirmed"),
        F.when(F.col("unresolved") > 0, "incomplete"), F.when(built & F.col("__locked") & differ("station_count", "stations"), "count"),
        F.when(built & F.col("__locked") & (differ("endpoint_start", "first_name") | differ("endpoint_end", "last_name")), "endpoints"),
    ]
    if hashes is not None:
        reasons += [F.when(built & differ("names_sha256", "__names"), "names_hash"), F.when(built & differ("keys_sha256", "__keys"), "keys_hash")]
    return j.select("corridor", F.array_join(F.array_compact(F.array(*reasons)), "+").alias("reasons")).where("reasons <> ''")


def state_faults(corrections: DataFrame, register: DataFrame | None = None) -> DataFrame:
    """Corrections whose stated status their own record does not bear out: correction, reasons.

    ``corrections``: correction, status, owner_decision, detour_ratio_max,
    confirmation, records (array of url, retrieved_at), exclusion_evidence.
    ``register``: decision; an accepted decision must be an entry of it.
    """
    j, unknown = corrections, F.lit(False)
    if register is not None:
        j = j.join(register.select(F.col("decision").alias("__d")).distinct(), F.col("owner_decision") == F.col("__d"), "left")
        unknown = F.col("__d").isNull()
    known, waits = F.col("status").isin(*PENDING, APPLIED), F.col("status") == PENDING[0]
    applied, formed = F.col("status") == APPLIED, F.col("owner_decision").rlike(DECISION_ID)
    no = lambda c: ~F.coalesce(c, F.lit(False))
    said = lambda c: F.col(c).eqNullSafe(F.lit("CONFIRMED"))
    incomplete = F.exists("records", lambda r: no(r["url"] != "") | no(r["retrieved_at"] != ""))
    reasons = F.array_compact(F.array(
        F.when(no(known), "unknown_status"), F.when(no(F.col("detour_ratio_max").between(*DETOUR_RATIOS)), "detour_ratio"),
        F.when(waits & no(F.col("owner_decision") == "PENDING"), "decided_while_waiting"), F.when(known & ~waits & no(formed), "decision_id"),
        F.when(known & ~waits & F.coalesce(formed, F.lit(False)) & unknown, "decision_not_registered"),
        F.when(applied & (~said("confirmation") | no(F.size("records") > 0)), "not_confirmed"), F.when(applied & F.coalesce(incomplete, F.lit(False)), "confirmation_without_url"),
        F.when(applied & ~said("exclusion_evidence"), "exclusion_not_confirmed"),
    ))
    return j.select("correction", F.array_join(reasons, "+").alias("reasons")).where("reasons <> ''")


def pin_faults(pins: DataFrame, pool: DataFrame, registry: DataFrame, chain: DataFrame, applied: Column) -> DataFrame:
    """Insertions that are not what they are pinned to: corridor, name, reasons.

    ``pins``: corridor, name, source_key, station_id, station_group_id.  ``pool``:
    source_key, name, group_code.  ``registry``: kind, key, id.  ``chain``:
    corridor, name, station_id, station_group_id of what was built, which an applied insertion must reuse.
    """
    p = pool.select("source_key", F.col("name").alias("__name"), F.col("group_code").alias("__group"))
    ids = lambda kind, key, name: registry.where(F.col("kind") == kind).select(F.col("key").alias(key), F.col("id").alias(name))
    j = pins.join(p, "source_key", "left").join(ids("station", "source_key", "__station"), "source_key", "left").join(ids("station_group", "__group", "__station_group"), "__group", "left")
    built = chain.select("corridor", "name", F.col("station_id").alias("__s"), F.col("station_group_id").alias("__g")).dropDuplicates(["corridor", "name"])
    j = j.join(built, ["corridor", "name"], "left").withColumn("__applied", F.coalesce(applied, F.lit(False)))
    differ = lambda a, b: ~F.col(a).eqNullSafe(F.col(b)) | F.col(a).isNull()
    reasons = F.array_compact(F.array(
        F.when(differ("__name", "name"), "no_such_record"), F.when(differ("station_id", "__station"), "station_id"), F.when(differ("station_group_id", "__station_group"), "station_group_id"),
        F.when(F.col("__applied") & (differ("__s", "station_id") | differ("__g", "station_group_id")), "not_reused"),
    ))
    return j.select("corridor", "name", F.array_join(reasons, "+").alias("reasons")).where("reasons <> ''")


def pending_faults(gaps: DataFrame, insertions: DataFrame) -> DataFrame:
    """Pending insertions that the screen does not find where they are to go: corridor, source_key.

    ``gaps`` as ``corridor_gaps`` gives them; ``insertions``: corridor, source_key, after, before.
    """
    found = gaps.select("corridor", "source_key", F.col("after").alias("__a"), F.col("before").alias("__b"))
    j = insertions.join(found, ["corridor", "source_key"], "left")
    return j.where(~F.col("after").eqNullSafe(F.col("__a")) | ~F.col("before").eqNullSafe(F.col("__b"))).select("corridor", "source_key")


def completeness(chain: DataFrame, pool: DataFrame, corrections: DataFrame, insertions: DataFrame, exclusions: DataFrame, context: DataFrame, ratio: float) -> DataFrame:
    """The state of each corridor, from its gaps and what has been decided of them: corridor, gaps, unexplained, status, derived, reasons.

    ``chain``: corridor, place, name, source_key, lon, lat.  ``pool``: corridor, name,
    source_key, lon, lat of all records that a corridor's operator and routes have.
    ``corrections``: corridor, status, locked_count_before, corrected_count; a
    corridor without one has no status.  ``insertions``: corridor, source_key,
    after, before.  ``exclusions`` and ``context``: corridor, source_key.

    Derived: ``COMPLETE`` without gaps, ``APPLIED`` where all insertions stand in
    the chain, ``PENDING_REGENERATION`` where all gaps left are decided, else
    ``PENDING_OWNER_DECISION``.  Reasons: unexplained gaps, insertions that are
    not found in their place, counts that do not add up, and a stated status
    that the derived one contradicts.
    """
    gaps = checkpointed(gates.corridor_gaps(pool, chain, "corridor", "source_key", "name", "place", "lon", "lat", ratio))
    state = corrections.select("corridor", "status")
    waiting = insertions.join(state.where(F.col("status").isin(*PENDING)), "corridor").select(*insertions.columns)
    explained = context.select("corridor", "source_key").unionByName(exclusions.select("corridor", "source_key")).distinct()
    open_gaps = gates.unexplained_gaps(gaps, explained, "corridor", "source_key")
    undecided = gates.unexplained_gaps(open_gaps, insertions.select("corridor", "source_key"), "corridor", "source_key")
    unexplained = gates.unexplained_gaps(open_gaps, waiting.select("corridor", "source_key"), "corridor", "source_key")
    standing = insertions.join(chain.select("corridor", "source_key").distinct(), ["corridor", "source_key"], "left_semi")
    counted = lambda df, name: df.groupBy("corridor").agg(F.count("*").alias(name))
    j = counted(chain, "stations")
    for df, name in ((gaps, "gaps"), (open_gaps, "__open"), (undecided, "__undecided"), (unexplained, "unexplained"), (insertions, "__inserted"), (standing, "__standing"), (pending_faults(gaps, waiting), "__misplaced")):
        j = j.join(counted(df, name), "corridor", "left")
    j = j.na.fill(0).join(corrections.select("corridor", "status", "locked_count_before", "corrected_count"), "corridor", "left")
    derived = screen.workflow_state(F.col("__open") > 0, F.col("__undecided") == 0, (F.col("__inserted") > 0) & (F.col("__standing") == F.col("__inserted")) & (F.col("__open") == 0))
    j = j.withColumn("derived", derived)
    pending = F.col("status").isin(*PENDING)
    expected = F.when(pending, F.col("locked_count_before")).otherwise(F.col("corrected_count"))
    reasons = F.array_compact(F.array(
        F.when(F.col("unexplained") > 0, "unexplained_gaps"), F.when(F.col("__misplaced") > 0, "insertion_not_detected"),
        F.when(F.col("status").isNotNull() & ~F.col("corrected_count").eqNullSafe(F.col("locked_count_before") + F.col("__inserted")), "arithmetic"),
        F.when(F.col("status").isNotNull() & ~expected.eqNullSafe(F.col("stations")), "count"),
        F.when((F.col("status") == APPLIED) & (F.col("__standing") < F.col("__inserted")), "insertion_missing"),
        F.when(pending & (F.col("derived") == APPLIED), "status_behind"),
    ))
    return j.select("corridor", "stations", "gaps", "unexplained", "status", "derived", F.array_join(reasons, "+").alias("reasons"))
