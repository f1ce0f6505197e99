"""Identities: source keys are aliases of persisted opaque ids; ambiguity goes to a queue."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.variant import json_merge


def resolve_names(wanted: DataFrame, pool: DataFrame, on: Sequence[str], preferred: str, key: str, group: str, row_id: str) -> DataFrame:
    """Match each wanted row to a source record.

    Candidates agree on ``on``; if any also agrees on ``preferred``, only those
    count.  None: ``no_match``.  One, or several of one non-blank group:
    ``confirmed``, the first by key.  Else ``ambiguous``.  ``row_id`` is unique.
    """
    cands = pool.select(*[F.col(c).alias(f"__{c}") for c in on], F.col(preferred).alias("__route"), F.col(key).alias("__key"), F.col(group).alias("__group")).distinct()
    rows = wanted.select(row_id, *on, preferred).distinct()
    # what the candidates of a name come to is counted once, not for each row that asks for it
    told = [
        F.count_distinct("__key").alias("n"), F.min("__key").alias("first"), F.count_distinct("__group").alias("groups"), F.bool_and(F.coalesce(F.col("__group"), F.lit("")) != "").alias("named"),
    ]
    names = [f"__{c}" for c in on]
    every = cands.groupBy(*names).agg(*told).select(*names, F.struct("n", "first", "groups", "named").alias("__every"))
    mine = cands.where("__route is not null").groupBy(*names, "__route").agg(*told).select(*[F.col(c).alias(f"_{c}") for c in (*names, "__route")], F.struct("n", "first", "groups", "named").alias("__mine"))
    same = lambda prefix: reduce(Column.__and__, [F.col(c) == F.col(f"{prefix}{c}") for c in on])
    rows = rows.join(every, same("__"), "left").join(mine, same("___") & (F.col(preferred) == F.col("___route")), "left")
    c = F.coalesce("__mine", "__every")
    n = F.coalesce(c["n"], F.lit(0))
    status = F.when(n == 0, "no_match").when((n == 1) | (c["named"] & (c["groups"] == 1)), "confirmed").otherwise("ambiguous")
    return rows.select(row_id, F.when(status == "confirmed", c["first"]).alias("source_key"), status.alias("resolution"), n.alias("candidates"))


def registry_resolve(keys: DataFrame, base: DataFrame, extension: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's identity: the base registry's, else the extension's, else null (not minted)."""
    b = base.select(F.col(key).alias("__b"), F.col(value).alias("__bv"))
    e = extension.select(F.col(key).alias("__e"), F.col(value).alias("__ev"))
    joined = keys.join(b, keys[key] == F.col("__b"), "left").join(e, keys[key] == F.col("__e"), "left")
    origin = F.when(F.col("__bv").isNotNull(), "base").when(F.col("__ev").isNotNull(), "extension").otherwise("unminted")
    return joined.select(*[keys[c] for c in keys.columns], F.coalesce("__bv", "__ev").alias(value), origin.alias("origin"))


def mint(keys: DataFrame, registry: DataFrame, key: str, value: str, prefix: str, path: str) -> DataFrame:
    """The registry with new random ids for keys that it lacks, written to ``path`` before it is used.

    A random id must never be computed twice, so the result is read from what was written.
    """
    new = keys.select(key).distinct().join(registry, key, "left_anti")
    made = registry.select(key, value).unionByName(new.select(key, F.concat(F.lit(prefix), F.replace(F.uuid(), F.lit("-"), F.lit(""))).alias(value)))
    made.write.mode("errorifexists").parquet(path)
    return keys.sparkSession.read.parquet(path)


def merge_base_wins(base: DataFrame, extension: DataFrame, key: str) -> DataFrame:
    return base.unionByName(extension.join(base.select(key), key, "left_anti"))


def coverage_gap(open_keys: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    """Keys in only one of the two, and in which."""
    a, b = open_keys.select(F.col(key).alias("a")).distinct(), decided.select(F.col(key).alias("b")).distinct()
    return a.join(b, F.col("a") == F.col("b"), "full").where("a is null or b is null").select(F.coalesce("a", "b").alias(key), F.when(F.col("a").isNull(), "not_open").otherwise("undecided").alias("gap"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is not null and not in the parent."""
    return child.where(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias("__p")), F.col(child_key) == F.col("__p"), "left_anti")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def first_by(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row for each key: the first in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def upsert_reviews(queue: DataFrame, issues: DataFrame, natural_key: str, order: str) -> DataFrame:
    """The queue with the first of each new issue; what is there already stays as it is."""
    return merge_base_wins(queue, first_by(issues, [natural_key], F.col(order)), natural_key)


def hub_candidates(members: DataFrame, group: str, operator: str, route: str, name: str) -> DataFrame:
    """Groups of several operators or routes are hub candidates; of several names, cases for review."""
    g = members.groupBy(group).agg(F.count_distinct(operator).alias("operators"), F.count_distinct(route).alias("routes"), F.count_distinct(name).alias("names"))
    kind = F.when(F.col("names") > 1, "review").when((F.col("operators") > 1) | (F.col("routes") > 1), "hub_candidate").otherwise("plain")
    return g.withColumn("kind", kind)


def apply_decisions(hubs: DataFrame, links: DataFrame, decisions: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply review decisions to hubs and their links.

    ``decisions``: source_key, decision, target_hub_key, station_group_keys (array),
    transfer_basis.  ``confirm_hub`` confirms the target, or makes it from at least two known
    groups; ``resolve_duplicate`` needs a target that exists; ``reject_hub`` changes
    nothing.  Returns (hubs, links, faults); faults must be empty before publishing.
    """
    known = hubs.select(F.col("hub_key").alias("__h"))
    d = decisions.join(known, F.col("target_hub_key") == F.col("__h"), "left")
    confirm, exists = F.col("decision") == "confirm_hub", F.col("__h").isNotNull()
    exploded = d.where(confirm & ~exists).select("source_key", "target_hub_key", "transfer_basis", F.explode_outer("station_group_keys").alias("group_key"))
    unknown = exploded.join(groups.select("group_key"), "group_key", "left_anti").where("group_key is not null").select("source_key").distinct().withColumn("__unknown", F.lit(True))
    d = d.join(unknown, "source_key", "left")
    also_made = Window.partitionBy("target_hub_key")
    made_here = F.max(confirm.cast("int")).over(also_made) == 1
    reasons = F.array_compact(F.array(
        F.when(~F.col("decision").isin("confirm_hub", "resolve_duplicate", "reject_hub"), "unknown_decision"),
        F.when(F.col("decision").isin("confirm_hub", "resolve_duplicate") & F.col("target_hub_key").isNull(), "no_target"),
        F.when(confirm & ~exists & (F.coalesce(F.size("station_group_keys"), F.lit(0)) < 2), "too_few_groups"),
        F.when(F.col("__unknown"), "unknown_group"),
        F.when((F.col("decision") == "resolve_duplicate") & ~exists & ~made_here, "unknown_duplicate_target"),
    ))
    faults = d.withColumn("reasons", reasons).where(F.size("reasons") > 0).select("source_key", F.array_join("reasons", "+").alias("reasons"))
    confirmed = d.where(confirm & F.col("target_hub_key").isNotNull()).select(F.col("target_hub_key").alias("hub_key"), F.col("transfer_basis").alias("__basis")).distinct()
    old = hubs.join(confirmed, "hub_key", "left").select("hub_key", F.coalesce("__basis", "transfer_basis").alias("transfer_basis"), F.when(F.col("__basis").isNotNull(), "confirmed").otherwise(F.col("review_status")).alias("review_status"))
    new = d.where(confirm & ~exists & F.col("target_hub_key").isNotNull()).select(F.col("target_hub_key").alias("hub_key"), "transfer_basis", F.lit("confirmed").alias("review_status")).distinct()
    old_links = links.join(confirmed.withColumn("__c", F.lit(True)).select("hub_key", "__c"), "hub_key", "left").select("hub_key", "group_key", F.when(F.col("__c"), F.lit(1)).otherwise(F.col("is_manual")).alias("is_manual"))
    new_links = exploded.where("group_key is not null and target_hub_key is not null").select(F.col("target_hub_key").alias("hub_key"), "group_key", F.lit(1).alias("is_manual")).distinct()
    return old.unionByName(new), old_links.unionByName(new_links), faults


def resolve_reviews(queue: DataFrame, decisions: DataFrame, resolved_at: str, hubs: DataFrame | None = None) -> DataFrame:
    """Open cases that have a decision are resolved, the decision added to their evidence, which keeps its types.

    ``decisions``: source_key, decision and whatever else was decided.  If it has
    no further column, the bare decision is added, else the whole row as an
    object.  A ``resolution_note`` becomes the case's, where the queue has one.
    ``hubs``: hub_key, hub_id; the id of a decision's ``target_hub_key`` is
    added as ``resolved_hub_id``.  One decision a key; a case without is left as it is.
    """
    more = [c for c in decisions.columns if c not in ("source_key", "decision")]
    known = decisions if hubs is None else decisions.join(hubs.select(F.col("hub_key").alias("target_hub_key"), F.col("hub_id").alias("__hub")), "target_hub_key", "left")
    said = F.struct(*[F.col(c) for c in decisions.columns]) if more else F.col("decision")
    added = F.to_json(F.struct(said.alias("adjudication"), *([] if hubs is None else [F.col("__hub").alias("resolved_hub_id")])))
    note = F.col("resolution_note") if "resolution_note" in more else F.lit(None).cast("string")
    d = known.select(F.col("source_key").alias("__k"), added.alias("__d"), note.alias("__note"))
    joined = queue.join(d, queue["source_key"] == F.col("__k"), "left")
    done = (queue["status"] == "open") & F.col("__k").isNotNull()
    changed = {"status": F.lit("resolved"), "resolved_at": F.lit(resolved_at), "evidence_json": json_merge(queue["evidence_json"], F.col("__d")), "resolution_note": F.col("__note")}
    return joined.select(*[F.when(done, changed[c]).otherwise(queue[c]).alias(c) if c in changed else queue[c] for c in queue.columns])


def replay_decisions(decisions: DataFrame, links: DataFrame) -> DataFrame:
    """(source_key, agrees): whether the links are what each decision says.

    Confirmed: the hub's groups are those of the decision.  Duplicate: the hub
    exists.  Rejected: no hub holds all of the decision's groups.
    """
    # sizes and counts of matches stand for the sets of groups, which may be large: no row carries a hub's groups
    pairs = links.where("hub_key is not null").select("hub_key", "group_key").distinct()
    sizes = pairs.groupBy(F.col("hub_key").alias("__hub")).agg(F.count("group_key").alias("__size"))
    d = decisions.withColumn("__want", F.array_sort(F.array_distinct("station_group_keys")))
    kind = F.coalesce("decision", F.lit(""))
    confirms, rejects = kind == "confirm_hub", ~kind.isin("confirm_hub", "resolve_duplicate")
    asked = d.where(confirms).select("target_hub_key", "__want").distinct().select("target_hub_key", "__want", F.explode("__want").alias("group_key"))
    held = asked.join(pairs.withColumnRenamed("hub_key", "target_hub_key"), ["target_hub_key", "group_key"]).groupBy(F.col("target_hub_key").alias("__t"), F.col("__want").alias("__w")).agg(F.count("*").alias("__held"))
    wants = d.where(rejects).select("__want").distinct().select("__want", F.explode("__want").alias("group_key"))
    full = pairs.join(wants, "group_key").groupBy(F.col("__want").alias("__r"), "hub_key").agg(F.count("*").alias("n")).where(F.col("n") == F.size("__r"))
    together = full.select("__r").distinct()
    out = d.join(sizes, F.col("target_hub_key") == F.col("__hub"), "left")
    out = out.join(held, confirms & (F.col("target_hub_key") == F.col("__t")) & (F.col("__want") == F.col("__w")), "left")
    out = out.join(together, rejects & (F.col("__want") == F.col("__r")), "left")
    want = F.size("__want")
    equal = F.coalesce((F.col("__size") == want) & (F.coalesce("__held", F.lit(0)) == want), F.lit(False))
    agrees = F.when(confirms, equal).when(F.col("decision") == "resolve_duplicate", F.col("__hub").isNotNull()).otherwise(F.col("__r").isNull())
    return out.select("source_key", agrees.alias("agrees"))
