"""Submitted predictions: a JSON payload parsed strictly, every refusal a row, what is left ready to evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import LIST, as_list, as_object, kind, member, text
from ..schema import NUMERIC, VALUELESS

#: The members of a payload, of a metric's contract and of a prediction; statuses of a value that is not there.
RUN, CONTRACT = ("model_run_id", "model_version"), ("definition", "unit", "reference_period")
CASE, METRICS = "golden_eval_id", "metrics"
MISSING = ("aggregation_destination", *VALUELESS, "invalid")


class Submitted(NamedTuple):
    """``predictions``: submission, case_id, relation, value, status, of submissions without faults.
    ``faults``: submission, case_id (null for the payload itself), reasons.  ``runs``: submission, model_run_id, model_version, model_artifact_sha256.
    """

    predictions: DataFrame
    faults: DataFrame
    runs: DataFrame


def _no(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def _reasons(*reasons: Column) -> Column:
    return F.array_compact(F.array(*reasons))


def _contract_faults(contracts: Column, relations: Sequence[str]) -> list[Column]:
    names = F.array_sort(F.map_keys(as_object(contracts)))
    out = [F.when(_no(names == F.array(*map(F.lit, sorted(relations)))), "contracts")]
    for relation in relations:
        c = member(contracts, relation)
        there = c.isNotNull()
        out += [F.when(there & text(member(c, k)).isNull(), f"contract_{relation}_{k}") for k in CONTRACT]
        refs = as_list(member(c, "source_refs"))
        out.append(F.when(there & _no((F.size(refs) > 0) & ~F.exists(refs, lambda r: text(r).isNull())), f"contract_{relation}_source_refs"))
    return out


def _observations(items: DataFrame) -> DataFrame:
    """``items`` with what is in them: ``exact``, ``value_kind``, ``number``, ``said``."""
    read = items.select("*", F.array_sort(F.map_keys(as_object(F.col("item")))).alias("names"), member(F.col("item"), "value").alias("v"), member(F.col("item"), "status").alias("s"))
    read = read.select("*", kind(F.col("v")).alias("value_kind"), kind(F.col("s")).alias("status_kind"))
    return read.select(
        *items.columns, (F.col("names") == F.array(F.lit("status"), F.lit("value"))).alias("exact"), "value_kind",
        F.when(F.col("value_kind") == "number", F.try_variant_get("v", "$", "double")).alias("number"), F.when(F.col("status_kind") == "text", F.try_variant_get("s", "$", "string")).alias("said"),
    )


def _observation_faults() -> list[Column]:
    number, said = F.col("number"), F.col("said")
    seen = F.coalesce(said.isin(*NUMERIC), F.lit(False))
    count = (number >= 0) & ~F.isnan(number) & (number != float("inf"))
    return [
        F.when(_no(F.col("exact")), "observation_members"), F.when(said.isNull(), "status_no_text"), F.when(seen & _no(count), "not_a_count"),
        F.when(seen & ((number == 0) & (said != NUMERIC[1]) | (number > 0) & (said == NUMERIC[1])), "zero_mismatch"),
        F.when(~seen & _no(said.isin(*MISSING)) & said.isNotNull(), "unknown_status"), F.when(~seen & _no(F.col("value_kind") == "null"), "value_with_missing_status"),
    ]


def read_submissions(payloads: DataFrame, cases: DataFrame, registry_sha256: str, relations: Sequence[str], split: str = "calibration") -> Submitted:
    """Parse ``payloads`` (submission, payload as JSON text) against ``cases`` (case_id, split).

    The payload: an object pinned to the registry's hash, with the run, the
    hash of the model, a contract of each metric (definition, unit, period,
    sources) and a list of predictions, each exactly a case and its metrics of
    ``relations``, each exactly a value and a status.  A payload that is no
    JSON, or repeats a name in an object, is ``no_object``.  A fault anywhere
    keeps all of a submission out.  Predictions are exploded before they are
    judged, so that the number of a submission's cases is not bound to one row;
    each is read once, and only what is said of a case moves.
    """
    # few bytes take long to parse, so their tasks are not to be as few as the bytes would make them
    dealt = payloads.repartition(4 * payloads.sparkSession.sparkContext.defaultParallelism, F.xxhash64("submission"))
    p = dealt.select("submission", F.try_parse_json("payload").alias("v"), F.ltrim("payload").startswith("{").alias("braced"))
    contracts, predictions = member(F.col("v"), "metric_contracts"), F.try_variant_get("v", "$.predictions", LIST)
    # the kind of the whole would be told from the types of all that is in it
    is_object = F.coalesce(F.col("v").isNotNull() & F.col("braced"), F.lit(False))
    head = _reasons(
        F.when(~is_object, "no_object"), F.when(is_object & _no(text(member(F.col("v"), "registry_sha256")) == registry_sha256), "registry_hash"),
        *[F.when(is_object & text(member(F.col("v"), k)).isNull(), k) for k in RUN],
        F.when(is_object & _no(text(member(F.col("v"), "model_artifact_sha256")).rlike("^[a-f0-9]{64}$")), "model_artifact_sha256"),
        *[F.when(is_object, fault) for fault in _contract_faults(contracts, relations)],
        F.when(is_object & predictions.isNull(), "predictions"),
    )
    heads = p.select("submission", F.lit(None).cast("string").alias("case_id"), head.alias("reasons"), F.lit(0).alias("rows"), F.lit(False).alias("row_object"))
    rows = p.select("submission", F.explode(predictions).alias("row"))
    rows = rows.select("submission", kind(F.col("row")).alias("row_kind"), member(F.col("row"), CASE).alias("case"), member(F.col("row"), METRICS).alias("metrics"), F.array_sort(F.map_keys(as_object(F.col("row")))).alias("names"))
    rows = rows.select(
        "submission", (F.col("row_kind") == "object").alias("row_object"), F.when(kind(F.col("case")) == "text", F.try_variant_get("case", "$", "string")).alias("case_id"),
        "names", as_object(F.col("metrics")).alias("metrics"),
    )
    row_object = F.coalesce("row_object", F.lit(False))
    of_case = _reasons(
        F.when(~row_object, "prediction_no_object"), F.when(row_object & _no(F.col("names") == F.array(*map(F.lit, sorted((CASE, METRICS))))), "prediction_members"),
        F.when(row_object & (F.col("metrics").isNull() | F.coalesce(F.exists(F.map_keys("metrics"), lambda m: ~m.isin(*relations)), F.lit(False))), "undeclared_metric"),
    )
    items = _observations(rows.select("submission", "case_id", row_object.alias("row_object"), of_case.alias("of_case"), F.posexplode_outer("metrics").alias("i", "relation", "item")))
    of_item = F.transform(_reasons(*_observation_faults()), lambda r: F.concat_ws(":", F.col("relation"), r))
    judged = items.select(
        "submission", "case_id", F.concat("of_case", F.when(F.col("relation").isNotNull(), of_item).otherwise(F.array().cast("array<string>"))).alias("reasons"),
        F.when(F.coalesce("i", F.lit(0)) == 0, 1).otherwise(0).alias("rows"), "row_object",
    )
    said = heads.unionByName(judged).groupBy("submission", "case_id").agg(F.collect_set(F.when(F.size("reasons") > 0, F.col("reasons"))).alias("told"), F.sum("rows").alias("rows"), F.max("row_object").alias("row_object"))
    j = said.join(cases.select("case_id", F.col("split").alias("__split")).distinct(), "case_id", "left")
    of_all = _reasons(F.when(F.col("row_object") & F.col("__split").isNull(), "unknown_case"), F.when(F.col("__split") != split, "held_out_case"), F.when(F.col("case_id").isNotNull() & (F.col("rows") > 1), "repeated"))
    told = j.select("submission", "case_id", F.array_distinct(F.concat(F.flatten("told"), of_all)).alias("reasons")).where(F.size("reasons") > 0)
    faults = told.select("submission", "case_id", F.array_join(F.array_sort("reasons"), "+").alias("reasons"))
    bad = told.select("submission").distinct()
    kept = items.where("relation is not null").join(bad, "submission", "left_anti").select("submission", "case_id", "relation", F.col("number").alias("value"), F.col("said").alias("status"))
    run = p.join(bad, "submission", "left_anti").select("submission", *[text(member(F.col("v"), k)).alias(k) for k in (*RUN, "model_artifact_sha256")])
    return Submitted(kept, faults, run)
