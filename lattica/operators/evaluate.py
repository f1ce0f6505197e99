"""Pairwise evaluation of predictions against adjudicated order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import NUMERIC


def calibration_packet(cases: DataFrame, pairs: DataFrame, split: str = "calibration") -> tuple[DataFrame, DataFrame]:
    """Cases of one split, and the pairs both of whose cases are in it; mixed pairs go whole."""
    allowed = cases.where(F.col("split") == split)
    ids = allowed.select("case_id")
    kept = pairs.join(ids.withColumnRenamed("case_id", "larger"), "larger", "left_semi").join(ids.withColumnRenamed("case_id", "smaller"), "smaller", "left_semi")
    return allowed.select("case_id", "split"), kept


def pair_status(pairs: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each pair's values and status; an absent prediction is kept as not evaluated.

    ``predictions``: case_id, relation, value, status.
    """

    def side(name):
        return predictions.select(F.col("case_id").alias(name), "relation", F.col("value").alias(f"{name}_value"), F.col("status").alias(f"{name}_status"))

    j = pairs.join(side("larger"), ["larger", "relation"], "left").join(side("smaller"), ["smaller", "relation"], "left")
    ok = F.col("larger_value").isNotNull() & F.col("smaller_value").isNotNull()
    absent = F.lit("prediction_or_metric_absent")
    return j.select(
        "pair_index", "relation", "larger", "smaller",
        F.when(~ok, "NOT_EVALUATED").when(F.col("larger_value") > F.col("smaller_value"), "PASS").otherwise("FAIL").alias("status"),
        "larger_value", "smaller_value",
        F.coalesce("larger_status", absent).alias("larger_status"), F.coalesce("smaller_status", absent).alias("smaller_status"),
    )


def pair_report(results: DataFrame, target: float) -> DataFrame:
    """One row: counts, pass rate over all pairs, and the verdict."""
    passed, failed, n = F.count_if(F.col("status") == "PASS"), F.count_if(F.col("status") == "FAIL"), F.count("*")
    r = results.agg(n.alias("required"), passed.alias("passed"), failed.alias("failed"), (n - passed - failed).alias("missing"))
    rate = F.col("passed") / F.nullif(F.col("required"), F.lit(0))
    verdict = F.when((F.col("required") == 0) | (F.col("missing") == F.col("required")), "NOT_EVALUATED").when(F.col("missing") > 0, "INCOMPLETE").when(rate >= target, "PASS").otherwise("FAIL")
    return r.select("required", (F.col("passed") + F.col("failed")).alias("evaluated"), "passed", "failed", "missing", rate.alias("pass_rate"), F.lit(target).alias("minimum_pass_rate"), verdict.alias("verdict"))


def payload_faults(predictions: DataFrame, cases: DataFrame, split: str = "calibration") -> DataFrame:
    """Predictions that must be refused: unknown or held-out case, repeated, or a value that its status denies."""
    known = cases.select("case_id", "split")
    j = predictions.join(known, "case_id", "left")
    again = predictions.groupBy("case_id", "relation").agg(F.count("*").alias("__n"))
    j = j.join(again, ["case_id", "relation"])
    v, s = F.col("value"), F.col("status")
    seen = s.isin(*NUMERIC)
    reasons = F.array_compact(F.array(
        F.when(F.col("split").isNull(), "unknown_case"),
        F.when(F.col("split") != split, "held_out_case"),
        F.when(F.col("__n") > 1, "repeated"),
        F.when(seen & (v.isNull() | F.isnan(v) | (v < 0) | (F.abs(v) == float("inf"))), "not_a_count"),
        F.when(seen & ((v == 0) != (s == "observed_zero")), "zero_mismatch"),
        F.when(~seen & v.isNotNull(), "value_with_missing_status"),
    ))
    return j.select("case_id", "relation", F.array_join(reasons, "+").alias("reasons")).where("reasons <> ''")
