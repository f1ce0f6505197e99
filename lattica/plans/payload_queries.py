"""Nested evidence merged with its types, and payloads of predictions parsed strictly, over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.variant import json_merge
from ..operators import identity, submission
from .carriers import query, read

RELATIONS = ("commercial_mass", "consumer_facing_mass")


def _evidence(o):
    return F.to_json(F.struct(
        F.col("o_orderstatus").alias("basis"), (F.col("o_custkey") % 3 == 0).alias("flag"), F.col("o_custkey").alias("n"),
        F.struct(F.col("o_orderkey").alias("a"), F.array(F.lit(1), F.lit(None).cast("int"), F.col("o_orderkey") % 7).alias("b")).alias("nested"),
    ))


_NESTED = """'"n":' || o_custkey || ',"nested":{"a":' || o_orderkey || ',"b":[1,null,' || (o_orderkey % 7) || ']}'"""
_FLAG = """'"flag":' || CASE WHEN o_custkey % 3 = 0 THEN 'true' ELSE 'false' END || ','"""


@query(f"""SELECT o_orderkey AS review_id, CASE WHEN o_custkey % 2 = 0 THEN 'resolved' ELSE 'open' END AS status, CASE WHEN o_custkey % 2 = 0 THEN '2026-01-01' END AS resolved_at, CASE WHEN o_custkey % 2 = 0 THEN 'note ' || o_custkey END AS resolution_note,
  CASE WHEN o_custkey % 2 = 0 THEN '{{"adjudication":{{"decision":"confirm","priority":' || (o_custkey % 9) || ',"resolution_note":"note ' || o_custkey || '","source_key":"' || o_custkey || '","target_hub_key":"h' || (o_custkey % 40) || '"}},' ELSE '{{' END
    || '"basis":"' || o_orderstatus || '",' || {_FLAG} || {_NESTED} || CASE WHEN o_custkey % 2 = 0 AND o_custkey % 40 < 30 THEN ',"resolved_hub_id":"hub_' || (o_custkey % 40) || '"' ELSE '' END || '}}' AS evidence_json FROM orders""")
def review_resolution_whole(spark, d):
    """The whole decision becomes part of the evidence, with the id of the hub that it settles on."""
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    none = F.lit(None).cast("string")
    queue = o.select(F.col("o_orderkey").alias("review_id"), F.col("o_custkey").cast("string").alias("source_key"), F.lit("open").alias("status"), none.alias("resolved_at"), none.alias("resolution_note"), _evidence(o).alias("evidence_json"))
    k = F.col("c_custkey")
    dec = read(spark, d, "customer", "c_custkey").where("c_custkey % 2 = 0").select(
        k.cast("string").alias("source_key"), F.lit("confirm").alias("decision"), F.concat(F.lit("note "), k).alias("resolution_note"), F.concat(F.lit("h"), k % 40).alias("target_hub_key"), (k % 9).alias("priority"),
    )
    hubs = spark.range(30).select(F.concat(F.lit("h"), "id").alias("hub_key"), F.concat(F.lit("hub_"), "id").alias("hub_id"))
    return identity.resolve_reviews(queue, dec, "2026-01-01", hubs).drop("source_key")


@query("""SELECT o_orderkey, '{"basis":{"a":' || o_custkey || ',"s":"' || o_orderstatus || '"},"flag":' || CASE WHEN o_orderkey % 2 = 0 THEN 'null' ELSE 'true' END || ',"list":[' || (o_orderkey % 5) || '],"n":' || o_orderkey || '}' AS merged FROM orders""")
def evidence_merged(spark, d):
    """Objects merge member by member; a list and a JSON null stand for themselves."""
    k = F.col("o_orderkey")
    left = F.to_json(F.struct(F.struct(F.col("o_custkey").alias("a"), F.lit("old").alias("s")).alias("basis"), F.lit(True).alias("flag"), F.array(F.lit(9), F.lit(9)).alias("list"), k.alias("n")))
    right = F.concat(F.lit('{"basis":{"s":"'), F.col("o_orderstatus"), F.lit('"},"list":['), k % 5, F.lit("]"), F.when(k % 2 == 0, ',"flag":null').otherwise(""), F.lit("}"))
    return read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus").select("o_orderkey", json_merge(left, right, depth=2).alias("merged"))


_ROWS_SQL = """one AS (SELECT l_suppkey AS s, l_partkey AS k, CAST(min(l_quantity) AS DOUBLE) AS q, count(*) AS n FROM lineitem WHERE l_suppkey % 3 <> 0 OR l_partkey <= 100 AND l_partkey % 97 <> 0 GROUP BY ALL),
obs AS (SELECT s, k, n, CASE WHEN s % 3 <> 0 AND k % 13 = 0 THEN 'consumer_mass' ELSE 'commercial_mass' END AS relation, CASE WHEN k % 4 = 0 THEN 'observed' WHEN k % 4 = 1 THEN 'observed_zero' WHEN k % 4 = 2 THEN 'suppressed' WHEN s % 3 = 0 THEN 'not_public' ELSE 'guessed' END AS status,
  CASE WHEN k % 4 = 0 THEN CASE WHEN s % 3 <> 0 AND k % 11 = 0 THEN 0.0 ELSE q END WHEN k % 4 = 1 THEN 0.0 END AS value FROM one)"""


def _submitted(spark, d):
    s, k = F.col("s"), F.col("k")
    li = read(spark, d, "lineitem", "l_suppkey", "l_partkey", "l_quantity").where("l_suppkey % 3 <> 0 or l_partkey <= 100 and l_partkey % 97 <> 0")
    one = li.groupBy(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("k")).agg(F.min("l_quantity").cast("double").alias("q"), F.count("*").alias("n"))
    clean = s % 3 == 0
    status = F.when(k % 4 == 0, "observed").when(k % 4 == 1, "observed_zero").when(k % 4 == 2, "suppressed").when(clean, "not_public").otherwise("guessed")
    value = F.when(k % 4 == 0, F.when(~clean & (k % 11 == 0), 0.0).otherwise(F.col("q"))).when(k % 4 == 1, 0.0)
    relation = F.when(~clean & (k % 13 == 0), "consumer_mass").otherwise("commercial_mass")
    case = F.concat(F.lit("GE"), k)
    row = F.to_json(F.struct(case.alias("golden_eval_id"), F.map_from_arrays(F.array(relation), F.array(F.struct(value.alias("value"), status.alias("status")))).alias("metrics")), {"ignoreNullFields": "false"})
    # a part that a supplier delivers often is submitted twice
    rows = one.select("s", F.explode(F.array_repeat(row, F.when(~clean & (F.col("n") > 2), 2).otherwise(1))).alias("row")).groupBy("s").agg(F.concat_ws(",", F.array_sort(F.collect_list("row"))).alias("rows"))
    contract = F.lit('{"definition":"d","unit":"count","reference_period":"2026","source_refs":["x"]}')
    half = F.when(~clean & (s % 7 == 2), '{"definition":" ","unit":"count","reference_period":"2026","source_refs":[]}').otherwise(contract)
    quoted = lambda name, v: F.concat(F.lit(f'"{name}":"'), v, F.lit('",'))
    payload = F.concat(
        F.lit("{"), quoted("registry_sha256", F.when(~clean & (s % 7 == 1), "0").otherwise("f" * 64)), quoted("model_run_id", F.when(~clean & (s % 5 == 2), " ").otherwise("run")), quoted("model_version", F.lit("1")), quoted("model_artifact_sha256", F.lit("a" * 64)),
        F.lit('"metric_contracts":{"commercial_mass":'), contract, F.lit(',"consumer_facing_mass":'), half, F.lit('},"predictions":['), "rows", F.when(~clean & (s % 10 == 4), "").otherwise("]}"),
    )
    cases = read(spark, d, "customer", "c_custkey").select(F.concat(F.lit("GE"), "c_custkey").alias("case_id"), F.when(F.col("c_custkey") % 97 == 0, "holdout").otherwise("calibration").alias("split"))
    return submission.read_submissions(rows.select(s.alias("submission"), payload.alias("payload")), cases, "f" * 64, RELATIONS)


@query(f"""WITH {_ROWS_SQL}, cut AS (SELECT DISTINCT s FROM one WHERE s % 3 <> 0 AND s % 10 = 4), whole AS (SELECT * FROM obs WHERE s NOT IN (SELECT s FROM cut)),
r AS (SELECT s, NULL AS case_id, 'no_object' AS reason FROM cut
  UNION ALL SELECT DISTINCT s, NULL, 'registry_hash' FROM whole WHERE s % 3 <> 0 AND s % 7 = 1 UNION ALL SELECT DISTINCT s, NULL, 'model_run_id' FROM whole WHERE s % 3 <> 0 AND s % 5 = 2
  UNION ALL SELECT DISTINCT s, NULL, unnest(['contract_consumer_facing_mass_definition', 'contract_consumer_facing_mass_source_refs']) FROM whole WHERE s % 3 <> 0 AND s % 7 = 2
  UNION ALL SELECT s, 'GE' || k, 'unknown_case' FROM whole WHERE k NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT s, 'GE' || k, 'held_out_case' FROM whole WHERE k % 97 = 0 AND k IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT s, 'GE' || k, 'repeated' FROM whole WHERE s % 3 <> 0 AND n > 2 UNION ALL SELECT s, 'GE' || k, 'undeclared_metric' FROM whole WHERE relation = 'consumer_mass'
  UNION ALL SELECT s, 'GE' || k, relation || ':unknown_status' FROM whole WHERE status = 'guessed' UNION ALL SELECT s, 'GE' || k, relation || ':zero_mismatch' FROM whole WHERE status = 'observed' AND value = 0)
SELECT s AS submission, case_id, string_agg(DISTINCT reason, '+' ORDER BY reason) AS reasons FROM r GROUP BY ALL""")
def submission_faults(spark, d):
    return _submitted(spark, d).faults


@query(f"WITH {_ROWS_SQL} SELECT s AS submission, 'GE' || k AS case_id, relation, value, status FROM obs WHERE s % 3 = 0")
def submission_predictions(spark, d):
    return _submitted(spark, d).predictions
