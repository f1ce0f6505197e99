"""Tokens, triplets, components and gates over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tokens
from ..functions.text import composite_key, joined_set, sorted_json
from ..operators import components as comp
from ..operators import constraints, ranking
from .carriers import COMPONENTS_SQL, components, query, read, status_sql, token, token_sql, value_sql

T = token_sql("o_orderkey")


def _flat(df, key, obs="o"):
    return df.select(key, F.col(f"{obs}.raw").alias("raw"), F.col(f"{obs}.value").cast("long").alias("value"), F.col(f"{obs}.status").alias("status"))


@query(f"SELECT o_orderkey, t AS raw, {value_sql('t')} AS value, {status_sql('t')} AS status FROM (SELECT o_orderkey, {T} AS t FROM orders)")
def estat_token_status(spark, d):
    rows = read(spark, d, "orders", "o_orderkey").withColumn("t", token(F.col("o_orderkey")))
    return _flat(rows.withColumn("o", tokens.estat_count(F.col("t"))), "o_orderkey")


@query(f"""
SELECT o_orderkey, t AS raw, CASE WHEN s IN ('observed', 'observed_zero') THEN {value_sql('t')} END AS value, s AS status FROM (
  SELECT *, CASE WHEN e = 4 OR p = 3 THEN 'station_absent' WHEN e = 3 THEN 'not_public' WHEN e = 2 THEN 'source_absent' WHEN p = 2 THEN 'duplicate_on_other_record' ELSE {status_sql('t')} END AS s
  FROM (SELECT o_orderkey, {T} AS t, 1 + o_orderkey % 4 AS e, 1 + o_orderkey % 3 AS p FROM orders))""")
def s12_precedence(spark, d):
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders", "o_orderkey").select("o_orderkey", token(k).alias("t"), (1 + k % 4).cast("string").alias("e"), (1 + k % 3).cast("string").alias("p"))
    return _flat(rows.withColumn("o", tokens.s12_count(F.col("t"), F.col("e"), F.col("p"))), "o_orderkey")


@query(f"""
SELECT o_orderkey, code, t AS raw, CASE WHEN code <> '2' THEN {value_sql('t')} END AS value,
  CASE WHEN code = '2' THEN 'suppressed' WHEN code = '1' THEN 'aggregation_destination' ELSE {status_sql('t')} END AS status
FROM (SELECT *, CASE WHEN n IS NULL THEN CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE '2' END ELSE CAST(o_orderkey % 3 AS VARCHAR) END AS code
  FROM (SELECT o_orderkey, {T} AS t, TRY_CAST({T} AS BIGINT) AS n FROM orders))""")
def census_suppression(spark, d):
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders", "o_orderkey").withColumn("t", token(k))
    code = F.when(F.col("t").try_cast("bigint").isNull(), F.when(k % 2 == 0, "0").otherwise("2")).otherwise((k % 3).cast("string"))
    rows = rows.withColumn("code", code).withColumn("o", tokens.census_count(F.col("t"), F.col("code")))
    return rows.select("o_orderkey", "code", F.col("o.raw").alias("raw"), F.col("o.value").cast("long").alias("value"), F.col("o.status").alias("status"))


@query("""
SELECT code, status, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT o_orderkey % 3 AS code, CASE o_orderkey % 3 WHEN 0 THEN 'observed' WHEN 1 THEN 'aggregation_destination' ELSE 'suppressed' END AS status
  FROM orders WHERE o_orderkey % 97 <> 0) GROUP BY 1, 2""")
def processing_code_map(spark, d):
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders", "o_orderkey").where(k % 97 != 0).select((k % 3).alias("code"), tokens.census_count((k % 97).cast("string"), (k % 3).cast("string"))["status"].alias("status"))
    return rows.groupBy("code", "status").agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey, raw, unit, CASE WHEN status IN ('observed', 'below_rounding_unit') THEN TRY_CAST(raw AS BIGINT) END AS value, status FROM (
  SELECT *, CASE WHEN raw IS NULL OR raw = '' THEN 'not_reported' WHEN raw IN ('x', 'X') THEN 'suppressed' WHEN raw = '-' THEN 'not_applicable' WHEN TRY_CAST(raw AS BIGINT) = 0 AND unit = '百万円' THEN 'below_rounding_unit' ELSE 'observed' END AS status
  FROM (SELECT p_partkey, CASE p_partkey % 11 WHEN 0 THEN 'x' WHEN 1 THEN '-' WHEN 2 THEN '' WHEN 3 THEN '0' WHEN 4 THEN NULL WHEN 5 THEN 'X' ELSE CAST(p_size AS VARCHAR) END AS raw, CASE p_partkey % 2 WHEN 0 THEN '百万円' ELSE '人' END AS unit FROM part))""")
def district_token_status(spark, d):
    k = F.col("p_partkey")
    raw = F.when(k % 11 == 0, "x").when(k % 11 == 1, "-").when(k % 11 == 2, "").when(k % 11 == 3, "0").when(k % 11 == 4, F.lit(None)).when(k % 11 == 5, "X").otherwise(F.col("p_size").cast("string"))
    rows = read(spark, d, "part", "p_partkey", "p_size").select("p_partkey", raw.alias("t"), F.when(k % 2 == 0, "百万円").otherwise("人").alias("unit"))
    rows = rows.withColumn("o", tokens.district_cell(F.col("t"), F.col("unit")))
    return rows.select("p_partkey", F.col("o.raw").alias("raw"), "unit", F.col("o.value").cast("long").alias("value"), F.col("o.status").alias("status"))


@query("""
SELECT p_partkey, raw, CASE WHEN regexp_full_match(raw, '[0-9,]+') THEN CAST(replace(raw, ',', '') AS BIGINT) END AS value,
  CASE WHEN regexp_full_match(raw, '[0-9,]+') THEN 'observed' ELSE 'symbol_unresolved' END AS status
FROM (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '-' WHEN 1 THEN '1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') WHEN 2 THEN p_brand ELSE CAST(p_partkey AS VARCHAR) END AS raw FROM part)""")
def cafe_token_status(spark, d):
    k = F.col("p_partkey")
    raw = F.when(k % 7 == 0, "-").when(k % 7 == 1, F.concat(F.lit("1,"), F.lpad(F.col("p_size").cast("string"), 3, "0"))).when(k % 7 == 2, F.col("p_brand")).otherwise(k.cast("string"))
    return _flat(read(spark, d, "part", "p_partkey", "p_size", "p_brand").select("p_partkey", tokens.plain_or_symbol(raw).alias("o")), "p_partkey")


_METRICS = {"economic": 1, "population": 7, "students": 13}
_LONG = " UNION ALL ".join(f"SELECT '{m}' AS metric, {token_sql(f'l_orderkey * {f} + l_linenumber')} AS t FROM lineitem" for m, f in _METRICS.items())


@query(f"SELECT metric, {status_sql('t')} AS status, CAST(count(*) AS BIGINT) AS rows, CAST(sum({value_sql('t')}) AS BIGINT) AS value_sum FROM ({_LONG}) GROUP BY 1, 2")
def metric_status_histogram(spark, d):
    rows = read(spark, d, "lineitem", "l_orderkey", "l_linenumber")
    items = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), token(F.col("l_orderkey") * f + F.col("l_linenumber")).alias("raw")) for m, f in _METRICS.items()]))
    flat = rows.select(items.alias("i")).select("i.metric", tokens.estat_count(F.col("i.raw")).alias("o"))
    flat = flat.select("metric", F.col("o.status").alias("status"), F.col("o.value").alias("value"))
    return comp.status_histogram(flat, "metric", "status", "value").withColumn("value_sum", F.col("value_sum").cast("long"))


def _observed(spark, d):
    c = components(spark, d).withColumn("o", tokens.estat_count(F.col("raw")))
    return c.select("mesh", "partition", "k", "raw", F.col("o.value").cast("long").alias("value"), F.col("o.status").alias("status"))


@query(f"""WITH {COMPONENTS_SQL} SELECT mesh, partition, k, CAST(count(*) OVER w AS BIGINT) AS component_count,
  (SELECT string_agg(DISTINCT CAST(x.partition AS VARCHAR), ',' ORDER BY CAST(x.partition AS VARCHAR)) FROM obs x WHERE x.mesh = obs.mesh) AS partitions,
  count(*) OVER w > 1 AS needs_rollup, false AS cell_faulty FROM obs WINDOW w AS (PARTITION BY mesh)""")
def component_overlap(spark, d):
    a = comp.annotate_overlap(_observed(spark, d), "mesh", "partition")
    return a.select("mesh", "partition", "k", "component_count", F.array_join(F.col("partition_codes").cast("array<string>"), ",").alias("partitions"), "needs_rollup", "cell_faulty")


@query(f"""WITH {COMPONENTS_SQL}, cells AS (SELECT mesh, count(*) AS n FROM obs GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS component_rows, CAST(count(*) AS BIGINT) AS cells, CAST(count(*) FILTER (n > 1) AS BIGINT) AS cross_cells, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS cross_rows FROM cells""")
def component_overlap_summary(spark, d):
    return comp.overlap_summary(_observed(spark, d), "mesh")


_CC = """SELECT mesh, CASE WHEN count(*) FILTER (status IN ('observed', 'observed_zero')) = count(*) THEN CAST(sum(value) AS BIGINT) END AS total,
  count(*) FILTER (status IN ('observed', 'observed_zero')) = count(*) AS complete,
  CAST(count(*) FILTER (status IN ('observed', 'observed_zero')) AS BIGINT) AS observed, CAST(count(*) AS BIGINT) AS expected,
  coalesce(string_agg(partition || ':' || status, ',' ORDER BY partition || ':' || status) FILTER (status NOT IN ('observed', 'observed_zero')), '') AS missing
  FROM obs GROUP BY mesh"""


@query(f"WITH {COMPONENTS_SQL}, cc AS ({_CC}) SELECT *, CASE WHEN total IS NOT NULL THEN CAST(rank() OVER (ORDER BY total DESC NULLS LAST) AS INTEGER) END AS rank FROM cc")
def component_complete_case_ranked(spark, d):
    sums = comp.complete_case(_observed(spark, d), ["mesh"], "value", "status", "partition").drop("has_rounding")
    return ranking.competition_rank(sums, "total")


_LATTICE = f"""WITH {COMPONENTS_SQL}, lattice AS (SELECT c_custkey AS mesh, CAST(p AS INTEGER) AS partition FROM customer, range(11, 15) r(p) WHERE c_custkey % 3 = 0),
rows AS (SELECT l.mesh, l.partition, o.value, coalesce(o.status, 'source_absent') AS status, coalesce(o.k, 4611686018427387904) AS pos FROM lattice l LEFT JOIN obs o USING (mesh, partition)),
gap AS (SELECT DISTINCT c_custkey AS mesh FROM customer WHERE c_custkey % 30 = 0)"""


@query(f"""{_LATTICE}, sums AS (SELECT mesh,
  CAST(count(*) FILTER (partition < 13) AS BIGINT) AS display_members, CAST(sum(value) FILTER (partition < 13) AS BIGINT) AS ds,
  count(*) FILTER (partition < 13 AND status NOT IN ('observed', 'observed_zero')) AS db, arg_min(status, row(pos, partition, status)) FILTER (partition < 13 AND status NOT IN ('observed', 'observed_zero')) AS df,
  CAST(count(*) AS BIGINT) AS analysis_members, CAST(sum(value) AS BIGINT) AS asum,
  count(*) FILTER (status NOT IN ('observed', 'observed_zero')) AS ab, arg_min(status, row(pos, partition, status)) FILTER (status NOT IN ('observed', 'observed_zero')) AS af
  FROM rows GROUP BY mesh)
SELECT mesh, display_members, CASE WHEN db = 0 THEN ds END AS display_sum, CASE WHEN db = 0 THEN 'complete' ELSE 'contains_' || df END AS display_status,
  analysis_members, CASE WHEN ab = 0 AND g.mesh IS NULL THEN asum END AS analysis_sum, CASE WHEN g.mesh IS NOT NULL THEN 'partition_coverage_incomplete' WHEN ab = 0 THEN 'complete' ELSE 'contains_' || af END AS analysis_status
FROM sums LEFT JOIN gap g USING (mesh)""")
def scope_rollup_native(spark, d):
    cells = read(spark, d, "customer", "c_custkey").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("mesh"), F.explode(F.sequence(F.lit(11), F.lit(14))).alias("partition"))
    expected = read(spark, d, "customer", "c_custkey").where("c_custkey % 30 = 0").select(F.col("c_custkey").alias("mesh"), F.lit(20).alias("partition"))
    return comp.roll_up(cells, _observed(spark, d), "mesh", "partition", "value", "status", "k", [11, 12], expected, [11, 12, 13, 14])


@query(f"""WITH {COMPONENTS_SQL} SELECT mesh, string_agg(DISTINCT status, '+' ORDER BY status) AS statuses, '[' || string_agg(DISTINCT partition::VARCHAR, ',' ORDER BY partition::VARCHAR) || ']' AS partitions_json,
  coalesce(string_agg(DISTINCT partition::VARCHAR, ',' ORDER BY partition::VARCHAR) FILTER (partition > 12), '') AS outside FROM obs GROUP BY mesh""")
def mesh_context(spark, d):
    rows = _observed(spark, d)
    return rows.groupBy("mesh").agg(joined_set(F.col("status")).alias("statuses"), sorted_json(F.col("partition")).alias("partitions_json"), joined_set(F.when(F.col("partition") > 12, F.col("partition").cast("string")), sep=",").alias("outside"))


_F = f"WITH {COMPONENTS_SQL}, fam AS (SELECT 'economic' AS family, mesh, partition, value, status FROM obs UNION ALL SELECT 'population', mesh, partition, value, status FROM obs WHERE k % 2 = 0)"


@query(f"""{_F} SELECT mesh AS cell, CAST(count(*) FILTER (partition < 13) AS INTEGER) AS shown_components, CAST(count(DISTINCT partition) AS INTEGER) AS codes,
  CAST(count(DISTINCT partition) FILTER (partition >= 13) AS INTEGER) AS outside, coalesce(bool_or(partition < 13 AND status IN ('observed', 'observed_zero')), false) AS available, count(DISTINCT partition) > 1 AS needs_rollup FROM fam GROUP BY mesh""")
def context_families(spark, d):
    rows = _observed(spark, d)
    c = comp.context_assembly({"economic": rows, "population": rows.where("k % 2 = 0")}, "mesh", "partition", "value", "status", [11, 12])
    return c.select("cell", F.size("components").alias("shown_components"), F.size("partition_codes").alias("codes"), F.size("outside_codes").alias("outside"), "available", "needs_rollup")


_BAD = "CASE WHEN o_orderkey % 101 = 0 THEN 'observed' WHEN o_orderkey % 103 = 0 THEN 'typo' WHEN o_orderkey % 107 = 0 THEN 'observed_zero' ELSE {s} END"


@query(f"""SELECT o_orderkey, reasons FROM (SELECT o_orderkey, array_to_string(list_filter([
    CASE WHEN s = 'typo' THEN 'unknown_status' END, CASE WHEN s = 'observed' AND coalesce(v, 0) <= 0 THEN 'observed_needs_positive' END,
    CASE WHEN s = 'observed_zero' AND (v IS NULL OR v <> 0) THEN 'zero_needs_zero' END, CASE WHEN s = 'observed_zero' AND (v IS NULL OR v <> 0) THEN 'zero_needs_zero_token' END,
    CASE WHEN s IN ('suppressed', 'not_surveyed', 'not_applicable', 'source_absent') AND v IS NOT NULL THEN 'value_with_missing_status' END], lambda x: x IS NOT NULL), '+') AS reasons
  FROM (SELECT o_orderkey, t, {value_sql('t')} AS v, {_BAD.format(s=status_sql('t'))} AS s FROM (SELECT o_orderkey, {T} AS t FROM orders))) WHERE reasons <> ''""")
def observation_gate(spark, d):
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders", "o_orderkey").select("o_orderkey", tokens.estat_count(token(k)).alias("o"))
    status = F.when(k % 101 == 0, "observed").when(k % 103 == 0, "typo").when(k % 107 == 0, "observed_zero").otherwise(F.col("o.status"))
    rows = rows.select("o_orderkey", F.col("o.raw").alias("raw"), F.col("o.value").alias("value"), status.alias("status"))
    return constraints.violations(rows, constraints.observation_faults(F.col("raw"), F.col("value"), F.col("status")), "o_orderkey")


@query(f"""SELECT o_orderkey, coalesce(o_orderpriority, '') || '|' || coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END, '') || '|' || CAST(o_custkey AS VARCHAR) AS source_key,
  {status_sql('t')} IN ('observed', 'observed_zero') AS available, CASE {status_sql('t')} WHEN 'suppressed' THEN 'withheld by the source' WHEN 'not_surveyed' THEN 'not surveyed' WHEN 'not_applicable' THEN 'not applicable' WHEN 'source_absent' THEN 'no source row' END AS reason
FROM (SELECT *, {T} AS t FROM orders)""")
def keyed_reasons(spark, d):
    k = F.col("o_orderkey")
    status = tokens.estat_count(token(k))["status"]
    key = composite_key(F.col("o_orderpriority"), F.when(k % 5 != 0, F.col("o_orderstatus")), F.col("o_custkey"))
    return read(spark, d, "orders").select("o_orderkey", key.alias("source_key"), status.isin("observed", "observed_zero").alias("available"), tokens.missing_reason(status).alias("reason"))
