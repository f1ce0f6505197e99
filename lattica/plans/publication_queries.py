"""Gates before publication, over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import components, corridor_build, publication, ranking
from .carriers import EDGES_SQL, INSIDE_SQL, POLYGON, lat, lat_sql, lon, lon_sql, query, read

_IDENTITY_SQL = f"""{EDGES_SQL}, r AS (SELECT c_custkey, {lon_sql('c_custkey')} AS lon, {lat_sql('c_custkey')} AS lat, c_custkey % 29 = 0 AS twice, c_custkey % 31 = 0 OR c_custkey % 37 = 0 OR c_custkey % 41 = 0 AS lacks, c_custkey % 9 = 0 AS before FROM customer),
o AS (SELECT c_custkey, CASE WHEN {INSIDE_SQL} THEN 'candidate' WHEN before THEN 'retained' END AS origin, twice, lacks FROM r)"""


def _identities(spark, d):
    k = F.col("c_custkey")
    r = read(spark, d, "customer", "c_custkey", "c_name").select(
        "c_custkey", lon(k).alias("lon"), lat(k).alias("lat"), F.when(k % 29 == 0, F.array("c_name", F.lit("other"))).otherwise(F.array("c_name")).alias("names"),
        F.when(k % 31 == 0, "").when(k % 37 != 0, F.col("c_name")).alias("name"), F.concat(F.when(k % 41 == 0, "MISSING_").otherwise("S"), k).alias("code"),
    )
    told = publication.identity_reasons(r, ["names"], ["name"], "code")
    return publication.publishable(told, geo.inside(F.col("lon"), F.col("lat"), POLYGON), r.where("c_custkey % 9 = 0"), "c_custkey")


@query(f"WITH {_IDENTITY_SQL} SELECT c_custkey, origin FROM o WHERE origin IS NOT NULL AND NOT twice AND NOT lacks")
def network_publishable(spark, d):
    return _identities(spark, d)[0].select("c_custkey", "origin")


@query(f"WITH {_IDENTITY_SQL} SELECT c_custkey, concat_ws('+', CASE WHEN twice THEN 'ambiguous_source_identity' END, CASE WHEN lacks THEN 'missing_identity_attribute' END) AS reasons FROM o WHERE origin IS NOT NULL AND (twice OR lacks)")
def network_unresolved(spark, d):
    return _identities(spark, d)[1]


def _hubs(spark, d):
    k = F.col("s_suppkey")
    links = read(spark, d, "supplier", "s_suppkey")
    links = links.select((k % 90).alias("station_group_id"), F.concat(F.lit("h"), F.when(k % 45 == 0, k).otherwise(k % 90).cast("string")).alias("hub_id"))
    rows = read(spark, d, "customer", "c_custkey").select("c_custkey", (F.col("c_custkey") % 120).alias("station_group_id"))
    return publication.attach_hubs(rows, links)


_HUBS_SQL = """l AS (SELECT s_suppkey % 90 AS g, 'h' || CASE WHEN s_suppkey % 45 = 0 THEN s_suppkey ELSE s_suppkey % 90 END AS h FROM supplier), t AS (SELECT g, min(h) AS h, count(DISTINCT h) AS hubs FROM l GROUP BY 1)"""


@query(f"WITH {_HUBS_SQL} SELECT c_custkey, c_custkey % 120 AS station_group_id, h AS hub_id FROM customer LEFT JOIN t ON g = c_custkey % 120 AND hubs = 1")
def hubs_attached(spark, d):
    return _hubs(spark, d)[0]


@query(f"WITH {_HUBS_SQL} SELECT g AS station_group_id, hubs FROM t WHERE hubs > 1")
def groups_of_several_hubs(spark, d):
    return _hubs(spark, d)[1]


def _context(spark, d):
    k = F.col("p_partkey")
    items = read(spark, d, "part", "p_partkey").select(k.alias("item"), (k % 140).alias("source_id"), F.when(k % 19 != 0, k % 17 != 0).alias("approved"), F.when(k % 5 == 0, "symbol_unresolved").when(k % 7 != 0, "observed").alias("status"))
    return publication.approved_context(items, read(spark, d, "supplier", F.col("s_suppkey").alias("source_id")), "source_id", "approved", "status")


_CONTEXT_SQL = "c AS (SELECT p_partkey AS item, p_partkey % 140 AS source_id, p_partkey % 17 = 0 OR p_partkey % 19 = 0 AS bad, p_partkey % 140 NOT IN (SELECT s_suppkey FROM supplier) AS lost FROM part)"


@query(f"WITH {_CONTEXT_SQL} SELECT item, source_id FROM c WHERE NOT bad AND NOT lost AND item % 5 <> 0")
def context_approved(spark, d):
    return _context(spark, d)[0].select("item", "source_id")


@query(f"WITH {_CONTEXT_SQL} SELECT item, concat_ws('+', CASE WHEN bad THEN 'not_approved' END, CASE WHEN lost THEN 'source_missing' END) AS reasons FROM c WHERE bad OR lost")
def context_refused(spark, d):
    return _context(spark, d)[1]


@query("SELECT o_orderkey AS assertion_id, count(DISTINCT l_partkey) AS cases FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1 HAVING bool_and(l_partkey % 13 <> 0)")
def structural_assertions_kept(spark, d):
    a = read(spark, d, "lineitem", "l_orderkey", "l_partkey").groupBy(F.col("l_orderkey").alias("assertion_id")).agg(F.collect_set("l_partkey").alias("cases"))
    allowed = read(spark, d, "part", F.col("p_partkey").alias("case_id")).where("case_id % 13 <> 0")
    return publication.kept_assertions(a, allowed).select("assertion_id", F.size("cases").cast("long").alias("cases"))


@query("SELECT l_orderkey, l_linenumber, s_suppkey, s_nationkey FROM lineitem JOIN supplier ON s_nationkey = l_suppkey % 30 WHERE l_linenumber = 1")
def feature_fanned_out(spark, d):
    f = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey").where("l_linenumber = 1").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 30).cast("int").alias("s_nationkey"))
    return publication.feature_fan_out(f, read(spark, d, "supplier", "s_suppkey", "s_nationkey"), "s_nationkey")[0]


@query("""SELECT o_custkey % 25 AS corridor, o_orderkey AS key, concat_ws('+', CASE WHEN o_orderkey % 10 = 0 THEN 'not_in_pool' END, CASE WHEN o_orderpriority LIKE '1%' AND o_custkey % 25 > 3 AND o_orderkey % 6 <> 0 THEN 'filter_misses' END) AS reasons
FROM orders WHERE reasons <> ''""")
def corridor_screen_faults(spark, d):
    k = F.col("key")
    chain = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority").select((F.col("o_custkey") % 25).alias("corridor"), F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("route"))
    filters = chain.where("route not like '1%' or corridor <= 3").select("corridor", "route")
    return publication.screen_faults(chain, chain.where(k % 10 != 0), filters, "corridor", "key", ["corridor", "route"], k % 6 == 0)


_MESH_SQL = """m AS (SELECT o_orderkey AS observation_id, CASE WHEN o_custkey % 53 = 0 THEN 'x' ELSE '' END || lpad(CAST(o_custkey AS VARCHAR), 9, '5') AS mesh, lpad(CAST(8 + o_orderkey % 9 AS VARCHAR), 2, '0') AS part,
    o_orderkey % 59 = 0 AS raw_bad, o_orderkey % 61 = 0 AS key_bad, o_orderkey % 67 = 0 AS geo_bad, o_orderkey % 71 = 0 AS roll_bad, o_orderkey % 73 = 0 AS period_bad, o_orderkey % 79 = 0 AS pub_bad, o_orderkey % 83 = 0 AS count_bad, o_orderkey % 89 = 0 AS codes_bad, o_orderkey % 97 = 0 AS value_bad FROM orders),
c AS (SELECT mesh, count(*) AS n, count(DISTINCT part) AS p FROM m GROUP BY 1)"""


@query(f"""WITH {_MESH_SQL} SELECT observation_id, mesh, part AS partition, concat_ws('+', CASE WHEN NOT regexp_full_match(mesh, '[0-9]{{9}}') THEN 'mesh_key' END, CASE WHEN part IN ('15', '16') THEN 'partition' END, CASE WHEN raw_bad THEN 'raw_key' END, CASE WHEN key_bad THEN 'record_key' END,
  CASE WHEN geo_bad THEN 'geometry_status' END, CASE WHEN roll_bad THEN 'rollup_status' END, CASE WHEN period_bad THEN 'reference_period' END, CASE WHEN pub_bad THEN 'published_at' END, CASE WHEN count_bad THEN 'partition_count' END, CASE WHEN codes_bad THEN 'partition_codes' END,
  CASE WHEN p < n THEN 'partition_twice' END, CASE WHEN value_bad THEN 'employees:observed_needs_positive' END) AS reasons FROM m JOIN c USING (mesh) WHERE reasons <> ''""")
def mesh_component_faults(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    m = read(spark, d, "orders", "o_orderkey", "o_custkey").select(
        k.alias("observation_id"), F.concat(F.when(c % 53 == 0, "x").otherwise(""), F.lpad(c.cast("string"), 9, "5")).alias("mesh"), F.lpad((8 + k % 9).cast("string"), 2, "0").alias("partition"),
    )
    cells = m.groupBy("mesh").agg(F.count("*").alias("n"), F.to_json(F.array_sort(F.collect_set("partition"))).alias("codes"))
    o = F.col("observation_id")
    bad = lambda by, wrong, right: F.when(o % by == 0, wrong).otherwise(right)
    rows = m.join(cells, "mesh").select(
        "observation_id", "mesh", "partition", bad(59, "other", F.col("mesh")).alias("raw_key"), bad(61, None, F.concat_ws(":", F.lit("census"), "partition", "mesh")).alias("record_key"), bad(67, "clipped", publication.GEOMETRY).alias("geometry_status"),
        bad(71, "unknown", F.when(F.col("n") > 1, publication.SEVERAL).otherwise(publication.SINGLE)).alias("rollup_status"), bad(73, "", "2021").alias("reference_period"), bad(79, None, "2022").alias("published_at"),
        (F.col("n") + bad(83, 1, F.lit(0))).alias("partition_count"), bad(89, "[]", F.col("codes")).alias("partition_codes"), F.lit("5").alias("raw"), bad(97, -0.0, F.lit(5.0)).alias("value"), F.lit("observed").alias("status"),
    )
    return publication.mesh_component_faults(rows, "census", ["08", "09", "10", "11", "12", "13", "14", "19", "22"], {"employees": ("raw", "value", "status")})


@query("""WITH p AS (SELECT c_custkey AS k, unnest(['a', 'b', 'c']) AS metric, unnest([c_custkey % 11, c_custkey % 7, c_custkey % 5]) AS v FROM customer)
SELECT k, CASE WHEN bool_and(v > 0) THEN CAST(sum(v) AS BIGINT) END AS total, count(*) FILTER (v > 0) AS observed, count(*) AS expected FROM p GROUP BY 1""")
def three_sector_rows_total(spark, d):
    k = F.col("c_custkey")
    wide = read(spark, d, "customer", "c_custkey").select(k.alias("k"), *[x for name, n in (("a", 11), ("b", 7), ("c", 5)) for x in ((k % n).alias(f"{name}_value"), F.when(k % n > 0, "observed").otherwise("suppressed").alias(f"{name}_status"))])
    rows = ranking.unpivot_metrics(wide, ["k"], ["a", "b", "c"])
    return components.complete_case(rows, ["k"], "value", "status", "metric").select("k", "total", "observed", "expected")


@query("""WITH p AS (SELECT l_partkey % 25 AS corridor, 'n' || l_orderkey || '_' || l_linenumber AS name, 'k' || l_orderkey || '_' || l_linenumber AS source_key, l_orderkey AS k FROM lineitem WHERE l_linenumber = 1)
SELECT DISTINCT corridor, name, concat_ws('+', CASE WHEN k % 7 = 0 THEN 'no_such_record' END, CASE WHEN k % 11 = 0 OR k % 7 = 0 AND k % 14 <> 0 THEN 'station_id' END, CASE WHEN k % 13 = 0 OR k % 14 = 0 THEN 'station_group_id' END, CASE WHEN corridor < 5 AND k % 17 = 0 THEN 'not_reused' END) AS reasons FROM p WHERE reasons <> ''""")
def corridor_pin_faults(spark, d):
    k = F.col("k")
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").where("l_linenumber = 1")
    tail = F.concat(F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber"))
    p = li.select((F.col("l_partkey") % 25).alias("corridor"), F.concat(F.lit("n"), tail).alias("name"), F.concat(F.lit("k"), tail).alias("source_key"), F.col("l_orderkey").alias("k")).distinct()
    named = lambda head: F.concat(F.lit(head), k.cast("string"))
    pins = p.select("corridor", "name", "source_key", named("s").alias("station_id"), named("g").alias("station_group_id"))
    keys = p.dropDuplicates(["source_key"])
    # of the records a seventh has another name, and half of those another group
    pool = keys.select("source_key", F.when(k % 7 == 0, "other").otherwise(F.col("name")).alias("name"), F.when(k % 14 == 0, "lost").otherwise(named("G")).alias("group_code"))
    stations = keys.where("k % 11 <> 0 and not (k % 7 = 0 and k % 14 <> 0)").select(F.lit("station").alias("kind"), F.col("source_key").alias("key"), named("s").alias("id"))
    groups = keys.where("k % 13 <> 0").select(F.lit("station_group").alias("kind"), named("G").alias("key"), named("g").alias("id"))
    chain = p.where("k % 17 <> 0").select("corridor", "name", named("s").alias("station_id"), named("g").alias("station_group_id"))
    return corridor_build.pin_faults(pins, pool, stations.unionByName(groups), chain, F.col("corridor") < 5)


@query("""SELECT correction, concat_ws('+', CASE WHEN status IS NULL OR status = 'DONE' THEN 'unknown_status' END, CASE WHEN ratio NOT BETWEEN 1.25 AND 1.35 THEN 'detour_ratio' END, CASE WHEN status = 'PENDING_OWNER_DECISION' AND decision <> 'PENDING' THEN 'decided_while_waiting' END,
  CASE WHEN status IN ('PENDING_REGENERATION', 'APPLIED') AND decision = 'PENDING' THEN 'decision_id' END, CASE WHEN status IN ('PENDING_REGENERATION', 'APPLIED') AND decision LIKE 'DEC-%' AND correction % 4 = 3 THEN 'decision_not_registered' END,
  CASE WHEN status = 'APPLIED' AND (correction % 19 = 0 OR correction % 23 = 0) THEN 'not_confirmed' END, CASE WHEN status = 'APPLIED' AND correction % 23 <> 0 AND correction % 29 = 0 THEN 'confirmation_without_url' END, CASE WHEN status = 'APPLIED' AND correction % 31 = 0 THEN 'exclusion_not_confirmed' END) AS reasons
FROM (SELECT c_custkey AS correction, CASE c_custkey % 5 WHEN 0 THEN 'PENDING_OWNER_DECISION' WHEN 1 THEN 'PENDING_REGENERATION' WHEN 2 THEN 'APPLIED' WHEN 3 THEN 'DONE' END AS status, CASE WHEN c_custkey % 3 = 0 THEN 'PENDING' ELSE 'DEC-' || lpad(CAST(c_custkey % 4 AS VARCHAR), 4, '0') END AS decision,
  CASE WHEN c_custkey % 17 = 0 THEN 1.4 ELSE 1.3 END AS ratio FROM customer) WHERE reasons <> ''""")
def correction_state_faults(spark, d):
    k = F.col("c_custkey")
    page = lambda when: F.struct(F.lit("https://example.org").alias("url"), when.alias("retrieved_at"))
    records = F.when(k % 23 == 0, F.slice(F.array(page(F.lit("2026"))), 1, 0)).otherwise(F.array(page(F.when(k % 29 != 0, "2026"))))
    c = read(spark, d, "customer", "c_custkey").select(
        k.alias("correction"), F.when(k % 5 == 0, corridor_build.PENDING[0]).when(k % 5 == 1, corridor_build.PENDING[1]).when(k % 5 == 2, corridor_build.APPLIED).when(k % 5 == 3, "DONE").alias("status"),
        F.when(k % 3 == 0, "PENDING").otherwise(F.concat(F.lit("DEC-"), F.lpad((k % 4).cast("string"), 4, "0"))).alias("owner_decision"), F.when(k % 17 == 0, 1.4).otherwise(1.3).alias("detour_ratio_max"),
        F.when(k % 19 != 0, "CONFIRMED").alias("confirmation"), records.alias("records"), F.when(k % 31 == 0, "OPEN").otherwise("CONFIRMED").alias("exclusion_evidence"),
    )
    register = c.where("correction % 4 <> 3 and owner_decision <> 'PENDING'").select(F.col("owner_decision").alias("decision"))
    return corridor_build.state_faults(c, register)
