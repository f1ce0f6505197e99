"""Identity resolution, registries, reviews and integrity over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import components as comp
from ..operators import constraints, identity
from .carriers import query, read

_ACC = """acc AS (SELECT o_custkey, o_orderkey, o_orderkey % 97 AS v, CASE WHEN o_orderkey % 8 = 7 THEN 'not_public' WHEN o_orderkey % 4 = 1 THEN 'duplicate_on_other_record' WHEN o_orderkey % 4 = 2 THEN 'station_absent' ELSE 'observed' END AS s
  FROM orders)"""


@query(f"""WITH {_ACC} SELECT o_custkey, CASE WHEN count(*) FILTER (s = 'observed') = 1 THEN max(v) FILTER (s = 'observed') END AS value,
  CASE WHEN count(*) FILTER (s = 'observed') = 1 THEN 'observed' WHEN count(*) FILTER (s = 'observed') > 1 THEN 'ambiguous_multiple_records' WHEN count(DISTINCT s) = 1 THEN min(s) ELSE 'source_absent' END AS status, CAST(count(*) AS BIGINT) AS records FROM acc GROUP BY 1""")
def access_single_authority(spark, d):
    k = F.col("o_orderkey")
    status = F.when(k % 8 == 7, "not_public").when(k % 4 == 1, "duplicate_on_other_record").when(k % 4 == 2, "station_absent").otherwise("observed")
    o = read(spark, d, "orders", "o_custkey", "o_orderkey").select("o_custkey", (k % 97).alias("v"), status.alias("s"))
    return comp.single_authority(o, "o_custkey", "v", "s", F.col("s") == "observed")


@query("""SELECT l_partkey, CAST(count(DISTINCT (l_suppkey, l_returnflag)) AS BIGINT) AS pairs, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS suppliers,
  string_agg(DISTINCT l_returnflag, '+' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1""")
def route_membership_distinct(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_returnflag")
    return li.groupBy("l_partkey").agg(F.count_distinct("l_suppkey", "l_returnflag").alias("pairs"), F.count_distinct("l_suppkey").alias("suppliers"), F.array_join(F.array_sort(F.collect_set("l_returnflag")), "+").alias("flags"))


@query("""WITH pool AS (SELECT p_name AS name, p_brand AS route, p_partkey AS source_key, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'g' || (p_partkey % 7) END AS grp FROM part WHERE p_partkey % 10 = 1),
want AS (SELECT p_partkey AS row_id, p_name AS name, p_brand AS route FROM part WHERE p_partkey % 4 = 2),
c AS (SELECT w.row_id, p.source_key, p.grp, p.route IS NOT DISTINCT FROM w.route AS pref FROM want w LEFT JOIN pool p USING (name)),
f AS (SELECT * FROM (SELECT *, bool_or(pref AND source_key IS NOT NULL) OVER (PARTITION BY row_id) AS anyp FROM c) WHERE pref OR NOT anyp),
r AS (SELECT row_id, count(DISTINCT source_key) AS n, min(source_key) AS k, count(DISTINCT grp) AS g, bool_and(coalesce(grp, '') <> '') AS named FROM f GROUP BY 1)
SELECT row_id, CASE WHEN n = 1 OR (n > 1 AND g = 1 AND named) THEN k END AS source_key, CASE WHEN n = 0 THEN 'no_match' WHEN n = 1 OR (g = 1 AND named) THEN 'confirmed' ELSE 'ambiguous' END AS resolution, CAST(n AS BIGINT) AS candidates FROM r""")
def name_resolution(spark, d):
    k = F.col("p_partkey")
    p = read(spark, d, "part", "p_partkey", "p_name", "p_brand").withColumnsRenamed({"p_name": "name", "p_brand": "route"})
    pool = p.where(k % 10 == 1).select("name", "route", k.alias("source_key"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("g"), (k % 7).cast("string"))).alias("grp"))
    want = p.where(k % 4 == 2).withColumnRenamed("p_partkey", "row_id")
    return identity.resolve_names(want, pool, ["name"], "route", "source_key", "grp", "row_id")


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 'base_' || o_custkey WHEN o_custkey % 2 = 0 THEN 'ext_' || o_custkey END AS canonical_id,
  CASE WHEN o_custkey % 3 = 0 THEN 'base' WHEN o_custkey % 2 = 0 THEN 'extension' ELSE 'unminted' END AS origin FROM orders""")
def registry_resolve_base_wins(spark, d):
    k = F.col("c_custkey")
    c = read(spark, d, "customer", "c_custkey")
    base = c.where(k % 3 == 0).select(k.alias("o_custkey"), F.concat(F.lit("base_"), k.cast("string")).alias("canonical_id"))
    ext = c.where(k % 2 == 0).select(k.alias("o_custkey"), F.concat(F.lit("ext_"), k.cast("string")).alias("canonical_id"))
    return identity.registry_resolve(read(spark, d, "orders", "o_orderkey", "o_custkey"), base, ext, "o_custkey", "canonical_id")


@query("""SELECT c_custkey, 'base' AS origin, c_acctbal AS value FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'extension', c_acctbal + 1 FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0""")
def read_model_merge(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_acctbal")
    base = c.where("c_custkey % 3 = 0").select("c_custkey", F.lit("base").alias("origin"), F.col("c_acctbal").alias("value"))
    ext = c.where("c_custkey % 2 = 0").select("c_custkey", F.lit("extension").alias("origin"), (F.col("c_acctbal") + 1).alias("value"))
    return identity.merge_base_wins(base, ext, "c_custkey")


@query("""SELECT coalesce(a.k, b.k) AS orderkey, CASE WHEN a.k IS NULL THEN 'not_open' ELSE 'undecided' END AS gap
FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 7 <> 3) a FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) b USING (k) WHERE a.k IS NULL OR b.k IS NULL""")
def review_coverage_gap(spark, d):
    a = read(spark, d, "orders", F.col("o_orderkey").alias("orderkey")).where("orderkey % 7 <> 3")
    return identity.coverage_gap(a, read(spark, d, "lineitem", F.col("l_orderkey").alias("orderkey")), "orderkey")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)""")
def fk_orphans(spark, d):
    return identity.orphans(read(spark, d, "orders", "o_orderkey", "o_custkey"), read(spark, d, "customer", "c_custkey").where("c_custkey % 5 <> 0"), "o_custkey", "c_custkey")


@query("SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_duplicates(spark, d):
    return identity.duplicates(read(spark, d, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("""SELECT l_suppkey, l_partkey, min(l_linenumber) AS first_sequence, max(l_linenumber) AS last_sequence, CAST(max(l_quantity) AS BIGINT) AS most, min(l_extendedprice) AS least_distance FROM lineitem GROUP BY 1, 2""")
def line_center_dedup(spark, d):
    li = read(spark, d, "lineitem", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return li.groupBy("l_suppkey", "l_partkey").agg(F.min("l_linenumber").alias("first_sequence"), F.max("l_linenumber").alias("last_sequence"), F.max("l_quantity").cast("long").alias("most"), F.min("l_extendedprice").alias("least_distance"))


@query("""SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name, s.s_name AS hub FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN supplier s ON s.s_suppkey = o.o_orderkey""")
def crosswalk_view(spark, d):
    for t in ("orders", "customer", "nation", "region", "supplier"):
        read(spark, d, t).createOrReplaceTempView(f"crosswalk_{t}")
    return spark.sql("""SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name, s.s_name AS hub FROM crosswalk_orders o JOIN crosswalk_customer c ON o.o_custkey = c.c_custkey
        JOIN crosswalk_nation n ON c.c_nationkey = n.n_nationkey JOIN crosswalk_region r ON n.n_regionkey = r.r_regionkey LEFT JOIN crosswalk_supplier s ON s.s_suppkey = o.o_orderkey""")


@query("""WITH i AS (SELECT o_custkey AS natural_key, o_orderkey AS pos, o_orderstatus AS issue FROM orders), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY natural_key ORDER BY pos) AS n FROM i) WHERE n = 1)
SELECT c_custkey AS natural_key, 0::BIGINT AS pos, 'kept' AS issue FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT natural_key, pos, issue FROM f WHERE natural_key % 4 <> 0""")
def review_upsert(spark, d):
    queue = read(spark, d, "customer", "c_custkey").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("natural_key"), F.lit(0).cast("long").alias("pos"), F.lit("kept").alias("issue"))
    issues = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus").toDF("natural_key", "pos", "issue")
    return identity.upsert_reviews(queue, issues, "natural_key", "pos")


@query("""SELECT l_partkey AS group_key, CAST(count(DISTINCT l_returnflag) AS BIGINT) AS operators, CAST(count(DISTINCT l_suppkey % 2) AS BIGINT) AS routes, CAST(count(DISTINCT l_linestatus) AS BIGINT) AS names,
  CASE WHEN count(DISTINCT l_linestatus) > 1 THEN 'review' WHEN count(DISTINCT l_returnflag) > 1 OR count(DISTINCT l_suppkey % 2) > 1 THEN 'hub_candidate' ELSE 'plain' END AS kind FROM lineitem WHERE l_quantity > 46 GROUP BY 1""")
def group_candidates(spark, d):
    li = read(spark, d, "lineitem", "l_partkey", "l_returnflag", "l_suppkey", "l_linestatus", "l_quantity").where("l_quantity > 46")
    li = li.select(F.col("l_partkey").alias("group_key"), "l_returnflag", (F.col("l_suppkey") % 2).alias("route"), "l_linestatus")
    return identity.hub_candidates(li, "group_key", "l_returnflag", "route", "l_linestatus")


def _decisions(spark, d):
    k = F.col("s_suppkey")
    s = read(spark, d, "supplier", "s_suppkey")
    name = lambda c: F.concat(F.lit("h"), c.cast("string"))
    decision = F.when(k % 5 == 0, "reject_hub").when(k % 5 == 1, "resolve_duplicate").when(k % 5 == 4, "no_such").otherwise("confirm_hub")
    groups = F.when(k % 7 == 0, F.array(k)).otherwise(F.array(k, k + 1))
    return s.select(k.alias("source_key"), decision.alias("decision"), F.when(k % 11 != 0, name(k % 40)).alias("target_hub_key"), groups.alias("station_group_keys"), F.lit("walk").alias("transfer_basis"))


def _hubs(spark, d):
    s = read(spark, d, "supplier", "s_suppkey").where("s_suppkey < 20")
    return s.select(F.concat(F.lit("h"), F.col("s_suppkey").cast("string")).alias("hub_key"), F.lit("same_group").alias("transfer_basis"), F.lit("candidate").alias("review_status"))


@query("""WITH dec AS (SELECT s_suppkey AS k, CASE s_suppkey % 5 WHEN 0 THEN 'reject_hub' WHEN 1 THEN 'resolve_duplicate' WHEN 4 THEN 'no_such' ELSE 'confirm_hub' END AS decision, CASE WHEN s_suppkey % 11 <> 0 THEN 'h' || (s_suppkey % 40) END AS target, CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 2 END AS n FROM supplier),
hubs AS (SELECT 'h' || s_suppkey AS hub FROM supplier WHERE s_suppkey < 20), top AS (SELECT max(s_suppkey) AS m FROM supplier),
x AS (SELECT *, target IN (SELECT hub FROM hubs) AS there, target IN (SELECT target FROM dec WHERE decision = 'confirm_hub' AND target IS NOT NULL) AS made FROM dec)
SELECT k AS source_key, reasons FROM (SELECT k, array_to_string(list_filter([CASE WHEN decision = 'no_such' THEN 'unknown_decision' END, CASE WHEN decision IN ('confirm_hub', 'resolve_duplicate') AND target IS NULL THEN 'no_target' END,
  CASE WHEN decision = 'confirm_hub' AND NOT coalesce(there, false) AND n < 2 THEN 'too_few_groups' END, CASE WHEN decision = 'confirm_hub' AND NOT coalesce(there, false) AND n = 2 AND k + 1 > (SELECT m FROM top) THEN 'unknown_group' END,
  CASE WHEN decision = 'resolve_duplicate' AND NOT coalesce(there, false) AND NOT coalesce(made, false) AND target IS NOT NULL THEN 'unknown_duplicate_target' END], lambda r: r IS NOT NULL), '+') AS reasons FROM x) WHERE reasons <> ''""")
def decision_faults(spark, d):
    groups = read(spark, d, "supplier", F.col("s_suppkey").alias("group_key"))
    links = _hubs(spark, d).select("hub_key", F.lit(1).cast("long").alias("group_key"), F.lit(0).alias("is_manual"))
    return identity.apply_decisions(_hubs(spark, d), links, _decisions(spark, d), groups)[2]


@query("""WITH dec AS (SELECT s_suppkey AS k, 'h' || (s_suppkey % 40) AS target FROM supplier WHERE s_suppkey % 5 IN (2, 3) AND s_suppkey % 11 <> 0), t AS (SELECT DISTINCT target FROM dec)
SELECT 'h' || s_suppkey AS hub_key, CASE WHEN t.target IS NOT NULL THEN 'walk' ELSE 'same_group' END AS transfer_basis, CASE WHEN t.target IS NOT NULL THEN 'confirmed' ELSE 'candidate' END AS review_status FROM supplier LEFT JOIN t ON t.target = 'h' || s_suppkey WHERE s_suppkey < 20
UNION ALL SELECT target, 'walk', 'confirmed' FROM t WHERE target NOT IN (SELECT 'h' || s_suppkey FROM supplier WHERE s_suppkey < 20)""")
def decisions_applied(spark, d):
    groups = read(spark, d, "supplier", F.col("s_suppkey").alias("group_key"))
    links = _hubs(spark, d).select("hub_key", F.lit(1).cast("long").alias("group_key"), F.lit(0).alias("is_manual"))
    return identity.apply_decisions(_hubs(spark, d), links, _decisions(spark, d), groups)[0]


@query("""SELECT o_orderkey AS review_id, CASE WHEN o_custkey % 2 = 0 THEN 'resolved' ELSE 'open' END AS status, CASE WHEN o_custkey % 2 = 0 THEN '2026-01-01' END AS resolved_at,
  CASE WHEN o_custkey % 2 = 0 THEN '{"adjudication":"confirm","basis":"' || o_orderstatus || '"}' ELSE '{"basis":"' || o_orderstatus || '"}' END AS evidence_json FROM orders""")
def review_resolution(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    queue = o.select(F.col("o_orderkey").alias("review_id"), F.col("o_custkey").cast("string").alias("source_key"), F.lit("open").alias("status"), F.lit(None).cast("string").alias("resolved_at"), F.to_json(F.struct(F.col("o_orderstatus").alias("basis"))).alias("evidence_json"))
    dec = read(spark, d, "customer", "c_custkey").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("source_key"), F.lit("confirm").alias("decision"))
    return identity.resolve_reviews(queue, dec, "2026-01-01").drop("source_key")


@query("""WITH l AS (SELECT DISTINCT l_orderkey % 200 AS hub, l_suppkey AS g FROM lineitem), d AS (SELECT s_suppkey AS k, s_suppkey * 2 % 210 AS hub, s_suppkey AS a, (s_suppkey * 3) % 100 AS b FROM supplier)
SELECT k AS source_key, CASE WHEN k % 2 = 0 THEN hub IN (SELECT hub FROM l) ELSE NOT EXISTS (SELECT 1 FROM l x JOIN l y USING (hub) WHERE x.g = d.a AND y.g = d.b) END AS agrees FROM d""")
def decision_replay(spark, d):
    k = F.col("s_suppkey")
    links = read(spark, d, "lineitem", "l_orderkey", "l_suppkey").select((F.col("l_orderkey") % 200).alias("hub_key"), F.col("l_suppkey").alias("group_key")).distinct()
    dec = read(spark, d, "supplier", "s_suppkey").select(k.alias("source_key"), F.when(k % 2 == 0, "resolve_duplicate").otherwise("reject_hub").alias("decision"), (k * 2 % 210).alias("target_hub_key"), F.array(k, k * 3 % 100).alias("station_group_keys"))
    return identity.replay_decisions(dec, links)


@query("""WITH a AS (SELECT o_orderkey AS artifact, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderkey % 10 <> 1), b AS (SELECT o_orderkey AS artifact, CASE WHEN o_orderkey % 13 = 0 THEN 'Z' ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders WHERE o_orderkey % 10 <> 2)
SELECT coalesce(a.artifact, b.artifact) AS artifact, drift FROM (SELECT a, b, CASE WHEN a.artifact IS NULL THEN 'only_right' WHEN b.artifact IS NULL THEN 'only_left' ELSE array_to_string(list_filter([CASE WHEN a.s IS DISTINCT FROM b.s THEN 's' END, CASE WHEN a.p IS DISTINCT FROM b.p THEN 'p' END], lambda x: x IS NOT NULL), '+') END AS drift FROM a FULL JOIN b ON a.artifact = b.artifact) WHERE drift <> ''""")
def lock_drift(spark, d):
    k = F.col("o_orderkey")
    o = read(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    a = o.where(k % 10 != 1).toDF("artifact", "s", "p")
    b = o.where(k % 10 != 2).select(k.alias("artifact"), F.when(k % 13 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("s"), F.when(k % 17 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("p"))
    return constraints.drift(a, b, "artifact", ["s", "p"])


@query("""SELECT o_custkey, total, child_sum FROM (SELECT o_custkey, CAST(count(*) + CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS child_sum FROM orders GROUP BY 1) WHERE total <> child_sum""")
def control_totals(spark, d):
    o = read(spark, d, "orders", "o_custkey")
    parents = o.groupBy("o_custkey").agg(F.count("*").alias("n")).select("o_custkey", (F.col("n") + F.when(F.col("o_custkey") % 10 == 0, 1).otherwise(0)).alias("total"))
    return constraints.control_totals(o.withColumn("one", F.lit(1)), parents, "o_custkey", "one", "total")


@query("""SELECT c_custkey, reasons FROM (SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_custkey % 6 = 0 THEN 'form' END, CASE WHEN c_custkey % 9 = 0 THEN 'prefix' END], lambda x: x IS NOT NULL), '+') AS reasons FROM customer) WHERE reasons <> ''""")
def opaque_id_faults(spark, d):
    k = F.col("c_custkey")
    good = F.concat(F.when(k % 9 == 0, "lin_").otherwise("sta_"), F.md5(k.cast("string")))
    c = read(spark, d, "customer", "c_custkey").withColumn("station_id", F.when(k % 6 == 0, F.concat(good, F.lit("x"))).otherwise(good))
    from ..functions.text import opaque_id_faults as faults

    return constraints.violations(c, faults(F.col("station_id"), "sta_"), "c_custkey")


@query("""SELECT o_custkey AS k, 'left' AS only_in FROM (SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer) UNION ALL SELECT c_custkey, 'right' FROM (SELECT c_custkey FROM customer EXCEPT ALL SELECT o_custkey FROM orders)""")
def set_symmetric_difference(spark, d):
    return constraints.set_difference(read(spark, d, "orders", F.col("o_custkey").alias("k")), read(spark, d, "customer", F.col("c_custkey").alias("k")))
