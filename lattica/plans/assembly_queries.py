"""Corridor screens and the assembly of published records over the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import assemble, constraints, corridor
from .carriers import approx_sql, components, lat, lat_sql, lon, lon_sql, query, read

#: Suppliers are the chains of five corridors, customers the pool of records, by nation.
_CHAIN_SQL = f"""chain AS (SELECT s_suppkey % 5 AS corridor, s_suppkey AS key, 'n' || (s_suppkey % 50) AS name, {lon_sql('s_suppkey')} AS lon, {lat_sql('s_suppkey')} AS lat FROM supplier),
pool AS (SELECT CAST(c_nationkey % 5 AS BIGINT) AS corridor, c_custkey AS key, 'n' || (c_custkey % 50) AS name, {lon_sql('c_custkey')} AS lon, {lat_sql('c_custkey')} AS lat FROM customer),
edge AS (SELECT * FROM (SELECT corridor, key, name, lon, lat, lead(key) OVER w AS nkey, lead(name) OVER w AS nname, lead(lon) OVER w AS nlon, lead(lat) OVER w AS nlat, row_number() OVER w AS i
  FROM chain WINDOW w AS (PARTITION BY corridor ORDER BY key)) WHERE nkey IS NOT NULL)"""
_GAPS_SQL = f"""{_CHAIN_SQL}, fresh AS (SELECT * FROM pool p WHERE NOT EXISTS (SELECT 1 FROM chain c WHERE c.corridor = p.corridor AND (c.key = p.key OR c.name = p.name AND {approx_sql('p.lon', 'p.lat', 'c.lon', 'c.lat', '110.574')} <= 30))),
r AS (SELECT f.corridor, f.key, e.i, e.name AS after, e.nname AS before, ({approx_sql('e.lon', 'e.lat', 'f.lon', 'f.lat', '110.574')} + {approx_sql('f.lon', 'f.lat', 'e.nlon', 'e.nlat', '110.574')}) / nullif({approx_sql('e.lon', 'e.lat', 'e.nlon', 'e.nlat', '110.574')}, 0) AS ratio
  FROM fresh f JOIN edge e USING (corridor)),
gaps AS (SELECT corridor, key, round(ratio, 3) AS ratio, after, before FROM (SELECT *, row_number() OVER (PARTITION BY corridor, key ORDER BY ratio, i) AS n FROM r WHERE ratio IS NOT NULL) WHERE n = 1 AND ratio <= 1.35)"""


def _stations(df, nation: str, key: str):
    k = F.col(key)
    return df.select((F.col(nation) % 5).cast("long").alias("corridor"), k.alias("key"), F.concat(F.lit("n"), (k % 50).cast("string")).alias("name"), lon(k).alias("lon"), lat(k).alias("lat"))


def _chain(spark, d):
    return _stations(read(spark, d, "supplier", "s_suppkey"), "s_suppkey", "s_suppkey")


def _gaps(spark, d):
    pool = _stations(read(spark, d, "customer", "c_nationkey", "c_custkey"), "c_nationkey", "c_custkey")
    found = corridor.corridor_gaps(pool, _chain(spark, d), "corridor", "key", "name", "key", "lon", "lat", 1.35, km=30)
    return found.withColumn("ratio", F.round("ratio", 3))


@query(f"WITH {_GAPS_SQL} SELECT * FROM gaps")
def corridor_missing_stations(spark, d):
    return _gaps(spark, d)


@query(f"WITH {_GAPS_SQL} SELECT * FROM gaps g WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = g.key AND p.p_partkey % 5 = g.corridor)")
def corridor_unexplained_gaps(spark, d):
    known = read(spark, d, "part", "p_partkey").select((F.col("p_partkey") % 5).alias("corridor"), F.col("p_partkey").alias("key"))
    return corridor.unexplained_gaps(_gaps(spark, d), known, "corridor", "key")


@query("""SELECT c_custkey, c_nationkey, c_mktsegment FROM customer c WHERE c_custkey % 11 <> 0
  AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = c.c_nationkey AND s.s_suppkey % 5 = length(c.c_mktsegment) % 5)""")
def corridor_filter_self_test(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment").withColumn("route", (F.length("c_mktsegment") % 5).cast("long"))
    filters = read(spark, d, "supplier", "s_nationkey", "s_suppkey").select(F.col("s_nationkey").alias("c_nationkey"), (F.col("s_suppkey") % 5).alias("route"))
    return corridor.filter_misses(c, filters, ["c_nationkey", "route"], F.col("c_custkey") % 11 == 0).drop("route")


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place FROM orders)
SELECT o_custkey, CAST(count(*) AS BIGINT) AS stations, CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS kinds, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM o WHERE place BETWEEN 2 AND 5 GROUP BY 1""")
def inclusive_line_slice(spark, d):
    o = corridor.line_slice(read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority"), "o_custkey", "o_orderkey", 2, 5)
    return o.groupBy("o_custkey").agg(F.count("*").alias("stations"), F.count_distinct("o_orderpriority").alias("kinds"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("""WITH s AS (SELECT c_nationkey AS corridor, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS seq FROM customer)
SELECT corridor, c_custkey, CAST(seq AS BIGINT) AS seq FROM s WHERE corridor <> 7 OR seq <= 2""")
def corridor_upto_anchor(spark, d):
    seq = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).cast("long")
    s = read(spark, d, "customer", "c_nationkey", "c_custkey").select(F.col("c_nationkey").alias("corridor"), "c_custkey", seq.alias("seq"))
    named = s.withColumn("name", F.concat(F.lit("s"), F.col("seq").cast("string")))
    return corridor.upto_named(named, "corridor", "seq", "name", 7, "s2", expected=2).drop("name")


@query("""SELECT c_nationkey, c_custkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN p_partkey % 3 = 0 THEN p_size END NULLS LAST, c_mktsegment NULLS LAST, c_custkey) AS INTEGER) AS display_rank
  FROM customer LEFT JOIN part ON p_partkey = c_custkey""")
def route_display_order(spark, d):
    order = read(spark, d, "part", "p_partkey", "p_size").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("c_custkey"), F.col("p_size").alias("position"))
    c = read(spark, d, "customer", "c_nationkey", "c_custkey", "c_mktsegment")
    return corridor.route_order(c, order, ["c_custkey"], "c_nationkey", "position", "c_mktsegment").drop("c_mktsegment")


@query("""WITH f AS (SELECT l_partkey AS key, l_orderkey * 8 + l_linenumber AS idx, CAST(l_orderkey * 7919 % 1000 AS DOUBLE) AS lon, CAST(l_orderkey * 104729 % 1000 AS DOUBLE) AS lat, l_linestatus AS v, l_returnflag AS g FROM lineitem),
v AS (SELECT key, string_agg(v, '+' ORDER BY i) AS name_variants FROM (SELECT key, v, min(idx) AS i FROM f GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT key, string_agg(g, '+' ORDER BY i) AS group_variants FROM (SELECT key, g, min(idx) AS i FROM f GROUP BY 1, 2) GROUP BY 1)
SELECT key, avg(lon) AS lon, avg(lat) AS lat, CAST(count(*) AS BIGINT) AS feature_count, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS feature_indexes, any_value(name_variants) AS name_variants, any_value(group_variants) AS group_variants
FROM f JOIN v USING (key) JOIN g USING (key) GROUP BY 1""")
def feature_merge(spark, d):
    k = F.col("l_orderkey")
    f = read(spark, d, "lineitem", "l_partkey", "l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag")
    f = f.select(F.col("l_partkey").alias("key"), (k * 8 + F.col("l_linenumber")).alias("idx"), (k * 7919 % 1000).cast("double").alias("lon"), (k * 104729 % 1000).cast("double").alias("lat"), F.col("l_linestatus").alias("name"), F.col("l_returnflag").alias("group"))
    m = assemble.merge_features(f, "key", "idx", "lon", "lat", "name", "group")
    joined = [F.array_join(F.col(c).cast("array<string>"), s).alias(c) for c, s in (("feature_indexes", ","), ("name_variants", "+"), ("group_variants", "+"))]
    return m.select("key", "lon", "lat", "feature_count", *joined)


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey <> 2")
def partition_metadata_join(spark, d):
    return _partition_metadata(spark, d)[0].select("c_custkey", "n_name")


@query("SELECT c_custkey, c_nationkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 2")
def partition_metadata_misses(spark, d):
    return _partition_metadata(spark, d)[1]


def _partition_metadata(spark, d):
    known = read(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return assemble.must_hit(read(spark, d, "customer", "c_custkey", "c_nationkey"), known, ["c_nationkey"])


@query("""SELECT o_orderkey, CAST(s_nationkey AS VARCHAR) AS source_release_id, s_suppkey AS source_artifact_id, md5(s_name) AS source_archive_sha256, CAST(2000 + s_suppkey % 20 AS VARCHAR) AS source_reference_period,
  CAST(2001 + s_suppkey % 20 AS VARCHAR) AS source_published_at, s_name AS source_lock_retrieved_at, o_orderpriority AS raw_recovered_at FROM orders LEFT JOIN supplier ON s_suppkey = o_orderkey % 12""")
def provenance_block(spark, d):
    k = F.col("s_suppkey")
    a = read(spark, d, "supplier", "s_suppkey", "s_nationkey", "s_name")
    a = a.select(k.alias("artifact_id"), F.col("s_nationkey").cast("string").alias("source_release_id"), F.md5("s_name").alias("sha256"), (2000 + k % 20).alias("reference_date_or_period"), (2001 + k % 20).alias("publication_date_or_period"), F.col("s_name").alias("retrieved_at"))
    o = read(spark, d, "orders", "o_orderkey", "o_orderpriority").withColumn("artifact", F.col("o_orderkey") % 12)
    return assemble.with_provenance(o, a, "artifact", "o_orderpriority").drop("artifact", "o_orderpriority")


@query("SELECT o_custkey, min(o_orderdate) AS recovered_first, max(o_orderdate) AS recovered_last FROM orders GROUP BY 1")
def recovery_window(spark, d):
    return assemble.recovery_window(read(spark, d, "orders", "o_custkey", "o_orderdate"), "o_custkey", "o_orderdate")


@query("""SELECT p_partkey, s_name AS source_url, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END AS period_label, CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE p_name || ' ' || p_type END AS display_note
  FROM part JOIN supplier ON s_suppkey = p_partkey % 20""")
def context_with_fallback(spark, d):
    k = F.col("p_partkey")
    p = read(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type")
    items = p.select("p_partkey", (k % 20).alias("source_id"), F.when(k % 3 == 0, F.col("p_brand")).alias("reference_period"), F.col("p_type").alias("reference_date"), F.col("p_name").alias("interpretation"), F.when(k % 4 != 0, F.col("p_type")).alias("scope_note"))
    s = read(spark, d, "supplier", "s_suppkey", "s_name")
    sources = s.select(F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("url"), F.lit("free").alias("license_id"), F.lit("").alias("attribution"), F.lit("").alias("terms_url"))
    return assemble.context_records(items, sources, "source_id").select("p_partkey", "source_url", "period_label", "display_note")


@query("""SELECT nation, coalesce(f, 0) AS found, coalesce(n, 0) AS declared FROM (SELECT c_nationkey AS nation, count(*) AS f FROM customer GROUP BY 1) FULL JOIN (SELECT s_nationkey AS nation, 15 * count(*) AS n FROM supplier GROUP BY 1) USING (nation)
WHERE coalesce(f, 0) <> coalesce(n, 0)""")
def declared_count_drift(spark, d):
    c = read(spark, d, "customer", "c_nationkey").withColumnRenamed("c_nationkey", "nation")
    said = read(spark, d, "supplier", "s_nationkey").groupBy(F.col("s_nationkey").alias("nation")).agg((15 * F.count("*")).alias("declared"))
    return assemble.declared_counts(c, ["nation"], said)


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity + CASE WHEN l_partkey % 50 = 0 THEN 1 ELSE 0 END AS l_quantity, CASE WHEN l_partkey % 70 = 0 THEN NULL ELSE l_linestatus END AS l_linestatus FROM lineitem WHERE l_suppkey % 9 <> 0)
SELECT l.l_orderkey, l.l_linenumber, CASE WHEN r.l_orderkey IS NULL THEN 'only_left' ELSE concat_ws('+', CASE WHEN l.l_quantity <> r.l_quantity THEN 'l_quantity' END, CASE WHEN l.l_linestatus IS DISTINCT FROM r.l_linestatus THEN 'l_linestatus' END) END AS drift
FROM lineitem l LEFT JOIN r ON l.l_orderkey = r.l_orderkey AND l.l_linenumber = r.l_linenumber WHERE r.l_orderkey IS NULL OR l.l_quantity <> r.l_quantity OR l.l_linestatus IS DISTINCT FROM r.l_linestatus""")
def member_drift(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus")
    p = F.col("l_partkey")
    locked = li.where("l_suppkey % 9 <> 0").withColumns({"l_quantity": F.col("l_quantity") + F.when(p % 50 == 0, 1).otherwise(0), "l_linestatus": F.when(p % 70 != 0, F.col("l_linestatus"))})
    return constraints.drift(li, locked, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_linestatus"])


@query("""WITH own AS (SELECT o_custkey AS cell, o_orderkey % 4 + 11 AS code FROM orders), other AS (SELECT l_partkey AS cell, l_linenumber + 11 AS code FROM lineitem),
b AS (SELECT cell, code, 1 AS own FROM own UNION ALL SELECT cell, code, 0 FROM other),
t AS (SELECT cell, string_agg(DISTINCT CAST(code AS VARCHAR), '+' ORDER BY CAST(code AS VARCHAR)) AS codes, sum(own) AS n FROM b GROUP BY 1)
SELECT c_custkey AS cell, coalesce(codes, '') AS source_partition_codes, CAST(coalesce(n, 0) AS BIGINT) AS components, CASE WHEN coalesce(n, 0) > 0 THEN 'available' ELSE 'source_absent' END AS status FROM customer LEFT JOIN t ON cell = c_custkey""")
def partition_code_union(spark, d):
    cells = read(spark, d, "customer", "c_custkey").withColumnRenamed("c_custkey", "cell")
    own = read(spark, d, "orders", "o_custkey", "o_orderkey").select(F.col("o_custkey").alias("cell"), (F.col("o_orderkey") % 4 + 11).cast("string").alias("code"))
    other = read(spark, d, "lineitem", "l_partkey", "l_linenumber").select(F.col("l_partkey").alias("cell"), (F.col("l_linenumber") + 11).cast("string").alias("code"))
    made = assemble.partition_union(cells, own, other, "cell", "code")
    return made.withColumn("source_partition_codes", F.array_join("source_partition_codes", "+"))


@query("""WITH g AS (SELECT o_custkey AS mesh, CAST(count(*) AS DOUBLE) AS n, CAST(count(DISTINCT o_orderpriority) AS DOUBLE) AS e, CAST(max(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 97 END) AS DOUBLE) AS x FROM orders GROUP BY 1),
f AS (SELECT avg(ln(1 + n)) AS mn, stddev_pop(ln(1 + n)) AS sn, avg(ln(1 + e)) AS me, stddev_pop(ln(1 + e)) AS se, avg(ln(1 + x)) AS mx, stddev_pop(ln(1 + x)) AS sx FROM g WHERE mesh % 2 = 0)
SELECT mesh, round(0.75 * (0.5 * (ln(1 + e) - me) / se + 0.5 * (ln(1 + n) - mn) / sn) + 0.25 * (0.5 * (ln(1 + x) - mx) / sx + 0.5 * (ln(1 + n) - mn) / sn), 6) AS activity FROM g, f""")
def activity_z_surface(spark, d):
    k = F.col("o_orderkey")
    g = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority").groupBy(F.col("o_custkey").alias("mesh"))
    g = g.agg(F.count("*").cast("double").alias("n"), F.count_distinct("o_orderpriority").cast("double").alias("e"), F.max(F.when(k % 7 != 0, k % 97)).cast("double").alias("x"))
    made = assemble.activity_surface(g, {"food": ("e", "n", 0.75, 0.5), "shopping": ("x", "n", 0.25, 0.5)}, F.col("mesh") % 2 == 0)
    return made.select("mesh", F.round("activity", 6).alias("activity"))


@query("""SELECT o_custkey, round(ln(1 + count(*)) + 0.5 * count(DISTINCT o_orderpriority) + 0.25 * (max(o_orderkey) % 10), 6) AS access FROM orders GROUP BY 1""")
def access_scores(spark, d):
    g = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority").groupBy("o_custkey").agg(F.count("*").alias("riders"), F.count_distinct("o_orderpriority").alias("routes"), (F.max("o_orderkey") % 10).alias("place"))
    return g.select("o_custkey", F.round(assemble.access_score(F.col("riders"), F.col("routes"), F.col("place"), (1.0, 0.5, 0.25)), 6).alias("access"))


@query("SELECT mesh, partition FROM (SELECT o_custkey AS mesh, CAST(11 + o_orderkey % 4 AS INTEGER) AS partition, min(o_orderkey) AS k FROM orders GROUP BY 1, 2) WHERE k % 23 < 5 AND k % 23 <> 4")
def open_review_cases(spark, d):
    c = components(spark, d)
    status = F.when(F.col("k") % 23 < 2, "open").when(F.col("k") % 23 >= 4, "resolved")
    return assemble.open_reviews(c.withColumn("status", status)).select("mesh", "partition")
