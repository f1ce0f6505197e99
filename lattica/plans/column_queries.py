"""Column expressions over the driver tables: tokens, keys, captions, outlines, comparable values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, text, tokens
from ..operators import explorer, ranking, screen
from ..sources import documents
from .carriers import components, lat, lat_sql, lon, lon_sql, query, read, status_sql, token, token_sql, value_sql
from .geo_queries import BOUNDS, CODED, PTS


@query(f"WITH t AS (SELECT o_orderkey, {token_sql('o_orderkey')} AS raw FROM orders) SELECT o_orderkey, raw AS employees_raw, {value_sql('raw')} AS employees_value, {status_sql('raw')} AS employees_status FROM t")
def metric_triplets_flat(spark, d):
    k = F.col("o_orderkey")
    o = read(spark, d, "orders", "o_orderkey").withColumn("obs", tokens.estat_count(token(k)))
    return o.select("o_orderkey", *tokens.triplet("employees", "obs")).withColumn("employees_value", F.col("employees_value").cast("long"))


@query("SELECT c_custkey, c_name AS operator, c_mktsegment AS route, CAST(c_nationkey AS VARCHAR) AS code FROM customer")
def key_parts(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    parts = text.split_key(text.composite_key(F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey")))
    return c.select("c_custkey", parts[0].alias("operator"), parts[1].alias("route"), parts[2].alias("code"))


@query(f"WITH {PTS}, {CODED}, {BOUNDS} SELECT c_custkey, 5 AS points, round(min_lon, 6) AS west, round(min_lat, 6) AS south, round(min_lon + 1.0 / 160, 6) AS east, round(min_lat + 1.0 / 240, 6) AS north, true AS closed FROM bounds")
def cell_outlines(spark, d):
    k = F.col("c_custkey")
    ring = geo.scope_outline("b")
    c = read(spark, d, "customer", "c_custkey").withColumn("b", geo.mesh_bounds(geo.mesh_code(lon(k), lat(k)))).select("c_custkey", ring.alias("ring"))
    at = lambda i, j: F.round(F.col("ring")[i][j], 6)
    return c.select("c_custkey", F.size("ring").alias("points"), at(0, 0).alias("west"), at(0, 1).alias("south"), at(2, 0).alias("east"), at(2, 1).alias("north"), (F.col("ring")[0] == F.col("ring")[4]).alias("closed"))


@query("SELECT o_custkey, 'op' || (o_custkey % 7) || ' / ' || string_agg(DISTINCT o_orderpriority, '・' ORDER BY o_orderpriority) AS caption FROM orders GROUP BY 1")
def station_captions(spark, d):
    o = read(spark, d, "orders", "o_custkey", "o_orderpriority").groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderpriority")).alias("routes"))
    return o.select("o_custkey", explorer.caption(F.concat(F.lit("op"), F.col("o_custkey") % 7), F.col("routes")).alias("caption"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT s_suppkey * 3 FROM supplier)")
def wanted_cells(spark, d):
    wanted = read(spark, d, "supplier", "s_suppkey").select((F.col("s_suppkey") * 3).alias("o_custkey"))
    return documents.wanted_meshes(read(spark, d, "orders", "o_orderkey", "o_custkey"), "o_custkey", wanted)


@query("""WITH c AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS keys FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN o_custkey % 2 = 0 THEN len(keys) >= 3 ELSE false END AS fits FROM c""")
def anchor_slice_matches(spark, d):
    """Whether the keys from the second on are the expected ones; odd chains expect a key that is not there."""
    c = read(spark, d, "orders", "o_custkey", "o_orderkey").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("keys"))
    wanted = F.when(F.col("o_custkey") % 2 == 0, F.slice("keys", 2, 2)).otherwise(F.array(F.lit(-1).cast("long")))
    full = F.when(F.size(wanted) == F.when(F.col("o_custkey") % 2 == 0, 2).otherwise(1), wanted)
    return c.select("o_custkey", screen.neighbours_match(F.col("keys"), F.lit(2), full).alias("fits"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS cleaned, c_custkey AS whole FROM customer")
def trimmed_and_whole(spark, d):
    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, F.lit(" 　\t")).otherwise(F.concat(F.lit("　 "), F.col("c_mktsegment"), F.lit(" \n")))
    return read(spark, d, "customer", "c_custkey", "c_mktsegment").select("c_custkey", tokens.clean_text(raw).alias("cleaned"), tokens.integral(k.cast("double")).alias("whole"))


@query(f"""WITH c AS (SELECT o_custkey AS mesh, o_orderkey % 4 AS part, min(o_orderkey) AS k FROM orders GROUP BY ALL), t AS (SELECT mesh, count(*) AS n, min(k) AS k FROM c GROUP BY 1), r AS (SELECT *, {token_sql('k')} AS raw FROM t)
SELECT mesh, CASE WHEN n = 1 AND {status_sql('raw')} IN ('observed', 'observed_zero') THEN {value_sql('raw')} END AS value FROM r""")
def comparable_values(spark, d):
    c = components(spark, d).groupBy("mesh").agg(F.collect_list("partition").alias("components"), F.collect_set("partition").alias("codes"), F.min("k").alias("k"))
    c = c.withColumn("obs", tokens.estat_count(token(F.col("k")))).select("mesh", "components", "codes", "obs.*")
    return c.select("mesh", explorer.comparable("components", "codes", "status", "value").cast("long").alias("value"))


@query(f"SELECT o_custkey, round(avg({lon_sql('o_orderkey')}), 6) AS lon, round(avg({lat_sql('o_orderkey')}), 6) AS lat FROM orders GROUP BY 1")
def centroids_of_points(spark, d):
    k = F.col("o_orderkey")
    o = read(spark, d, "orders", "o_custkey", "o_orderkey").groupBy("o_custkey").agg(F.collect_list(F.array(lon(k), lat(k))).alias("points")).withColumn("c", geo.centroid(F.col("points")))
    return o.select("o_custkey", F.round("c.lon", 6).alias("lon"), F.round("c.lat", 6).alias("lat"))


@query("""SELECT c_nationkey, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END DESC NULLS LAST, c_custkey) AS keys FROM customer GROUP BY 1""")
def deterministic_output_order(spark, d):
    """The order in which a table is written: values down, the unavailable last, ties by key."""
    from pyspark.sql import Window

    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal").withColumn("v", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")))
    at = F.row_number().over(Window.partitionBy("c_nationkey").orderBy(*ranking.nulls_last("v", True, "c_custkey")))
    keys = F.transform(F.array_sort(F.collect_list(F.struct("at", "c_custkey"))), lambda x: x["c_custkey"].cast("string"))
    return c.withColumn("at", at).groupBy("c_nationkey").agg(F.array_join(keys, ",").alias("keys"))
