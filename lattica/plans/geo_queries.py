"""Mesh cells, distances, polygons, chains and screens over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import model, near, screen
from .carriers import EDGES_SQL, INSIDE_SQL, POLYGON, approx_sql, haversine_sql, lat, lat_sql, lon, lon_sql, query, read

PTS = f"pts AS (SELECT c_custkey, c_nationkey, {lon_sql('c_custkey')} AS lon, {lat_sql('c_custkey')} AS lat FROM customer)"
CODE = """lpad(CAST(s // 160 AS VARCHAR), 2, '0') || lpad(CAST(w // 160 AS VARCHAR), 2, '0') || CAST((s % 160) // 20 AS VARCHAR) || CAST((w % 160) // 20 AS VARCHAR)
  || CAST((s % 20) // 2 AS VARCHAR) || CAST((w % 20) // 2 AS VARCHAR) || CAST(1 + w % 2 + 2 * (s % 2) AS VARCHAR)"""
CODED = f"coded AS (SELECT *, {CODE} AS code FROM (SELECT *, CAST(floor(lat * 240 + 1e-8) AS BIGINT) AS s, CAST(floor((lon - 100) * 160 + 1e-8) AS BIGINT) AS w FROM pts))"
BOUNDS = """bounds AS (SELECT *, CAST(substr(code, 3, 2) AS INTEGER) + 100.0::DOUBLE + CAST(substr(code, 6, 1) AS INTEGER) / 8.0::DOUBLE + CAST(substr(code, 8, 1) AS INTEGER) / 80.0::DOUBLE + CASE WHEN substr(code, 9, 1) IN ('2', '4') THEN 1.0::DOUBLE / 160 ELSE 0 END AS min_lon,
  CAST(substr(code, 1, 2) AS INTEGER) / 1.5::DOUBLE + CAST(substr(code, 5, 1) AS INTEGER) / 12.0::DOUBLE + CAST(substr(code, 7, 1) AS INTEGER) / 120.0::DOUBLE + CASE WHEN substr(code, 9, 1) IN ('3', '4') THEN 1.0::DOUBLE / 240 ELSE 0 END AS min_lat FROM coded)"""


def points(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer", "c_custkey", "c_nationkey").withColumn("lon", lon(k)).withColumn("lat", lat(k))


@query(f"WITH {PTS}, {CODED} SELECT c_custkey, code FROM coded")
def mesh_code_of_point(spark, d):
    return points(spark, d).select("c_custkey", geo.mesh_code(F.col("lon"), F.col("lat")).alias("code"))


def _bounded(spark, d):
    return points(spark, d).withColumn("code", geo.mesh_code(F.col("lon"), F.col("lat"))).withColumn("b", geo.mesh_bounds(F.col("code")))


@query(f"WITH {PTS}, {CODED}, {BOUNDS} SELECT c_custkey, round(min_lon, 6) AS min_lon, round(min_lat, 6) AS min_lat, round(min_lon + 1.0 / 320, 6) AS mid_lon, round(min_lat + 1.0 / 480, 6) AS mid_lat FROM bounds")
def mesh_bounds_of_code(spark, d):
    mid = geo.cell_centre("b")
    r = lambda c, n: F.round(c, 6).alias(n)
    return _bounded(spark, d).select("c_custkey", r(F.col("b.min_lon"), "min_lon"), r(F.col("b.min_lat"), "min_lat"), r(mid[0], "mid_lon"), r(mid[1], "mid_lat"))


@query(f"WITH {PTS}, {CODED}, {BOUNDS} SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (lon < min_lon - 1e-9 OR lon >= min_lon + 1.0 / 160 + 1e-9 OR lat < min_lat - 1e-9 OR lat >= min_lat + 1.0 / 240 + 1e-9) AS BIGINT) AS outside FROM bounds")
def mesh_round_trip_violations(spark, d):
    x, y, b, e = F.col("lon"), F.col("lat"), F.col("b"), 1e-9
    out = (x < b["min_lon"] - e) | (x >= b["max_lon"] + e) | (y < b["min_lat"] - e) | (y >= b["max_lat"] + e)
    return _bounded(spark, d).agg(F.count("*").alias("rows"), F.count_if(out).alias("outside"))


SUP = "sup AS (SELECT s_suppkey, 139.0::DOUBLE + (s_suppkey * 613) % 1000 / 1000.0::DOUBLE AS x, 35.0::DOUBLE + (s_suppkey * 347) % 1000 / 1000.0::DOUBLE AS y FROM supplier)"


def anchors(spark, d):
    k = F.col("s_suppkey")
    return read(spark, d, "supplier", "s_suppkey").select("s_suppkey", (139.0 + k * 613 % 1000 / 1000.0).alias("x"), (35.0 + k * 347 % 1000 / 1000.0).alias("y"))


@query(f"WITH {PTS}, {SUP} SELECT c_custkey, round(min({haversine_sql('lon', 'lat', 'x', 'y')}), 6) AS km, min({haversine_sql('lon', 'lat', 'x', 'y')}) <= 5 AS near FROM pts, sup GROUP BY 1")
def haversine_nearest(spark, d):
    return nearest(points(spark, d), anchors(spark, d)).select("c_custkey", F.round("km", 6).alias("km"), (F.col("km") <= 5).alias("near"))


def nearest(pts, anchor):
    return near.nearest(pts, anchor, "c_custkey")


_SCOPE = """CASE WHEN pref IN ('11', '12', '13', '14') THEN 'display_domain' WHEN pref = '08' AND km <= 5 THEN 'tx_pilot_exception' ELSE 'adjacent_partition_untrimmed' END"""


@query(f"""WITH {PTS}, {SUP}, n AS (SELECT c_custkey, c_nationkey, min({haversine_sql('lon', 'lat', 'x', 'y')}) AS km FROM pts, sup GROUP BY ALL), p AS (SELECT *, lpad(CAST(8 + c_nationkey % 7 AS VARCHAR), 2, '0') AS pref FROM n)
SELECT c_custkey, {_SCOPE} AS scope_status, {_SCOPE} <> 'adjacent_partition_untrimmed' AS analysis_eligible,
  CASE {_SCOPE} WHEN 'display_domain' THEN 'not_required_display_partition' WHEN 'tx_pilot_exception' THEN 'tx_station_buffer_5km' ELSE 'requires_official_administrative_boundary_clip' END AS clip_status FROM p""")
def scope_classification(spark, d):
    pts = points(spark, d)
    n = nearest(pts, anchors(spark, d)).join(pts.select("c_custkey", "c_nationkey"), "c_custkey")
    n = n.withColumn("pref", F.lpad((8 + F.col("c_nationkey") % 7).cast("string"), 2, "0"))
    shown, exempt = F.col("pref").isin("11", "12", "13", "14"), (F.col("pref") == "08") & (F.col("km") <= 5)
    pick = lambda a, b, c: F.when(shown, a).when(exempt, b).otherwise(c)
    return n.select("c_custkey", pick("display_domain", "tx_pilot_exception", "adjacent_partition_untrimmed").alias("scope_status"), (shown | exempt).alias("analysis_eligible"), pick("not_required_display_partition", "tx_station_buffer_5km", "requires_official_administrative_boundary_clip").alias("clip_status"))


@query(f"WITH {PTS}, {EDGES_SQL} SELECT c_custkey, {INSIDE_SQL} AS inside FROM pts")
def point_in_polygon(spark, d):
    return points(spark, d).select("c_custkey", geo.inside(F.col("lon"), F.col("lat"), POLYGON).alias("inside"))


@query(f"""WITH {PTS}, {EDGES_SQL}, p AS (SELECT c_custkey, {INSIDE_SQL} AS i FROM pts)
SELECT c_custkey, CASE WHEN i THEN 'candidate' ELSE 'retained' END AS origin FROM p WHERE i OR c_custkey % 9 = 0""")
def retain_outside_scope(spark, d):
    p = points(spark, d)
    cands = p.where(geo.inside(F.col("lon"), F.col("lat"), POLYGON)).select("c_custkey")
    old = p.where("c_custkey % 9 = 0").select("c_custkey")
    return cands.withColumn("origin", F.lit("candidate")).unionByName(old.join(cands, "c_custkey", "left_anti").withColumn("origin", F.lit("retained")))


@query(f"WITH {PTS} SELECT c_nationkey, round(min(lon) - 0.003, 6) AS min_lon, round(min(lat) - 0.003, 6) AS min_lat, round(max(lon) + 0.003, 6) AS max_lon, round(max(lat) + 0.003, 6) AS max_lat FROM pts GROUP BY 1")
def route_boxes(spark, d):
    b = points(spark, d).groupBy("c_nationkey").agg(*geo.padded_box(F.col("lon"), F.col("lat")))
    return b.select("c_nationkey", *[F.round(c, 6).alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")])


@query(f"""WITH p AS (SELECT p_partkey, p_name, p_brand, {lon_sql('p_partkey')} AS lon, {lat_sql('p_partkey')} AS lat FROM part)
SELECT x.p_name AS name, x.p_partkey AS a, y.p_partkey AS b, round({approx_sql('x.lon', 'x.lat', 'y.lon', 'y.lat')}, 6) AS km FROM p x JOIN p y ON x.p_name = y.p_name AND x.p_partkey < y.p_partkey AND x.p_brand <> y.p_brand
WHERE {approx_sql('x.lon', 'x.lat', 'y.lon', 'y.lat')} <= 5""")
def near_collision_pairs(spark, d):
    k = F.col("p_partkey")
    p = read(spark, d, "part", "p_partkey", "p_name", "p_brand").withColumn("lon", lon(k)).withColumn("lat", lat(k))
    return screen.near_collisions(p, "p_partkey", "p_name", "p_brand", "lon", "lat", 5.0).withColumn("km", F.round("km", 6))


ROUTE = f"chain AS (SELECT *, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS seq FROM ({PTS[8:-1]}))"
#: Even customers are the chain, odd ones the records that it is screened for.
CHAIN = f"chain AS (SELECT *, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS seq FROM (SELECT * FROM ({PTS[8:-1]}) WHERE c_custkey % 2 = 0))"


def chain(spark, d):
    return screen.ordinals(points(spark, d).where("c_custkey % 2 = 0"), ["c_nationkey"], F.col("c_custkey"), name="seq")


@query(f"""WITH {ROUTE}, step AS (SELECT *, lag(lon) OVER w AS px, lag(lat) OVER w AS py FROM chain WINDOW w AS (PARTITION BY c_nationkey ORDER BY seq))
SELECT c_nationkey, seq, c_custkey, round(sum(coalesce({approx_sql('px', 'py', 'lon', 'lat')}, 0)) OVER (PARTITION BY c_nationkey ORDER BY seq), 6) AS cumulative_km FROM step""")
def chain_cumulative_km(spark, d):
    route = screen.ordinals(points(spark, d), ["c_nationkey"], F.col("c_custkey"), name="seq")
    return screen.cumulative_km(route, "c_nationkey", "seq", "lon", "lat").select("c_nationkey", "seq", "c_custkey", F.round("cumulative_km", 6).alias("cumulative_km"))


@query(f"""WITH {PTS}, {CHAIN}, edge AS (SELECT c_nationkey, seq AS edge_index, lon AS a, lat AS b, lead(lon) OVER w AS x, lead(lat) OVER w AS y FROM chain WINDOW w AS (PARTITION BY c_nationkey ORDER BY seq)),
r AS (SELECT p.c_custkey, edge_index, ({approx_sql('a', 'b', 'lon', 'lat', '110.574')} + {approx_sql('lon', 'lat', 'x', 'y', '110.574')}) / nullif({approx_sql('a', 'b', 'x', 'y', '110.574')}, 0) AS ratio FROM pts p JOIN edge e USING (c_nationkey) WHERE p.c_custkey % 2 = 1 AND x IS NOT NULL),
best AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY ratio, edge_index) AS n FROM r WHERE ratio IS NOT NULL)
SELECT c_custkey, round(ratio, 6) AS ratio, edge_index FROM best WHERE n = 1 AND ratio <= 1.3""")
def edge_detour_screen(spark, d):
    e = screen.edges(chain(spark, d), "c_nationkey", "seq", "lon", "lat").withColumnRenamed("seq", "edge_index")
    odd = points(spark, d).where("c_custkey % 2 = 1").select("c_nationkey", "c_custkey", F.col("lon").alias("qx"), F.col("lat").alias("qy"))
    return screen.detour_screen(odd, e, "c_nationkey", "c_custkey", "qx", "qy", 1.3).select("c_custkey", F.round("ratio", 6).alias("ratio"), "edge_index")


@query("""WITH f AS (SELECT user_id, event_id, value > 100 AS f, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
g AS (SELECT *, n - row_number() OVER (PARTITION BY user_id ORDER BY n) AS island FROM f WHERE f)
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY min(n)) AS INTEGER) AS run, CAST(count(*) AS BIGINT) AS length, arg_min(event_id, n) AS first_at, arg_max(event_id, n) AS last_at FROM g GROUP BY user_id, island""")
def unscreened_runs(spark, d):
    e = read(spark, d, "events", "user_id", "event_id", "ts", "value").withColumn("at", F.col("event_id"))
    return screen.runs(e, "user_id", [F.col("ts"), F.col("event_id")], F.col("value") > 100)


@query("""WITH n AS (SELECT user_id, event_id, event_type AS name, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_name, value FROM events),
f AS (SELECT *, lag(next_name) OVER (PARTITION BY user_id ORDER BY seq) AS before FROM n WHERE next_name IS NOT NULL AND value > 60),
g AS (SELECT *, sum(CASE WHEN before = name THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY seq) AS run FROM f)
SELECT user_id, CAST(run AS INTEGER) AS run, arg_min(name, seq) AS run_start, arg_max(next_name, seq) AS run_end, CAST(count(*) AS BIGINT) AS edges FROM g GROUP BY 1, 2""")
def runs_by_name(spark, d):
    e = screen.ordinals(read(spark, d, "events", "user_id", "event_id", "ts", "event_type", "value"), ["user_id"], F.col("ts"), F.col("event_id"), name="seq").withColumnRenamed("event_type", "name")
    return screen.named_runs(screen.edges(e, "user_id", "seq", "name", "value"), "user_id", "seq", F.col("value") > 60)


@query("""SELECT o_custkey, CAST(count(*) AS BIGINT) AS members, sha256('[' || string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) || ']') AS order_sha256 FROM orders GROUP BY 1""")
def segment_hash_lock(spark, d):
    o = screen.ordinals(read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey"), name="seq")
    return screen.order_lock(o, "o_custkey", "seq", "o_orderkey")


@query("""SELECT l_orderkey, CAST(max(n) AS INTEGER) AS lines, CAST(sum(n * l_partkey % 1009) AS BIGINT) AS ordinal_sum FROM (
  SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS n FROM lineitem) GROUP BY 1""")
def source_ordinal(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    li = screen.ordinals(li, ["l_orderkey"], *map(F.col, ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")), name="n")
    return li.groupBy("l_orderkey").agg(F.max("n").alias("lines"), F.sum(F.col("n").cast("long") * F.col("l_partkey") % 1009).alias("ordinal_sum"))


@query("""SELECT l_orderkey, l_linenumber, CAST(n AS INTEGER) AS expected_sequence, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n FROM lineitem) WHERE n <> l_linenumber GROUP BY ALL""")
def sequence_contiguity(spark, d):
    bad = screen.not_contiguous(read(spark, d, "lineitem", "l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber")
    return bad.groupBy("l_orderkey", "l_linenumber", "expected_sequence").agg(F.count("*").alias("n_rows"))


@query(f"""WITH {PTS}, {SUP} SELECT s_suppkey, CAST(coalesce(sum(CASE WHEN {haversine_sql('lon', 'lat', 'x', 'y')} <= 0.4 THEN c_custkey END), 0) AS BIGINT) AS within_400m,
  CAST(coalesce(sum(CASE WHEN {haversine_sql('lon', 'lat', 'x', 'y')} <= 0.8 THEN c_custkey END), 0) AS BIGINT) AS within_800m, CAST(coalesce(sum(CASE WHEN {haversine_sql('lon', 'lat', 'x', 'y')} <= 1.2 THEN c_custkey END), 0) AS BIGINT) AS within_1200m FROM sup, pts GROUP BY 1""")
def station_buffer(spark, d):
    s = anchors(spark, d).withColumnsRenamed({"x": "lon", "y": "lat"})
    return model.buffer_sums(points(spark, d).select("lon", "lat", "c_custkey"), s, "s_suppkey", "c_custkey", [0.4, 0.8, 1.2])


@query("""WITH RECURSIVE cells AS (SELECT DISTINCT c_custkey % 97 AS x, (c_custkey * 31) % 89 AS y FROM customer),
walk(x, y, rx, ry) AS (SELECT x, y, x, y FROM cells UNION SELECT c.x, c.y, w.rx, w.ry FROM walk w JOIN cells c ON abs(c.x - w.x) + abs(c.y - w.y) = 1)
SELECT x, y, min_x || ':' || min_y AS component FROM (SELECT x, y, min(rx) AS min_x, arg_min(ry, row(rx, ry)) AS min_y FROM walk GROUP BY 1, 2)""")
def connected_meshes(spark, d):
    c = read(spark, d, "customer", "c_custkey").select((F.col("c_custkey") % 97).alias("x"), (F.col("c_custkey") * 31 % 89).alias("y"))
    return model.connected_cells(c)


@query(f"""WITH {PTS}, {SUP}, n AS (SELECT c_custkey, min({haversine_sql('lon', 'lat', 'x', 'y')}) AS km FROM pts, sup GROUP BY 1)
SELECT t AS threshold, CAST(count(*) FILTER (km <= t) AS BIGINT) AS within, CAST(count(*) AS BIGINT) AS rows FROM n, (VALUES (2.5::DOUBLE), (5.0::DOUBLE), (10.0::DOUBLE)) v(t) GROUP BY 1""")
def threshold_sensitivity(spark, d):
    return model.sensitivity(nearest(points(spark, d), anchors(spark, d)), "km", [2.5, 5.0, 10.0])
