"""Corridors built from names over the driver tables: chains, locks, cases for people, and states of corrections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import corridor, corridor_build
from ..operators.checkpoints import checkpointed
from .assembly_queries import _CHAIN_SQL, _stations
from .carriers import approx_sql, lat, lat_sql, lon, lon_sql, query, read

_BUILD_SQL = f"""records AS (SELECT 'k' || c_custkey AS source_key, c_nationkey % 5 AS operator, c_mktsegment AS route, 'n' || (c_custkey % 211) AS name,
    CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 4 = 0 THEN 'g' || c_custkey ELSE 'g' || (c_custkey % 211) END AS group_code, {lon_sql('c_custkey')} AS lon, {lat_sql('c_custkey')} AS lat FROM customer),
corridors AS (SELECT n_nationkey AS corridor, n_nationkey % 5 AS operator, CASE WHEN n_nationkey % 2 = 0 THEN ['AUTOMOBILE', 'BUILDING'] ELSE ['FURNITURE', 'MACHINERY', 'HOUSEHOLD'] END AS routes FROM nation),
stops AS (SELECT s_nationkey AS corridor, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INTEGER) AS place, 'n' || (s_suppkey * 13 % 211) AS name, CASE WHEN s_suppkey % 6 = 0 THEN 'BUILDING' END AS preferred, s_suppkey FROM supplier),
overrides AS (SELECT DISTINCT corridor, name, (corridor + 1) % 5 AS operator, 'MACHINERY' AS route FROM stops WHERE s_suppkey % 10 = 3),
asked AS (SELECT s.corridor, s.place, s.name, coalesce(o.operator, c.operator) AS operator, coalesce(s.preferred, o.route) AS preferred, c.routes, o.name IS NOT NULL AS extended
  FROM stops s JOIN corridors c USING (corridor) LEFT JOIN overrides o ON o.corridor = s.corridor AND o.name = s.name),
met AS (SELECT a.corridor, a.place, r.source_key, r.group_code, CASE WHEN r.route = a.preferred THEN 0 ELSE 1 END AS tier
  FROM asked a JOIN records r ON r.operator = a.operator AND r.name = a.name AND (r.route = a.preferred OR list_contains(a.routes, r.route))),
best AS (SELECT * FROM met QUALIFY tier = min(tier) OVER (PARTITION BY corridor, place)),
told AS (SELECT corridor, place, count(DISTINCT source_key) AS n, count(DISTINCT group_code) = 1 AND min(group_code) <> '' AS alike, min(source_key) AS k, string_agg(DISTINCT source_key, '+' ORDER BY source_key) AS candidates FROM best GROUP BY ALL),
chosen AS (SELECT a.*, candidates, CASE WHEN n IS NULL THEN 'unresolved_no_match' WHEN n > 1 AND NOT alike THEN 'unresolved_ambiguous' WHEN extended THEN 'confirmed_manual_extension' WHEN n > 1 THEN 'confirmed_same_group_seed' ELSE 'confirmed_source_route' END AS resolution,
    CASE WHEN n = 1 OR alike THEN k END AS source_key FROM asked a LEFT JOIN told t ON t.corridor = a.corridor AND t.place = a.place)"""


def _built(spark, d):
    k, n, s = F.col("c_custkey"), F.col("n_nationkey"), F.col("s_suppkey")
    number = lambda c: F.concat(F.lit("n"), c.cast("string"))
    customers = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    records = customers.select(
        F.concat(F.lit("k"), k.cast("string")).alias("source_key"), (F.col("c_nationkey") % 5).alias("operator"), F.col("c_mktsegment").alias("route"), number(k % 211).alias("name"),
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("g"), F.when(k % 4 == 0, k).otherwise(k % 211).cast("string"))).alias("group_code"), lon(k).alias("lon"), lat(k).alias("lat"),
    )
    routes = lambda *names: F.array(*map(F.lit, names))
    corridors = read(spark, d, "nation", "n_nationkey").select(n.alias("corridor"), (n % 5).alias("operator"), F.when(n % 2 == 0, routes("AUTOMOBILE", "BUILDING")).otherwise(routes("FURNITURE", "MACHINERY", "HOUSEHOLD")).alias("routes"))
    place = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    stops = read(spark, d, "supplier", "s_suppkey", "s_nationkey").select(F.col("s_nationkey").alias("corridor"), place.alias("place"), number(s * 13 % 211).alias("name"), F.when(s % 6 == 0, "BUILDING").alias("preferred"), "s_suppkey")
    overrides = stops.where("s_suppkey % 10 = 3").select("corridor", "name", ((F.col("corridor") + 1) % 5).alias("operator"), F.lit("MACHINERY").alias("route")).distinct()
    p = F.col("p_partkey")
    auxiliary = read(spark, d, "part", "p_partkey").select((p % 25).alias("corridor"), number(p % 211).alias("name"))
    return corridor_build.build_corridors(stops.drop("s_suppkey"), corridors, records, overrides, auxiliary)


@query(f"""WITH {_BUILD_SQL}, placed AS (SELECT c.*, r.group_code, r.lon, r.lat FROM chosen c JOIN records r USING (source_key)),
step AS (SELECT *, coalesce({approx_sql('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')}, 0) AS step FROM placed WINDOW w AS (PARTITION BY corridor ORDER BY place))
SELECT corridor, place, name, source_key, nullif(group_code, '') AS group_code, resolution, round(sum(step) OVER (PARTITION BY corridor ORDER BY place ROWS UNBOUNDED PRECEDING), 4) AS cumulative_km FROM step""")
def corridor_chain_built(spark, d):
    return _built(spark, d).chain.drop("lon", "lat").withColumn("cumulative_km", F.round("cumulative_km", 4))


_LINES_SQL = """lines AS (SELECT corridor, count(source_key) AS stations, count(*) FILTER (source_key IS NULL) AS unresolved, arg_min(name, place) AS first_name, arg_max(name, place) AS last_name,
    sha256(CAST(to_json(list(name ORDER BY place)) AS VARCHAR)) AS names_sha256, sha256(coalesce(CAST(to_json(list(source_key ORDER BY place) FILTER (source_key IS NOT NULL)) AS VARCHAR), '[]')) AS keys_sha256 FROM chosen GROUP BY 1)"""


@query(f"WITH {_BUILD_SQL}, {_LINES_SQL} SELECT * FROM lines")
def corridor_lines_built(spark, d):
    return _built(spark, d).lines


@query(f"""WITH {_BUILD_SQL}, {_LINES_SQL}, locks AS (
  SELECT n_nationkey AS corridor, CASE WHEN n_nationkey % 6 = 0 THEN 'open' ELSE 'confirmed_exact_segment' END AS decision, CASE WHEN n_nationkey % 7 = 0 THEN 'x' ELSE first_name END AS endpoint_start, last_name AS endpoint_end,
    stations + CASE WHEN n_nationkey % 5 = 0 THEN 1 ELSE 0 END AS station_count, CASE WHEN n_nationkey % 8 = 1 THEN '0' ELSE names_sha256 END AS names, CASE WHEN n_nationkey % 9 = 2 THEN '0' ELSE keys_sha256 END AS keys
  FROM nation LEFT JOIN lines ON corridor = n_nationkey WHERE n_nationkey < 24)
SELECT * FROM (SELECT coalesce(l.corridor, k.corridor) AS corridor, concat_ws('+', CASE WHEN k.corridor IS NULL THEN 'no_lock' END, CASE WHEN l.corridor IS NULL THEN 'not_built' END, CASE WHEN decision <> 'confirmed_exact_segment' THEN 'not_confirmed' END,
    CASE WHEN unresolved > 0 THEN 'incomplete' END, CASE WHEN l.corridor = k.corridor AND station_count IS DISTINCT FROM stations THEN 'count' END,
    CASE WHEN l.corridor = k.corridor AND (endpoint_start IS DISTINCT FROM first_name OR endpoint_end IS DISTINCT FROM last_name) THEN 'endpoints' END,
    CASE WHEN l.corridor IS NOT NULL AND names_sha256 IS DISTINCT FROM names THEN 'names_hash' END, CASE WHEN l.corridor IS NOT NULL AND keys_sha256 IS DISTINCT FROM keys THEN 'keys_hash' END) AS reasons
  FROM lines l FULL JOIN locks k ON l.corridor = k.corridor) WHERE reasons <> ''""")
def corridor_lock_faults(spark, d):
    lines = _built(spark, d).lines
    n = F.col("n_nationkey")
    made = read(spark, d, "nation", "n_nationkey").where("n_nationkey < 24").join(lines, F.col("corridor") == n, "left").drop("corridor")
    locks = made.select(
        n.alias("corridor"), F.when(n % 6 == 0, "open").otherwise(corridor_build.LOCKED).alias("decision"), F.when(n % 7 == 0, "x").otherwise(F.col("first_name")).alias("endpoint_start"), F.col("last_name").alias("endpoint_end"),
        (F.col("stations") + F.when(n % 5 == 0, 1).otherwise(0)).alias("station_count"),
    )
    hashes = made.select(n.alias("corridor"), F.when(n % 8 == 1, "0").otherwise(F.col("names_sha256")).alias("names_sha256"), F.when(n % 9 == 2, "0").otherwise(F.col("keys_sha256")).alias("keys_sha256"))
    return corridor_build.lock_faults(lines, locks, hashes)


@query(f"""WITH {_BUILD_SQL} SELECT DISTINCT * FROM (
  SELECT corridor, corridor || '|' || name AS source_key, 'no_match' AS issue_type, '' AS candidates, 'open' AS status FROM chosen WHERE resolution = 'unresolved_no_match'
  UNION ALL SELECT corridor, corridor || '|' || name, 'ambiguous_match', candidates, 'open' FROM chosen WHERE resolution = 'unresolved_ambiguous'
  UNION ALL SELECT corridor, source_key, 'merge_candidate', source_key, 'resolved' FROM chosen WHERE extended AND source_key IS NOT NULL)""")
def corridor_reviews_raised(spark, d):
    return _built(spark, d).reviews.withColumn("candidates", F.array_join("candidates", "+"))


@query(f"""WITH {_BUILD_SQL}, aux AS (SELECT DISTINCT p_partkey % 25 AS corridor, 'n' || (p_partkey % 211) AS name FROM part),
am AS (SELECT a.corridor, a.name, count(DISTINCT source_key) AS n, count(DISTINCT group_code) = 1 AND min(group_code) <> '' AS alike, min(source_key) AS source_key
  FROM aux a JOIN corridors c USING (corridor) JOIN records r ON r.operator = c.operator AND r.name = a.name AND list_contains(c.routes, r.route) GROUP BY ALL)
SELECT corridor, name, source_key, 'context_only' AS resolution FROM am WHERE n = 1 OR alike""")
def corridor_context_members(spark, d):
    return _built(spark, d).context


_STATES_SQL = f"""{_CHAIN_SQL}, fresh AS (SELECT * FROM pool p WHERE NOT EXISTS (SELECT 1 FROM chain c WHERE c.corridor = p.corridor AND (c.key = p.key OR c.name = p.name AND {approx_sql('p.lon', 'p.lat', 'c.lon', 'c.lat', '110.574')} <= 0.5))),
r AS (SELECT f.corridor, f.key, e.i, e.name AS after, e.nname AS before, ({approx_sql('e.lon', 'e.lat', 'f.lon', 'f.lat', '110.574')} + {approx_sql('f.lon', 'f.lat', 'e.nlon', 'e.nlat', '110.574')}) / nullif({approx_sql('e.lon', 'e.lat', 'e.nlon', 'e.nlat', '110.574')}, 0) AS ratio
  FROM fresh f JOIN edge e USING (corridor)),
gaps AS (SELECT corridor, key, after, before FROM (SELECT *, row_number() OVER (PARTITION BY corridor, key ORDER BY ratio, i) AS n FROM r WHERE ratio IS NOT NULL) WHERE n = 1 AND ratio <= 1.35),
ins AS (SELECT corridor, key, CASE WHEN key % 10 = 0 THEN 'elsewhere' ELSE after END AS after, before FROM gaps WHERE corridor IN (1, 2, 4) AND (key % 2 = 0 OR corridor = 2) UNION ALL SELECT corridor, key, name, name FROM chain WHERE corridor = 3 AND key % 50 < 20),
beside AS (SELECT corridor, key FROM pool WHERE key % 3 = 0 OR key % 7 = 0 OR corridor = 2 AND key % 5 = 1 OR corridor = 3 AND key % 2 = 1),
n AS (SELECT corridor, count(*) AS stations FROM chain GROUP BY 1), g AS (SELECT corridor, count(*) AS gaps FROM gaps GROUP BY 1), i AS (SELECT corridor, count(*) AS inserted FROM ins GROUP BY 1),
state AS (SELECT corridor, CASE corridor WHEN 1 THEN 'PENDING_OWNER_DECISION' WHEN 3 THEN 'APPLIED' ELSE 'PENDING_REGENERATION' END AS status, CAST(stations - corridor % 2 AS BIGINT) AS locked_count_before, CAST(stations - corridor % 2 + coalesce(inserted, 0) + CASE WHEN corridor = 4 THEN 1 ELSE 0 END AS BIGINT) AS corrected_count
  FROM n LEFT JOIN i USING (corridor) WHERE corridor > 0),
op AS (SELECT * FROM gaps g WHERE NOT EXISTS (SELECT 1 FROM beside b WHERE b.corridor = g.corridor AND b.key = g.key)),
und AS (SELECT * FROM op g WHERE NOT EXISTS (SELECT 1 FROM ins b WHERE b.corridor = g.corridor AND b.key = g.key)),
wait AS (SELECT ins.* FROM ins JOIN state USING (corridor) WHERE status <> 'APPLIED'),
une AS (SELECT * FROM op g WHERE NOT EXISTS (SELECT 1 FROM wait b WHERE b.corridor = g.corridor AND b.key = g.key)),
stand AS (SELECT * FROM ins WHERE EXISTS (SELECT 1 FROM chain c WHERE c.corridor = ins.corridor AND c.key = ins.key)),
mis AS (SELECT w.* FROM wait w LEFT JOIN gaps g ON g.corridor = w.corridor AND g.key = w.key WHERE w.after IS DISTINCT FROM g.after OR w.before IS DISTINCT FROM g.before),
c AS (SELECT corridor, stations, coalesce(gaps, 0) AS gaps, coalesce(inserted, 0) AS inserted, (SELECT count(*) FROM op WHERE op.corridor = n.corridor) AS open_gaps, (SELECT count(*) FROM und WHERE und.corridor = n.corridor) AS undecided, (SELECT count(*) FROM une WHERE une.corridor = n.corridor) AS unexplained,
    (SELECT count(*) FROM stand WHERE stand.corridor = n.corridor) AS standing, (SELECT count(*) FROM mis WHERE mis.corridor = n.corridor) AS misplaced FROM n LEFT JOIN g USING (corridor) LEFT JOIN i USING (corridor)),
t AS (SELECT c.*, status, locked_count_before, corrected_count, CASE WHEN open_gaps > 0 AND undecided > 0 THEN 'PENDING_OWNER_DECISION' WHEN open_gaps > 0 THEN 'PENDING_REGENERATION' WHEN inserted > 0 AND standing = inserted THEN 'APPLIED' ELSE 'COMPLETE' END AS derived FROM c LEFT JOIN state USING (corridor))"""


@query(f"""WITH {_STATES_SQL} SELECT corridor, stations, gaps, unexplained, status, derived, concat_ws('+', CASE WHEN unexplained > 0 THEN 'unexplained_gaps' END, CASE WHEN misplaced > 0 THEN 'insertion_not_detected' END,
  CASE WHEN status IS NOT NULL AND corrected_count <> locked_count_before + inserted THEN 'arithmetic' END, CASE WHEN status IS NOT NULL AND CASE WHEN status = 'APPLIED' THEN corrected_count ELSE locked_count_before END <> stations THEN 'count' END,
  CASE WHEN status = 'APPLIED' AND standing < inserted THEN 'insertion_missing' END, CASE WHEN status <> 'APPLIED' AND derived = 'APPLIED' THEN 'status_behind' END) AS reasons FROM t""")
def corridor_completeness_states(spark, d):
    named = lambda df: df.withColumnRenamed("key", "source_key")
    pool = named(_stations(read(spark, d, "customer", "c_nationkey", "c_custkey"), "c_nationkey", "c_custkey"))
    chain = named(_stations(read(spark, d, "supplier", "s_suppkey"), "s_suppkey", "s_suppkey")).withColumn("place", F.col("source_key"))
    gaps = checkpointed(corridor.corridor_gaps(pool, chain, "corridor", "source_key", "name", "place", "lon", "lat", 1.35))
    k, c = F.col("source_key"), F.col("corridor")
    waiting = gaps.where(c.isin(1, 2, 4) & ((k % 2 == 0) | (c == 2))).select("corridor", "source_key", F.when(k % 10 == 0, "elsewhere").otherwise(F.col("after")).alias("after"), "before")
    insertions = waiting.unionByName(chain.where((c == 3) & (k % 50 < 20)).select("corridor", "source_key", F.col("name").alias("after"), F.col("name").alias("before")))
    context = pool.where("source_key % 7 = 0")
    exclusions = pool.where((k % 3 == 0) | (c == 2) & (k % 5 == 1) | (c == 3) & (k % 2 == 1))
    counts = chain.where("corridor > 0").groupBy("corridor").agg(F.count("*").alias("stations")).join(insertions.groupBy("corridor").agg(F.count("*").alias("inserted")), "corridor", "left")
    before = F.col("stations") - c % 2
    corrections = counts.select("corridor", F.when(c == 1, corridor_build.PENDING[0]).when(c == 3, corridor_build.APPLIED).otherwise(corridor_build.PENDING[1]).alias("status"), before.alias("locked_count_before"), (before + F.coalesce("inserted", F.lit(0)) + F.when(c == 4, 1).otherwise(0)).alias("corrected_count"))
    return corridor_build.completeness(chain, pool, corrections, insertions, exclusions, context, 1.35)
