"""Acquisitions against audited sources, members against their lock, and reported figures against recomputed ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import locks
from .carriers import query, read

HOSTS = ("data.example.org", "mirror.example.org")

_ACQUIRED = """a AS (SELECT o_orderkey AS artifact_id, o_custkey % 40 AS source_id, 'r' || (o_custkey % 40) || CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END AS source_release_id, 't' || (o_orderkey % 3) AS table_id,
    CASE WHEN o_orderkey % 17 = 0 THEN 'http' ELSE 'https' END || '://data.example.org/' || (o_custkey % 40) || '/' || o_orderkey AS url,
    CASE WHEN o_orderkey % 19 = 0 THEN 'https://other.example.com/x' WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'https://mirror.example.org/' || o_orderkey END AS final_url,
    CASE WHEN o_orderkey % 29 = 0 THEN 404 WHEN o_orderkey % 31 = 0 THEN NULL ELSE 200 END AS status, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS content_length, o_custkey + CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END AS byte_size FROM orders),
s AS (SELECT s_suppkey AS source_id, 'r' || s_suppkey AS source_release_id, CASE WHEN s_suppkey % 4 = 0 THEN 't1' END AS table_id, 'https://data.example.org/' || s_suppkey || '/' AS url_prefix FROM supplier WHERE s_suppkey % 7 <> 0)"""


@query(f"""WITH {_ACQUIRED}
SELECT artifact_id, concat_ws('+', CASE WHEN s.source_id IS NULL THEN 'not_audited' END, CASE WHEN a.source_release_id <> s.source_release_id THEN 'release' END, CASE WHEN a.table_id <> s.table_id THEN 'table' END, CASE WHEN NOT starts_with(url, url_prefix) THEN 'url' END,
  CASE WHEN final_url IS NULL OR final_url LIKE '%other%' THEN 'host' END, CASE WHEN status IS DISTINCT FROM 200 THEN 'status' END, CASE WHEN content_length <> byte_size THEN 'content_length' END) AS reasons
FROM a LEFT JOIN s USING (source_id) WHERE reasons <> ''""")
def acquisition_audit(spark, d):
    k, c, s = F.col("o_orderkey"), F.col("o_custkey"), F.col("s_suppkey")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    a = read(spark, d, "orders", "o_orderkey", "o_custkey").select(
        k.alias("artifact_id"), (c % 40).alias("source_id"), text("r", c % 40, F.when(k % 11 == 0, "x").otherwise("")).alias("source_release_id"), text("t", k % 3).alias("table_id"),
        text(F.when(k % 17 == 0, "http").otherwise("https"), "://data.example.org/", c % 40, "/", k).alias("url"), F.when(k % 19 == 0, "https://other.example.com/x").when(k % 23 != 0, text("https://mirror.example.org/", k)).alias("final_url"),
        F.when(k % 29 == 0, 404).when(k % 31 != 0, 200).alias("status"), F.when(k % 2 == 0, c).alias("content_length"), (c + F.when(k % 37 == 0, 1).otherwise(0)).alias("byte_size"),
    )
    audited = read(spark, d, "supplier", "s_suppkey").where("s_suppkey % 7 <> 0").select(s.alias("source_id"), text("r", s).alias("source_release_id"), F.when(s % 4 == 0, "t1").alias("table_id"), text("https://data.example.org/", s, "/").alias("url_prefix"))
    return locks.acquisition_faults(a, audited, HOSTS)


@query("""WITH p AS (SELECT 'a' || l_orderkey AS path, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS sequence, l_partkey AS byte_size, l_suppkey AS crc, l_returnflag AS encoding FROM lineitem),
k AS (SELECT path, sequence + CASE WHEN path LIKE '%7' THEN 1 ELSE 0 END AS sequence, byte_size + CASE WHEN crc % 41 = 0 THEN 1 ELSE 0 END AS byte_size, crc, CASE WHEN byte_size % 43 = 0 THEN NULL ELSE encoding END AS encoding FROM p WHERE byte_size % 47 <> 0)
SELECT coalesce(p.path, k.path) AS path, CAST(coalesce(p.sequence, k.sequence) AS INTEGER) AS sequence, concat_ws('+', CASE WHEN p.path IS NULL THEN 'missing' END, CASE WHEN k.path IS NULL THEN 'not_locked' END, CASE WHEN p.path = k.path AND p.byte_size <> k.byte_size THEN 'byte_size' END,
  CASE WHEN p.path = k.path AND p.crc <> k.crc THEN 'crc' END, CASE WHEN p.path = k.path AND p.encoding IS DISTINCT FROM k.encoding THEN 'encoding' END) AS reasons FROM p FULL JOIN k ON p.path = k.path AND p.sequence = k.sequence WHERE reasons <> ''""")
def member_lock_drift(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    p = li.select(F.concat(F.lit("a"), "l_orderkey").alias("path"), F.row_number().over(w).alias("sequence"), F.col("l_partkey").alias("byte_size"), F.col("l_suppkey").alias("crc"), F.col("l_returnflag").alias("encoding"))
    lock = p.where("byte_size % 47 <> 0").select("path", (F.col("sequence") + F.when(F.col("path").endswith("7"), 1).otherwise(0)).alias("sequence"), (F.col("byte_size") + F.when(F.col("crc") % 41 == 0, 1).otherwise(0)).alias("byte_size"), "crc", F.when(F.col("byte_size") % 43 != 0, F.col("encoding")).alias("encoding"))
    return locks.member_lock_faults(p, lock, ("byte_size", "crc", "encoding"))


@query("""WITH c AS (SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS value FROM orders GROUP BY ALL), r AS (SELECT status, priority, value + CASE WHEN priority LIKE '1%' THEN 1 ELSE 0 END AS value FROM c WHERE NOT (status = 'F' AND priority LIKE '2%') UNION ALL SELECT 'X', '9', 4)
SELECT coalesce(c.status, r.status) AS status, coalesce(c.priority, r.priority) AS priority, r.value AS reported, c.value AS recomputed FROM c FULL JOIN r ON c.status = r.status AND c.priority = r.priority WHERE c.value IS DISTINCT FROM r.value""")
def report_summary_drift(spark, d):
    c = read(spark, d, "orders", "o_orderstatus", "o_orderpriority").groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("value"))
    told = c.where(~((F.col("status") == "F") & F.col("priority").startswith("2"))).withColumn("value", F.col("value") + F.when(F.col("priority").startswith("1"), 1).otherwise(0))
    return locks.summary_faults(told.unionByName(spark.createDataFrame([("X", "9", 4)], "status string, priority string, value long")), c, "status", "priority")
