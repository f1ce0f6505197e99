"""Density surfaces, lasting peaks, basins and passes over customers on a grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import surface
from .carriers import lat, lat_sql, lon, lon_sql, query, read

BANDS = {"fine": 1.0, "middle": 1.5, "wide": 2.0}
_KERNEL = "kernel(band, dx, dy, w) AS (VALUES " + ", ".join(f"('{n}', {dx}, {dy}, {w})" for n, b in BANDS.items() for (dx, dy), w in surface.kernel(b).items()) + ")"
_CELLS = f"""cells AS (SELECT CAST(floor(({lon_sql('c_custkey')} - 139) * 40 + 1e-9) AS BIGINT) AS x, CAST(floor(({lat_sql('c_custkey')} - 35) * 40 + 1e-9) AS BIGINT) AS y, count(*) AS v FROM customer GROUP BY ALL)"""
_SURFACE = f"""{_KERNEL}, {_CELLS}, d AS (SELECT c.x, c.y, {', '.join(f"CAST(sum(s.v * w) FILTER (band = '{n}') AS BIGINT) AS {n}" for n in BANDS)} FROM cells c, kernel JOIN cells s ON s.x = c.x - dx AND s.y = c.y - dy GROUP BY ALL)"""
_STEPS = "step(dx, dy) AS (VALUES " + ", ".join(f"({dx}, {dy})" for dx, dy in [(0, 0), *surface.AROUND]) + ")"
_UP = """up AS (SELECT a.x, a.y, max(struct_pack(h := b.wide, x := b.x, y := b.y)) AS t FROM d a, step JOIN d b ON b.x = a.x + dx AND b.y = a.y + dy GROUP BY ALL)"""


def _surface(spark, d):
    k = F.col("c_custkey")
    at = lambda v, low: F.floor((v - low) * 40 + 1e-9).cast("long")
    cells = read(spark, d, "customer", "c_custkey").groupBy(at(lon(k), 139).alias("x"), at(lat(k), 35).alias("y")).agg(F.count("*").alias("v"))
    return surface.density(cells, "v", BANDS)


@query(f"WITH {_SURFACE} SELECT * FROM d")
def density_surface(spark, d):
    return _surface(spark, d)


_PEAKS = " UNION ALL ".join(f"SELECT {i} AS scale, a.x, a.y, CAST(a.{n} AS DOUBLE) AS height FROM d a WHERE NOT EXISTS (SELECT 1 FROM d b WHERE abs(b.x - a.x) <= 1 AND abs(b.y - a.y) <= 1 AND (b.{n}, b.x, b.y) > (a.{n}, a.x, a.y))" for i, n in enumerate(BANDS))


@query(f"""WITH {_SURFACE}, p AS ({_PEAKS}), anchor AS (SELECT s_suppkey % 40 AS x, s_suppkey * 7 % 40 AS y FROM supplier WHERE s_suppkey % 4 = 0),
t AS (SELECT *, EXISTS (SELECT 1 FROM p q WHERE abs(q.scale - p.scale) = 1 AND abs(q.x - p.x) <= 1 AND abs(q.y - p.y) <= 1) AS persists, EXISTS (SELECT 1 FROM anchor a WHERE abs(a.x - p.x) <= 1 AND abs(a.y - p.y) <= 1) AS anchored FROM p)
SELECT * FROM t WHERE persists OR anchored""")
def lasting_density_peaks(spark, d):
    s = F.col("s_suppkey")
    anchors = read(spark, d, "supplier", "s_suppkey").where("s_suppkey % 4 = 0").select((s % 40).alias("x"), (s * 7 % 40).alias("y"))
    return surface.lasting_peaks(surface.peaks(_surface(spark, d), list(BANDS)), 1, anchors)


_BASIN = """way AS (SELECT x, y, x AS px, y AS py FROM d UNION SELECT w.x, w.y, u.t.x, u.t.y FROM way w JOIN up u ON u.x = w.px AND u.y = w.py),
basin AS (SELECT w.x, w.y, px, py FROM way w JOIN up u ON u.x = px AND u.y = py WHERE u.t.x = px AND u.t.y = py)"""


@query(f"WITH RECURSIVE {_SURFACE}, {_STEPS}, {_UP}, {_BASIN} SELECT x, y, px AS peak_x, py AS peak_y FROM basin")
def density_basins(spark, d):
    return surface.basins(_surface(spark, d), "wide").select("cell.x", "cell.y", F.col("peak.x").alias("peak_x"), F.col("peak.y").alias("peak_y"))


@query(f"""WITH RECURSIVE {_SURFACE}, {_STEPS}, {_UP}, {_BASIN}, named AS (SELECT b.x, b.y, d.wide AS h, b.px * 1000 + b.py AS p FROM basin b JOIN d ON d.x = b.x AND d.y = b.y),
pass AS (SELECT a.p AS a, b.p AS b, max(least(a.h, b.h)) AS s FROM named a, step JOIN named b ON b.x = a.x + dx AND b.y = a.y + dy WHERE a.p <> b.p GROUP BY ALL),
peak AS (SELECT p, max(struct_pack(h := h, x := x, y := y)) AS top FROM named GROUP BY 1), levels AS (SELECT DISTINCT s FROM pass),
reach AS (SELECT s, p, p AS q FROM levels, peak UNION SELECT r.s, r.p, e.b FROM reach r JOIN pass e ON e.a = r.q AND e.s >= r.s),
drowned AS (SELECT r.p, max(r.s) AS saddle FROM reach r JOIN peak a ON a.p = r.p JOIN peak b ON b.p = r.q WHERE b.top > a.top GROUP BY 1)
SELECT top.x AS x, top.y AS y, top.h AS height, saddle, top.h - saddle AS prominence FROM peak LEFT JOIN drowned USING (p)""")
def density_merge_tree(spark, d):
    tree = surface.merge_tree(surface.basins(_surface(spark, d), "wide"))
    return tree.select("peak.x", "peak.y", F.col("peak.h").alias("height"), "saddle", (F.col("peak.h") - F.col("saddle")).alias("prominence"))
