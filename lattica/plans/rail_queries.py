"""Rail sections cut at the boxes of the routes that run on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators.clip import clip_sections, line_feature
from .carriers import lat, lat_sql, lon, lon_sql, query, read

#: Sections from the items of an order, stations of a route about a supplier, both in SQL.
_SECTIONS = f"""xy AS (SELECT l_orderkey AS section, l_orderkey % 5 AS operator, l_linenumber AS n,
    {lon_sql('l_orderkey')} + l_linenumber * 0.02::DOUBLE + (l_partkey % 21 - 10) / 1000.0::DOUBLE AS x, {lat_sql('l_orderkey')} + (l_suppkey % 21 - 10) / 400.0::DOUBLE AS y FROM lineitem),
  dd AS (SELECT *, lag(x) OVER o AS px, lag(y) OVER o AS py FROM xy WINDOW o AS (PARTITION BY section ORDER BY n, x, y)),
  pt AS (SELECT *, CAST(row_number() OVER (PARTITION BY section ORDER BY n, x, y) AS INTEGER) - 1 AS i FROM dd WHERE px IS NULL OR x <> px OR y <> py),
  seg AS (SELECT section, operator, i, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM pt WINDOW w AS (PARTITION BY section ORDER BY i)),
  st AS (SELECT s_suppkey AS route, s_nationkey % 5 AS operator, {lon_sql('s_suppkey')} + k * 0.03::DOUBLE AS x, {lat_sql('s_suppkey')} + k % 2 * 0.04::DOUBLE AS y FROM supplier, range(3) AS r(k)),
  box AS (SELECT route, operator, min(x) - 0.003 AS a, min(y) - 0.003 AS b, max(x) + 0.003 AS c, max(y) + 0.003 AS d FROM st GROUP BY ALL)"""


def _six(v):
    """Rounded to six places as binary numbers are, like SQL; ``F.round`` goes by the decimal text, which differs where a seventh digit is five."""
    return F.round(v * 1e6, 0) / 1e6


def _clipped(spark, d):
    k = F.col("l_orderkey")
    at = F.struct(F.col("l_linenumber"), (lon(k) + F.col("l_linenumber") * 0.02 + (F.col("l_partkey") % 21 - 10) / 1000.0).alias("lon"), (lat(k) + (F.col("l_suppkey") % 21 - 10) / 400.0).alias("lat"))
    items = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    sections = items.groupBy(k.alias("section"), (k % 5).alias("operator")).agg(F.transform(F.array_sort(F.collect_list(at)), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("points"))
    s = F.col("s_suppkey")
    stops = read(spark, d, "supplier", "s_suppkey", "s_nationkey").select(s.alias("route"), (F.col("s_nationkey") % 5).alias("operator"), F.explode(F.array(*[F.struct((lon(s) + n * 0.03).alias("x"), (lat(s) + n % 2 * 0.04).alias("y")) for n in range(3)])).alias("p"))
    boxes = stops.groupBy("route", "operator").agg(*geo.padded_box(F.col("p.x"), F.col("p.y")))
    return clip_sections(sections, boxes, "section", "points", "route", ["operator"], cell=0.05, every=False)


@query(f"""WITH {_SECTIONS}, side AS (
  SELECT section, i, x0, y0, x1, y1, route, CASE WHEN x1 <> x0 THEN least((a - x0) / (x1 - x0), (c - x0) / (x1 - x0)) ELSE 0 END AS ex, CASE WHEN x1 <> x0 THEN greatest((a - x0) / (x1 - x0), (c - x0) / (x1 - x0)) ELSE 1 END AS lx,
    CASE WHEN y1 <> y0 THEN least((b - y0) / (y1 - y0), (d - y0) / (y1 - y0)) ELSE 0 END AS ey, CASE WHEN y1 <> y0 THEN greatest((b - y0) / (y1 - y0), (d - y0) / (y1 - y0)) ELSE 1 END AS ly
  FROM seg JOIN box ON seg.operator = box.operator AND x1 IS NOT NULL AND (x0 <> x1 OR x0 BETWEEN a AND c) AND (y0 <> y1 OR y0 BETWEEN b AND d)
), hit AS (SELECT *, greatest(0, ex, ey) AS t0, least(1, lx, ly) AS t1 FROM side WHERE greatest(0, ex, ey) <= least(1, lx, ly)),
ids AS (SELECT section, count(DISTINCT route) AS routes, min(route) AS first_route FROM hit GROUP BY 1),
far AS (SELECT *, max(i + t1) OVER (PARTITION BY section ORDER BY i, t0, t1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM hit WHERE t0 < t1),
run AS (SELECT *, sum(CASE WHEN i + t0 <= reached THEN 0 ELSE 1 END) OVER (PARTITION BY section ORDER BY i, t0, t1 ROWS UNBOUNDED PRECEDING) AS part FROM far),
ends AS (SELECT section, part, arg_min(x0 + (x1 - x0) * t0, i + t0) AS in_lon, arg_min(y0 + (y1 - y0) * t0, i + t0) AS in_lat, arg_max(x0 + (x1 - x0) * t1, i + t1) AS out_lon, arg_max(y0 + (y1 - y0) * t1, i + t1) AS out_lat, min(i + t0) AS s, max(i + t1) AS e FROM run GROUP BY ALL)
SELECT section, CAST(part - 1 AS INTEGER) AS part, CAST(2 + greatest(ceil(e) - 1 - floor(s), 0) AS INTEGER) AS points, round(in_lon, 6) AS in_lon, round(in_lat, 6) AS in_lat, round(out_lon, 6) AS out_lon, round(out_lat, 6) AS out_lat, CAST(routes AS INTEGER) AS routes, first_route
FROM ends JOIN ids USING (section)""")
def rail_sections_clipped(spark, d):
    parts = _clipped(spark, d).select("section", "boxes", "n_boxes", F.posexplode("parts").alias("part", "p"))
    first, last = F.get("p", F.lit(0)), F.element_at("p", -1)
    return parts.select(
        "section", "part", F.size("p").alias("points"), _six(first["lon"]).alias("in_lon"), _six(first["lat"]).alias("in_lat"), _six(last["lon"]).alias("out_lon"), _six(last["lat"]).alias("out_lat"),
        F.col("n_boxes").cast("int").alias("routes"), F.get("boxes", F.lit(0)).alias("first_route"),
    )


@query(f"""WITH {_SECTIONS}, side AS (
  SELECT section, i, route, CASE WHEN x1 <> x0 THEN least((a - x0) / (x1 - x0), (c - x0) / (x1 - x0)) ELSE 0 END AS ex, CASE WHEN x1 <> x0 THEN greatest((a - x0) / (x1 - x0), (c - x0) / (x1 - x0)) ELSE 1 END AS lx,
    CASE WHEN y1 <> y0 THEN least((b - y0) / (y1 - y0), (d - y0) / (y1 - y0)) ELSE 0 END AS ey, CASE WHEN y1 <> y0 THEN greatest((b - y0) / (y1 - y0), (d - y0) / (y1 - y0)) ELSE 1 END AS ly
  FROM seg JOIN box ON seg.operator = box.operator AND x1 IS NOT NULL AND (x0 <> x1 OR x0 BETWEEN a AND c) AND (y0 <> y1 OR y0 BETWEEN b AND d)
), hit AS (SELECT *, greatest(0, ex, ey) AS t0, least(1, lx, ly) AS t1 FROM side WHERE greatest(0, ex, ey) < least(1, lx, ly)),
far AS (SELECT *, max(i + t1) OVER (PARTITION BY section ORDER BY i, t0, t1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM hit),
n AS (SELECT section, count(*) FILTER (reached IS NULL OR i + t0 > reached) AS parts FROM far GROUP BY 1)
SELECT CASE WHEN parts = 1 THEN 'LineString' ELSE 'MultiLineString' END AS geometry, count(*) AS features, CAST(sum(parts) AS BIGINT) AS parts FROM n GROUP BY 1""")
def rail_features(spark, d):
    """The features as they are published, read back from their text."""
    text = _clipped(spark, d).select(line_feature(F.col("parts"), F.struct("section", F.col("boxes").alias("pilotRouteIds"))).alias("feature"))
    kind = F.get_json_object("feature", "$.geometry.type")
    lines = F.when(kind == "LineString", F.lit(1)).otherwise(F.json_array_length(F.get_json_object("feature", "$.geometry.coordinates")))
    return text.select(kind.alias("geometry"), lines.alias("n")).groupBy("geometry").agg(F.count("*").alias("features"), F.sum("n").alias("parts"))
