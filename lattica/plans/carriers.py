"""Raw tokens, points and components derived from the driver tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def token(k: Column) -> Column:
    """A raw token of every kind, made from a key."""
    r = k % 23
    return F.when(r == 0, "X").when(r == 1, "...").when(r == 2, "-").when(r == 3, "").when(r == 4, "0").otherwise((k % 97).cast("string"))


def token_sql(k: str) -> str:
    return f"CASE ({k}) % 23 WHEN 0 THEN 'X' WHEN 1 THEN '...' WHEN 2 THEN '-' WHEN 3 THEN '' WHEN 4 THEN '0' ELSE CAST(({k}) % 97 AS VARCHAR) END"


def status_sql(t: str) -> str:
    return f"CASE WHEN {t} = '' THEN 'source_absent' WHEN {t} = 'X' THEN 'suppressed' WHEN {t} = '...' THEN 'not_surveyed' WHEN {t} = '-' THEN 'not_applicable' WHEN CAST({t} AS BIGINT) = 0 THEN 'observed_zero' ELSE 'observed' END"


def value_sql(t: str) -> str:
    return f"TRY_CAST({t} AS BIGINT)"


def lon(k: Column) -> Column:
    return F.lit(139.0) + (k * 7919) % 1000 / 1000.0


def lat(k: Column) -> Column:
    return F.lit(35.0) + (k * 104729) % 1000 / 1000.0


def lon_sql(k: str) -> str:
    return f"(139.0::DOUBLE + (({k}) * 7919) % 1000 / 1000.0::DOUBLE)"


def lat_sql(k: str) -> str:
    return f"(35.0::DOUBLE + (({k}) * 104729) % 1000 / 1000.0::DOUBLE)"


def haversine_sql(a: str, b: str, c: str, d: str) -> str:
    return f"(2 * 6371.0088 * asin(sqrt(pow(sin(radians(({d}) - ({b})) / 2), 2) + cos(radians({b})) * cos(radians({d})) * pow(sin(radians(({c}) - ({a})) / 2), 2))))"


def approx_sql(a: str, b: str, c: str, d: str, lat_km: str = "111.32") -> str:
    return f"sqrt(pow((({c}) - ({a})) * 111.32 * cos(radians((({b}) + ({d})) / 2)), 2) + pow((({d}) - ({b})) * {lat_km}, 2))"


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as components: mesh, partition, k, raw."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    c = o.groupBy(F.col("o_custkey").alias("mesh"), (11 + F.col("o_orderkey") % 4).cast("int").alias("partition")).agg(F.min("o_orderkey").alias("k"))
    return c.withColumn("raw", token(F.col("k")))


COMPONENTS_SQL = f"""comp AS (
  SELECT mesh, partition, k, {token_sql('k')} AS raw FROM (
    SELECT o_custkey AS mesh, CAST(11 + o_orderkey % 4 AS INTEGER) AS partition, min(o_orderkey) AS k
    FROM orders GROUP BY 1, 2)
), obs AS (SELECT *, {status_sql('raw')} AS status, {value_sql('raw')} AS value FROM comp)"""

#: The closed ring of the browse polygon.
POLYGON = [[139.15, 35.98], [139.78, 35.98], [140.0, 35.86], [140.30, 35.70], [140.33, 35.48], [139.73, 35.48], [139.73, 35.28], [139.35, 35.28], [139.15, 35.50], [139.15, 35.98]]
EDGES_SQL = "edges(x0, y0, x1, y1) AS (VALUES " + ", ".join(f"({p[0]}::DOUBLE, {p[1]}::DOUBLE, {q[0]}::DOUBLE, {q[1]}::DOUBLE)" for p, q in zip(POLYGON, POLYGON[1:], strict=False)) + ")"
INSIDE_SQL = """(SELECT bool_or(abs(side) < 1e-12 AND on_x AND on_y) OR count(*) FILTER (astride AND (side < 0) = (y1 > y0)) % 2 = 1
    FROM (SELECT y0, y1, (lon - x0) * (y1 - y0) - (lat - y0) * (x1 - x0) AS side, (y0 > lat) <> (y1 > lat) AS astride,
      lon BETWEEN least(x0, x1) AND greatest(x0, x1) AS on_x, lat BETWEEN least(y0, y1) AND greatest(y0, y1) AS on_y FROM edges))"""
