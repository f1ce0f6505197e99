"""Scales fitted on a fold, lineage over versions, and scores without each feature, over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lineage, model, order_stats
from .carriers import query, read


@query("""WITH q AS (SELECT unnest(range(21)) * 5.0 AS share, unnest(quantile_cont(c_acctbal, [0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1])) AS cut FROM customer WHERE c_custkey % 2 = 0),
p AS (SELECT cut, avg(share) AS share FROM q GROUP BY 1), seg AS (SELECT cut, share, lead(cut) OVER (ORDER BY cut) AS up, lead(share) OVER (ORDER BY cut) AS top FROM p)
SELECT c_custkey, round(CASE WHEN c_acctbal <= (SELECT min(cut) FROM p) THEN (SELECT share FROM p ORDER BY cut LIMIT 1) WHEN up IS NULL THEN share ELSE share + (top - share) * ((c_acctbal - cut) / (up - cut)) END, 5) AS score
FROM customer LEFT JOIN seg ON c_acctbal >= cut AND (c_acctbal < up OR up IS NULL)""")
def monotone_scores(spark, d):
    """A scale of 0 to 100 that the training fold alone decides."""
    made = order_stats.percent_scale(read(spark, d, "customer", "c_custkey", "c_acctbal"), "c_acctbal", F.col("c_custkey") % 2 == 0)
    return made.select("c_custkey", F.round("score", 5).alias("score"))


#: Cells are customers; a version's centres come from their nations, some joined, some cut in two.
_CENTRES = """m AS (
  SELECT 1 AS version, 'a' || c_nationkey AS center_id, c_custkey AS cell, abs(c_acctbal) + 1 AS mass FROM customer
  UNION ALL SELECT 2, CASE WHEN c_nationkey < 10 THEN 'b' || (c_nationkey // 2) WHEN c_nationkey < 15 THEN 'c' || c_nationkey || '_' || (c_custkey % 2) ELSE 'a' || c_nationkey END, c_custkey, abs(c_acctbal) + 1 FROM customer
  UNION ALL SELECT 5, CASE WHEN c_nationkey < 4 THEN 'd' || (c_custkey % 3) WHEN c_nationkey < 10 THEN 'b' || (c_nationkey // 2) WHEN c_nationkey < 15 THEN 'e' || c_nationkey WHEN c_nationkey < 20 THEN 'f' || c_nationkey ELSE 'a' || c_nationkey END, c_custkey, abs(c_acctbal) + 1
    FROM customer WHERE c_nationkey <> 24 AND (c_nationkey NOT BETWEEN 15 AND 19 OR c_custkey % 5 < 2)),
anchor AS (SELECT version, center_id, min(cell) AS cell FROM m GROUP BY ALL), size AS (SELECT version, center_id, count(*) AS n, sum(mass) AS t FROM m GROUP BY ALL),
pair AS (SELECT b.version, a.version AS earlier, a.center_id AS predecessor, b.center_id AS successor, count(*) AS n, sum(a.mass) AS am, sum(b.mass) AS bm FROM m a JOIN m b ON a.cell = b.cell AND a.version = CASE b.version WHEN 2 THEN 1 WHEN 5 THEN 2 END GROUP BY ALL),
edge AS (SELECT p.*, p.n / x.n AS oc, p.n / y.n AS nc, am / x.t AS om, bm / y.t AS nm FROM pair p JOIN size x ON x.version = earlier AND x.center_id = predecessor JOIN size y ON y.version = p.version AND y.center_id = successor WHERE am / x.t >= 0.5 OR bm / y.t >= 0.5),
told AS (SELECT version, earlier, predecessor, successor, CASE WHEN o > 1 AND i > 1 THEN 'superseded_by' WHEN o > 1 THEN 'split_into' WHEN i > 1 THEN 'merged_into' WHEN oc >= 0.5 AND nc >= 0.5 AND om >= 0.5 AND nm >= 0.5
    AND EXISTS (SELECT 1 FROM anchor k JOIN m h ON h.cell = k.cell WHERE k.version = e.earlier AND k.center_id = e.predecessor AND h.version = e.version AND h.center_id = e.successor) THEN 'continues' ELSE 'reidentified_as' END AS relation
  FROM (SELECT *, count(*) OVER (PARTITION BY version, predecessor) AS o, count(*) OVER (PARTITION BY version, successor) AS i FROM edge) e)"""


def _members(spark, d):
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    c = read(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    name = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    half = F.floor(n / 2)
    first = name("a", n)
    second = F.when(n < 10, name("b", half)).when(n < 15, name("c", n, "_", k % 2)).otherwise(name("a", n))
    third = F.when(n < 4, name("d", k % 3)).when(n < 10, name("b", half)).when(n < 15, name("e", n)).when(n < 20, name("f", n)).otherwise(name("a", n))
    rows = lambda df, version, who: df.select(F.lit(version).alias("version"), who.alias("center_id"), k.alias("cell"), (F.abs("c_acctbal") + 1).alias("mass"))
    return rows(c, 1, first).unionByName(rows(c, 2, second)).unionByName(rows(c.where((n != 24) & (~n.between(15, 19) | (k % 5 < 2))), 5, third))


def _lineage(spark, d):
    m = _members(spark, d)
    return m, lineage.lineage(m, m.groupBy("version", "center_id").agg(F.min("cell").alias("cell")))


@query(f"WITH {_CENTRES} SELECT * FROM told")
def center_lineage(spark, d):
    return _lineage(spark, d)[1]


@query(f"""WITH RECURSIVE {_CENTRES}, up AS (SELECT version, successor, predecessor AS ancestor, earlier AS ancestor_version, 1 AS steps FROM told
  UNION SELECT u.version, u.successor, t.predecessor, t.earlier, u.steps + 1 FROM up u JOIN told t ON t.version = u.ancestor_version AND t.successor = u.ancestor) SELECT * FROM up""")
def center_ancestors(spark, d):
    return lineage.ancestors(_lineage(spark, d)[1], versions=3)


@query(f"""WITH RECURSIVE {_CENTRES}, own AS (SELECT DISTINCT version, center_id FROM m), back AS (SELECT version, center_id, version AS first_version, center_id AS first_id FROM own
  UNION SELECT b.version, b.center_id, t.earlier, t.predecessor FROM back b JOIN told t ON t.version = b.first_version AND t.successor = b.first_id AND t.relation = 'continues')
SELECT version, center_id, min(first_version) AS first_version, arg_min(first_id, first_version) AS first_id FROM back GROUP BY ALL""")
def center_identities(spark, d):
    m, links = _lineage(spark, d)
    return lineage.identities(links, m)


WEIGHTS, THRESHOLDS = {"n": 0.5, "e": 0.3, "x": 0.2}, (5.0, 9.5, 14.0)
_VARIANTS = {"all": list(WEIGHTS)} | {f"-{k}": [c for c in WEIGHTS if c != k] for k in WEIGHTS}
_SCORES = ", ".join("0.0::DOUBLE" + "".join(f" + {c} * {WEIGHTS[c] * sum(WEIGHTS.values()) / sum(WEIGHTS[k] for k in cs)!r}::DOUBLE" for c in cs) + f" AS s{i}" for i, cs in enumerate(_VARIANTS.values()))
_STACKED = " UNION ALL ".join(f"SELECT '{name}' AS variant, o_custkey, s0 AS base, s{i} AS score, abs(rank() OVER (ORDER BY s{i} DESC) - rank() OVER (ORDER BY s0 DESC)) AS shift FROM sc" for i, name in enumerate(_VARIANTS))


@query(f"""WITH g AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n, CAST(count(DISTINCT o_orderpriority) AS DOUBLE) AS e, CAST(max(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 31 END) AS DOUBLE) AS x FROM orders GROUP BY 1),
sc AS (SELECT o_custkey, {_SCORES} FROM g WHERE x IS NOT NULL), st AS ({_STACKED})
SELECT variant, t AS threshold, count(*) AS rows, count(*) FILTER (score >= t AND base >= t) AS kept, count(*) FILTER (score >= t AND base < t) AS gained, count(*) FILTER (score < t AND base >= t) AS lost, round(avg(shift), 6) AS mean_shift, CAST(max(shift) AS INTEGER) AS most_shift
FROM st, (VALUES {', '.join(f'({t}::DOUBLE)' for t in THRESHOLDS)}) v(t) GROUP BY ALL""")
def score_without_each(spark, d):
    k = F.col("o_orderkey")
    g = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority").groupBy("o_custkey")
    g = g.agg(F.count("*").cast("double").alias("n"), F.count_distinct("o_orderpriority").cast("double").alias("e"), F.max(F.when(k % 7 != 0, k % 31)).cast("double").alias("x"))
    return model.leave_one_out(g, "o_custkey", WEIGHTS, THRESHOLDS).withColumn("mean_shift", F.round("mean_shift", 6))
