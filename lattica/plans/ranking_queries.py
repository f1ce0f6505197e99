"""Totals, ranks, medians, boards, evaluation and read models over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tokens
from ..operators import constraints, evaluate, explorer, model, ranking
from ..streaming import events as stream
from .carriers import query, read, status_sql, token, token_sql, value_sql


def _status(t):
    o = tokens.estat_count(F.col(t))
    return o["value"].cast("long"), o["status"]


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN c THEN a + b + q END AS total, CASE WHEN c THEN 'observed' ELSE 'incomplete' END AS status, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS a, l_partkey AS b, l_suppkey AS q, l_partkey % 5 <> 0 AND l_suppkey % 7 <> 0 AS c FROM lineitem) GROUP BY ALL""")
def three_sector_complete_case(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey")
    a, b, q = F.col("l_quantity").cast("long"), F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey")), F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey"))
    out = li.select("l_orderkey", "l_linenumber", (a + b + q).alias("total"))
    return out.withColumn("status", F.when(F.col("total").isNotNull(), "observed").otherwise("incomplete")).groupBy("l_orderkey", "l_linenumber", "total", "status").agg(F.count("*").alias("n"))


_MEMBERS = f"members AS (SELECT p_partkey AS id, {value_sql('t')} AS value, {status_sql('t')} AS status FROM (SELECT p_partkey, {token_sql('p_partkey')} AS t FROM part))"
_ROSTER = """roster AS (SELECT p_brand AS area, p_partkey AS id FROM part WHERE p_partkey % 40 = 0 UNION ALL SELECT 'overlap', p_partkey FROM part WHERE p_partkey IN (40, 41) UNION ALL SELECT 'unknown', -1 UNION ALL SELECT 'unknown', 43
  UNION ALL SELECT 'twice', 44 UNION ALL SELECT 'twice', 44 UNION ALL SELECT 'empty', NULL)"""
_AREAS = f"""WITH {_MEMBERS}, {_ROSTER}, m AS (SELECT r.*, count(*) OVER (PARTITION BY area, id) AS same FROM roster r),
x AS (SELECT m.*, (SELECT count(DISTINCT area) FROM roster z WHERE z.id = m.id) AS areas, (SELECT count(*) FROM members z WHERE z.id = m.id) AS hits FROM m),
f AS (SELECT area, bool_or(id IS NULL OR same > 1 OR areas > 1 OR hits <> 1) AS blocked FROM x GROUP BY 1),
s AS (SELECT area, count(*) FILTER (status IN ('observed', 'observed_zero')) AS observed, count(*) AS expected, sum(value) AS total FROM (SELECT DISTINCT * FROM roster WHERE id IS NOT NULL) LEFT JOIN members USING (id) GROUP BY 1),
t AS (SELECT area, blocked, CAST(coalesce(observed, 0) AS BIGINT) AS observed, CAST(coalesce(expected, 0) AS BIGINT) AS expected, CASE WHEN NOT blocked AND observed = expected THEN CAST(total AS BIGINT) END AS total FROM f LEFT JOIN s USING (area))"""


def _areas(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand").withColumn("t", token(F.col("p_partkey")))
    v, s = _status("t")
    members = p.select(F.col("p_partkey").alias("id"), v.alias("value"), s.alias("status"))
    extra = spark.createDataFrame([("unknown", -1), ("unknown", 43), ("twice", 44), ("twice", 44), ("empty", None)], "area string, id long")
    roster = p.where("p_partkey % 40 = 0").select(F.col("p_brand").alias("area"), F.col("p_partkey").alias("id"))
    roster = roster.unionByName(p.where("p_partkey in (40, 41)").select(F.lit("overlap").alias("area"), F.col("p_partkey").alias("id"))).unionByName(extra)
    return roster, members


@query(f"{_AREAS} SELECT *, CASE WHEN total IS NOT NULL THEN CAST(rank() OVER (ORDER BY total DESC NULLS LAST) AS INTEGER) END AS rank FROM t")
def area_totals_ranked(spark, d):
    return ranking.area_totals(*_areas(spark, d), "area", "id", "value", "status")


@query(f"{_AREAS} SELECT area, blocked FROM t")
def overlapping_roster_blocked(spark, d):
    return ranking.roster_faults(*_areas(spark, d), "area", "id")


_SUP = f"sup AS (SELECT s_suppkey, {value_sql('t')} AS value FROM (SELECT s_suppkey, {token_sql('s_suppkey')} AS t FROM supplier))"


def _sup(spark, d):
    s = read(spark, d, "supplier", "s_suppkey").withColumn("t", token(F.col("s_suppkey")))
    return s.select("s_suppkey", _status("t")[0].alias("value"))


def _placed(df, descending):
    """Rank and place of every row, the unavailable last."""
    return ranking.places(ranking.competition_rank(df, "value", descending), "value", "s_suppkey", descending)


@query(f"WITH {_SUP} SELECT s_suppkey, value, CASE WHEN value IS NOT NULL THEN CAST(rank() OVER (ORDER BY value DESC NULLS LAST) AS INTEGER) END AS rank, CAST(row_number() OVER (ORDER BY value DESC NULLS LAST, s_suppkey) AS INTEGER) AS place FROM sup")
def rank_unavailable_last_desc(spark, d):
    return _placed(_sup(spark, d), True)


@query(f"WITH {_SUP} SELECT s_suppkey, value, CASE WHEN value IS NOT NULL THEN CAST(rank() OVER (ORDER BY value ASC NULLS LAST) AS INTEGER) END AS rank, CAST(row_number() OVER (ORDER BY value ASC NULLS LAST, s_suppkey) AS INTEGER) AS place FROM sup")
def rank_unavailable_last_asc(spark, d):
    return _placed(_sup(spark, d), False)


_FACTORS = {"retail": 1, "food": 7, "jobs": 13}
_CELLS = "cells AS (" + " UNION ALL ".join(f"SELECT c_nationkey AS route, c_custkey AS mesh, '{m}' AS metric, {value_sql('t')} AS v FROM (SELECT c_nationkey, c_custkey, {token_sql(f'c_custkey * {f}')} AS t FROM customer)" for m, f in _FACTORS.items()) + ")"
_MED = f"{_CELLS}, med AS (SELECT route, metric, median(v) AS median, count(v) AS with_value, count(*) AS cells FROM (SELECT route, metric, mesh, max(v) AS v FROM cells GROUP BY ALL) GROUP BY 1, 2)"


def _medians(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey")
    items = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), token(F.col("c_custkey") * f).alias("t")) for m, f in _FACTORS.items()]))
    c = c.select(F.col("c_nationkey").alias("route"), F.col("c_custkey").alias("mesh"), items.alias("i")).select("route", "mesh", "i.*")
    return ranking.route_medians(c.withColumn("v", _status("t")[0]), "route", "mesh", "metric", "v")


@query(f"""WITH {_MED}, r AS (SELECT *, rank() OVER (PARTITION BY metric ORDER BY median DESC NULLS LAST) AS rk FROM med)
SELECT route, CASE WHEN count(*) = 3 AND bool_and(median IS NOT NULL AND with_value >= 0.8 * cells) THEN round(avg(rk), 6) END AS mean_rank, round(min(with_value / cells), 6) AS least_coverage FROM r GROUP BY 1""")
def route_median_mean_rank(spark, d):
    r = ranking.mean_rank(_medians(spark, d), "route", "metric", 0.8)
    return r.select("route", F.round("mean_rank", 6).alias("mean_rank"), F.round("least_coverage", 6).alias("least_coverage"))


@query(f"WITH {_MED} SELECT route, metric, median, CAST(with_value AS BIGINT) AS with_value, CAST(cells AS BIGINT) AS cells FROM med")
def route_medians(spark, d):
    return _medians(spark, d)


@query(f"""SELECT c_mktsegment, median(v) AS median, CAST(count(v) AS BIGINT) AS with_value, CAST(count(*) AS BIGINT) AS cells FROM (SELECT c_mktsegment, {value_sql('t')} AS v FROM (SELECT c_mktsegment, {token_sql('c_custkey')} AS t FROM customer)) GROUP BY 1""")
def cohort_benchmark(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_mktsegment").withColumn("t", token(F.col("c_custkey"))).withColumn("v", _status("t")[0]).withColumn("metric", F.lit("m"))
    return ranking.route_medians(c, "c_mktsegment", "c_custkey", "metric", "v").drop("metric")


_AB = f"SELECT o_orderkey, {value_sql('ta')} AS a, {value_sql('tb')} AS b FROM (SELECT o_orderkey, {token_sql('o_orderkey')} AS ta, {token_sql('o_orderkey * 7')} AS tb FROM orders)"


def _ab(spark, d):
    o = read(spark, d, "orders", "o_orderkey").select("o_orderkey", token(F.col("o_orderkey")).alias("ta"), token(F.col("o_orderkey") * 7).alias("tb"))
    return o.select("o_orderkey", _status("ta")[0].alias("a"), _status("tb")[0].alias("b"))


@query(f"SELECT o_orderkey, round(a * 100.0::DOUBLE / nullif(a + b, 0), 6) AS a_share, round(b * 100.0::DOUBLE / nullif(a + b, 0), 6) AS b_share FROM ({_AB})")
def composition_share(spark, d):
    s = _ab(spark, d).select("o_orderkey", *ranking.composition("a", "b"))
    return s.select("o_orderkey", F.round("a_share", 6).alias("a_share"), F.round("b_share", 6).alias("b_share"))


@query(f"SELECT o_orderkey, CASE WHEN b > 0 AND a <= b AND o_orderkey % 4 <> 0 THEN round(a * 100.0::DOUBLE / b, 6) END AS share FROM ({_AB})")
def student_share_guarded(spark, d):
    return _ab(spark, d).select("o_orderkey", F.round(ranking.guarded_share("a", "b", F.col("o_orderkey") % 4 != 0), 6).alias("share"))


@query("SELECT o_custkey, o_orderkey, CAST(n AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 3")
def top3_peaks(spark, d):
    return ranking.top_k(read(spark, d, "orders", "o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], 3, F.col("o_totalprice").desc(), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "place")


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 10 OFFSET 20")
def page_slice(spark, d):
    return ranking.page(read(spark, d, "supplier", "s_suppkey", "s_name"), 3, 10, F.col("s_suppkey"))


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 30")
def first_rows(spark, d):
    return read(spark, d, "supplier", "s_suppkey", "s_name").orderBy("s_suppkey").limit(30)


@query("""SELECT c_custkey, array_to_string([x for x in l if x % 3 <> 0][1:4], ',') AS pins FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN [c_custkey % 7, c_custkey % 11 + 7, c_custkey % 5 + 20, c_custkey % 3 + 30, c_custkey % 13 + 40, c_custkey % 17 + 60] ELSE [c_custkey % 7, c_custkey % 11 + 7] END AS l FROM customer)""")
def pins_cap(spark, d):
    k = F.col("c_custkey")
    two = [k % 7, k % 11 + 7]
    ids = F.when(k % 2 == 0, F.array(*two, *two, k % 5 + 20, k % 3 + 30, k % 13 + 40, k % 17 + 60)).otherwise(F.array(*two, *two))
    known = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(100).cast("long")), lambda x: x % 3 != 0)
    return read(spark, d, "customer", "c_custkey").select("c_custkey", F.array_join(ranking.pins(ids, known).cast("array<string>"), ",").alias("pins"))


@query("""WITH r AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey = 7 THEN 0 WHEN c_custkey IN (11, 13) THEN 1 ELSE 2 END AS priority FROM customer)
SELECT c_custkey, c_nationkey, CAST(priority AS INTEGER) AS priority FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY priority, c_custkey) AS n FROM r) WHERE n = 1 OR priority < 2""")
def board_rows(spark, d):
    k = F.col("c_custkey")
    return ranking.board_rows(read(spark, d, "customer", "c_custkey", "c_nationkey"), k == 7, k.isin(11, 13), "c_nationkey", k)


@query("""SELECT p_partkey, p_brand, last_value(CASE WHEN p_partkey % 9 = 0 THEN p_type END IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS label FROM part""")
def forward_fill_label(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type").withColumn("l", F.when(F.col("p_partkey") % 9 == 0, F.col("p_type")))
    return ranking.fill_label(p, "p_brand", "p_partkey", "l", "label").select("p_partkey", "p_brand", "label")


@query("""SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN sqrt(c_acctbal / (SELECT max(c_acctbal) FROM customer)) * 20 ELSE 0 END, 6) AS radius, c_acctbal <= 0 AS empty FROM customer""")
def quantity_radius(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_acctbal")
    most = c.agg(F.coalesce(F.nullif(F.max("c_acctbal"), F.lit(0.0)), F.lit(1.0)).alias("m")).scalar()
    return c.select("c_custkey", F.round(ranking.quantity_radius(F.col("c_acctbal"), most), 6).alias("radius"), (F.col("c_acctbal") <= 0).alias("empty"))


@query("""SELECT p_partkey FROM part WHERE contains(lower(p_name || ' ' || p_type), 'a') AND contains(lower(p_name || ' ' || p_type), 'e') AND p_size IN (1, 2, 3, 5, 8) AND p_brand IN (SELECT p_brand FROM part WHERE p_partkey % 10 = 0) AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)""")
def search_filter_and(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type", "p_size", "p_brand")
    fav = read(spark, d, "lineitem", F.col("l_partkey").alias("p_partkey"), "l_quantity").where("l_quantity > 40")
    out = explorer.search(p, F.concat_ws(" ", "p_name", "p_type"), "A e", [1, 2, 3, 5, 8], "p_size", favourites=fav, key="p_partkey")
    return out.join(p.where("p_partkey % 10 = 0").select("p_brand"), "p_brand", "left_semi").select("p_partkey")


@query("SELECT DISTINCT p_brand FROM part WHERE p_partkey % 97 = 5")
def child_selects_group(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand")
    return explorer.child_selects_group(p.select("p_brand").distinct(), p, "p_brand", F.col("p_partkey") % 97 == 5)


@query("""SELECT 'customer' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_name AS label FROM customer WHERE contains(lower(c_name), '11') UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier WHERE contains(lower(s_name), '11') UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation WHERE contains(lower(n_name), '11')""")
def typed_suggestions(spark, d):
    return explorer.suggestions("11", customer=(read(spark, d, "customer"), "c_custkey", "c_name"), supplier=(read(spark, d, "supplier"), "s_suppkey", "s_name"), nation=(read(spark, d, "nation"), "n_nationkey", "n_name"))


@query(f"SELECT s_suppkey, value FROM ({_SUP[8:-1]}) WHERE value IS NOT NULL")
def available_by_map_metric(spark, d):
    return _sup(spark, d).where("value is not null")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def unknown_facet(spark, d):
    return explorer.unknown_facet(read(spark, d, "customer", "c_custkey"), read(spark, d, "orders", F.col("o_custkey").alias("c_custkey"), "o_orderpriority").where("o_orderpriority = '1-URGENT'"), "c_custkey")


@query(f"SELECT c_nationkey AS mesh, CAST(coalesce(max(v), -1) AS BIGINT) AS value, max(v) IS NULL AS missing FROM (SELECT c_nationkey, CASE WHEN c_nationkey % 6 <> 0 THEN {value_sql('t')} END AS v FROM (SELECT c_nationkey, {token_sql('c_custkey')} AS t FROM customer)) GROUP BY 1")
def quantity_features(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_nationkey").withColumn("t", token(F.col("c_custkey")))
    c = c.select(F.col("c_nationkey").alias("mesh"), F.when(F.col("c_nationkey") % 6 != 0, _status("t")[0]).alias("v"))
    return explorer.quantity_features(c, "mesh", "v")


@query(f"SELECT o_orderkey, CAST((a IS NOT NULL)::INT + (b IS NOT NULL)::INT AS INTEGER) AS coverage FROM ({_AB})")
def metric_coverage(spark, d):
    return _ab(spark, d).select("o_orderkey", explorer.metric_coverage(F.col("a"), F.col("b")).alias("coverage"))


@query("""SELECT l_orderkey, '[' || string_agg('{"line":' || l_linenumber || ',"part":' || l_partkey || '}', ',' ORDER BY l_linenumber, l_partkey) || ']' AS json FROM lineitem GROUP BY 1""")
def json_documents(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"))
    return explorer.document(li, "l_orderkey", "line", "part")


_GOLD = """cases AS (SELECT c_custkey AS case_id, CASE WHEN c_custkey % 4 = 0 THEN 'holdout' ELSE 'calibration' END AS split FROM customer),
pairs AS (SELECT c_custkey AS pair_index, 'scale' AS relation, c_custkey AS larger, c_custkey % 50 + 1 AS smaller FROM customer WHERE c_custkey % 3 = 0),
pred AS (SELECT c_custkey AS case_id, 'scale' AS relation, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS value, CASE WHEN c_acctbal > 0 THEN 'observed' ELSE 'suppressed' END AS status FROM customer WHERE c_custkey % 11 <> 0),
kept AS (SELECT * FROM pairs WHERE larger IN (SELECT case_id FROM cases WHERE split = 'calibration') AND smaller IN (SELECT case_id FROM cases WHERE split = 'calibration')),
res AS (SELECT p.pair_index, p.relation, p.larger, p.smaller, CASE WHEN a.value IS NULL OR b.value IS NULL THEN 'NOT_EVALUATED' WHEN a.value > b.value THEN 'PASS' ELSE 'FAIL' END AS status, a.value AS larger_value, b.value AS smaller_value,
  coalesce(a.status, 'prediction_or_metric_absent') AS larger_status, coalesce(b.status, 'prediction_or_metric_absent') AS smaller_status FROM kept p LEFT JOIN pred a ON a.case_id = p.larger LEFT JOIN pred b ON b.case_id = p.smaller)"""


def _golden(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_acctbal")
    k, v = F.col("c_custkey"), F.col("c_acctbal")
    cases = c.select(k.alias("case_id"), F.when(k % 4 == 0, "holdout").otherwise("calibration").alias("split"))
    pairs = c.where(k % 3 == 0).select(k.alias("pair_index"), F.lit("scale").alias("relation"), k.alias("larger"), (k % 50 + 1).alias("smaller"))
    pred = c.where(k % 11 != 0).select(k.alias("case_id"), F.lit("scale").alias("relation"), F.when(v >= 0, v).alias("value"), F.when(v > 0, "observed").otherwise("suppressed").alias("status"))
    return cases, pairs, pred


@query(f"WITH {_GOLD} SELECT * FROM res")
def golden_pairs(spark, d):
    cases, pairs, pred = _golden(spark, d)
    return evaluate.pair_status(evaluate.calibration_packet(cases, pairs)[1], pred)


@query(f"""WITH {_GOLD}, n AS (SELECT count(*) AS required, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'FAIL') AS failed FROM res)
SELECT CAST(required AS BIGINT) AS required, CAST(passed + failed AS BIGINT) AS evaluated, CAST(passed AS BIGINT) AS passed, CAST(failed AS BIGINT) AS failed, CAST(required - passed - failed AS BIGINT) AS missing, passed / required AS pass_rate, 0.85::DOUBLE AS minimum_pass_rate,
  CASE WHEN required = 0 OR passed + failed = 0 THEN 'NOT_EVALUATED' WHEN required > passed + failed THEN 'INCOMPLETE' WHEN passed / required >= 0.85 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM n""")
def golden_pair_report(spark, d):
    return evaluate.pair_report(golden_pairs(spark, d), 0.85)


@query(f"""WITH {_GOLD} SELECT p.case_id, p.relation, array_to_string(list_filter([CASE WHEN c.split <> 'calibration' THEN 'held_out_case' END, CASE WHEN p.status = 'suppressed' AND p.value IS NOT NULL THEN 'value_with_missing_status' END], lambda x: x IS NOT NULL), '+') AS reasons
FROM pred p JOIN cases c USING (case_id) WHERE c.split <> 'calibration' OR (p.status = 'suppressed' AND p.value IS NOT NULL)""")
def prediction_faults(spark, d):
    cases, _, pred = _golden(spark, d)
    return evaluate.payload_faults(pred, cases)


@query("SELECT user_id, event_type, max(ts) AS latest FROM events GROUP BY 1, 2")
def latest_event_per_key(spark, d):
    return read(spark, d, "events", "user_id", "event_type", "ts").groupBy("user_id", "event_type").agg(F.max("ts").alias("latest"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS value_sum FROM events GROUP BY 1, 2")
def event_tumbling_batch(spark, d):
    return stream.tumbling(read(spark, d, "events"), "1 hour").withColumn("value_sum", F.round("value_sum", 4))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS sess FROM g) SELECT user_id, min(ts) AS session_start, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY user_id, sess""")
def event_session_batch(spark, d):
    return stream.sessions(read(spark, d, "events"), "30 minutes")


@query("SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS quantity, CAST(grouping(l_returnflag) AS INTEGER) AS all_flags, CAST(grouping(l_linestatus) AS INTEGER) AS all_statuses FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")
def grouping_sets_extension(spark, d):
    read(spark, d, "lineitem").createOrReplaceTempView("grouping_lineitem")
    return spark.sql("SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS quantity, CAST(grouping(l_returnflag) AS INT) AS all_flags, CAST(grouping(l_linestatus) AS INT) AS all_statuses FROM grouping_lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")


@query("""WITH t AS (SELECT * FROM customer WHERE c_custkey % 2 = 0), q AS (SELECT quantile_cont(c_acctbal, 0.01) AS lo, quantile_cont(c_acctbal, 0.99) AS hi, median(c_acctbal) AS med FROM t),
m AS (SELECT median(abs(greatest(lo, least(hi, c_acctbal)) - med)) AS mad FROM t, q) SELECT c_custkey, round((greatest(lo, least(hi, c_acctbal)) - med) / nullif(mad, 0), 6) AS scaled FROM customer, q, m""")
def robust_activity(spark, d):
    s = model.robust_scale(read(spark, d, "customer", "c_custkey", "c_acctbal"), "c_acctbal", F.col("c_custkey") % 2 == 0)
    return s.select("c_custkey", F.round("scaled", 6).alias("scaled"))


@query("""SELECT c_custkey, round(percent_rank() OVER (ORDER BY c_acctbal) - percent_rank() OVER (ORDER BY c_nationkey), 6) AS gap FROM customer""")
def transport_town_gap(spark, d):
    g = model.percentile_gap(read(spark, d, "customer", "c_custkey", "c_acctbal", "c_nationkey"), "c_acctbal", "c_nationkey")
    return g.select("c_custkey", F.round("gap", 6).alias("gap"))


@query("SELECT p_partkey, round(0.6 * ln(1 + p_size) + 0.4 * ln(1 + p_retailprice), 6) AS activity, round(0.5 * p_size + 0.3 * p_retailprice + 0.2 * (p_partkey % 10), 6) AS core FROM part")
def activity_and_core(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_size", "p_retailprice")
    return p.select("p_partkey", F.round(model.activity(F.col("p_size"), F.col("p_retailprice")), 6).alias("activity"), F.round(model.core_scale(F.col("p_size"), F.col("p_retailprice"), F.col("p_partkey") % 10), 6).alias("core"))


@query("SELECT n_nationkey AS metric, CASE WHEN n_nationkey % 3 = 0 THEN 'access' ELSE 'scale' END AS domain FROM nation WHERE n_nationkey % 3 = 0 AND n_nationkey IN (0, 1, 2, 3, 4)")
def domain_isolation(spark, d):
    m = read(spark, d, "nation", "n_nationkey").select(F.col("n_nationkey").alias("metric"), F.when(F.col("n_nationkey") % 3 == 0, "access").otherwise("scale").alias("domain"))
    return constraints.domain_isolation(m, "metric", "domain", [0, 1, 2, 3, 4])
