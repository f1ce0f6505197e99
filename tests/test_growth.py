"""Work that grows with the rows and not with the pairs of rows that are alike: rows that joins make, and what is broadcast."""

import duckdb
from pyspark.sql import functions as F

from lattica.operators import clip, corridor, identity, screen, submission
from lattica.plans import canonical_queries, rail_queries


def nodes(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    else:
        yield plan
        at = plan.children().iterator()
        while at.hasNext():
            yield from nodes(at.next())


def collected(df):
    """(rows, most rows that one join made)."""
    rows = df.collect()
    made = [p.metrics().get("numOutputRows") for p in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in p.nodeName()]
    return rows, max([m.get().value() for m in made if m.isDefined()], default=0)


def test_detours_of_records_and_edges_that_are_alike(spark):
    records = spark.range(300).select(F.lit(1).alias("c"), F.col("id").alias("r"), F.lit(139.5).alias("x"), F.lit(35.5).alias("y"))
    edge = spark.range(300).select(F.lit(1).alias("c"), F.col("id").alias("edge_index"), F.lit(139.0).alias("lon"), F.lit(35.5).alias("lat"), F.lit(140.0).alias("next_lon"), F.lit(35.5).alias("next_lat"))
    rows, most = collected(screen.detour_screen(records, edge, "c", "r", "x", "y", 1.3))
    assert sorted((r["r"], round(r["ratio"], 9), r["edge_index"]) for r in rows) == [(i, 1.0, 0) for i in range(300)]
    assert most <= 300


def test_gaps_of_a_pool_whose_places_repeat(spark):
    pool = spark.range(200).select(F.lit(1).alias("c"), (F.col("id") + 1000).alias("key"), F.lit("new").alias("name"), F.lit(139.5).alias("lon"), F.lit(35.5).alias("lat"))
    line = spark.range(200).select(F.lit(1).alias("c"), F.col("id").alias("key"), F.col("id").alias("seq"), F.when(F.col("id") == 7, "new").otherwise("s").alias("name"), (139.0 + F.col("id") % 2).alias("lon"), F.lit(35.5).alias("lat"))
    rows, most = collected(corridor.corridor_gaps(pool, line, "c", "key", "name", "seq", "lon", "lat", 1.2, km=5))
    assert len(rows) == 200 and most <= 200
    # a station of that name within reach keeps them out
    assert corridor.corridor_gaps(pool, line, "c", "key", "name", "seq", "lon", "lat", 1.2, km=50).isEmpty()


def test_near_collisions_broadcast_nothing(spark):
    df = spark.range(100).select("id", F.lit("n").alias("name"), (F.col("id") % 2).alias("g"), F.lit(139.0).alias("lon"), (35 + F.col("id") * 0.5).alias("lat"))
    found = screen.near_collisions(df.union(df.select(F.col("id") + 100, "name", 1 - F.col("g"), "lon", "lat")), "id", "name", "g", "lon", "lat", 1.0)
    assert len(found.collect()) == 100
    assert not [p for p in nodes(found._jdf.queryExecution().executedPlan()) if "Broadcast" in p.nodeName()]


def test_names_asked_for_often_and_held_often(spark):
    pool = spark.range(200).select(F.lit("n").alias("name"), F.when(F.col("id") < 3, "a").otherwise("b").alias("route"), "id", F.when(F.col("id") < 3, "g").otherwise("h").alias("grp"))
    wanted = spark.range(200).select(F.col("id").alias("row"), F.when(F.col("id") == 9, "none").otherwise("n").alias("name"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "c").alias("route"))
    rows, most = collected(identity.resolve_names(wanted, pool, ["name"], "route", "id", "grp", "row"))
    got = {r["row"]: (r["source_key"], r["resolution"], r["candidates"]) for r in rows}
    assert got[0] == (0, "confirmed", 3) and got[1] == got[2] == (None, "ambiguous", 200) and got[9] == (None, "no_match", 0)
    assert len(rows) == 200 and most <= 200


def test_decisions_do_not_carry_the_groups_of_a_hub(spark):
    links = spark.createDataFrame([("h", i) for i in range(500)] + [("s", 1), ("s", 2), ("s", 2), ("e", None)], "hub_key string, group_key long")
    said = [
        ("a", "confirm_hub", "s", [2, 1, 1]), ("b", "confirm_hub", "s", [1]), ("c", "confirm_hub", "h", [1, 2]), ("d", "confirm_hub", "x", [1]), ("e", "confirm_hub", "s", None), ("f", "confirm_hub", "e", []), ("g", "confirm_hub", "s", [1, None]),
        ("h", "resolve_duplicate", "h", None), ("i", "resolve_duplicate", "x", None), ("j", "reject_hub", None, [1, 2]), ("k", "reject_hub", None, [1, 900]), ("l", "reject_hub", None, []), ("m", None, "s", [499]), ("n", "confirm_hub", "s", [1, 3]),
    ]
    df = identity.replay_decisions(spark.createDataFrame(said, "source_key string, decision string, target_hub_key string, station_group_keys array<long>"), links)
    rows = df.collect()
    assert {r["source_key"]: r["agrees"] for r in rows} == dict(a=True, b=False, c=False, d=False, e=False, f=True, g=False, h=True, i=False, j=False, k=True, l=True, m=False, n=False)
    assert "collect_set" not in df._jdf.queryExecution().toString()


def test_sections_on_rectangles_that_are_alike(spark):
    sections = spark.range(50).select(F.col("id").alias("s"), F.lit(1).alias("k"), F.expr("array(named_struct('lon', 0.0d, 'lat', 0.5d), named_struct('lon', 3.0d, 'lat', 0.5d))").alias("p"))
    box = lambda df, x, first: df.select((F.col("id") + first).alias("b"), F.lit(1).alias("k"), F.lit(x).alias("min_lon"), F.lit(0.0).alias("min_lat"), F.lit(x + 0.5).alias("max_lon"), F.lit(1.0).alias("max_lat"))
    boxes = box(spark.range(40), 1.0, 10).union(box(spark.range(2), 2.0, 3))
    rows, most = collected(clip.clip_sections(sections, boxes, "s", "p", "b", ["k"], cell=5.0, every=False))
    assert len(rows) == 50 and {(tuple(r["boxes"]), r["n_boxes"], len(r["parts"])) for r in rows} == {((3, 10), 42, 2)}
    assert most <= 100
    whole = clip.clip_sections(sections, boxes, "s", "p", "b", ["k"], cell=5.0).collect()
    assert {tuple(r["boxes"]) for r in whole} == {(3, 4, *range(10, 50))}


def test_rounding_as_in_sql(spark):
    v = 35.863437499999996
    assert spark.range(1).select(rail_queries._six(F.lit(v)).alias("v")).first()["v"] == duckdb.sql(f"select round({v}::double, 6)").fetchall()[0][0] != round(v, 6)


def test_kinds_and_members_of_a_large_payload(spark):
    cases = spark.createDataFrame([("a", "calibration")], "case_id string, split string")
    payload = '{"registry_sha256":"h","predictions":[5,{"golden_eval_id":"a","metrics":{}},{"golden_eval_id":"a","metrics":{"m":{"value":1,"status":"guessed"}}},{"golden_eval_id":null,"metrics":3}]}'
    df = submission.read_submissions(spark.createDataFrame([(1, payload), (2, " [1]"), (3, "{")], "submission int, payload string"), cases, "h", ["m"]).faults
    got = {(r["submission"], r["case_id"]): r["reasons"] for r in df.collect()}
    assert got[(2, None)] == got[(3, None)] == "no_object"
    assert got[(1, "a")] == "m:not_a_count+m:unknown_status+repeated".replace("m:not_a_count+", "").replace("m:unknown_status", "m:unknown_status+m:value_with_missing_status")
    assert {"prediction_no_object", "undeclared_metric", "unknown_case", "contracts"} <= set(got[(1, None)].split("+"))
    # each payload is parsed in two passes at most: its head and its predictions
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parse_json") + df._jdf.queryExecution().optimizedPlan().toString().count("parseJson") <= 2


def test_relations_are_exploded_once(spark, sf):
    plan = canonical_queries.canonical_violations(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == len(canonical_queries.MADE)
