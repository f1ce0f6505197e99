"""Gates before publication on small tables, nulls and empty ones among them."""

import pytest
from pyspark.sql import functions as F

from lattica.operators import publication as p
from lattica.operators.constraints import GateError


def test_identities_that_are_not_whole_stop_publication(spark):
    rows = [(1, ["a"], "a", "S1", True), (2, ["a", "b"], "a", "S2", True), (3, ["a"], "", "S3", True), (4, ["a"], "a", "MISSING_4", False), (5, ["a"], "a", None, True), (6, [], None, "S6", True), (7, ["a"], "a", "S7", False), (8, None, "a", "S8", False)]
    r = p.identity_reasons(spark.createDataFrame(rows, "k int, names array<string>, name string, code string, i boolean"), ["names"], ["name"], "code")
    good, bad = p.publishable(r, F.col("i"), spark.createDataFrame([(4,), (7,), (7,), (99,)], "k int"), "k")
    assert {(x["k"], x["origin"]) for x in good.collect()} == {(1, "candidate"), (7, "retained")}
    assert {tuple(x) for x in bad.collect()} == {(2, "ambiguous_source_identity"), (3, "missing_identity_attribute"), (4, "missing_identity_attribute"), (5, "missing_identity_attribute"), (6, "ambiguous_source_identity+missing_identity_attribute")}


def test_a_group_has_one_hub(spark):
    rows = spark.createDataFrame([(1, "g1", "old"), (2, "g2", None), (3, "g3", None), (4, None, None)], "k int, station_group_id string, hub_id string")
    links = spark.createDataFrame([("g1", "h1"), ("g1", "h1"), ("g2", "h1"), ("g2", "h2"), (None, "h3")], "station_group_id string, hub_id string")
    got, several = p.attach_hubs(rows, links)
    assert {(r["k"], r["hub_id"]) for r in got.collect()} == {(1, "h1"), (2, None), (3, None), (4, None)} and [tuple(r) for r in several.collect()] == [("g2", 2)]
    assert p.attach_hubs(rows, links.limit(0))[0].where("hub_id is not null").count() == 0


def test_context_needs_approval_and_a_source(spark):
    items = spark.createDataFrame([(1, "s", True, "observed"), (2, "s", None, "observed"), (3, "x", True, "observed"), (4, "s", True, "symbol_unresolved"), (5, None, False, None), (6, "s", True, None)], "item int, source string, ok boolean, status string")
    shown, refused = p.approved_context(items, spark.createDataFrame([("s",)], "source string"), "source", "ok", "status")
    assert {r["item"] for r in shown.collect()} == {1, 6} and {tuple(r) for r in refused.collect()} == {(2, "not_approved"), (3, "source_missing"), (5, "not_approved+source_missing")}


def test_assertions_and_fan_out(spark):
    a = spark.createDataFrame([("w", ["1", "2"]), ("m", ["1", "9"]), ("e", []), ("n", None)], "assertion_id string, cases array<string>")
    assert {r["assertion_id"] for r in p.kept_assertions(a, spark.createDataFrame([("1",), ("2",)], "case_id string")).collect()} == {"w", "e", "n"}
    out, none = p.feature_fan_out(spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "key string, f int"), spark.createDataFrame([("a", "x"), ("a", "y")], "key string, t string"), "key")
    assert {(r["f"], r["t"]) for r in out.collect()} == {(1, "x"), (1, "y")} and [tuple(r) for r in none.collect()] == [("b", 2)]


def test_fan_out_by_blocks_is_the_join(spark):
    f = spark.range(40_000).selectExpr("case when id % 10 = 0 then null when id % 10 = 1 then 'b' else 'a' end key", "if(id % 7 = 0, null, id div 2) `f.x`", "map('m', id) m")
    walk = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), (None, "n"), ("c", "z")], "key string, t string")
    out, plain = p.feature_fan_out(f, walk, "key")[0], f.join(walk, "key")
    assert out.columns == plain.columns and out.dtypes == plain.dtypes
    text = lambda df: df.withColumn("m", F.col("m")["m"])
    assert out.count() == 32_000 * 3 and text(out).exceptAll(text(plain)).isEmpty() and text(plain).exceptAll(text(out)).isEmpty()
    assert p.feature_fan_out(f.limit(0), walk, "key")[0].isEmpty() and p.feature_fan_out(f, walk.limit(0), "key")[0].isEmpty()
    zero = spark.createDataFrame([(-0.0, 1), (0.0, 2)], "key double, f int")
    assert {(str(r["key"]), r["f"]) for r in p.feature_fan_out(zero, spark.createDataFrame([(0.0, "x")], "key double, t string"), "key")[0].collect()} == {("-0.0", 1), ("0.0", 2)}


def test_fan_out_puts_alike_values_together(spark):
    # features of 5 keys in turn, 4 rows of the crosswalk each: a value of the crosswalk that changes from row to row is written each time
    f, walk = spark.range(20_000).selectExpr("id % 5 key", "id f"), spark.range(20).selectExpr("id % 5 key", "id t")
    out = p.feature_fan_out(f, walk, "key")[0].select(F.spark_partition_id().alias("at"), "t").collect()
    assert len(out) == 80_000 and sum(a != b for a, b in zip(out, out[1:])) < len(out) / 10


def test_station_points(spark):
    walk = spark.createDataFrame([("c", "s1"), ("c", "s1"), ("d", "s9")], "corridor string, station string")
    points = spark.createDataFrame([("s1", 1.0, 2.0)], "station string, lon double, lat double")
    assert [tuple(r) for r in p.station_points(walk, points, F.col("corridor") == "c", "station", "lon", "lat").collect()] == [("s1", 1.0, 2.0)]
    for which in ("d", "nowhere"):
        with pytest.raises(GateError):
            p.station_points(walk, points, F.col("corridor") == which, "station", "lon", "lat")


def test_screens_that_would_find_nothing(spark):
    chain = spark.createDataFrame([("c", "k1", "r"), ("c", "k2", "q"), ("c", "k3", "q"), ("d", "k4", "r")], "corridor string, key string, route string")
    pool, filters = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "key string"), spark.createDataFrame([("c", "r"), ("d", "r")], "corridor string, route string")
    assert {tuple(r) for r in p.screen_faults(chain, pool, filters, "corridor", "key", ["corridor", "route"], F.col("key") == "k3").collect()} == {("c", "k2", "filter_misses"), ("d", "k4", "not_in_pool")}


def test_each_fault_of_a_component(spark):
    good = dict(observation_id="1", mesh="533945511", partition="11", raw_key="533945511", record_key="L:11:533945511", geometry_status=p.GEOMETRY, rollup_status=p.SEVERAL, reference_period="p", published_at="q", partition_count=2, partition_codes='["11","13"]', raw="5", value=5.0, status="observed")
    other = good | {"observation_id": "2", "partition": "13", "record_key": "L:13:533945511"}
    changes = {"raw_key": {"raw_key": None}, "record_key": {"record_key": "x"}, "geometry_status": {"geometry_status": ""}, "rollup_status": {"rollup_status": p.SINGLE}, "reference_period": {"reference_period": ""}, "published_at": {"published_at": None}, "partition_count": {"partition_count": 1}, "partition_codes": {"partition_codes": '["13","11"]'}, "m:value_with_missing_status": {"status": "suppressed"}}
    rows = [good, other]
    for i, (name, change) in enumerate(changes.items()):
        mesh = f"70000000{i}"
        for code in ("11", "13"):
            rows.append(good | {"observation_id": f"{name}-{code}", "mesh": mesh, "raw_key": mesh, "partition": code, "record_key": f"L:{code}:{mesh}"} | (change if code == "11" else {}))
    alone = good | {"observation_id": "a", "mesh": "12345678x", "raw_key": "12345678x", "partition": "47", "record_key": "L:47:12345678x", "partition_count": 1, "partition_codes": '["47"]', "rollup_status": p.SINGLE}
    twice = [good | {"observation_id": "t", "mesh": "600000001", "raw_key": "600000001", "record_key": "L:11:600000001", "partition_codes": '["11"]'}] * 2
    df = spark.createDataFrame([tuple(r.values()) for r in [*rows, alone, *twice]], ", ".join(f"{k} {'int' if k == 'partition_count' else 'double' if k == 'value' else 'string'}" for k in good))
    got = {}
    for r in p.mesh_component_faults(df, "L", ["11", "13"], {"m": ("raw", "value", "status")}).collect():
        got.setdefault(r["observation_id"], set()).add(r["reasons"])
    assert got == {f"{name}-11": {name} for name in changes} | {"a": {"mesh_key+partition"}, "t": {"partition_twice+observation_id"}}
