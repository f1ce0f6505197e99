"""Corridor gates and assembly on small tables."""

import pytest
from pyspark.sql import functions as F

from lattica.operators import assemble, constraints, corridor


@pytest.fixture(scope="module")
def chain(spark):
    return spark.createDataFrame([("a", i, n, f"k{n}") for i, n in enumerate("PQRST", 1)] + [("b", 1, "P", "kP"), ("b", 2, "Z", "kZ")], "corridor string, seq int, name string, key string")


def test_insertions_stand_in_order(spark, chain):
    blocks = spark.createDataFrame([("a", "Q", ["R", "S"], "T"), ("a", "P", ["R"], "S"), ("b", "Y", ["P"], "Z"), ("a", "S", ["T"], "U")], "corridor string, after string, stations array<string>, before string")
    got = {tuple(r) for r in corridor.insertion_faults(chain, blocks, "corridor", "seq", "name").collect()}
    assert got == {("a", "P", "not_in_order"), ("b", "Y", "anchor_missing"), ("a", "S", "not_in_order")}


def test_counts_of_a_correction(spark, chain):
    specs = spark.createDataFrame([("a", 5, 2, 7, True), ("b", 2, 1, 4, True), ("c", 0, 1, 1, False)], "corridor string, locked_count_before int, inserted int, corrected_count int, pending boolean")
    got = {tuple(r) for r in corridor.count_drift(chain, specs, "corridor", F.col("pending")).collect()}
    assert got == {("b", "arithmetic"), ("c", "corrected_count")}


def test_same_station_and_chain_keys_are_no_gaps(spark):
    line = spark.createDataFrame([("a", 1, "P", "kP", 139.0, 35.0), ("a", 2, "Q", "kQ", 139.1, 35.0), ("a", 3, "R", "kR", 139.2, 35.0)], "corridor string, seq int, name string, key string, lon double, lat double")
    pool = spark.createDataFrame([("a", "kP", "P", 139.0, 35.0), ("a", "k2", "Q", 139.101, 35.0), ("a", "k3", "M", 139.15, 35.001), ("a", "k4", "Far", 139.1, 36.0), ("a", "k5", "Q", 139.05, 35.0)], "corridor string, key string, name string, lon double, lat double")
    got = corridor.corridor_gaps(pool, line, "corridor", "key", "name", "seq", "lon", "lat", 1.2).collect()
    assert {(r["key"], r["after"], r["before"]) for r in got} == {("k3", "Q", "R"), ("k5", "P", "Q")}
    known = spark.createDataFrame([("a", "k3"), ("b", "k5")], "corridor string, key string")
    left = corridor.unexplained_gaps(corridor.corridor_gaps(pool, line, "corridor", "key", "name", "seq", "lon", "lat", 1.2), known, "corridor", "key")
    assert [r["key"] for r in left.collect()] == ["k5"]


def test_cut_at_a_named_station(spark, chain):
    assert corridor.upto_named(chain, "corridor", "seq", "name", "a", "R", expected=3).count() == 5
    for anchor, at in (("R", 4), ("Z", None)):
        with pytest.raises(constraints.GateError):
            corridor.upto_named(chain, "corridor", "seq", "name", "a", anchor, expected=at)


def test_composite_drift_with_null_keys(spark):
    left = spark.createDataFrame([(1, None, "x"), (1, 2, "y"), (2, 1, "z")], "a int, b int, v string")
    right = spark.createDataFrame([(1, None, "x"), (1, 2, None), (3, 1, "z")], "a int, b int, v string")
    got = {tuple(r) for r in constraints.drift(left, right, ["a", "b"], ["v"]).collect()}
    assert got == {(1, 2, "v"), (2, 1, "only_left"), (3, 1, "only_right")}


def test_flags_reviews_and_surfaces(spark):
    assert assemble.flag_faults({"m": {"a": [{"used": False}], "used": False}}, "used") == []
    assert len(assemble.flag_faults({"m": {}, "n": {"used": 0}, "o": {"x": {"used": True}}}, "used")) == 3
    cases = spark.createDataFrame([(1, "open"), (2, "resolved"), (3, None)], "id int, status string")
    assert sorted(r["id"] for r in assemble.open_reviews(cases).collect()) == [1, 3]
    rows = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 5.0)], "id int, e double, n double")
    got = {r["id"]: r["activity"] for r in assemble.activity_surface(rows, {"k": ("e", "n", 2.0, 0.5)}, F.col("id") < 3).collect()}
    assert got[3] is None and abs(got[1] + 1) < 1e-9 and abs(got[2] - 1) < 1e-9
