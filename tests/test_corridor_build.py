"""Corridors built by hand: how names resolve, locks, each state of a correction and each refusal."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lattica.operators import corridor_build as b


@pytest.fixture(scope="module")
def built(spark):
    records = spark.createDataFrame([
        ("k1", "o", "r", "A", "g1", 139.0, 35.0), ("k2", "o", "r", "B", "g2", 139.1, 35.0), ("k3", "o", "r2", "B", "g3", 139.2, 35.0), ("k5", "o", "r", "C", "g4", 139.2, 35.0), ("k4", "o", "r2", "C", "g4", 139.3, 35.0),
        ("k6", "o", "r", "D", "", 139.4, 35.0), ("k7", "o", "r2", "D", "", 139.4, 35.0), ("k8", "p", "q", "E", None, 139.5, 35.0), ("k9", "o", "z", "F", "g9", 139.6, 35.0), ("k0", "o", "r2", "X", "gx", 139.0, 36.0),
    ], "source_key string, operator string, route string, name string, group_code string, lon double, lat double")
    stops = spark.createDataFrame([
        ("c", 1, "A", None), ("c", 2, "B", "r2"), ("c", 3, "C", "none"), ("c", 4, "E", None), ("c", 5, "F", "z"),
        ("d", 1, "B", None), ("d", 2, "D", None), ("d", 3, "G", None), ("d", 4, "A", None),
    ], "corridor string, place int, name string, preferred string")
    corridors = spark.createDataFrame([("c", "o", ["r", "r2"]), ("d", "o", ["r", "r2"])], "corridor string, operator string, routes array<string>")
    overrides = spark.createDataFrame([("c", "E", "p", "q")], "corridor string, name string, operator string, route string")
    auxiliary = spark.createDataFrame([("c", "X"), ("c", "X"), ("c", "nowhere"), ("d", "D")], "corridor string, name string")
    return b.build_corridors(stops, corridors, records, overrides, auxiliary)


def test_names_resolve(built):
    chain = {(r["corridor"], r["name"]): (r["source_key"], r["resolution"]) for r in built.chain.collect()}
    assert chain == {
        ("c", "A"): ("k1", "confirmed_source_route"), ("c", "B"): ("k3", "confirmed_source_route"), ("c", "C"): ("k4", "confirmed_same_group_seed"), ("c", "E"): ("k8", "confirmed_manual_extension"),
        ("c", "F"): ("k9", "confirmed_source_route"), ("d", "A"): ("k1", "confirmed_source_route"),
    }
    reviews = {(r["corridor"], r["source_key"], r["issue_type"], tuple(r["candidates"]), r["status"]) for r in built.reviews.collect()}
    assert reviews == {("d", "d|B", "ambiguous_match", ("k2", "k3"), "open"), ("d", "d|D", "ambiguous_match", ("k6", "k7"), "open"), ("d", "d|G", "no_match", (), "open"), ("c", "k8", "merge_candidate", ("k8",), "resolved")}
    assert [tuple(r) for r in built.context.collect()] == [("c", "X", "k0", "context_only")]
    km = {r["name"]: r["cumulative_km"] for r in built.chain.where("corridor = 'c'").collect()}
    assert km["A"] == 0 and km["B"] < km["C"] < km["E"] < km["F"]


def test_locks_and_hashes(spark, built):
    sha = lambda x: hashlib.sha256(json.dumps(x, separators=(",", ":")).encode()).hexdigest()
    line = {r["corridor"]: r for r in built.lines.collect()}
    assert line["c"]["names_sha256"] == sha(list("ABCEF")) and line["c"]["keys_sha256"] == sha(["k1", "k3", "k4", "k8", "k9"])
    assert (line["d"]["stations"], line["d"]["unresolved"], line["d"]["first_name"], line["d"]["keys_sha256"]) == (1, 3, "B", sha(["k1"]))
    schema = "corridor string, decision string, endpoint_start string, endpoint_end string, station_count int"
    good = ("c", b.LOCKED, "A", "F", 5)
    faults = lambda rows, hashes=None: {tuple(r) for r in b.lock_faults(built.lines, spark.createDataFrame(rows, schema), hashes).collect()}
    assert faults([good]) == {("d", "no_lock+incomplete")}
    assert faults([("c", "open", "A", "E", 4), ("d", b.LOCKED, "B", "A", 4), ("e", b.LOCKED, "x", "y", 2)]) == {("c", "not_confirmed+count+endpoints"), ("d", "incomplete+count"), ("e", "not_built")}
    assert faults([good, ("d", b.LOCKED, "B", "A", 1)], built.lines.select("corridor", "names_sha256", F.lit("0").alias("keys_sha256")).where("corridor = 'c'")) == {("c", "keys_hash"), ("d", "incomplete+names_hash+keys_hash")}


STATE = "correction string, status string, owner_decision string, detour_ratio_max double, confirmation string, records array<struct<url:string,retrieved_at:string>>, exclusion_evidence string"
PAGE = [("https://example.org", "2026-01-01")]


@pytest.mark.parametrize(("row", "reasons"), [
    (("PENDING_OWNER_DECISION", "PENDING", 1.3, None, None, None), ""), (("PENDING_OWNER_DECISION", "DEC-0001", 1.3, None, None, None), "decided_while_waiting"),
    (("PENDING_REGENERATION", "DEC-0001", 1.25, None, None, None), ""), (("PENDING_REGENERATION", "PENDING", 1.3, None, None, None), "decision_id"), (("PENDING_REGENERATION", "DEC-0009", 1.3, None, None, None), "decision_not_registered"),
    (("APPLIED", "OWNER-2026-01-02-A-1", 1.35, "CONFIRMED", PAGE, "CONFIRMED"), ""), (("APPLIED", "DEC-0001", 1.36, "CONFIRMED", PAGE, "CONFIRMED"), "detour_ratio"), (("APPLIED", "DEC-0001", 1.3, "OPEN", PAGE, "CONFIRMED"), "not_confirmed"),
    (("APPLIED", "DEC-0001", 1.3, "CONFIRMED", [], "CONFIRMED"), "not_confirmed"), (("APPLIED", "DEC-0001", 1.3, "CONFIRMED", [("u", None)], "CONFIRMED"), "confirmation_without_url"),
    (("APPLIED", "DEC-0001", 1.3, "CONFIRMED", PAGE, None), "exclusion_not_confirmed"), (("DONE", None, None, None, None, None), "unknown_status+detour_ratio"), ((None, None, 1.3, None, None, None), "unknown_status"),
])
def test_a_status_is_borne_out(spark, row, reasons):
    register = spark.createDataFrame([("DEC-0001",), ("OWNER-2026-01-02-A-1",)], "decision string")
    got = b.state_faults(spark.createDataFrame([("x", *row)], STATE), register).collect()
    assert [r["reasons"] for r in got] == ([reasons] if reasons else [])


def test_pins(spark):
    pins = spark.createDataFrame([("c", "M", "kM", "s1", "g1"), ("c", "N", "kN", "s9", "g2"), ("c", "O", "kM", "s1", "g1"), ("d", "M", "kM", "s1", None)], "corridor string, name string, source_key string, station_id string, station_group_id string")
    pool = spark.createDataFrame([("kM", "M", "GM"), ("kN", "N", "GN")], "source_key string, name string, group_code string")
    registry = spark.createDataFrame([("station", "kM", "s1"), ("station", "kN", "s2"), ("station_group", "GM", "g1"), ("station_group", "GN", "g2")], "kind string, key string, id string")
    chain = spark.createDataFrame([("c", "M", "s1", "g1")], "corridor string, name string, station_id string, station_group_id string")
    got = {(r["corridor"], r["name"]): r["reasons"] for r in b.pin_faults(pins, pool, registry, chain, F.col("corridor") == "c").collect()}
    assert got == {("c", "N"): "station_id+not_reused", ("c", "O"): "no_such_record+not_reused", ("d", "M"): "station_group_id"}


def test_each_state_of_a_corridor(spark):
    """a is complete, b waits, c is decided, d is applied, e is behind, f leaves a gap unexplained."""
    line = [(c, i, n, f"{c}{n}", 139.0 + i / 10, 35.0) for c in "abcdef" for i, n in enumerate("PQRS")]
    line += [("d", 4, "T", "dT", 139.4, 35.0), ("e", 4, "T", "eT", 139.4, 35.0)]
    schema = "corridor string, place int, name string, source_key string, lon double, lat double"
    chain = spark.createDataFrame(line, schema)
    pool = spark.createDataFrame([*line, *[(c, 0, "M", f"{c}M", 139.15, 35.001) for c in "bcf"], ("a", 0, "M", "aM", 139.15, 35.001), ("a", 0, "Far", "aF", 139.0, 37.0)], schema).drop("place")
    corrections = spark.createDataFrame([("b", b.PENDING[0], 4, 4), ("c", b.PENDING[1], 4, 5), ("d", b.APPLIED, 4, 5), ("e", b.PENDING[1], 4, 5)], "corridor string, status string, locked_count_before int, corrected_count int")
    insertions = spark.createDataFrame([("c", "cM", "Q", "R"), ("d", "dT", "S", "U"), ("e", "eT", "S", "U")], "corridor string, source_key string, after string, before string")
    exclusions = spark.createDataFrame([("a", "aM")], "corridor string, source_key string")
    got = {r["corridor"]: (r["gaps"], r["unexplained"], r["derived"], r["reasons"]) for r in b.completeness(chain, pool, corrections, insertions, exclusions, exclusions.limit(0), 1.3).collect()}
    assert got == {
        "a": (1, 0, "COMPLETE", ""), "b": (1, 1, "PENDING_OWNER_DECISION", "unexplained_gaps"), "c": (1, 0, "PENDING_REGENERATION", ""), "d": (0, 0, "APPLIED", ""),
        "e": (0, 0, "APPLIED", "insertion_not_detected+count+status_behind"), "f": (1, 1, "PENDING_OWNER_DECISION", "unexplained_gaps"),
    }
