"""Typed merges of JSON, and every refusal of a submitted payload."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from lattica.functions import variant
from lattica.operators.submission import read_submissions

SHA, RELATIONS = "f" * 64, ["commercial_mass", "consumer_facing_mass"]


@pytest.mark.parametrize(("left", "right", "depth", "want"), [
    ('{"b":1,"a":{"x":true}}', '{"a":{"y":[1,null,2.5]}}', 1, '{"a":{"y":[1,null,2.5]},"b":1}'), ('{"b":1,"a":{"x":true}}', '{"a":{"y":"s"}}', 2, '{"a":{"x":true,"y":"s"},"b":1}'),
    ('{"a":{"b":{"c":1,"d":2}}}', '{"a":{"b":{"c":null}}}', 4, '{"a":{"b":{"c":null,"d":2}}}'), ('{"a":[1,2]}', '{"a":[3]}', 4, '{"a":[3]}'), ('{"a":{"b":1}}', '{"a":7}', 4, '{"a":7}'), ('{"a":7}', '{"a":{"b":1}}', 4, '{"a":{"b":1}}'),
    (None, '{"n":12345678901234567890}', 1, '{"n":12345678901234567890}'), ('{"é":"日本"}', None, 1, '{"é":"日本"}'), ("{}", "{}", 3, "{}"),
])
def test_merge(spark, left, right, depth, want):
    df = spark.createDataFrame([(left, right)], "l string, r string")
    assert df.select(variant.json_merge(F.col("l"), F.col("r"), depth).alias("m")).first()["m"] == want


@pytest.mark.parametrize("bad", ["{", '{"a":1,"a":2}', "nothing"])
def test_malformed_json_fails(spark, bad):
    with pytest.raises(Exception, match="MALFORMED|VARIANT|JSON"):
        spark.createDataFrame([(bad,)], "l string").select(variant.json_merge(F.col("l"), F.lit("{}"))).collect()


def test_kinds(spark):
    made = {"object": "{}", "list": "[]", "text": '"x"', "boolean": "true", "number": "1.5", "null": "null"}
    df = spark.createDataFrame([(k, v) for k, v in made.items()] + [(None, None)], "k string, v string").select("k", variant.kind(F.parse_json("v")).alias("got"))
    assert all(r["k"] == r["got"] for r in df.collect())


GOOD = {
    "registry_sha256": SHA, "model_run_id": "run", "model_version": "1", "model_artifact_sha256": "a" * 64,
    "metric_contracts": {r: {"definition": "d", "unit": "u", "reference_period": "p", "source_refs": ["x"]} for r in RELATIONS},
    "predictions": [{"golden_eval_id": "GE1", "metrics": {"commercial_mass": {"value": 2.5, "status": "observed"}, "consumer_facing_mass": {"value": None, "status": "suppressed"}}}, {"golden_eval_id": "GE2", "metrics": {"commercial_mass": {"value": 0, "status": "observed_zero"}}}],
}


def changed(*path, to):
    out = copy.deepcopy(GOOD)
    at = out
    for p in path[:-1]:
        at = at[p]
    if to is KeyError:
        del at[path[-1]]
    else:
        at[path[-1]] = to
    return out


O1 = ("predictions", 0, "metrics", "commercial_mass")
REFUSED = [
    ([], None, "no_object"), ("{", None, "no_object"), (None, None, "no_object"), (changed("registry_sha256", to="0"), None, "registry_hash"), (changed("model_run_id", to=" "), None, "model_run_id"), (changed("model_version", to=3), None, "model_version"),
    (changed("model_artifact_sha256", to="A" * 64), None, "model_artifact_sha256"), (changed("metric_contracts", RELATIONS[0], to=KeyError), None, "contracts"), (changed("metric_contracts", "more", to={}), None, "contracts"),
    (changed("metric_contracts", RELATIONS[1], "unit", to=""), None, "contract_consumer_facing_mass_unit"), (changed("metric_contracts", RELATIONS[0], "source_refs", to=[]), None, "contract_commercial_mass_source_refs"),
    (changed("metric_contracts", RELATIONS[0], "source_refs", to=["x", 1]), None, "contract_commercial_mass_source_refs"), (changed("predictions", to={}), None, "predictions"), (changed("predictions", 0, to="GE1"), None, "prediction_no_object"),
    (changed("predictions", 0, "golden_eval_id", to="GE9"), "GE9", "unknown_case"), (changed("predictions", 0, "golden_eval_id", to=1), None, "unknown_case"), (changed("predictions", 0, "golden_eval_id", to="GE3"), "GE3", "held_out_case"),
    (changed("predictions", 0, "golden_eval_id", to="GE2"), "GE2", "repeated"), (changed("predictions", 0, "run", to="x"), "GE1", "prediction_members"), (changed("predictions", 0, "metrics", to=[]), "GE1", "undeclared_metric"),
    (changed("predictions", 1, "metrics", "CoreScale", to={"value": 1, "status": "observed"}), "GE2", "undeclared_metric"), (changed(*O1, "unit", to="x"), "GE1", "commercial_mass:observation_members"), (changed(*O1, "status", to=1), "GE1", "commercial_mass:status_no_text+commercial_mass:value_with_missing_status"),
    (changed(*O1, "value", to=True), "GE1", "commercial_mass:not_a_count"), (changed(*O1, "value", to="2"), "GE1", "commercial_mass:not_a_count"), (changed(*O1, "value", to=-1), "GE1", "commercial_mass:not_a_count"), (changed(*O1, "value", to=None), "GE1", "commercial_mass:not_a_count"),
    (changed(*O1, "value", to=0), "GE1", "commercial_mass:zero_mismatch"), (changed("predictions", 1, "metrics", "commercial_mass", "value", to=1), "GE2", "commercial_mass:zero_mismatch"), (changed(*O1, "status", to="suppressed"), "GE1", "commercial_mass:value_with_missing_status"),
    (changed(*O1, to={"value": None, "status": "guessed"}), "GE1", "commercial_mass:unknown_status"), (changed(*O1, to=7), "GE1", "commercial_mass:observation_members+commercial_mass:status_no_text+commercial_mass:value_with_missing_status"),
]


def test_every_refusal_has_a_row(spark):
    rows = [(i, x if isinstance(x, str) or x is None else json.dumps(x)) for i, (x, _, _) in enumerate(REFUSED)] + [(99, json.dumps(GOOD))]
    cases = spark.createDataFrame([("GE1", "calibration"), ("GE2", "calibration"), ("GE3", "holdout")], "case_id string, split string")
    got = read_submissions(spark.createDataFrame(rows, "submission int, payload string"), cases, SHA, RELATIONS)
    faults = {}
    for r in got.faults.collect():
        faults.setdefault(r["submission"], set()).add((r["case_id"], r["reasons"]))
    for i, (_, case, reasons) in enumerate(REFUSED):
        assert any(c == case and set(reasons.split("+")) <= set(found.split("+")) for c, found in faults.get(i, ())), (i, reasons, faults.get(i))
    assert 99 not in faults
    assert {(r["submission"], r["case_id"], r["relation"], r["value"], r["status"]) for r in got.predictions.collect()} == {(99, "GE1", "commercial_mass", 2.5, "observed"), (99, "GE1", "consumer_facing_mass", None, "suppressed"), (99, "GE2", "commercial_mass", 0.0, "observed_zero")}
    assert [tuple(r) for r in got.runs.collect()] == [(99, "run", "1", "a" * 64)]
