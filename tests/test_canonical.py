"""The constraints of every canonical relation, one fault each; statuses and values as the dictionary settles them."""

import pytest
from pyspark.sql import types as T

from lattica.operators.canonical import canonical_faults, canonical_gate, conformed, row_checks
from lattica.operators.constraints import GateError
from lattica.schema import ENUMS, RELATIONS, VALUED, VALUELESS


def valid(name, n=1):
    """A row of ``name`` that satisfies everything, number ``n``."""
    r, row = RELATIONS[name], {}
    for f in r.columns:
        if f.name in r.refers:
            row[f.name] = key_of(r.refers[f.name]) if not f.nullable else None
        elif f.name in r.like:
            row[f.name] = r.like[f.name].replace("%", str(n))
        elif f.name in r.one_of:
            row[f.name] = ENUMS[r.one_of[f.name]][0]
        elif f.name in r.sizes:
            row[f.name] = f"{n:064d}"
        elif f.nullable:
            row[f.name] = None
        else:
            row[f.name] = {T.StringType: str(n)}.get(type(f.dataType), 1)
    if name == "feature_observation":
        row |= {"observation_status": "observed", "numeric_value": 1.0}
    if name == "station_line_membership":
        row["valid_from"] = str(n)
    if name == "center_lineage":
        row["successor_center_id"] = "ctr_2"
    return row


def key_of(name):
    return valid(name)[RELATIONS[name].key[0]]


def frame(spark, name, rows):
    columns = RELATIONS[name].columns
    free = T.StructType([T.StructField(f.name, f.dataType, True) for f in columns])
    return spark.createDataFrame([tuple(r[f.name] for f in columns) for r in rows], free)


@pytest.fixture(scope="module")
def world(spark):
    rows = {name: [valid(name)] for name in RELATIONS}
    rows["center"].append(valid("center", 2))
    return rows


def test_rows_that_satisfy_all_are_no_faults(spark, world):
    assert canonical_gate({n: frame(spark, n, rows) for n, rows in world.items()}) == {"canonical constraints": 0}
    assert canonical_faults({n: frame(spark, n, []) for n in ("hub", "station")}).count() == 0


def breaks(name):
    """(constraint, row) of each constraint of a row, of unique ones and of references."""
    r, n = RELATIONS[name], 100
    for f in r.columns:
        n += 1
        if not f.nullable:
            yield f"required:{f.name}", valid(name, n) | {f.name: None}
    wrong = {"like": {c: f"x{c}" for c in r.like}, "one_of": {c: "nothing" for c in r.one_of}, "length": {c: "ab" for c in r.sizes}, "least": {c: b - 1 for c, b in r.least.items()}, "share": {c: 1.5 for c in r.shares}, "flag": {c: 2 for c in r.flags}}
    for kind, columns in wrong.items():
        for c, value in columns.items():
            n += 1
            value = float(value) if isinstance(r.columns[c].dataType, T.DoubleType) else value
            yield f"{kind}:{c}", valid(name, n) | {c: value}
    for c in r.refers:
        n += 1
        yield f"refers:{c}", valid(name, n) | {c: "nowhere"}
    for rule, change in {"not_its_own_parent": {"parent_center_id": "ctr_900", "center_id": "ctr_900"}, "not_its_own_successor": {"successor_center_id": "ctr_1"}, "first_before_last": {"first_sequence": 2, "last_sequence": 1}, "known_status": {"observation_status": "guessed", "numeric_value": None}, "status_fits_value": {"numeric_value": 0.0}}.items():
        if rule in r.rules:
            yield f"rule:{rule}", valid(name, n + 1) | change
    for u in (r.key, *r.unique):
        n += 1
        again = valid(name, n)
        yield f"unique:{'+'.join(u)}", valid(name, n + 500) | {c: again[c] for c in u}
        yield "", again


@pytest.mark.parametrize("name", sorted(RELATIONS))
def test_every_constraint_finds_its_fault(spark, world, name):
    made = list(breaks(name))
    tables = {n: frame(spark, n, world[n]) for n in RELATIONS[name].refers.values()}
    tables[name] = frame(spark, name, [*world[name], *[row for _, row in made]])
    found = {(r["relation"], r["constraint"]) for r in canonical_faults(tables).collect()}
    assert {c for rel, c in found if rel == name} >= {c for c, _ in made if c}
    assert {c for c, _ in row_checks(RELATIONS[name]) if not c.startswith("type:")} <= {c for c, _ in made}


#: Every status with a value that is null, zero or positive, and whether the three together are an observation.
CASES = [(s, v, {"observed": v == 2.0, "observed_zero": v == 0.0}.get(s, v is not None if s in VALUED else v is None and s in VALUELESS)) for s in (*VALUED, *VALUELESS, "invalid", "guessed") for v in (None, 0.0, 2.0)]


def test_status_and_value(spark):
    rows = [valid("feature_observation", i) | {"observation_status": s, "numeric_value": v, "source_record_key": str(i)} for i, (s, v, _) in enumerate(CASES)]
    bad = {r["key"] for r in canonical_faults({"feature_observation": frame(spark, "feature_observation", rows)}).collect()}
    assert bad == {f"obs_{i}" for i, (_, _, good) in enumerate(CASES) if not good}


def test_nulls_types_and_tables_that_lack(spark, world):
    hub = frame(spark, "hub", [valid("hub")] * 3)
    assert [(r["constraint"], r["rows"]) for r in canonical_faults({"hub": hub}).collect()] == [("unique:hub_id", 3)]
    open_end = valid("station_line_membership") | {"valid_from": None}
    tables = {n: frame(spark, n, world[n]) for n in ("station", "line")} | {"station_line_membership": frame(spark, "station_line_membership", [open_end] * 2)}
    assert canonical_faults(tables).count() == 0
    text = frame(spark, "hub_station_group_link", [valid("hub_station_group_link")]).selectExpr("hub_id", "station_group_id", "'far' walking_distance_m", "evidence_json", "'0' is_manual", "1 extra")
    assert [r["constraint"] for r in canonical_faults({"hub_station_group_link": text}).collect()] == ["type:walking_distance_m"]
    assert conformed(text.drop("walking_distance_m").selectExpr("*", "'7' walking_distance_m"), "hub_station_group_link").schema.fieldNames() == RELATIONS["hub_station_group_link"].columns.fieldNames()
    for tables in ({"hub": hub.drop("created_at")}, {"hubs": hub}, {}):
        with pytest.raises(GateError):
            canonical_faults(tables).collect()
    with pytest.raises(GateError, match="unique:hub_id"):
        canonical_gate({"hub": hub})
