"""Exact quantiles by counting, the monotone scale, places without values, and centres over versions."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lattica.operators import lineage, order_stats, ranking


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False) | st.sampled_from([0.0, 1.0, 1.0, 5e-324, -1.7e308, 1.7e308]), min_size=1, max_size=40))
def test_order_statistics_are_exact(spark, values):
    ranks = [0, len(values) // 2, len(values) - 1]
    assert order_stats.order_statistics(column(spark, [*values, None, math.nan]), F.col("v"), ranks) == [sorted(values)[r] for r in ranks]


def test_quantiles_of_a_long_tail(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "CUTS", 7)
    rnd = random.Random(1)
    values = [round(math.exp(rnd.gauss(0, 6)), 3) for _ in range(3000)] + [0.0] * 1500
    shares = [0, 0.01, 0.3, 0.5, 0.99, 1]
    assert np.allclose(order_stats.quantiles(column(spark, values), F.col("v"), shares), np.quantile(values, shares), rtol=1e-12)
    assert order_stats.quantiles(column(spark, [None, math.nan]), F.col("v"), [0.5]) is None
    with pytest.raises(ValueError):
        order_stats.order_statistics(column(spark, [1.0]), F.col("v"), [1])


def test_the_scale_is_monotone_and_knows_only_its_fold(spark):
    train = [0.0] * 30 + [float(i * i) for i in range(1, 31)]
    other = [-5.0, 0.0, 2.0, 100.0, 1e9, None, math.nan]
    rows = [(v, True) for v in train] + [(v, False) for v in other]
    df = spark.createDataFrame(rows, "v double, t boolean")
    got = order_stats.percent_scale(df, "v", F.col("t"), knots=11).collect()
    pairs = sorted((r["v"], r["score"]) for r in got if r["score"] is not None)
    assert all(a[1] <= b[1] for a, b in zip(pairs, pairs[1:], strict=False)) and pairs[-1] == (1e9, 100.0)
    alone = order_stats.percent_scale(df.where("t"), "v", F.col("t"), knots=11).collect()
    assert {(r["v"], r["score"]) for r in alone} <= set(pairs)
    assert sum(r["score"] is None for r in got) == 2 and {s for v, s in pairs if v <= 0} == {20.0}
    assert order_stats.percent_scale(df, "v", F.lit(False)).where("score is not null").count() == 0


@pytest.mark.parametrize("descending", [True, False])
def test_places_of_rows_without_a_value(spark, descending):
    rows = [(i, None if i % 3 else float(i % 4)) for i in range(40)]
    got = {r["id"]: r["place"] for r in ranking.places(spark.createDataFrame(rows, "id int, v double"), "v", "id", descending).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, 0 if r[1] is None else -r[1] if descending else r[1], r[0]))
    assert got == {r[0]: n for n, r in enumerate(order, 1)}


@pytest.fixture(scope="module")
def centres(spark):
    """Version 1 to 3: p goes on; q is cut into q1 and q2; r and s become t; u is named anew; v ends, w is new; x and y are both cut and joined."""
    old = {"p": range(0, 10), "q": range(10, 20), "r": range(20, 25), "s": range(25, 30), "u": range(30, 40), "v": range(40, 45), "x": range(50, 60), "y": range(60, 70)}
    new = {"p": range(0, 9), "q1": range(10, 15), "q2": range(15, 20), "t": range(20, 30), "u": range(30, 34), "w": range(45, 50), "x1": range(50, 55), "xy": [*range(55, 65)], "y1": range(65, 70)}
    last = {"p": range(0, 10), "z": [*range(10, 15), *range(20, 30)]}
    rows = [(v, c, cell, 1.0) for v, named in ((1, old), (2, new), (3, last)) for c, cells in named.items() for cell in cells]
    members = spark.createDataFrame(rows, "version int, center_id string, cell int, mass double")
    anchors = spark.createDataFrame([(v, c, min(cells)) for v, named in ((1, old), (2, new)) for c, cells in named.items()], "version int, center_id string, cell int")
    return members, lineage.lineage(members, anchors)


def test_lineage_by_hand(centres):
    got = {(r["version"], r["predecessor"], r["successor"]): r["relation"] for r in centres[1].collect()}
    assert got == {
        (2, "p", "p"): "continues", (2, "q", "q1"): "split_into", (2, "q", "q2"): "split_into", (2, "r", "t"): "merged_into", (2, "s", "t"): "merged_into", (2, "u", "u"): "reidentified_as",
        (2, "x", "x1"): "split_into", (2, "x", "xy"): "superseded_by", (2, "y", "xy"): "superseded_by", (2, "y", "y1"): "split_into", (3, "p", "p"): "continues", (3, "q1", "z"): "merged_into", (3, "t", "z"): "merged_into",
    }


def test_a_moved_anchor_ends_an_identity(spark, centres):
    moved = spark.createDataFrame([(1, "p", 9)], "version int, center_id string, cell int")
    got = lineage.lineage(centres[0], moved).where("version = 2 and predecessor = 'p'").collect()
    assert [r["relation"] for r in got] == ["reidentified_as"]


def test_ancestors_and_identities(centres):
    members, links = centres
    up = {(r["successor"], r["ancestor"], r["steps"]) for r in lineage.ancestors(links, 3).where("version = 3").collect()}
    assert up == {("p", "p", 1), ("p", "p", 2), ("z", "q1", 1), ("z", "t", 1), ("z", "q", 2), ("z", "r", 2), ("z", "s", 2)}
    who = {(r["version"], r["center_id"]): (r["first_version"], r["first_id"]) for r in lineage.identities(links, members).collect()}
    assert who[3, "p"] == (1, "p") and who[2, "u"] == (2, "u") and who[3, "z"] == (3, "z") and who[1, "v"] == (1, "v")
    assert len(who) == members.select("version", "center_id").distinct().count()
