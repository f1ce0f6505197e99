"""Faults that a review found: each test fails without its change."""

import pytest
from pyspark.sql import functions as F

from lattica.functions import geo, text, tokens
from lattica.operators import components
from lattica.operators.constraints import GateError
from lattica.sources import sinks


def test_a_null_identity_is_a_fault(spark):
    df = spark.createDataFrame([(None,), ("sta_" + "0" * 32,)], "i string")
    assert sorted(len(r[0]) for r in df.select(text.opaque_id_faults(F.col("i"), "sta_")).collect()) == [0, 2]


def test_the_stored_token_is_trimmed(spark):
    df = spark.createDataFrame([(" 1,234\u3000",), ("\t-\n",), (None,)], "t string")
    got = [tuple(r[0]) for r in df.select(tokens.estat_count(F.col("t"))).collect()]
    assert got == [("1,234", 1234, "observed"), ("-", None, "not_applicable"), (None, None, "source_absent")]


def test_a_null_status_is_missing(spark):
    df = spark.createDataFrame([(1, 1, 5, "observed"), (1, 2, 6, None), (2, 1, 7, "observed")], "k int, part int, v int, s string")
    got = {r["k"]: (r["total"], r["complete"], r["missing"]) for r in components.complete_case(df, ["k"], "v", "s", "part").collect()}
    assert got == {1: (None, False, "2:null"), 2: (7, True, "")}


def test_reports_are_not_cut(spark):
    assert sinks.markdown_table(spark.range(3), most=3).count("\n") == 5
    with pytest.raises(GateError):
        sinks.markdown_table(spark.range(4), most=3)


def test_a_table_stands_until_the_next_is_published(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    sinks.write_parquet(spark.range(3), path)
    sinks.write_parquet(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and not (tmp_path / "t.parquet.before").exists()
    with pytest.raises(GateError):
        sinks.write_parquet(spark.range(0), path)
    assert spark.read.parquet(path).count() == 5


def test_points_about_a_polygon(spark):
    """Corners, edges, and points beside them, of a ring with a notch."""
    ring = [[0, 0], [4, 0], [4, 4], [2, 2], [0, 4], [0, 0]]
    want = {(0.0, 0.0): True, (2.0, 0.0): True, (2.0, 2.0): True, (2.0, 2.1): False, (1.0, 2.9): True, (3.0, 3.1): False, (4.0, 4.0): True, (-0.1, 4.0): False, (1.0, 4.0): False, (3.0, 2.0): True, (4.1, 2.0): False, (2.0, -0.1): False}
    df = spark.createDataFrame(list(want), "lon double, lat double")
    assert {(r[0], r[1]): r[2] for r in df.select("lon", "lat", geo.inside(F.col("lon"), F.col("lat"), ring)).collect()} == want
