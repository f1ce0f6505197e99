"""Guards of column expressions, and filters that reach the scan."""

import json

import pytest
from pyspark.sql import functions as F

from lattica.functions import geo, text, tokens
from lattica.operators import constraints
from lattica.operators.constraints import GateError
from lattica.sources import documents, sinks


def test_wanted_cells_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/cells"
    spark.range(10_000).select(F.col("id").alias("mesh"), (F.col("id") * 2).alias("v"), F.lit("x").alias("unused")).write.parquet(path)
    wanted = spark.createDataFrame([(5,), (7,), (7,), (None,), (99_999,)], "mesh long")
    got = documents.wanted_meshes(spark.read.parquet(path).select("mesh", "v"), "mesh", wanted)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(mesh" in plan and "unused" not in plan.split("ReadSchema")[1]
    assert {r["v"] for r in got.collect()} == {10, 14} == {r["v"] for r in documents.wanted_meshes(spark.read.parquet(path), "mesh", wanted, most=2).collect()}
    assert documents.wanted_meshes(spark.read.parquet(path), "mesh", wanted.limit(0)).count() == 0


def test_guards_fail(spark):
    df = spark.createDataFrame([(1.5, "a|b", None)], "v double, k string, p array<array<double>>")
    for column in (tokens.integral(F.col("v")), text.split_key(F.col("k")), geo.centroid(F.slice(F.array(F.array(F.lit(1.0), F.lit(2.0))), 1, 0))):
        with pytest.raises(Exception, match="not integral|malformed key|no coordinates"):
            df.select(column).collect()
    with pytest.raises(GateError, match="lacks columns"):
        constraints.require_columns(df, ["v", "w"])
    assert constraints.require_columns(df, ["v"]) is df
    with pytest.raises(GateError, match="is empty"):
        constraints.not_empty(df.limit(0))
    assert constraints.not_empty(df) is df


def test_json_csv_and_logs(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"a": {"b": [1, 2]}}, indent=1))
    assert documents.json_document(spark, f"{tmp_path}/d.json").select(F.explode("a.b").alias("x")).count() == 2
    (tmp_path / "f.csv").write_text("a,b\n1,x\n2,\n")
    assert [tuple(r) for r in documents.fixture_csv(spark, f"{tmp_path}/f.csv", "a int, b string").collect()] == [(1, "x"), (2, None)]
    rows = spark.createDataFrame([(1, "x"), (2, None)], "b int, a string")
    sinks.write_documents(rows, f"{tmp_path}/out")
    sinks.write_documents(rows.where("b = 1"), f"{tmp_path}/out")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/out").collect()] == ['{"a":"x","b":1}']
    for _ in range(2):
        sinks.append_events(rows, f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").count() == 4
    assert sinks.publish_yaml(f"{tmp_path}/m.yml", {"b": 1, "a": ["é"]}) and (tmp_path / "m.yml").read_text() == "b: 1\na:\n- é\n"
