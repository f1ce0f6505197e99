import pytest
from pyspark.sql import functions as F

from lattica.functions import geo, text, tokens, variant


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())] if values else [(1,)], ", ".join(f"{k} {t}" for k, t in zip(values, ["string"] * len(values), strict=True)) or "x int")
    return row.select(column.alias("v")).first()["v"]


ESTAT = [("0", "observed_zero", 0), ("15", "observed", 15), ("1,234", "observed", 1234), ("X", "suppressed", None), ("x", "suppressed", None), ("...", "not_surveyed", None), ("-", "not_applicable", None), ("", "source_absent", None), ("　", "source_absent", None), (None, "source_absent", None)]


@pytest.mark.parametrize("raw,status,value", ESTAT)
def test_estat(spark, raw, status, value):
    got = one(spark, tokens.estat_count(F.col("r")), r=raw)
    assert got["status"] == status
    assert (got["value"] is None) if value is None else float(got["value"]) == value


@pytest.mark.parametrize("raw", ["abc", "-5", "1_000", "NaN"])
def test_unknown_token_fails(spark, raw):
    with pytest.raises(Exception, match="unknown count token"):
        one(spark, tokens.estat_count(F.col("r")), r=raw)
    assert one(spark, tokens.estat_count(F.col("r"), strict=False), r=raw)["status"] == "invalid"


@pytest.mark.parametrize("raw,existence,duplicate,status", [("", "3", "1", "not_public"), ("123", "1", "2", "duplicate_on_other_record"), ("", "4", "1", "station_absent"), ("9", "1", "3", "station_absent"), ("9", "2", "1", "source_absent"), ("9", "1", "1", "observed")])
def test_s12(spark, raw, existence, duplicate, status):
    assert one(spark, tokens.s12_count(F.col("r"), F.col("e"), F.col("d")), r=raw, e=existence, d=duplicate)["status"] == status


@pytest.mark.parametrize("raw,code,status,value", [("", "2", "suppressed", None), ("7", "2", "suppressed", None), ("42", "1", "aggregation_destination", 42), ("0", "0", "observed_zero", 0)])
def test_census(spark, raw, code, status, value):
    got = one(spark, tokens.census_count(F.col("r"), F.col("c")), r=raw, c=code)
    assert got["status"] == status and (got["value"] is None if value is None else float(got["value"]) == value)


def test_census_refuses(spark):
    for raw, code in (("X", "1"), ("1", "9")):
        with pytest.raises(Exception, match="unknown"):
            one(spark, tokens.census_count(F.col("r"), F.col("c")), r=raw, c=code)


def test_mesh_bounds(spark):
    b = one(spark, geo.mesh_bounds(F.col("c")), c="533945511")
    assert b["min_lon"] == pytest.approx(139.6375) and b["min_lat"] == pytest.approx(35.7083333333)
    assert b["max_lon"] - b["min_lon"] == pytest.approx(1 / 160) and b["max_lat"] - b["min_lat"] == pytest.approx(1 / 240)
    for bad in ("12345678", "533945515", "abc", None):
        with pytest.raises(Exception, match="malformed mesh code"):
            one(spark, geo.mesh_bounds(F.col("c")), c=bad)


def test_wkb(spark):
    row = spark.range(1).select(geo.point_wkb(F.lit(139.0), F.lit(35.0)).alias("p"), geo.mesh_bounds(F.lit("533945511")).alias("b")).select("p", geo.cell_wkb("b").alias("c")).first()
    assert len(row["p"]) == 21 and row["p"][0] == 1 and len(row["c"]) == 1 + 4 + 4 + 4 + 80


def test_inside_edges(spark):
    square = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    rows = spark.createDataFrame([(0.5, 0.5, True), (0.0, 0.5, True), (1.0, 1.0, True), (1.5, 0.5, False), (0.5, -0.1, False)], "x double, y double, want boolean")
    assert all(r["got"] == r["want"] for r in rows.withColumn("got", geo.inside(F.col("x"), F.col("y"), square)).collect())


def test_text(spark):
    assert one(spark, text.composite_key(F.col("a"), F.lit(None), F.col("b")), a="x", b="y") == "x||y"
    assert one(spark, variant.json_merge(F.col("a"), F.col("b")), a='{"z":"1","a":"2"}', b='{"z":"3"}') == '{"a":"2","z":"3"}'
    assert one(spark, text.html_unescape(F.col("a")), a="a &amp; b") == "a & b"
    assert one(spark, text.forbidden_source(F.col("a"), "abc"), a="xＡＢＣ") is True
    assert one(spark, text.excel_cell(F.lit(28), F.lit(3)), a="") == "AB3"
    assert one(spark, text.zfill(F.col("a"), 2), a="123") == "123"
    for path, ok in (("a/b.txt", True), ("/a", False), ("a/../b", False), ("a\\b", False)):
        assert one(spark, text.safe_member(F.col("a")), a=path) is ok
    assert one(spark, text.url_host_in(F.col("a"), ["x.org"]), a="https://x.org/a") is True
    assert one(spark, text.url_host_in(F.col("a"), ["x.org"]), a="nonsense") is False


def test_labels(spark):
    assert one(spark, tokens.money_label(F.lit(12345), F.lit("observed")), a="") == "123.5 億円"
    assert one(spark, tokens.money_label(F.lit(None).cast("double"), F.lit("suppressed")), a="") == "withheld by the source"
    assert one(spark, tokens.format_value(F.lit(0)), a="") == "0"
    assert one(spark, tokens.format_value(F.lit(None).cast("int")), a="") == "—"
    assert one(spark, geo.camera(F.col("a")), a="139.5,35.6,12") is not None
    assert one(spark, geo.camera(F.col("a")), a="999,35.6,12") is None
