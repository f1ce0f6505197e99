import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.operators import constraints
from lattica.operators.constraints import GateError
from lattica.schema import RELATIONS, fields
from lattica.sources import acquire, archives, documents, sinks


def zipped(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "."), data)
    return str(path)


def test_zip_csv(spark, tmp_path):
    body = "KEY_CODE,T1,T2\n,ラベル,x\n533945511,5,a\n533945512,,b\n".encode("cp932")
    path = zipped(tmp_path / "a.zip", data__txt=body)
    rows = archives.zip_csv(archives.archives(spark, path), ["KEY_CODE", "T1"], label_key="KEY_CODE").orderBy("row_number").collect()
    assert [(r["row_number"], r["KEY_CODE"], r["T1"]) for r in rows] == [(3, "533945511", "5"), (4, "533945512", "")]
    with pytest.raises(Exception, match="lacks columns"):
        archives.zip_csv(archives.archives(spark, path), ["NOPE"]).collect()
    two = zipped(tmp_path / "b.zip", a__txt=body, b__txt=body)
    with pytest.raises(Exception, match="2 members"):
        archives.zip_csv(archives.archives(spark, two), ["T1"]).collect()


def test_geojson(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [{"properties": {"o": "A", "n": "x"}, "geometry": {"type": "Point", "coordinates": [139.0, 35.0]}}, {"properties": {}, "geometry": {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}}]}
    path = zipped(tmp_path / "g.zip", f__geojson=json.dumps(doc))
    rows = archives.zip_geojson(archives.archives(spark, path), ["n"], ["o", "n"]).orderBy("feature_index").collect()
    assert [r["source_key"] for r in rows] == ["A|x", "MISSING_000001"]
    with pytest.raises(Exception, match="no point"):
        archives.zip_geojson(archives.archives(spark, path), ["n"], point_only=True).collect()


def test_members_and_lock(spark, tmp_path):
    path = zipped(tmp_path / "m.zip", a__txt="日本".encode("cp932"), b__txt="x")
    index = archives.member_index(archives.archives(spark, path)).orderBy("sequence").collect()
    assert [(r["member"], r["encoding"], r["crc_ok"], r["safe"]) for r in index] == [("a.txt", "cp932", True, True), ("b.txt", "utf-8", True, True)]
    with pytest.raises(GateError):
        archives.checked(archives.archives(spark, path), {"m.zip": "0" * 64})


def test_documents(spark, tmp_path):
    log = tmp_path / "log.jsonl"
    log.write_text('{"artifact_id":"a","result":"acquired","retrieved_at":"2026-01-01"}\n\n{"artifact_id":"a","result":"acquired","retrieved_at":"2026-02-01"}\n{"artifact_id":"b","result":"skipped_existing","retrieved_at":"2026-03-01"}\n')
    assert [tuple(r) for r in documents.latest_events(spark, str(log)).collect()] == [("a", "2026-02-01")]
    page = spark.createDataFrame([('<th data-unique="13101">A</th><td>1,2</td><th data-unique="13102">B</th> <td>-</td>',)], "h string")
    assert [tuple(r) for r in documents.html_cells(page, "h").collect()] == [("13101", "A", "1,2"), ("13102", "B", "-")]
    got = documents.header_dump("HTTP/1.1 301 Moved\nLocation: x\n\nHTTP/2 200\nSet-Cookie: a\nset-cookie: b\nContent-Length: 12\n")
    assert got["status"] == 200 and got["headers"]["set-cookie"] == ["a", "b"] and got["content_length"] == 12 and len(got["chain"]) == 2
    specs = [{"artifact_id": "m-{code}", "url": "u/{code}.zip", "codes": [8, 13]}, {"artifact_id": "one", "url": "v"}]
    assert sorted(r["artifact_id"] for r in documents.expand_template(spark, specs).collect()) == ["m-08", "m-13", "one"]
    with pytest.raises(GateError):
        documents.expand_template(spark, [specs[1], specs[1]])
    config = tmp_path / "c.yml"
    config.write_text("- a\n")
    with pytest.raises(GateError):
        documents.yaml_mapping(str(config))


def test_xlsx(spark, tmp_path):
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="2"><c r="A2"><v>5</v></c><c r="C2" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>'
    strings = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>code</t></si></sst>'
    path = tmp_path / "s.xlsx"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", strings)
    df = documents.district_sheet(spark, str(path), {"code": 1, "type": 3}, {(1, 1): "code"})
    assert [tuple(r) for r in df.collect()] == [(2, "5", "x")]
    with pytest.raises(GateError):
        documents.district_sheet(spark, str(path), {"code": 1}, {(1, 1): "other"})


def test_sinks(spark, tmp_path):
    schema = fields("a string!, b int")
    good = spark.createDataFrame([("x", 1), ("y", None)], "a string, b int")
    target = str(tmp_path / "t.parquet")
    assert sinks.write_parquet(good, target, schema)["rows"] == 2
    assert spark.read.parquet(target).count() == 2 and sinks.manifest(spark, target).count() >= 1
    for bad in (spark.createDataFrame([(None, 1)], "a string, b int"), good.limit(0)):
        with pytest.raises(GateError):
            sinks.write_parquet(bad, target, schema)
    assert spark.read.parquet(target).count() == 2
    assert sinks.publish_csv(good, str(tmp_path / "x.csv")) == 2 and (tmp_path / "x.csv").read_bytes().startswith(b"\xef\xbb\xbfa,b")
    assert 'width="500.0"' in sinks.bar_chart([("a", 5), ("b", None)])
    one = next((tmp_path / "t.parquet").glob("*.parquet"))
    sinks.with_geo_metadata(str(one), str(tmp_path / "geo.parquet"), sinks.geo_metadata(["Point"]))
    assert sinks.geo_footer_faults(str(tmp_path / "geo.parquet"), ["Point"]) == [] and sinks.geo_footer_faults(str(one), ["Point"])


def test_acquire(tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a", "b")

    class Response(io.BytesIO):
        status, headers = 200, {}

        def geturl(self):
            return "https://ok.org/x"

    got = acquire.acquire("https://ok.org/x", tmp_path / "x.zip", tmp_path, ["ok.org"], opener=lambda u: Response(data.getvalue()))
    assert got["result"] == "acquired" and got["zip_member_count"] == 1
    assert acquire.acquire("https://ok.org/x", tmp_path / "x.zip", tmp_path, ["ok.org"])["result"] == "skipped_existing"
    for url, target in (("https://bad.org/x", tmp_path / "y.zip"), ("https://ok.org/x", tmp_path.parent / "z.zip")):
        with pytest.raises(GateError):
            acquire.acquire(url, target, tmp_path, ["ok.org"], opener=lambda u: Response(data.getvalue()))


def test_gates(spark):
    bad = spark.createDataFrame([("a", "1", 1.0, "observed"), ("b", "0", None, "observed_zero"), ("c", "X", 3.0, "suppressed"), ("d", None, None, "imputed"), ("e", None, None, "source_absent")], "id string, raw string, value double, status string")
    found = constraints.violations(bad, constraints.observation_faults(F.col("raw"), F.col("value"), F.col("status")), "id")
    assert {r["id"] for r in found.collect()} == {"b", "c", "d"}
    with pytest.raises(GateError, match="observations: 3"):
        constraints.gate([("observations", found)])
    assert constraints.gate([("unique", constraints.unique(bad, ["id"]))]) == {"unique": 0}
    assert constraints.schema_faults(bad, T.StructType([T.StructField("id", T.LongType())]))
    assert constraints.config_pins({"a": {"b": 1}}, {"a.b": 2}) == ["a.b: 1 instead of 2"]
    assert dict(constraints.walk({"a": [1]})) == {"a": [1], "a.0": 1}
    assert len(RELATIONS) == 20
