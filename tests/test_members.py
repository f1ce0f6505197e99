"""ZIP members as a data source: tasks, columns, filters and faults."""

import json
import zipfile

import pytest

from lattica.sources.members import MemberReader, ZipMembers


@pytest.fixture(scope="module")
def read(spark):
    spark.dataSource.register(ZipMembers)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return lambda **options: spark.read.format("zip_members").options(**options)


def zipped(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data if isinstance(data, bytes) else data.encode("cp932"))
    return str(path)


def body(n):
    return "KEY_CODE,T1,T2\n,ラベル,x\n" + "".join(f"{n}{i:04d},{i},あ{i}\n" for i in range(30))


def test_a_member_is_a_task_and_rows_are_those_of_the_table(read, tmp_path):
    path = zipped(tmp_path / "ten.zip", {f"t{n}.txt": body(n) for n in range(10)} | {"readme.md": "x", "folder/": ""})
    df = read(path=path, members="*.txt", columns="KEY_CODE,T2", labelKey="KEY_CODE").load()
    assert df.rdd.getNumPartitions() == 10
    rows = {(r["member"], r["row_number"]): (r["KEY_CODE"], r["T2"]) for r in df.collect()}
    assert len(rows) == 300 and rows["t7.txt", 3] == ("70000", "あ0") and min(n for _, n in rows) == 3
    assert {r["path"] for r in df.select("path").distinct().collect()} == {path}


def test_a_schema_names_the_columns_that_are_built(read, tmp_path):
    path = zipped(tmp_path / "a.zip", {"a.txt": body(1)})
    df = read(path=path, labelKey="KEY_CODE").schema("T1 string, row_number int").load()
    assert df.columns == ["T1", "row_number"] and df.where("row_number = 4").collect()[0]["T1"] == "1"


def test_filters_choose_the_tasks(spark, read, tmp_path):
    for k in "ab":
        zipped(tmp_path / f"{k}.zip", {f"t{n}.txt": body(n) for n in range(4)})
    df = read(path=str(tmp_path), members="*.txt", columns="T1", labelKey="KEY_CODE").load()
    assert df.rdd.getNumPartitions() == 8 and df.count() == 240
    one = df.where(f"member = 't2.txt' and path = '{tmp_path}/b.zip'")
    assert one.rdd.getNumPartitions() == 1 and one.count() == 30
    assert df.where("member in ('t0.txt', 't1.txt')").where("T1 = '5'").count() == 4
    assert df.where("member = 'none'").count() == 0
    from pyspark.sql.datasource import EqualTo, GreaterThan

    reader = MemberReader("csv", {"path": str(tmp_path)}, df.schema)
    left = list(reader.pushFilters([EqualTo(("member",), "t1.txt"), GreaterThan(("row_number",), 3)]))
    assert left == [GreaterThan(("row_number",), 3)] and [m.name for m in reader.partitions()] == ["t1.txt"] * 2


def test_features(read, tmp_path):
    doc = {"type": "FeatureCollection", "features": [{"properties": {"o": "A", "n": "x"}, "geometry": {"type": "Point", "coordinates": [139.0, 35.0]}}, {"properties": None, "geometry": {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}}]}
    path = zipped(tmp_path / "g.zip", {"f.geojson": json.dumps(doc).encode(), "g.geojson": b"\xef\xbb\xbf" + json.dumps(doc | {"features": []}).encode()})
    df = read(path=path, kind="geojson", columns="n", keyParts="o,n").load()
    assert [(r["feature_index"], r["source_key"], r["geometry_type"], r["coordinates"], r["n"]) for r in df.orderBy("feature_index").collect()] == [(0, "A|x", "Point", "[139.0, 35.0]", "x"), (1, "MISSING_000001", "LineString", "[[1, 2], [3, 4]]", None)]
    with pytest.raises(Exception, match="no point"):
        read(path=path, kind="geojson", pointOnly="true").load().collect()


def test_index_tells_of_damage(read, tmp_path):
    path = zipped(tmp_path / "m.zip", {"a.txt": "日本", "b.txt": b"x" * 50})
    raw = bytearray((tmp_path / "m.zip").read_bytes())
    with zipfile.ZipFile(path) as z:
        raw[z.infolist()[1].header_offset + 30 + 5] ^= 0xFF
    (tmp_path / "m.zip").write_bytes(bytes(raw))
    rows = read(path=path, kind="index").load().orderBy("sequence").collect()
    assert [(r["member"], r["byte_size"], r["encoding"], r["crc_ok"]) for r in rows] == [("a.txt", 4, "cp932", True), ("b.txt", 50, None, False)]


@pytest.mark.parametrize(("options", "says"), [
    ({"columns": "NOPE"}, "lacks columns"), ({"columns": "T1", "labelKey": "T1"}, "no labels"), ({"single": "true"}, "2 members"), ({"kind": "xml"}, "is none of"), ({"path": "/nowhere/*.zip"}, "no archive"), ({"kind": "geojson"}, "DecodeError"),
])
def test_faults_fail_the_read(read, tmp_path, options, says):
    path = zipped(tmp_path / "a.zip", {"a.txt": body(1), "b.txt": body(2)})
    with pytest.raises(Exception, match=says):
        read(**({"path": path} | options)).load().collect()


def test_no_members(read, tmp_path):
    assert read(path=zipped(tmp_path / "e.zip", {}), columns="a").load().count() == 0
