"""Files, members and outputs against their locks, and tables with geo footers behind a pointer."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lattica.functions import geo
from lattica.operators.constraints import GateError
from lattica.sources import geo_tables, locks, sinks
from lattica.sources.files import open_read

LOCK = "path string, byte_size long, sha256 string"


@pytest.fixture
def folder(tmp_path):
    for name, data in {"a.zip": b"a" * 3_000_000, "sub/b c.zip": b"", "sub/日本.zip": b"x", "d.zip.part": b"half", "e.zip": b"e"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return tmp_path


@pytest.mark.parametrize("streamed", [True, False])
def test_bytes_are_hashed_in_tasks(spark, folder, streamed):
    got = {r["path"]: (r["byte_size"], r["sha256"]) for r in locks.file_hashes(spark, str(folder), streamed=streamed).collect()}
    want = {p.relative_to(folder).as_posix(): (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in folder.rglob("*") if p.is_file()}
    assert got == want
    assert locks.file_hashes(spark, str(folder), "*.part").count() == 1


def test_one_row_for_each_kind_of_fault(spark):
    present = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"), ("o", 1, "o"), ("p.part", 1, "p"), ("t", 1, "t")], LOCK)
    lock = spark.createDataFrame([("a", 1, "x"), ("b", 3, "y"), ("c", 3, "w"), ("gone", 1, "g"), ("../up", 1, "u"), ("t", 1, "t"), ("t", 1, "t")], LOCK)
    got = {r["path"]: r["reasons"] for r in locks.byte_lock_faults(present, lock).collect()}
    assert got == {"b": "byte_size", "c": "sha256", "gone": "missing", "o": "not_locked", "p.part": "partial", "../up": "missing+unsafe_path", "t": "locked_twice"}


def test_members_and_acquisitions(spark):
    kind = "path string, sequence int, member string, byte_size long, crc long, flags int, encoding string"
    a = spark.createDataFrame([("z", 1, "m", 1, 2, 0, "utf-8"), ("z", 2, "n", 1, 2, 0, None), ("z", 3, "o", 1, 2, 0, None)], kind)
    b = spark.createDataFrame([("z", 1, "M", 1, 3, 0, "utf-8"), ("z", 2, "n", 1, 2, 0, None), ("y", 1, "o", 1, 2, 0, None)], kind)
    assert {tuple(r) for r in locks.member_lock_faults(a, b).collect()} == {("z", 1, "member+crc"), ("z", 3, "not_locked"), ("y", 1, "missing")}
    got = spark.createDataFrame([("ok", "s", "r", "t", "https://h/x/1", "https://h/2", 200, None, 5), ("bad", "s", "q", "u", "https://h/y", "https://evil/1", 404, 4, 5), ("new", "n", None, None, None, None, None, None, None)], "artifact_id string, source_id string, source_release_id string, table_id string, url string, final_url string, status int, content_length long, byte_size long")
    audited = spark.createDataFrame([("s", "r", "t", "https://h/x/")], "source_id string, source_release_id string, table_id string, url_prefix string")
    assert {tuple(r) for r in locks.acquisition_faults(got, audited, ["h"]).collect()} == {("bad", "release+table+url+host+status+content_length"), ("new", "not_audited+host+status")}


def test_outputs_of_a_report(spark, tmp_path):
    tables = {n: f"{tmp_path}/{n}" for n in ("one", "two", "three")}
    for i, path in enumerate(tables.values()):
        spark.range(i + 2).repartition(2).write.parquet(path)
    told = locks.output_manifest(spark, tables)
    assert locks.output_faults(told, told).count() == 0
    spark.range(9).write.mode("overwrite").parquet(tables["two"])
    now = locks.output_manifest(spark, {n: p for n, p in tables.items() if n != "three"} | {"four": tables["three"]})
    rows = {r["name"]: r["row_count"] for r in now.collect()}
    assert rows == {"one": 2, "two": 9, "four": 4}
    before = spark.createDataFrame([("one", 2, "other"), ("two", 3, "x"), ("three", 4, "y")], "name string, row_count long, sha256 string")
    assert {tuple(r) for r in locks.output_faults(before, now).collect()} == {("one", "sha256"), ("two", "row_count+sha256"), ("three", "not_written"), ("four", "not_reported")}


def test_geo_tables_of_many_files(spark, tmp_path):
    path = f"{tmp_path}/points"
    df = spark.range(40).select("id", geo.point_wkb(F.col("id").cast("double"), F.lit(35.0)).alias("geometry"))
    told = geo_tables.write_geo(df.repartition(5), path, ["Point"])
    assert (told["files"], told["rows"]) == (5, 40)
    assert geo_tables.read_geo(spark, path).count() == 40
    files = geo_tables.current(spark, path)[1]
    assert geo_tables.footer_faults(files, ["Point"]).count() == 0
    assert {r["fault"] for r in geo_tables.footer_faults(files, ["Polygon"]).collect()} == {"types: ['Point']"}
    for r in files.collect():
        with open_read(r["file"]) as file:
            assert hashlib.sha256(file.read()).hexdigest() == r["sha256"]
    # what failed, or was tried twice, is not seen; the version before stays
    plain = f"{path}/{told['version']}/part-000009-99.parquet"
    df.limit(1).toPandas().to_parquet(plain)
    assert geo_tables.read_geo(spark, path).count() == 40
    assert geo_tables.footer_faults(spark.createDataFrame([(plain,)], "file string"), ["Point"]).first()["fault"] == "no geo key"
    with pytest.raises(GateError):
        geo_tables.write_geo(df.limit(0), path, ["Point"])
    with pytest.raises(Exception, match="no geometry"):
        geo_tables.write_geo(df.withColumn("geometry", F.lit(None).cast("binary")), path, ["Point"])
    assert geo_tables.current(spark, path)[0] == told
    assert geo_tables.write_geo(df.limit(7), path, ["Point"])["version"] != told["version"] and geo_tables.read_geo(spark, path).count() == 7


def test_texts_are_published_whole(tmp_path):
    path = f"file://{tmp_path}/deep/x.json"
    sha = sinks.publish_json(path, {"b": 1, "a": "é"})
    assert (tmp_path / "deep/x.json").read_bytes() == b'{"a":"\xc3\xa9","b":1}' and sha == hashlib.sha256(b'{"a":"\xc3\xa9","b":1}').hexdigest()
    assert json.loads((tmp_path / "deep/x.json").read_text()) and not list(tmp_path.rglob("*.part"))
