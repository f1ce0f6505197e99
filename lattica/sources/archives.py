"""Members of ZIP archives as rows: CSV tables, GeoJSON features, and an index of the members."""

from __future__ import annotations

import csv
import io
import json
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from typing import TextIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_member
from ..operators.constraints import GateError

#: Encodings that are tried, in this order.
ENCODINGS = ("utf-8", "cp932", "euc_jp")


def archives(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, content of each file; one row a file, dealt over the executors."""
    return spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).select("path", "content")


def _member(data: bytes, name: str | None, suffix: str) -> tuple[str, bytes]:
    """The named member, or the only one with the suffix."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        found = [n for n in z.namelist() if (n == name if name else n.lower().endswith(suffix))]
        if len(found) != 1:
            raise ValueError(f"{len(found)} members {name or suffix} instead of one")
        return found[0], z.read(found[0])


def zip_csv(files: DataFrame, required: Sequence[str], member: str | None = None, encoding: str = "cp932", label_key: str | None = None, suffix: str = ".txt") -> DataFrame:
    """Rows of the table in each archive: path, row_number (of the file's lines), then ``required`` as strings.

    Only the required columns are kept.  If ``label_key`` is given, the first data
    row must hold labels, with that key blank, and is not returned; row numbers
    then begin at 3.  A missing column, or another number of members, fails.
    """
    schema = "path string, row_number int, " + ", ".join(f"`{c}` string" for c in required)

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = io.StringIO(_member(data, member, suffix)[1].decode(encoding))
                for rows in table_rows(text, path, required, label_key):
                    yield batch_of([(path, *row) for row in rows], [pa.string(), pa.int32(), *[pa.string()] * len(required)], ["path", "row_number", *required])

    return files.mapInArrow(run, schema)


def table_rows(text: TextIO, path: str, required: Sequence[str], label_key: str | None) -> Iterator[list[tuple]]:
    """Lists of (row number, required values) of a table that is read as it is parsed."""
    reader = csv.DictReader(text)
    lacking = [c for c in (*required, *([label_key] if label_key else ())) if c not in (reader.fieldnames or ())]
    if lacking:
        raise ValueError(f"{path} lacks columns {lacking}")
    rows: list[tuple] = []
    for number, row in enumerate(reader, 2):
        if label_key and number == 2:
            if (row[label_key] or "").strip():
                raise ValueError(f"{path}: the first row holds no labels")
            continue
        rows.append((number, *((row[c] if row[c] is not None else "") for c in required)))
        if len(rows) == 10_000:
            yield rows
            rows = []
    yield rows


def batch_of(rows: Sequence[tuple], kinds: Sequence[pa.DataType], names: Sequence[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))


def zip_geojson(files: DataFrame, properties: Sequence[str], key_parts: Sequence[str] = (), member: str | None = None, suffix: str = ".geojson", point_only: bool = False) -> DataFrame:
    """Features of the collection in each archive: path, feature_index, source_key, geometry_type, coordinates (JSON), properties.

    A feature whose key parts are all blank keeps a row under ``MISSING_`` and its
    six-digit index.  ``point_only``: any other geometry fails.
    """
    schema = "path string, feature_index int, source_key string, geometry_type string, coordinates string, " + ", ".join(f"`{p}` string" for p in properties)

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [(path, *row) for row in feature_rows(_member(data, member, suffix)[1], path, properties, key_parts, point_only)]
                yield batch_of(rows, [pa.string(), pa.int32(), *[pa.string()] * (3 + len(properties))], ["path", "feature_index", "source_key", "geometry_type", "coordinates", *properties])

    return files.mapInArrow(run, schema)


def feature_rows(data: bytes, path: str, properties: Sequence[str], key_parts: Sequence[str], point_only: bool) -> Iterator[tuple]:
    """(index, source key, geometry's type, coordinates, properties) of each feature of a collection."""
    document = json.loads(data.decode("utf-8-sig"))
    if document.get("type") != "FeatureCollection":
        raise ValueError(f"{path} is no FeatureCollection")
    for i, f in enumerate(document["features"]):
        p, g = f.get("properties") or {}, f.get("geometry") or {}
        if point_only and g.get("type") != "Point":
            raise ValueError(f"{path}: feature {i} is no point")
        parts = [str(p.get(k) or "") for k in key_parts]
        key = "|".join(parts) if any(parts) else f"MISSING_{i:06d}"
        yield i, key, g.get("type"), json.dumps(g.get("coordinates")), *(None if p.get(k) is None else str(p.get(k)) for k in properties)


def coordinates(df: DataFrame, kind: str = "array<array<double>>") -> DataFrame:
    """The JSON coordinates as nested arrays."""
    return df.withColumn("coordinates", F.from_json("coordinates", kind))


def probe_encoding(data: bytes) -> str | None:
    """The first encoding that reads all bytes."""
    for name in ENCODINGS:
        try:
            data.decode(name)
            return name
        except UnicodeDecodeError:
            continue
    return None


def member_index(files: DataFrame) -> DataFrame:
    """path, sequence, member, byte_size, crc, flags, encoding, crc_ok, safe: one row for each member."""

    def run(batches):
        for batch in batches:
            rows = []
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    for i, info in enumerate(z.infolist(), 1):
                        content = z.read(info)
                        rows.append((path, i, info.filename, info.file_size, info.CRC, info.flag_bits, probe_encoding(content), zlib.crc32(content) == info.CRC))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "sequence", "member", "byte_size", "crc", "flags", "encoding", "crc_ok"])

    index = files.mapInArrow(run, "path string, sequence int, member string, byte_size long, crc long, flags int, encoding string, crc_ok boolean")
    return index.withColumn("safe", safe_member(F.col("member")))


def checked(files: DataFrame, sha256: dict[str, str]) -> DataFrame:
    """``files`` after each one's bytes have been held against its lock (by file name)."""
    spark = files.sparkSession
    lock = spark.createDataFrame(sorted(sha256.items()), "name string, locked string")
    got = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))
    bad = got.join(lock, "name", "full").where("not (sha256 <=> locked)").collect()
    if bad:
        raise GateError(f"files differ from their lock: {[r['name'] for r in bad]}")
    return files
