"""Members of ZIP archives as a Spark data source: one task a member, whatever archive it is in.

``spark.dataSource.register(ZipMembers)``, then ``spark.read.format("zip_members")``
with the options below.  Only an archive's directory is read to plan, and only
a member's own bytes, as they are parsed, to read it; an archive is never held
whole.  Paths are local or of any store that pyarrow's file systems open.
"""

from __future__ import annotations

import fnmatch
import io
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import IntegerType, StringType, StructType

from .archives import batch_of, feature_rows, probe_encoding, table_rows
from .files import listed, open_read

#: Columns that every kind has, and those of each kind before its own.
HEAD = "path string, member string"
KINDS = {"csv": ", row_number int", "geojson": ", feature_index int, source_key string, geometry_type string, coordinates string", "index": ", sequence int, byte_size long, crc long, flags int, encoding string, crc_ok boolean"}
#: Archives whose directories are read at a time.
AT_ONCE = 32


@dataclass
class Member(InputPartition):
    """One member of one archive, with its place there from 1."""

    path: str
    name: str
    place: int


class ZipMembers(DataSource):
    """Options:

    ``path``: an archive, a pattern or a folder; several are parted by ``;``.
    ``kind``: ``csv``, ``geojson`` or ``index``.  ``members``: a pattern, ``*`` unless
    given.  ``single``: whether each archive must have exactly one such member.
    ``columns``: the columns or properties wanted, parted by commas; a schema
    given to the reader names them instead, and only what it names is built.
    ``encoding`` and ``labelKey`` are for ``csv``, ``keyParts`` and ``pointOnly`` for ``geojson``.

    A missing column, a label row that is none, a document that is no
    collection, another geometry than a point, and a member that is damaged
    fail the read.  An archive without members has no rows; one that lacks fails.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        own = [c for c in self.options.get("columns", "").split(",") if c] if self.kind != "index" else []
        return HEAD + KINDS[self.kind] + "".join(f", `{c}` string" for c in own)

    @property
    def kind(self) -> str:
        kind = self.options.get("kind", "csv")
        if kind not in KINDS:
            raise ValueError(f"kind {kind} is none of {sorted(KINDS)}")
        return kind

    def reader(self, schema: StructType) -> MemberReader:
        return MemberReader(self.kind, dict(self.options), schema)


class MemberReader(DataSourceReader):
    def __init__(self, kind: str, options: dict[str, str], schema: StructType):
        self.kind, self.options, self.schema = kind, options, schema
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality on ``path`` or ``member`` chooses the tasks; all else stays with Spark."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in ("path", "member"):
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[name] = self.wanted.get(name, values) & values

    def partitions(self) -> Sequence[Member]:
        paths = [p for part in self.options.get("path", "").split(";") if part for p in listed(part)]
        if not paths:
            raise ValueError(f"no archive at {self.options.get('path')}")
        with ThreadPoolExecutor(AT_ONCE) as pool:
            found = [m for members in pool.map(self._members, paths) for m in members]
        chosen = [m for m in found if all(getattr(m, {"member": "name"}.get(k, k)) in values for k, values in self.wanted.items())]
        return chosen or [Member("", "", 0)]

    def _members(self, path: str) -> list[Member]:
        pattern = self.options.get("members", "*")
        with open_read(path) as file, zipfile.ZipFile(file) as z:
            found = [Member(path, i.filename, n) for n, i in enumerate(z.infolist(), 1) if not i.is_dir() and fnmatch.fnmatchcase(i.filename, pattern)]
        if self.options.get("single", "false").lower() == "true" and len(found) != 1:
            raise ValueError(f"{path} has {len(found)} members {pattern} instead of one")
        return found

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not partition.place:
            return
        head = {"path": partition.path, "member": partition.name}
        fixed = [c.split()[0] for c in KINDS[self.kind].strip(", ").split(", ")]
        own = [f.name for f in self.schema if f.name not in (*head, *fixed)]
        names = [*fixed, *own]
        with open_read(partition.path) as file, zipfile.ZipFile(file) as z:
            info = z.infolist()[partition.place - 1]
            for rows in getattr(self, f"_{self.kind}")(z, info, partition, own):
                yield self._batch([head | dict(zip(names, row, strict=True)) for row in rows])

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {StringType: pa.string(), IntegerType: pa.int32()}
        kind = lambda f: kinds.get(type(f.dataType)) or {"bigint": pa.int64(), "boolean": pa.bool_()}[f.dataType.simpleString()]
        return batch_of([tuple(r[f.name] for f in self.schema) for r in rows], [kind(f) for f in self.schema], self.schema.fieldNames())

    def _csv(self, z: zipfile.ZipFile, info: zipfile.ZipInfo, at: Member, own: list[str]) -> Iterator[list[tuple]]:
        with z.open(info) as raw, io.TextIOWrapper(raw, self.options.get("encoding", "cp932"), newline="") as text:
            yield from table_rows(text, f"{at.path}/{at.name}", own, self.options.get("labelkey") or self.options.get("labelKey"))

    def _geojson(self, z: zipfile.ZipFile, info: zipfile.ZipInfo, at: Member, own: list[str]) -> Iterator[list[tuple]]:
        keys = [k for k in (self.options.get("keyparts") or self.options.get("keyParts") or "").split(",") if k]
        point_only = (self.options.get("pointonly") or self.options.get("pointOnly") or "false").lower() == "true"
        yield list(feature_rows(z.read(info), f"{at.path}/{at.name}", own, keys, point_only))

    def _index(self, z: zipfile.ZipFile, info: zipfile.ZipInfo, at: Member, own: list[str]) -> Iterator[list[tuple]]:
        try:
            content = z.read(info)
            encoding, sound = probe_encoding(content), zlib.crc32(content) == info.CRC
        except (zipfile.BadZipFile, zlib.error):
            encoding, sound = None, False
        yield [(at.place, info.file_size, info.CRC, info.flag_bits, encoding, sound)]
