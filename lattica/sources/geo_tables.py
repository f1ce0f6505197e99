"""GeoParquet tables written by tasks, footers included, and published by a pointer to one version."""

from __future__ import annotations

import hashlib
import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.constraints import GateError
from .files import open_read, open_write
from .sinks import geo_metadata, publish_json

#: Rows of a group in a file.
GROUP = 100_000
FILES = "file string, rows long, byte_size long, sha256 string"


def write_geo(df: DataFrame, path: str, types: list[str], column: str = "geometry", crs: dict | None = None) -> dict:
    """Write ``df`` as a new version of the table at ``path`` and point to it; returns what the pointer says.

    Every task writes one file with the ``geo`` key in its footer and tells its
    rows, bytes and hash.  Only files of tasks that succeeded are in the
    version's list, so a task that ran twice leaves a file that no reader sees.
    A table without rows or with a null geometry is not published; the version
    that stands before stays until the pointer moves.
    """
    spark = df.sparkSession
    path, version = path.rstrip("/"), uuid.uuid4().hex
    meta = json.dumps(geo_metadata(types, column, crs)).encode()

    def run(batches):
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        at = TaskContext.get()
        target, writer, rows = f"{path}/{version}/part-{at.partitionId():06d}-{at.taskAttemptId()}.parquet", None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if batch.column(batch.schema.get_field_index(column)).null_count:
                raise ValueError(f"{path}: a row has no {column}")
            if writer is None:
                file = open_write(target)
                schema = batch.schema.with_metadata({**(batch.schema.metadata or {}), b"geo": meta})
                writer = pq.ParquetWriter(file, schema, compression="zstd")
            writer.write_batch(batch.replace_schema_metadata(writer.schema.metadata), row_group_size=GROUP)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
            file.close()
            digest, size = hashlib.sha256(), 0
            with open_read(target) as done:
                while piece := done.read(1 << 20):
                    digest.update(piece)
                    size += len(piece)
            yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([rows], pa.int64()), pa.array([size], pa.int64()), pa.array([digest.hexdigest()])], ["file", "rows", "byte_size", "sha256"])

    df.mapInArrow(run, FILES).write.parquet(f"{path}/{version}/_files")
    files, rows = spark.read.schema(FILES).parquet(f"{path}/{version}/_files").agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    if not rows:
        raise GateError(f"{path} would be empty")
    told = {"version": version, "files": files, "rows": rows, "columns": df.columns}
    publish_json(f"{path}/_current.json", told)
    return told


def current(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """What the pointer says, and the list of the version's files."""
    path = path.rstrip("/")
    with open_read(f"{path}/_current.json") as file:
        told = json.loads(file.read())
    return told, spark.read.schema(FILES).parquet(f"{path}/{told['version']}/_files")


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    """The published version of a table; only the files in its list."""
    return spark.read.parquet(*[r["file"] for r in current(spark, path)[1].select("file").toLocalIterator()])


def footer_faults(files: DataFrame, types: list[str]) -> DataFrame:
    """file, fault: what is wrong with the ``geo`` key of each file, read where tasks run; footers alone are read."""

    def run(batches):
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                with open_read(path) as file:
                    raw = (pq.ParquetFile(file).schema_arrow.metadata or {}).get(b"geo")
                if raw is None:
                    found.append((path, "no geo key"))
                    continue
                geo = json.loads(raw)
                column = geo.get("columns", {}).get(geo.get("primary_column"), {})
                found += [(path, f"{name}: {got!r}") for name, got, want in (("encoding", column.get("encoding"), "WKB"), ("types", column.get("geometry_types"), types)) if got != want]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.string()), pa.array([x for _, x in found], pa.string())], ["file", "fault"])

    return files.select("file").mapInArrow(run, "file string, fault string")
