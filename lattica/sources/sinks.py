"""Writers: Parquet with a declared schema, manifests, JSON documents, CSV with a mark, GeoParquet metadata."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.constraints import GateError, required_nulls
from .files import open_write, replace


def declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a declared schema; a missing column fails."""
    lacking = [f.name for f in schema if f.name not in df.columns]
    if lacking:
        raise GateError(f"table lacks columns {lacking}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_parquet(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: tuple[str, ...] = ()) -> dict:
    """Write with zstd and give a manifest: path, rows, columns.

    Nulls in required columns, or no rows, fail after the write to a staged
    folder and before it is renamed, so that a reader never sees them.
    """
    spark = df.sparkSession
    out = declared(df, schema) if schema else df
    staged = f"{path.rstrip('/')}.part"
    writer = out.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
    back = spark.read.parquet(staged)
    rows = back.count()
    if not rows:
        raise GateError(f"{path} would be empty")
    if schema:
        bad = required_nulls(back, schema).limit(3).collect()
        if bad:
            raise GateError(f"{path}: nulls in required columns, such as {bad}")
    jvm = spark._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    # the table that stands is set aside first, so that a crash in between loses neither
    before = fs_path(f"{path.rstrip('/')}.before")
    if fs.exists(fs_path(path)):
        fs.delete(before, True)
        fs.rename(fs_path(path), before)
    if not fs.rename(fs_path(staged), fs_path(path)):
        fs.rename(before, fs_path(path))
        raise GateError(f"{path} could not be published")
    fs.delete(before, True)
    return {"path": path, "rows": rows, "columns": out.columns}


def manifest(spark, path: str) -> DataFrame:
    """name, byte_size, sha256 of a written table's files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("byte_size"), F.sha2("content", 256).alias("sha256"))


def publish_text(path: str, text: str, encoding: str = "utf-8") -> str:
    """Write a small text whole or not at all, to a local folder or a store; returns its SHA-256."""
    data = text.encode(encoding)
    with open_write(f"{path}.part") as file:
        file.write(data)
    replace(f"{path}.part", path)
    return hashlib.sha256(data).hexdigest()


def publish_json(path: str, value) -> str:
    return publish_text(path, json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")))


def publish_yaml(path: str, value) -> str:
    import yaml

    return publish_text(path, yaml.safe_dump(value, allow_unicode=True, sort_keys=False))


def write_documents(df: DataFrame, path: str) -> None:
    """One compact JSON object a row, in files of lines."""
    df.select(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]))).write.mode("overwrite").text(path)


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def publish_csv(df: DataFrame, path: str, most: int = 100_000) -> int:
    """A small table as one CSV with a byte order mark; a table above ``most`` rows fails."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise GateError(f"more than {most} rows for one file")
    quote = lambda v: "" if v is None else '"' + str(v).replace('"', '""') + '"' if any(c in str(v) for c in ',"\n') else str(v)
    publish_text(path, "\n".join(",".join(map(quote, r)) for r in [df.columns, *rows]) + "\n", "utf-8-sig")
    return len(rows)


def markdown_table(df: DataFrame, most: int = 1_000) -> str:
    """A report of at most ``most`` rows; a longer one is an error, not a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise GateError(f"a report holds at most {most} rows")
    cell = lambda v: "—" if v is None else str(v).replace("|", "\\|")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in rows]) + "\n"


def bar_chart(rows: list[tuple[str, float | None]], width: int = 500) -> str:
    """An SVG of bars as wide as value / largest; a missing value has no bar but its label."""
    most = max((v for _, v in rows if v is not None), default=0) or 1
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    bars = [f'<text x="0" y="{24 * i + 16}">{esc(n)}</text>' + ("" if v is None else f'<rect x="160" y="{24 * i + 4}" width="{width * v / most:.1f}" height="16"/>') for i, (n, v) in enumerate(rows)]
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width + 180}" height="{24 * len(rows) + 8}">{"".join(bars)}</svg>'


def geo_metadata(types: list[str], column: str = "geometry", crs: dict | None = None) -> dict:
    """The ``geo`` key of a GeoParquet file."""
    return {"version": "1.1.0", "primary_column": column, "columns": {column: {"encoding": "WKB", "geometry_types": types, "crs": crs}}}


def with_geo_metadata(source: str, target: str, meta: dict) -> None:
    """Copy one Parquet file, adding the ``geo`` key to its footer, row group by row group."""
    import pyarrow.parquet as pq

    f = pq.ParquetFile(source)
    schema = f.schema_arrow.with_metadata({**(f.schema_arrow.metadata or {}), b"geo": json.dumps(meta).encode()})
    part = f"{target}.part"
    with pq.ParquetWriter(part, schema, compression="zstd") as w:
        for i in range(f.num_row_groups):
            w.write_table(f.read_row_group(i).cast(schema))
    os.replace(part, target)


def geo_footer_faults(path: str, types: list[str]) -> list[str]:
    """What is wrong with a file's ``geo`` key."""
    import pyarrow.parquet as pq

    raw = (pq.ParquetFile(path).schema_arrow.metadata or {}).get(b"geo")
    if raw is None:
        return ["no geo key"]
    geo = json.loads(raw)
    column = geo.get("columns", {}).get(geo.get("primary_column"), {})
    return [f"{name}: {got!r}" for name, got, want in (("encoding", column.get("encoding"), "WKB"), ("types", column.get("geometry_types"), types)) if got != want]
