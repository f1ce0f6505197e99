"""What was locked against what is there: bytes of files, members of archives, acquisitions, outputs of a run."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_member, url_host_in
from .files import open_read

#: Bytes of a file that are hashed at a time.
CHUNK = 1 << 20


def file_hashes(spark: SparkSession, folder: str, pattern: str = "*", streamed: bool = True) -> DataFrame:
    """path (below ``folder``), byte_size, sha256 of every file, hashed where Spark's tasks run.

    Files are dealt over tasks by their bytes.  Streamed, a task reads a file
    piece by piece, so that it may be of any size; else Spark reads it whole,
    for stores that only Spark opens.  An empty folder has no rows.  Files
    without bytes, which Spark's tasks pass over, come from its listing.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(root).toString().rstrip("/")
    below = F.substring(F.col("path"), F.lit(len(root) + 2), F.length("path")).alias("path")
    every = spark.createDataFrame([(re.sub("^file:/+", "file:/", unquote(path)),) for path in files.inputFiles()], "path string")
    empty = every.join(files.select("path"), "path", "left_anti").select(below, F.lit(0).cast("long").alias("byte_size"), F.lit(hashlib.sha256().hexdigest()).alias("sha256"))
    if not streamed:
        return files.select(below, F.col("length").alias("byte_size"), F.sha2("content", 256).alias("sha256")).unionByName(empty)

    def run(batches):
        for batch in batches:
            hashes = []
            for path in batch.column(0).to_pylist():
                digest = hashlib.sha256()
                with open_read(path) as file:
                    while piece := file.read(CHUNK):
                        digest.update(piece)
                hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hashes, pa.string())], ["path", "byte_size", "sha256"])

    return files.select("path", "length").mapInArrow(run, "path string, byte_size long, sha256 string").select(below, "byte_size", "sha256").unionByName(empty)


def _reasons(*reasons: Column) -> Column:
    return F.array_join(F.array_compact(F.array(*reasons)), "+").alias("reasons")


def byte_lock_faults(present: DataFrame, lock: DataFrame) -> DataFrame:
    """path, reasons of every file that is not as it was locked.

    Both have path, byte_size, sha256.  ``missing``, ``not_locked`` (an orphan),
    ``partial`` (a download that was not finished), ``byte_size``, ``sha256``,
    ``unsafe_path`` and ``locked_twice``.
    """
    once = lock.groupBy("path").agg(F.count("*").alias("__n"), F.first("byte_size").alias("__size"), F.first("sha256").alias("__sha"))
    j = present.join(once.withColumnRenamed("path", "__path"), F.col("path") == F.col("__path"), "full")
    here, there = F.col("path").isNotNull(), F.col("__path").isNotNull()
    at = F.coalesce("path", "__path")
    differ = lambda a, b: here & there & ~F.col(a).eqNullSafe(F.col(b))
    reasons = _reasons(
        F.when(~here, "missing"), F.when(~there & ~F.col("path").endswith(".part"), "not_locked"), F.when(here & F.col("path").endswith(".part"), "partial"), F.when(differ("byte_size", "__size"), "byte_size"),
        F.when(differ("sha256", "__sha"), "sha256"), F.when(there & ~safe_member(F.col("__path")), "unsafe_path"), F.when(F.col("__n") > 1, "locked_twice"),
    )
    return j.select(at.alias("path"), reasons).where("reasons <> ''")


def member_lock_faults(present: DataFrame, lock: DataFrame, columns: Sequence[str] = ("member", "byte_size", "crc", "flags", "encoding")) -> DataFrame:
    """path, sequence, reasons: members that differ from the locked ones of the same archive and place; and those in one only."""
    named = lock.select(F.col("path").alias("__p"), F.col("sequence").alias("__s"), *[F.col(c).alias(f"__{c}") for c in columns])
    j = present.join(named, (F.col("path") == F.col("__p")) & (F.col("sequence") == F.col("__s")), "full")
    here, there = F.col("path").isNotNull(), F.col("__p").isNotNull()
    reasons = _reasons(F.when(~here, "missing"), F.when(~there, "not_locked"), *[F.when(here & there & ~F.col(c).eqNullSafe(F.col(f"__{c}")), c) for c in columns])
    return j.select(F.coalesce("path", "__p").alias("path"), F.coalesce("sequence", "__s").alias("sequence"), reasons).where("reasons <> ''")


def acquisition_faults(acquired: DataFrame, audited: DataFrame, hosts: Sequence[str]) -> DataFrame:
    """artifact_id, reasons of what was acquired otherwise than its source was audited.

    ``acquired``: artifact_id, source_id, source_release_id, table_id, url,
    final_url, status, content_length, byte_size.  ``audited``: source_id,
    source_release_id, table_id (null: any), url_prefix.  A source that was not
    audited has no further reasons but those of the transfer itself.
    """
    a = audited.select(F.col("source_id").alias("__id"), F.col("source_release_id").alias("__release"), F.col("table_id").alias("__table"), "url_prefix")
    j = acquired.join(a, F.col("source_id") == F.col("__id"), "left")
    known = F.col("__id").isNotNull()
    no = lambda c: ~F.coalesce(c, F.lit(False))
    reasons = _reasons(
        F.when(~known, "not_audited"), F.when(known & ~F.col("source_release_id").eqNullSafe(F.col("__release")), "release"), F.when(known & F.col("__table").isNotNull() & ~F.col("table_id").eqNullSafe(F.col("__table")), "table"),
        F.when(known & no(F.col("url").startswith(F.col("url_prefix"))), "url"), F.when(no(url_host_in(F.col("url"), list(hosts))) | no(url_host_in(F.col("final_url"), list(hosts))), "host"),
        F.when(no(F.col("status") == 200), "status"), F.when(F.col("content_length").isNotNull() & ~F.col("content_length").eqNullSafe(F.col("byte_size")), "content_length"),
    )
    return j.select("artifact_id", reasons).where("reasons <> ''")


def output_manifest(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """name, row_count, byte_size, sha256 of written Parquet tables; the hash is that of their files' names and hashes, in order."""
    made = None
    for name, path in sorted(tables.items()):
        files = file_hashes(spark, path, "*.parquet").agg(
            F.sum("byte_size").alias("byte_size"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda f: F.concat_ws(" ", f["sha256"], f["path"])), "\n"), 256).alias("sha256"),
        )
        one = spark.read.parquet(path).agg(F.count("*").alias("row_count")).join(files).select(F.lit(name).alias("name"), "row_count", "byte_size", "sha256")
        made = one if made is None else made.unionByName(one)
    return made


def output_faults(reported: DataFrame, present: DataFrame) -> DataFrame:
    """name, reasons: outputs that the report of a run tells otherwise than they are; both as ``output_manifest`` gives them."""
    r = reported.select(F.col("name").alias("__n"), F.col("row_count").alias("__rows"), F.col("sha256").alias("__sha"))
    j = present.join(r, F.col("name") == F.col("__n"), "full")
    here, there = F.col("name").isNotNull(), F.col("__n").isNotNull()
    differ = lambda a, b: here & there & ~F.col(a).eqNullSafe(F.col(b))
    return j.select(F.coalesce("name", "__n").alias("name"), _reasons(F.when(~here, "not_written"), F.when(~there, "not_reported"), F.when(differ("row_count", "__rows"), "row_count"), F.when(differ("sha256", "__sha"), "sha256"))).where("reasons <> ''")


def summary_faults(reported: DataFrame, recomputed: DataFrame, *keys: str) -> DataFrame:
    """``keys``, reported, recomputed of every figure that a report gives otherwise than it comes out; both have keys and value."""
    r = reported.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("value").alias("reported"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    j = recomputed.select(*keys, F.col("value").alias("recomputed")).join(r, on, "full")
    return j.where(~F.col("recomputed").eqNullSafe(F.col("reported"))).select(*[F.coalesce(k, f"__{k}").alias(k) for k in keys], "reported", "recomputed")
