"""Helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in one Arrow batch sent to Python.
ARROW_ROWS, ARROW_BYTES = 4_000, 8 << 20
#: While a table is written, its shuffles' files go as soon as the write ends: the table stands for them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session does not name one and driver and executors are one
    process, a new temporary folder is used and noted in the session; on a
    cluster that is an error, as each executor would write to its own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("lattica.shared.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="lattica-")
        spark.conf.set("lattica.shared.dir", path)
    return path.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}.parquet"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before else spark.conf.unset(SHUFFLE_CLEANUP)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote, once all that was made of them is written too."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._written_to)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def arrow_rows(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python by rows and bytes, so that long texts fit in a worker.

    The session keeps the bounds, as they are read when a plan runs.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        spark.conf.set(key, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
