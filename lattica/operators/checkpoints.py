"""Reliable checkpoints in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def ensure_folder(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir``; a temporary folder only where driver and executors are one process."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        return
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        path = tempfile.mkdtemp()
    spark.sparkContext.setCheckpointDir(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder and cut off from what it was made of."""
    ensure_folder(df.sparkSession)
    return df.checkpoint()
