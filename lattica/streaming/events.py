"""Windows over an event table: the same plan in batch and as a stream (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(df: DataFrame, late: str) -> DataFrame:
    """Event time as a timestamp; a stream gets a watermark."""
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df.withWatermark("ts", late) if df.isStreaming else df


def tumbling(events: DataFrame, width: str, late: str = "10 minutes") -> DataFrame:
    """Count and sum of each type in windows of fixed width."""
    g = _timed(events, late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value_sum"))
    return g.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "value_sum")


def sessions(events: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of each user: events less than ``gap`` apart."""
    g = _timed(events, late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("session_start"), "n")


def latest(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """The latest event of each user and type; as a stream in update or complete mode."""
    return _timed(events, late).groupBy("user_id", "event_type").agg(F.max("ts").alias("latest"))
