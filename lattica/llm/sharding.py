"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows of equal text form a group that stays together.  Groups are dealt into
blocks; in each block differencing leaves one partial partition of ``shards``
sums; the blocks' partial partitions are differenced in turn, those of largest
spread first and oppositely ordered: in a tree of bounded blocks until few are
left, then together.  A group thus reaches its shard through (block, subset) -> shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kk
from .common import materialise

#: Groups (or partial partitions) differenced in one task, and the most partial partitions that meet in the driver.
BLOCK_GROUPS, MOST_BLOCKS = 4_000, 4_096
#: Rows of one text from which its shard reaches them by a broadcast (of at most all rows over this).
HOT_ROWS = 100_000
#: Rows numbered in one window partition, and the most such buckets.
BUCKET_ROWS, MOST_BUCKETS = 50_000, 16_384


def karmarkar_karp_shards(docs: DataFrame, shards: int = 24, overhead: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal every row of ``docs`` into shards of near-equal bytes.

    Returns ``id_col``, size, text_crc32, law ('bytes'), shard, slot, grown_shard.
    size is the text's UTF-8 bytes plus ``overhead``.  A null text counts as an
    empty one (size ``overhead``, CRC 0, one group with the empty texts).  Rows
    that repeat an id are rows of their own; slots run from 0 without gaps in
    each shard.  A null id is kept and sorts first.  No rows in: no rows out.
    Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("text_key"),
    )
    rows = materialise(rows, "shard-rows")
    groups = materialise(rows.groupBy("text_key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    n_groups = groups.count()
    blocks = max(1, -(-n_groups // BLOCK_GROUPS))

    def difference_block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "text_key"], ascending=[False, True], kind="stable")
        subset, _ = kk.items(pdf["bytes"].to_numpy(np.int64), shards)
        return pd.DataFrame({"text_key": pdf["text_key"], "bytes": pdf["bytes"], "block": pdf["block"], "subset": subset})

    dealt = groups.withColumn("block", F.pmod(F.xxhash64("text_key"), F.lit(blocks)).cast("int"))
    dealt = materialise(dealt.groupBy("block").applyInPandas(difference_block, "text_key binary, bytes long, block int, subset int"), "shard-subsets")
    owners = dealt.select("text_key", "block", "subset")
    sums = dealt.groupBy("block", "subset").agg(F.sum("bytes").alias("bytes"))

    def difference_sums(pdf: pd.DataFrame) -> pd.DataFrame:
        names, at = np.unique(pdf["block"].to_numpy(), return_inverse=True)
        loads = np.zeros((len(names), shards), np.int64)
        loads[at, pdf["subset"].to_numpy()] = pdf["bytes"].to_numpy()
        place, _ = kk.difference(loads)
        return pd.DataFrame({"block": pdf["block"], "subset": pdf["subset"], "bytes": pdf["bytes"], "above": pdf["above"], "place": place[at, pdf["subset"].to_numpy()]})

    while blocks > MOST_BLOCKS:
        blocks = -(-blocks // MOST_BLOCKS)
        lifted = sums.withColumn("above", F.pmod(F.xxhash64("block"), F.lit(blocks)).cast("int"))
        lifted = materialise(lifted.groupBy("above").applyInPandas(difference_sums, "block int, subset int, bytes long, above int, place int"), "shard-lifted")
        owners = owners.join(lifted.select("block", "subset", "above", "place"), ["block", "subset"]).select("text_key", F.col("above").alias("block"), F.col("place").alias("subset"))
        sums = lifted.groupBy(F.col("above").alias("block"), F.col("place").alias("subset")).agg(F.sum("bytes").alias("bytes"))
    # at most MOST_BLOCKS x shards sums
    sums = sums.collect()
    names = sorted({r["block"] for r in sums})
    loads = np.zeros((len(names), shards), np.int64)
    for r in sums:
        loads[np.searchsorted(names, r["block"]), r["subset"]] = r["bytes"]
    place, _ = kk.difference(loads)
    plan = pd.DataFrame({"block": np.repeat(names, shards).astype("int32"), "subset": np.tile(np.arange(shards, dtype="int32"), len(names)), "shard": place.reshape(-1).astype("int32")})
    plan = spark.createDataFrame(plan, "block int, subset int, shard int")
    owners = materialise(owners.join(F.broadcast(plan), ["block", "subset"]).select("text_key", "shard"), "shard-owners")
    hot = materialise(groups.where(F.col("n") >= HOT_ROWS).select("text_key").join(owners, "text_key"), "shard-hot")
    cold = rows.join(F.broadcast(hot.select("text_key")), "text_key", "left_anti").join(owners.hint("merge"), "text_key")
    placed = cold.unionByName(rows.join(F.broadcast(hot), "text_key"))

    n_buckets = max(64, min(MOST_BUCKETS, rows.count() // BUCKET_ROWS))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_key", F.lit(1)), F.lit(n_buckets)).cast("int"))
    placed = materialise(placed, "shard-placed")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    here = Window.partitionBy("bucket", "shard").orderBy("doc_id", "text_key")
    # starts has at most shards x n_buckets rows
    return (
        placed.withColumn("n", F.row_number().over(here))
        .join(F.broadcast(starts), ["shard", "bucket"])
        .select(F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("n") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
