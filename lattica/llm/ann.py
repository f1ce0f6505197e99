"""Approximate nearest neighbours by a permutation index.

Each distinct vector is represented by the order of its nearest pivots.  The
index is kept in blocks of rows; in a block every pivot has an inverted file
that holds the block's vectors with the pivot's place in their orders.  A query
reads the files of its own pivots, sums the differences of the places to the
footrule distance of the two orders, and the best by footrule are reranked by
the exact distance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Rows from which pivots may be chosen; pivots; length of an order.
SAMPLE_ROWS, PIVOTS, ORDER = 20_000, 128, 128
#: Distinct vectors in a block of the index, and queries that meet it at once.
BLOCK_ROWS, BLOCK_QUERIES = 1_000, 2_000
#: Vectors of a block that are reranked: so many at least, and this share.
RERANK, RERANK_SHARE = 250, 0.12


def valid(vec) -> F.Column:
    """Not null, without null, NaN or infinite components, not all zero."""
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)


def _orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first, ties to the smaller pivot."""
    far = (vectors**2).sum(1)[:, None] - 2 * vectors @ pivots.T + (pivots**2).sum(1)[None]
    return np.argsort(far, axis=1, kind="stable")[:, :length].astype(np.int32)


def _places(orders: np.ndarray, n_pivots: int) -> np.ndarray:
    """Inverted files: a row for each pivot, with its place in every vector's order (the order's length where it is not in it)."""
    n, length = orders.shape
    files = np.full((n_pivots, n), length, np.int16)
    np.put_along_axis(files, orders.T, np.arange(length, dtype=np.int16)[:, None], axis=0)
    return files


def permutation_search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query among all other rows.

    ``is_query``: a boolean column over ``vectors``.  Returns query_id, rank
    (from 1), vec_id, score: Euclidean distance in double precision on the
    original vectors; nearest first, ties to the smaller id; fewer rows where
    there are fewer candidates.  Vectors that are null, zero, or hold a null or
    non-finite component take no part, nor do those of another width than the
    most frequent one, nor rows without an id.  Rows that repeat id and vector
    count once.  Equal vectors are one entry of the index; as ties go to smaller
    ids, a query can get no more than the ``k`` + 1 smallest ids of an entry,
    so no others are kept with it.  Empty table: no rows.  Other columns are not read.

    Pivots are chosen from a sample of ``SAMPLE_ROWS`` rows by hash; every row
    is indexed.  Blocks of queries meet blocks of the index, so that a task
    holds a bounded part of each.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"), is_query.alias("is_query")).where(F.col("vec_id").isNotNull() & valid(F.col("vec")))
    rows = materialise(rows.withColumn("key", F.xxhash64("vec")), "ann-rows")
    widths = rows.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not widths:
        return spark.createDataFrame([], result)
    width = widths[0]["w"]
    rows = rows.where(F.size("vec") == width)

    # members of an entry: the k + 1 smallest ids, found in salted parts first
    salted = Window.partitionBy("vec", "salt").orderBy("vec_id")
    whole = Window.partitionBy("vec").orderBy("vec_id")
    members = rows.select("vec_id", "vec", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt"))
    members = members.withColumn("n", F.dense_rank().over(salted)).where(F.col("n") <= k + 1)
    members = members.withColumn("n", F.dense_rank().over(whole)).where(F.col("n") <= k + 1).select("vec", "vec_id").distinct()
    members = materialise(members.withColumn("entry", F.min("vec_id").over(Window.partitionBy("vec"))), "ann-members")
    entries = members.where(F.col("vec_id") == F.col("entry")).select("entry", "vec")
    n_entries = entries.count()

    sample = rows.select("vec", F.xxhash64("vec_id", F.lit(3)).alias("h")).orderBy("h").limit(SAMPLE_ROWS).select("vec", "h")
    pivots = np.array([r["vec"] for r in sample.groupBy("vec").agg(F.min("h").alias("h")).orderBy("h").limit(PIVOTS).collect()])
    length = min(ORDER, len(pivots))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            held = held.sort_values("entry", kind="stable")
            ids, vecs = held["entry"].to_numpy(), np.stack(held["vec"].to_numpy())
            files = _places(_orders(vecs, pivots, length), len(pivots))
            take = min(len(held), max(RERANK, int(len(held) * RERANK_SHARE)))
            wanted = np.stack(asked["vec"].to_numpy())
            for q, vec, own in zip(asked["vec_id"], wanted, _places(_orders(wanted, pivots, length), len(pivots)).T, strict=True):
                footrule = np.abs(files - own[:, None]).sum(0, dtype=np.int32)
                near = np.argpartition(footrule, take - 1)[:take]
                score = np.sqrt(((vecs[near] - vec) ** 2).sum(1))
                best = np.lexsort((ids[near], score))[: k + 1]
                out.append((np.full(len(best), q), ids[near][best], score[best]))
        query, entry, score = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.array([], np.int64), np.array([], np.int64), np.array([], float))
        return pd.DataFrame({"query_id": query, "entry": entry, "score": score})

    queries = rows.where("is_query").select("vec_id", "vec").distinct()
    index_blocks, query_blocks = -(-n_entries // BLOCK_ROWS), max(1, -(-queries.count() // BLOCK_QUERIES))
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    dealt = lambda col, n, name: F.pmod(F.xxhash64(col, F.lit(5)), F.lit(n)).cast("int").alias(name)
    asked = queries.select("vec_id", "vec", every(index_blocks, "block"), dealt("vec_id", query_blocks, "asked_in"))
    held = entries.select("entry", "vec", dealt("entry", index_blocks, "block"), every(query_blocks, "asked_in"))
    found = asked.groupBy("block", "asked_in").cogroup(held.groupBy("block", "asked_in")).applyInPandas(search, "query_id long, entry long, score double")
    per_query = Window.partitionBy("query_id")
    found = found.distinct().withColumn("n", F.row_number().over(per_query.orderBy("score", "entry"))).where(F.col("n") <= k + 1)
    pairs = found.join(members.select("entry", "vec_id"), "entry").where(F.col("vec_id") != F.col("query_id"))
    return pairs.withColumn("rank", F.row_number().over(per_query.orderBy("score", "vec_id"))).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
