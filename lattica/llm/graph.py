"""Connected components by rounds of joins; nothing of the graph is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

#: Edges up to which a round's minima (two an edge at most) are broadcast and written by so few tasks.
FEW_EDGES, FEW_TASKS = 250_000, 8


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label): every id of an edge, with the smallest id reachable from it.

    Alternating stars: each node's larger neighbours, then its smaller ones, are
    linked to its smallest neighbour, until the edges are stars.  Rounds grow
    with the logarithm of the longest path; sums are taken before rows move.
    A round of few edges moves only their minima, and in a few tasks, however
    many partitions the session asks for; its result is the same.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = materialise(pairs, "edges")
    n_edges, before = pairs.count(), None
    while True:
        few = n_edges <= FEW_EDGES
        narrow = lambda df: df.coalesce(FEW_TASKS) if few else df  # noqa: B023, E731
        sent = lambda df: F.broadcast(narrow(df)) if few else df  # noqa: B023, E731
        # large star: from each node, larger neighbours go to its smallest neighbour or itself
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(sent(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: from each node, it and its smaller neighbours go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(sent(low), "u").select(F.explode(F.array("u", "v")).alias("u"), "m").where("u <> m").select("u", F.col("m").alias("v")).distinct()
        last, pairs = pairs, materialise(narrow(small), "edges")
        discard(last)
        state = pairs.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            return pairs.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
        n_edges, before = state[0], state
