"""Centres over model versions: which go on, split, merge or are named anew, and what each came from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a successor came to be; ``continues`` keeps the identity and is no lineage.
SPLIT, MERGED, SUPERSEDED, RENAMED, CONTINUES = "split_into", "merged_into", "superseded_by", "reidentified_as", "continues"


def overlaps(members: DataFrame) -> DataFrame:
    """Centres of consecutive versions that share cells: version, predecessor, successor, cells, mass and their shares of both.

    ``members``: version (int), center_id, cell, mass; a cell is in one centre
    of a version.  ``version`` of the result is the successor's.
    """
    m = members.select("version", "center_id", "cell", F.coalesce(F.col("mass").cast("double"), F.lit(0.0)).alias("mass"))
    size = m.groupBy("version", "center_id").agg(F.count("*").alias("size"), F.sum("mass").alias("total"))
    versions = m.select("version").distinct()
    # the version before, also where numbers leave gaps
    before = versions.alias("a").join(versions.alias("b"), F.col("b.version") < F.col("a.version")).groupBy(F.col("a.version").alias("version")).agg(F.max("b.version").alias("earlier"))
    old = m.select(F.col("version").alias("earlier"), F.col("center_id").alias("predecessor"), "cell", F.col("mass").alias("old_mass"))
    met = m.join(F.broadcast(before), "version").join(old, ["earlier", "cell"])
    pairs = met.groupBy("version", "earlier", "predecessor", F.col("center_id").alias("successor")).agg(F.count("*").alias("cells"), F.sum("old_mass").alias("old_mass"), F.sum("mass").alias("new_mass"))
    sized = lambda at, who, tag: size.select(F.col("version").alias(at), F.col("center_id").alias(who), F.col("size").alias(f"{tag}_size"), F.col("total").alias(f"{tag}_total"))
    j = pairs.join(sized("earlier", "predecessor", "old"), ["earlier", "predecessor"]).join(sized("version", "successor", "new"), ["version", "successor"])
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0.0)), F.lit(0.0))
    return j.select(
        "version", "earlier", "predecessor", "successor", "cells", (F.col("cells") / F.col("old_size")).alias("old_cell_share"), (F.col("cells") / F.col("new_size")).alias("new_cell_share"),
        share("old_mass", "old_total").alias("old_mass_share"), share("new_mass", "new_total").alias("new_mass_share"),
    )


def lineage(members: DataFrame, anchors: DataFrame, linked: float = 0.5, same: float = 0.5) -> DataFrame:
    """version, earlier, predecessor, successor, relation of all centres that are linked over a version.

    Two are linked where they share ``linked`` of the mass of either.  Told by
    degrees: one predecessor with several successors is split, several with one
    are merged, and where both hold it is superseded.  One with one continues
    if both share ``same`` of their cells and mass and the predecessor's anchor
    (``anchors``: version, center_id, cell) lies in the successor; else it is
    named anew.  Neither names nor centroids decide.
    """
    edges = overlaps(members).where((F.col("old_mass_share") >= linked) | (F.col("new_mass_share") >= linked))
    after = edges.groupBy("version", "predecessor").agg(F.count("*").alias("successors"))
    back = edges.groupBy("version", "successor").agg(F.count("*").alias("predecessors"))
    peak = anchors.select(F.col("version").alias("earlier"), F.col("center_id").alias("predecessor"), "cell")
    home = members.select("version", F.col("center_id").alias("successor"), "cell")
    kept = edges.select("version", "earlier", "predecessor", "successor").join(peak, ["earlier", "predecessor"]).join(home, ["version", "successor", "cell"]).select("version", "predecessor", "successor").distinct().withColumn("anchored", F.lit(True))
    j = edges.join(after, ["version", "predecessor"]).join(back, ["version", "successor"]).join(kept, ["version", "predecessor", "successor"], "left")
    alike = reduce(Column.__and__, [F.col(c) >= same for c in ("old_cell_share", "new_cell_share", "old_mass_share", "new_mass_share")])
    several_out, several_in = F.col("successors") > 1, F.col("predecessors") > 1
    relation = F.when(several_out & several_in, SUPERSEDED).when(several_out, SPLIT).when(several_in, MERGED).when(alike & F.coalesce("anchored", F.lit(False)), CONTINUES).otherwise(RENAMED)
    return j.select("version", "earlier", "predecessor", "successor", relation.alias("relation"))


def ancestors(links: DataFrame, versions: int) -> DataFrame:
    """version, successor, ancestor, ancestor_version, steps: all that each centre came from.

    ``links`` as ``lineage`` gives them, ``versions`` the number of versions; an
    ancestor that is reached in several ways stands once.  The walk has as many
    joins as there are versions, less two.
    """
    one = links.select("version", "successor", F.col("predecessor").alias("ancestor"), F.col("earlier").alias("ancestor_version")).distinct()
    found, last = [one.withColumn("steps", F.lit(1))], one
    for step in range(2, versions):
        further = one.select(F.col("version").alias("ancestor_version"), F.col("successor").alias("ancestor"), F.col("ancestor").alias("__a"), F.col("ancestor_version").alias("__v"))
        last = last.join(further, ["ancestor_version", "ancestor"]).select("version", "successor", F.col("__a").alias("ancestor"), F.col("__v").alias("ancestor_version")).distinct()
        found.append(last.withColumn("steps", F.lit(step)))
    return reduce(DataFrame.unionByName, found)


def identities(links: DataFrame, members: DataFrame) -> DataFrame:
    """version, center_id, first_version, first_id: under which identity a centre goes on; all else is minted anew.

    A centre that continues has the identity of the one it continues, back to
    the first; one that was split, merged, superseded or named anew has its own.
    """
    own = members.select("version", "center_id").distinct()
    goes_on = links.where(F.col("relation") == CONTINUES).select("version", F.col("successor").alias("center_id"), F.col("earlier").alias("first_version"), F.col("predecessor").alias("first_id"))
    j = own.join(goes_on, ["version", "center_id"], "left").select("version", "center_id", F.coalesce("first_version", "version").alias("first_version"), F.coalesce("first_id", "center_id").alias("first_id"))
    count = own.select("version").distinct().count()
    for _ in range(max(count.bit_length(), 1)):
        # a pointer jumps to where its own points
        hop = j.select(F.col("version").alias("first_version"), F.col("center_id").alias("first_id"), F.col("first_version").alias("__v"), F.col("first_id").alias("__i"))
        j = j.join(hop, ["first_version", "first_id"]).select("version", "center_id", F.col("__v").alias("first_version"), F.col("__i").alias("first_id"))
    return j
