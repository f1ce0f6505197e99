"""Exact n-gram Jaccard join with count-vector points under R-trees.

Shingles are hashed into groups; a document's group counts are a point.  The
points are dealt into tiles by exact parts of them: of all groups, ``slabs``
many blocks are made, more than two linked sets can differ in, so that two such
sets agree on a whole block, and documents that agree on a block share a tile.
In a tile the sum of coordinate minima bounds the overlap, first of R-tree
nodes, then of points; surviving pairs are verified on the shingle sets.

One document of a tile is compared with all others first.  Only tiles whose
members are not in one component after that are joined in full by R-trees, in
pairs of chunks of bounded size.  There a parity sketch bounds the difference of
two sets from below, as the points bound their overlap from above.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, discard, materialise
from .graph import components
from .packing import chunks
from .shingles import mix, shingle_sets

#: Coordinates of a point; bits of a sketch; points of an R-tree leaf; members of a tile in one chunk; candidates whose ids are broadcast.
GROUPS, SKETCH, LEAF, CHUNK, BROADCAST_IDS = 64, 4_096, 16, 1_000, 500_000
#: Members of the small tiles that one call joins.
CALL_MEMBERS = 4_000


class Bands:
    """Bands of set sizes, and the blocks that sets of a band are cut into.

    Sets of sizes a <= b that link (share >= num/den of their union) differ in at
    most (a + b)(den - num)/(den + num) elements.  A band reaches over
    ``widen`` times that ratio; a set is placed in its own band and, if it can
    link with a set of the next band, in that one too.
    """

    #: Elements that a block of the smallest set of a band should hold on average, at least, so that few blocks are empty.
    FILLED = 3.4

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        ratio, most = num / den, (den + num) / (2 * (den - num)) if den > num else 1e9
        self.widen = int(np.clip(np.floor(np.log(self.FILLED / most) / np.log(ratio)), 1, 4)) if ratio < 1 else 1
        self.upper = np.zeros(1, np.int64)

    def _grow(self, size: int) -> None:
        upper = self.upper.tolist()
        while upper[-1] <= size:
            low = upper[-1] + 1
            upper.append(max(low, int(low * (self.den / self.num) ** self.widen)))
        self.upper = np.array(upper, np.int64)

    def places(self, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Twice: which sets, and their band."""
        self._grow(int(sizes.max(initial=1)) * 2)
        own = np.searchsorted(self.upper, sizes)
        after = np.flatnonzero((sizes > 0) & (sizes * self.den >= self.num * (self.upper[own] + 1)))
        here = np.flatnonzero(sizes > 0)
        return [(here, own[here]), (after, own[after] + 1)]

    def blocks(self, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of each band, and how many of them may be empty; no blocks where only equal sets link."""
        differ = 2 * self.upper[band] * (self.den - self.num) // (self.den + self.num)
        low = self.upper[np.maximum(band - 1, 0)] + 1
        spare = np.ones(len(band))
        for _ in range(3):
            # empty blocks of the band's smallest sets, with four deviations to spare
            n = differ + 1 + spare
            empty = n * np.exp(-low / n)
            spare = np.ceil(1 + empty + 4 * np.sqrt(empty))
        spare = spare.astype(np.int64)
        return np.where(differ > 0, differ + 1 + spare, 0), spare


def tile_keys(sets: list[np.ndarray], bands: Bands) -> list[np.ndarray]:
    """Each set's tiles: a hash of band, block and the block's elements.

    A block without elements makes no tile, unless a set has more of them than
    are spare; two sets that both have more meet in those tiles as well.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out: list[list[np.ndarray]] = [[] for _ in sets]
    with np.errstate(over="ignore"):
        spread = mix(flat + np.uint64(0x51ED))
        for which, band in bands.places(sizes):
            n_blocks, spare = bands.blocks(band)
            use = n_blocks > 0
            which, band, n_blocks, spare = which[use], band[use], n_blocks[use], spare[use]
            if not len(which):
                continue
            n = sizes[which]
            ends = np.cumsum(n)
            at = np.repeat(starts[which] - (ends - n), n) + np.arange(ends[-1])
            block_of = (flat[at] % np.repeat(n_blocks, n).astype(np.uint64)).astype(np.int64)
            offset = np.cumsum(n_blocks) - n_blocks
            key = np.repeat(offset, n) + block_of
            total = int(n_blocks.sum())
            # exact sums of 32-bit halves, then joined modulo 2^64
            low = np.bincount(key, weights=(spread[at] & np.uint64(0xFFFFFFFF)).astype(float), minlength=total).astype(np.uint64)
            high = np.bincount(key, weights=(spread[at] >> np.uint64(32)).astype(float), minlength=total).astype(np.uint64)
            filled = np.bincount(key, minlength=total) > 0
            names = np.repeat(band, n_blocks).astype(np.uint64) * np.uint64(1 << 40) + (np.arange(total) - np.repeat(offset, n_blocks)).astype(np.uint64)
            made = mix(low + (high << np.uint64(32)) + mix(names + np.uint64(1)))
            for i, a, b, most in zip(which.tolist(), offset.tolist(), (offset + n_blocks).tolist(), spare.tolist(), strict=True):
                there = filled[a:b]
                out[i].append(made[a:b] if (b - a) - there.sum() > most else made[a:b][there])
    return [np.concatenate([*x, np.zeros(0, np.uint64)]) for x in out]


def points(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Group counts of each set."""
    return [np.bincount((mix(s + np.uint64(77)) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS).astype(np.int32) for s in sets]


def sketches(sets: list[np.ndarray]) -> list[bytes]:
    """Parities of the elements at each of ``SKETCH`` places: two sets differ in no fewer elements than their sketches in bits."""
    counts = (np.bincount((mix(s + np.uint64(0xA5A5)) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) for s in sets)
    return [np.packbits((c & 1).astype(np.uint8)).tobytes() for c in counts]


def _longs(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)))


class RTree:
    """Packed leaves of points, each with the largest value of every coordinate."""

    def __init__(self, pts: np.ndarray):
        self.order = np.lexsort((pts[:, 1], pts[:, 0], pts.sum(1)))
        self.leaves = [self.order[i : i + LEAF] for i in range(0, len(pts), LEAF)]
        self.most = np.stack([pts[leaf].max(0) for leaf in self.leaves]) if self.leaves else np.zeros((0, pts.shape[1]), pts.dtype)
        self.least = np.array([pts[leaf].sum(1).min() for leaf in self.leaves])


def tree_join(a: np.ndarray, b: np.ndarray, num: int, den: int):
    """Index pairs of points whose summed minima allow a link."""
    ta, tb = RTree(a), RTree(b)
    na, nb = a.sum(1), b.sum(1)
    for i, leaf in enumerate(ta.leaves):
        bound = np.minimum(ta.most[i], tb.most).sum(1)
        for j in np.flatnonzero(bound * (num + den) >= num * (ta.least[i] + tb.least)):
            other = tb.leaves[j]
            shared = np.minimum(a[leaf][:, None], b[other][None]).sum(2)
            x, y = np.nonzero(shared * (num + den) >= num * (na[leaf][:, None] + nb[other][None]))
            yield from zip(leaf[x].tolist(), other[y].tolist(), strict=True)


def join_chunks(pdf: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """a, b: once for each call, the pairs of members of different labels that may link."""
    out = set()
    for _, one in pdf.sort_values(["tile", "c", "d", "node"]).groupby(["tile", "c", "d"], sort=False):
        left, right = one[one["part"] == one["c"]], one[one["part"] == one["d"]]
        if not len(left) or not len(right):
            continue
        pairs = np.array(list(tree_join(np.stack(left["point"].to_numpy()), np.stack(right["point"].to_numpy()), num, den)), np.int64).reshape(-1, 2)
        pairs = pairs[left["label"].to_numpy()[pairs[:, 0]] != right["label"].to_numpy()[pairs[:, 1]]]
        x, y = (np.frombuffer(b"".join(side["sketch"]), np.uint64).reshape(len(side), -1) for side in (left, right))
        for some in np.array_split(pairs, 1 + len(pairs) // 10_000):
            i, j = some[:, 0], some[:, 1]
            apart = np.bitwise_count(x[i] ^ y[j]).sum(1, dtype=np.int64)
            may = apart * (num + den) <= (left["n"].to_numpy()[i] + right["n"].to_numpy()[j]) * (den - num)
            a, b = left["node"].to_numpy()[i[may]], right["node"].to_numpy()[j[may]]
            out.update(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
    return pd.DataFrame(sorted(out), columns=["a", "b"]).astype("int64")


def calls_for(told: DataFrame) -> int:
    """Calls that hold ``CALL_MEMBERS`` rows on average: a member is copied to as many chunk pairs as its tile has chunks."""
    return max(1, -(-(told.agg(F.sum("parts")).first()[0] or 0) // CALL_MEMBERS))


def similarity_components(docs: DataFrame, num: int = 90, den: int = 100, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Two documents link when ``den`` times the shared shingles reach ``num``
    times those of their union.  component_id is the smallest id reachable over
    links.  A text with fewer than ``words`` words is one shingle; a null, empty
    or blank text has none, links with nothing and is its own component.  Equal
    sets are one node, however many rows have them.  Rows that repeat an id are
    judged each by its own text.  A row without an id gets its component's
    smallest id, or null.  No rows in: no rows out.  Other columns are not read.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def describe(batches):
        bands = Bands(num, den)
        for batch in batches:
            for a, part in chunks(batch.column(1)):
                sets = shingle_sets(part, words)
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(part)), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), _longs(tile_keys(sets, bands))], ["doc_id", "n_shingles", "set_key", "tiles"])

    rows = materialise(source.mapInArrow(describe, "doc_id long, n_shingles long, set_key binary, tiles array<long>"), "jaccard-rows")
    sets_of = materialise(rows.select("doc_id", "n_shingles", "set_key"), "jaccard-sets")
    nodes = materialise(sets_of.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("node")), "jaccard-nodes")

    # tiles with at least two nodes; of tiles with the same members one is enough
    others = sets_of.select("doc_id", "set_key").join(nodes, "set_key").where("doc_id <> node").select("doc_id", "set_key")
    others = materialise(others, "jaccard-others")
    chosen = rows.where("set_key is not null and doc_id is not null").join(F.broadcast(others) if others.count() <= BROADCAST_IDS else others, ["doc_id", "set_key"], "left_anti")
    posts = chosen.select(F.col("doc_id").alias("node"), F.explode("tiles").alias("tile"))
    in_tile = Window.partitionBy("tile")
    posts = posts.withColumn("hub", F.min("node").over(in_tile)).withColumn("last", F.max("node").over(in_tile))
    shared = materialise(posts.where("hub <> last").select("tile", "hub", "node").distinct(), "jaccard-shared")
    discard(rows, others)
    whole = lambda seed: F.sum(F.xxhash64("node", F.lit(seed)).cast("decimal(20,0)"))
    named = shared.groupBy("tile", "hub").agg(F.count("*").alias("members"), whole(1).alias("who"), whole(2).alias("who2"))
    named = named.groupBy("members", "hub", "who", "who2").agg(F.min("tile").alias("tile"))
    tiles = materialise(shared.join(named.select("tile", "members"), "tile"), "jaccard-tiles")
    discard(shared)

    # points and sets of the nodes in tiles, from their texts again; a row that repeats a node's id with another set is left out
    wanted = nodes.join(tiles.select("node").distinct(), "node").select(F.col("node").alias("doc_id"), F.col("set_key").alias("wanted_key"))
    wanted = materialise(wanted, "jaccard-wanted")
    few = wanted.count() <= BROADCAST_IDS
    picked = source.join(F.broadcast(wanted) if few else wanted, "doc_id").select("doc_id", "text", "wanted_key")

    def detail(batches):
        for batch in batches:
            for a, part in chunks(batch.column(1)):
                ids, keys = batch.column(0).slice(a, len(part)), batch.column(2).slice(a, len(part)).to_pylist()
                sets = shingle_sets(part, words)
                keep = [i for i, s in enumerate(sets) if xxhash.xxh3_128_digest(s.tobytes()) == keys[i]]
                sets = [sets[i] for i in keep]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep, pa.int64())), pa.array([p.tolist() for p in points(sets)], pa.list_(pa.int32())), pa.array(sketches(sets), pa.binary()), _longs(sets)], ["node", "point", "sketch", "shingles"])

    details = materialise(picked.mapInArrow(detail, "node long, point array<int>, sketch binary, shingles array<long>"), "jaccard-details")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that link: the bounds by minima and by sketches first, then the sets of those that are left."""
        pairs = materialise(pairs.distinct(), "jaccard-pairs")

        def joined(pairs: DataFrame, *columns: str) -> DataFrame:
            ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
            named = details.select("node", *columns).join(ids, "node", "left_semi")
            side = lambda name: named.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])
            return pairs.join(side("a"), "a").join(side("b"), "b")

        def bounded(batches):
            for batch in batches:
                x, y = (np.stack(batch.column(f"point_{s}").to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, GROUPS)) for s in "ab")
                both = x.sum(1) + y.sum(1)
                bits = [np.frombuffer(b"".join(batch.column(f"sketch_{s}").to_pylist()), np.uint64).reshape(-1, SKETCH // 64) for s in "ab"]
                apart = np.bitwise_count(bits[0] ^ bits[1]).sum(1, dtype=np.int64)
                may = (np.minimum(x, y).sum(1) * (num + den) >= both * num) & (apart * (num + den) <= both * (den - num))
                keep = pa.array(np.flatnonzero(may))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], ["a", "b"])

        alive = joined(pairs, "point", "sketch").select("a", "b", "point_a", "point_b", "sketch_a", "sketch_b").mapInArrow(bounded, "a long, b long")
        alive = materialise(alive, "jaccard-alive")
        both = joined(alive, "shingles")
        shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
        found = materialise(both.where(shared * (num + den) >= (F.size("shingles_a") + F.size("shingles_b")) * num).select("a", "b"), "jaccard-links")
        discard(pairs, alive)
        return found

    def unresolved(labels: DataFrame) -> DataFrame:
        """Members, with their labels, of tiles of three and more that still hold several labels."""
        told = tiles.where("members > 2").join(labels.withColumnRenamed("id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node"))
        apart = told.groupBy("tile").agg(F.min("label").alias("x"), F.max(F.struct("label", (-F.col("node")).alias("n"))).alias("y")).where("x <> y.label")
        return materialise(told.join(apart.select("tile", F.col("y.label").alias("second_label"), (-F.col("y.n")).alias("second")), "tile"), "jaccard-apart")

    links = verified(tiles.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")))
    labels = components(links)
    told = unresolved(labels)
    if not told.isEmpty():
        # a second star, about a node of the tile's last label
        again = told.where("label <> second_label and node <> hub").select(F.col("second").alias("a"), F.col("node").alias("b"))
        links = links.unionByName(verified(again))
        told = unresolved(components(links))
        # what is still apart is joined in full: a chunk meets every chunk, itself included, as (smaller, larger)
        told = told.withColumn("parts", F.ceil(F.col("members") / CHUNK).cast("int")).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        met = told.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("tile", F.least("part", "other").alias("c"), F.greatest("part", "other").alias("d"), "part", "node", "label")
        met = met.join(details.select("node", F.size("shingles").alias("n"), "point", "sketch"), "node")
        calls = F.pmod(F.xxhash64("tile", "c", "d"), F.lit(calls_for(told))).alias("call")
        links = links.unionByName(verified(met.groupBy(calls).applyInPandas(lambda pdf: join_chunks(pdf, num, den), "a long, b long")))
        labels = components(links)
    discard(tiles, wanted, details)
    labels = labels.withColumnRenamed("id", "node")
    found = nodes.join(labels, "node", "left").select("set_key", F.coalesce("label", "node").alias("found"))
    return sets_of.join(found, "set_key", "left").select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))
