"""Every operator and stage on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import collections

import public_tokenizers as P
from pyspark.sql import functions as F

from lattica.llm import ann, jaccard, line_dedup, media, packing, pii, quality, segment, sharding, url_filter

BPE = P.path("word_bpe_49k.json")


def test_packing(docs, empty):
    rows = packing.pack(docs, packing.word_bpe(BPE)).collect()
    assert packing.pack(empty, packing.word_bpe(BPE)).count() == 0
    per = collections.Counter()
    for r in rows:
        per[r["doc_id"]] += r["length"]
    assert per[3] == per[4] == per[5] == 1 and per[None] == 8
    used = collections.defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing_ids_match_the_library(spark):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    texts = ["Hello, WORLD's  best", "<|endoftext|> İstanbul ﬁn", "a\tb\nc e\x1cf", "don't stop!!! 12³"]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), packing.word_bpe(BPE)).collect()
    for r in rows:
        ids = [*t.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4"))


def test_sharding(docs, empty):
    rows = sharding.karmarkar_karp_shards(docs, shards=3).collect()
    assert len(rows) == 10 and {r["law"] for r in rows} == {"bytes"}
    same = collections.defaultdict(set)
    for r in rows:
        same[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(s) == 1 for s in same.values())
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (3, 4)} == {(8, 0)}
    assert sharding.karmarkar_karp_shards(empty).count() == 0


def test_sharding_in_a_tree_with_hot_texts(spark, monkeypatch):
    """Blocks of blocks, and texts that many rows share: bytes stay even, equal texts together; sizes and checksums against the library."""
    import zlib

    monkeypatch.setattr(sharding, "BLOCK_GROUPS", 30)
    monkeypatch.setattr(sharding, "MOST_BLOCKS", 3)
    monkeypatch.setattr(sharding, "HOT_ROWS", 20)
    texts = ["é" * (i % 60) + str(i) for i in range(900)] + ["hot"] * 40 + [None] * 25
    rows = sharding.karmarkar_karp_shards(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards=4).collect()
    loads, of = collections.Counter(), collections.defaultdict(set)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == zlib.crc32(data)
        loads[r["shard"]] += r["size"]
        of[texts[r["doc_id"]]].add(r["shard"])
    assert len(rows) == len(texts) and all(len(s) == 1 for s in of.values()) and max(loads.values()) - min(loads.values()) <= 60
    for shard in loads:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_packing_of_many_empty_texts(monkeypatch):
    """Pieces of one id fill blocks by their number, so that no large matrix is made of them."""
    import numpy as np

    packer = packing.Packer(2048, 512, 0)
    for i in range(40_000):
        packer.add(i, np.ones(1, np.uint32))
        assert len(packer.pieces) < packing.BLOCK_PIECES
    packer.flush()
    loads = collections.Counter()
    for r in packer.out:
        loads[r[5]] += r[2]
    assert sum(loads.values()) == 40_000 and max(loads.values()) <= 2048 and len(loads) <= 22


def test_pii(docs, empty):
    got = pii.replace_pii(docs, b"k", count_col="node")
    rows = got.collect()
    assert len(rows) == 10 and set(got.columns) == set(docs.columns)
    by = {r["doc_id"]: r for r in rows}
    assert by[7]["node"] == 3 and "a@b.example.com" not in by[7]["text"] and by[3]["text"] is None and by[4]["text"] == ""
    assert by[1]["text"] == "the quick brown fox jumps over the lazy dog today" and by[8]["text"] == "ünïcode 日本 \U0001f600 text"
    assert pii.replace_pii(empty, b"k").count() == 0


def test_pii_is_the_same_when_overrides_are_joined(docs, monkeypatch):
    want = sorted(map(str, pii.replace_pii(docs, b"k").collect()))
    monkeypatch.setattr(pii, "BROADCAST_OVERRIDES", -1)
    assert sorted(map(str, pii.replace_pii(docs, b"k").collect())) == want


def test_line_dedup(docs, empty):
    got = line_dedup.line_dedup(docs, count_col="node")
    rows = got.collect()
    assert len(rows) == 10 and set(got.columns) == set(docs.columns)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["node"] == 0 and by[2]["text"] == "" and by[2]["node"] == 1 and by[3]["text"] is None and by[5]["text"] == "  \n \n"
    assert line_dedup.line_dedup(empty).count() == 0


def test_jaccard(docs, empty):
    rows = jaccard.similarity_components(docs).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert by[1] == (8, 1) and by[2] == (8, 1) and by[3] == (0, 3) and by[4] == (0, 4) and by[5] == (0, 5) and by[6] == (2998, 6) and by[None] == (5, None)
    assert jaccard.similarity_components(empty).count() == 0


def test_segmentation(docs, empty):
    path = P.path("piece_bpe_32k.model")
    got = segment.segmentations(docs, path, n=3, with_ids=True)
    rows = segment.decode(got, path).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(r["text"] == texts[r["doc_id"]] for r in rows)
    ranks = collections.Counter(r["doc_id"] for r in rows)
    assert ranks[3] == ranks[4] == 1 and ranks[1] == 3 and ranks[2] == 6
    assert segment.segmentations(empty, path).count() == 0


def test_quality(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1), (6, 1), (7, 0), (8, 0), (9, None), (4, 7)], "doc_id long, quality int")
    got = quality.classify_quality(docs, labels)
    assert got.count() == 10 and got.where("quality_score is null or keep is null").count() == 0
    assert quality.classify_quality(docs, labels.limit(0)).count() == 10 and quality.classify_quality(empty, labels).count() == 0


def test_url_filters(spark):
    pages = spark.createDataFrame([(1, "http://WWW.X.com/a?utm_s=1#f", "p"), (2, None, "p"), (3, "nonsense", "p"), (4, "ftp://x.com/a/", "p"), (4, "ftp://x.com/a/", "p"), (5, "http://y.org", "p"), (6, "http://x.com/a#y://z?q", "p"), (7, "http://x.com/a?q#y://z", "p"), (None, "http://", None)], "page_id long, url string, path string")
    listed = spark.createDataFrame([("x.com/a",), ("x.com/a",), (None,)], "canonical string")
    rows = url_filter.url_verdicts(pages, listed, [("allow", "y.org", "")]).collect()
    assert sorted((r["page_id"] or 0, r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in rows) == [
        (0, "", "", "", "allow"), (1, "www.x.com", "/a", "", "block"), (2, "", "", "", "allow"), (3, "", "", "", "allow"), (4, "x.com", "/a/", "", "block"), (4, "x.com", "/a/", "", "block"), (5, "y.org", "", "y.org", "allow"), (6, "x.com", "/a", "", "block"), (7, "x.com", "/a", "", "allow")]
    assert url_filter.url_verdicts(pages.limit(0), listed.limit(0), []).count() == 0


def test_ann(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0], "x") for i in range(60)] + [(100, None, "x"), (200, [0.0, 0.0, 0.0], "x"), (300, [1.0, float("nan"), 1.0], "x"), (400, [1.0, None, 2.0], "x"), (500, [1.0], "x"), (None, [1.0, 2.0, 3.0], "x"), (0, [0.0, 0.0, 1.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, entry string")
    got = ann.permutation_search(table, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert {r["query_id"] for r in got} == {0} and [r["rank"] for r in got] == list(range(1, 11))
    want = sorted((((i % 7) ** 2 + (i % 5) ** 2) ** 0.5, i) for i in range(1, 60))[:10]
    assert [(r["score"], r["vec_id"]) for r in got] == want
    assert ann.permutation_search(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_media(spark):
    pictures = [(i, bytearray(media.encode_pgm(media.render(i - i % 8 if i % 8 > 3 else i, max(0, i % 8 - 3))))) for i in range(16)]
    table = spark.createDataFrame([*pictures, (20, pictures[3][1]), (20, pictures[3][1]), (21, None), (22, bytearray(b"junk")), (23, bytearray(media.encode_pgm(media.render(1)[:9, :9]))), (None, pictures[2][1])], "image_id long, image binary")
    rows = media.image_copies(table).collect()
    assert len(rows) == 22
    by = {r["image_id"]: r["group_id"] for r in rows}
    assert all(by[i] == (i - i % 8 if i % 8 > 3 else i) for i in range(16))
    assert by[20] == 3 and by[21] == 21 and by[22] == 22 and by[23] == 23 and by[None] == 2
    assert media.image_copies(table.limit(0)).count() == 0
