"""Registered queries and operators against brute force, exact round trips and held-out accuracy."""

import collections
import itertools
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lattica.llm import graph, jaccard, kk, line_dedup, pii, quality, segment
from lattica.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def documents(sf):
    return pd.read_parquet(f"{sf}/documents.parquet")


def root_of(links, ids):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0d]+", text.translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute_components(texts, num, den, k):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * den >= num * max(len(sets[a]), len(sets[b])) and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    roots = root_of(links, sets)
    return {i: (len(sets[i]), roots[i]) for i in sets}


def test_jaccard_query(spark, sf, documents):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op10_jaccard"](spark, sf).collect()}
    assert got == brute_components(dict(zip(documents.doc_id, documents.text, strict=True)), 90, 100, 3)


@pytest.mark.parametrize("chunk", [3, 1000])
def test_jaccard_of_chains(spark, monkeypatch, chunk):
    """Near copies of near copies, most of them not like the first one; small chunks meet each other."""
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    texts, base = {}, [f"w{i}" for i in range(90)]
    for i in range(60):
        if i % 20 == 0:
            base = [f"v{i}_{j}" for j in range(90)]
        base = base.copy()
        base[int(rng.integers(90))] = f"x{i}"
        texts[i] = " ".join(base)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similarity_components(df, 80, 100, 3).collect()}
    want = brute_components(texts, 80, 100, 3)
    assert got == want and len({c for _, c in want.values()}) < 30


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 2**32 - 1))
def test_linked_sets_share_a_tile(size, changes, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    b = np.unique(np.concatenate([a[min(changes, len(a)) :], rng.integers(0, 2**63, int(rng.integers(0, 60))).astype(np.uint64)]))
    if len(b) and 10 * len(np.intersect1d(a, b)) >= 9 * len(np.union1d(a, b)) and not np.array_equal(a, b):
        x, y = jaccard.tile_keys([a, b], jaccard.Bands(90, 100))
        assert len(np.intersect1d(x, y))
        p, q = jaccard.points([a, b])
        assert list(jaccard.tree_join(p[None], q[None], 90, 100)) == [(0, 0)]
        x, y = (np.frombuffer(s, np.uint64) for s in jaccard.sketches([a, b]))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def word_matches(lines):
    """Numbers of the lines that any earlier one matches by 4/5 of the words of both, by brute force over an inverted index."""
    holds, gone = collections.defaultdict(list), set()
    for n, line in enumerate(lines):
        s = frozenset(line.split())
        common = collections.Counter(m for w in s for m in holds[w])
        if any(5 * c >= 4 * (len(s) + len(frozenset(lines[m].split())) - c) for m, c in common.items()):
            gone.add(n)
        for w in s:
            holds[w].append(n)
    return gone


@pytest.mark.parametrize("many", [1, 11])
def test_line_dedup_query(spark, sf, documents, monkeypatch, many):
    """The words of every line of the table, short lines too; also with all but the rarest tokens taken in pairs."""
    monkeypatch.setattr(line_dedup, "MANY_CLASS", many)
    lines = sorted((i, k, line) for i, t in zip(documents.doc_id, documents.text, strict=True) for k, line in enumerate(t.split("\n")))
    gone = word_matches([line for *_, line in lines])
    want = collections.defaultdict(list)
    for n, (i, _, line) in enumerate(lines):
        want[i] += [line] if n not in gone else []
    got = QUERIES["op3_line_dedup"](spark, sf).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: "\n".join(want[i]) for i in documents.doc_id}
    assert sum(r["n_removed"] for r in got) == len(gone) > 0
    assert any(len(lines[n][2].split()) < 5 for n in gone)


@pytest.mark.parametrize("many", [1, 5, 11])
def test_line_dedup_of_chains(spark, monkeypatch, many):
    """Near copies of near copies, in short and long lines, of frequent words only."""
    monkeypatch.setattr(line_dedup, "MANY_CLASS", many)
    rng = np.random.default_rng(4)
    rows = []
    for size, swap in ((4, 1), (5, 1), (12, 1), (80, 3), (200, 12)):
        words = [f"w{i}" for i in range(size)]
        for _ in range(25):
            words = words.copy()
            for at in rng.choice(size, swap, False):
                words[at] = f"w{int(rng.integers(size * 2))}"
            rows.append((len(rows), " ".join(words)))
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), count_col="n").collect()
    assert {r["doc_id"] for r in got if r["n"]} == word_matches([t for _, t in rows])


def test_line_dedup_of_repeated_ids_and_clashing_names(spark):
    rows = [(1, "a b c d e", 0), (2, "x y z", 1), (2, "a b c d e\nnew", 2), (2, "x y z", 3), (None, "a b c d e", 4), (None, None, 5), (3, None, 6)]
    names = ["__doc", "doc", "place", "row", "kept", "left", "text2", "tokens", "key"]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").coalesce(1)
    for c in names:
        df = df.withColumn(c, df["n"])
    got = {r["n"]: r for r in line_dedup.line_dedup(df, count_col="gone").collect()}
    assert [(got[n]["text"], got[n]["gone"]) for n in range(7)] == [("a b c d e", 0), ("x y z", 0), ("new", 1), ("", 1), ("a b c d e", 0), (None, 0), (None, 0)]
    assert all(got[n][c] == n for n in range(7) for c in names)


def test_url_query_matches_sql(spark, sf):
    c = duckdb.connect()
    c.sql(f"create view pages as select * from '{sf}/pages.parquet'")
    want = c.sql(SQL["op4_url_filters"])
    got = QUERIES["op4_url_filters"](spark, sf).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_ann_query_recall(spark, sf):
    e = pd.read_parquet(f"{sf}/embeddings.parquet")
    v, ids = np.stack(e.embedding.to_list()).astype(float), e.vec_id.to_numpy()
    got = QUERIES["op8_ann"](spark, sf).toPandas()
    hits = 0
    queries = ids[ids % 100 == 0]
    for q in queries:
        far = np.sqrt(((v - v[ids == q]) ** 2).sum(1))
        far[ids == q] = np.inf
        own = got[got.query_id == q].sort_values("rank")
        assert np.allclose(own.score, [far[ids == i][0] for i in own.vec_id], rtol=1e-12) and list(own["rank"]) == list(range(1, 11))
        hits += len(set(own.vec_id) & set(ids[np.lexsort((ids, far))[:10]]))
    assert hits >= 0.9 * 10 * len(queries)


def test_packing_query(spark, sf, documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = {i: [*t.encode(x, add_special_tokens=False).ids, 1] for i, x in zip(documents.doc_id, documents.text, strict=True)}
    got = QUERIES["op7_packing"](spark, sf).toPandas()
    for i, rows in got.sort_values("start").groupby("doc_id"):
        at = 0
        for r in rows.itertuples():
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[i][at : at + r.length], "<u4")) and r.doc_tokens == len(ids[i])
            at += r.length
        assert at == len(ids[i])
    loads = got.groupby("sequence_id").length.sum()
    assert set(got.doc_id) == set(ids) and loads.max() <= 2048 and loads.sum() / (2048 * len(loads)) > 0.97


def test_sharding_query(spark, sf, documents):
    got = QUERIES["op6_sharding"](spark, sf).toPandas()
    loads = got.groupby("shard")["size"].sum()
    group = documents.text.map(lambda x: len(x.encode()) + 8).groupby(documents.text).sum().max()
    assert len(got) == len(documents) and len(loads) == 24 and loads.max() <= max(loads.mean() * 1.01, group)


def test_quality_held_out(spark, sf):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.classify_quality(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    assert (scored.keep == (scored.quality == 1)).mean() > 0.95
    assert scored[scored.quality == 1].keep.mean() > 0.98


def test_quality_query(spark, sf, documents):
    """The registered query's posteriors against sums in plain Python that leave each document out."""
    got = QUERIES["op5_quality"](spark, sf).toPandas()
    model = quality.fit_quality(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert sorted(got.doc_id) == sorted(documents.doc_id)
    rows = got.merge(documents[["doc_id", "source", "lang"]].rename(columns={"source": "host", "lang": "path"}), on="doc_id")
    for r in rows.itertuples():
        of_host, of_path = rows[rows.host == r.host], rows[(rows.host == r.host) & (rows.path == r.path)]
        host = (model.k_host * model.prior + of_host.quality_evidence.sum() - r.quality_evidence) / (model.k_host + len(of_host) - 1)
        site = min(0.999, max(0.001, (model.k_path * host + of_path.quality_evidence.sum() - r.quality_evidence) / (model.k_path + len(of_path) - 1)))
        assert abs(site - r.quality_site) < 1e-9
        odds = r.quality_evidence / (1 - r.quality_evidence) * (1 - model.prior) / model.prior * site / (1 - site)
        assert abs(odds / (1 + odds) - r.quality_score) < 1e-6 and r.keep == (r.quality_score >= 0.5)


def test_quality_shrinks_sparse_sites(spark):
    rows = [(i, "good words " * 20 if i % 20 else "BAD!!! ### " * 20, f"s{i % 2}", "en") for i in range(400)] + [(1000, "BAD!!! ### " * 20, "tiny", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 20 > 0)) for i in range(400)], "doc_id long, quality int")
    sites = {r["host"]: r["site_mean"] for r in quality.fit_quality(docs, labels).sites.collect()}
    assert 0.3 < sites["tiny"] < 0.95 and sites["s1"] > 0.98


def test_pii_keeps_distinct_and_coreferent(spark, sf, documents):
    mail = "Mail x.y@q.example.org or X.Y@Q.EXAMPLE.ORG; call +1 (578) 555-6437 or 1 578 555 6437. Frau Müller met Mr. John Smith; Mr. Smith and г-жа Иванова left."
    docs = spark.createDataFrame([(1, mail)] + [(i, f"a.{i}@m.example.com 4{i:015d}") for i in range(2, 400)], "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in pii.replace_pii(docs, b"key").collect()}
    words = rows[1].split()
    assert words[1].lower() == words[3].rstrip(";").lower() != "x.y@q.example.org"
    digits = re.findall(r"\d[\d ()-]{8,}\d", rows[1])
    assert len({re.sub(r"\D", "", d) for d in digits}) == 1 and "555-6437" not in rows[1]
    smiths = re.findall(r"Mr\. (?:[A-Z]\w+ )?([A-Z]\w+)", rows[1])
    assert smiths[0] == smiths[1] != "Smith" and re.search(r"г-жа [А-Я]\w+а ", rows[1])
    assert len({rows[i].split()[0] for i in range(2, 400)}) == 398
    originals = {m for t in documents.text for m in re.findall(r"[\w.]+@mail\d\.example\.com", t)}
    got = QUERIES["op1_pii"](spark, sf).toPandas()
    assert originals and not any(m in t for t in got.text for m in originals)
    clean = {i for i, t in zip(documents.doc_id, documents.text, strict=True) if not re.search(r"[0-9@]", t)}
    before = dict(zip(documents.doc_id, documents.text, strict=True))
    assert all(r.text == before[r.doc_id] for r in got.itertuples() if r.doc_id in clean)


def test_pii_collisions_are_settled(spark, monkeypatch):
    whole = pii.surrogate
    monkeypatch.setattr(pii, "surrogate", lambda kind, c, key, attempt=0: "same@x.example.com" if attempt == 0 else whole(kind, c, key, attempt))
    found = spark.createDataFrame([("email", f"u{i}@x.example.com") for i in range(20)] + [("email", "same@x.example.com")], "pool string, canonical string")
    rows = pii.settle(found, b"k").collect()
    assert len(rows) == 21 == len({r["made"] for r in rows}) and "same@x.example.com" not in {r["made"] for r in rows}


def test_segmentation_against_the_whole_lattice(documents):
    m = segment.Pieces(P.path("piece_bpe_32k.model"))
    texts = ["", "a", "the cat  sat\n日本語", *[t[:70] for t in documents.text[:40]]]
    for t, ways in zip(texts, segment.Segmenter(m, 4)(texts), strict=True):
        want = segment.nbest(m, segment.SPACE + t.replace(" ", segment.SPACE) if t else "", 4)
        assert np.allclose([s for s, _ in want], [s for s, _ in ways])
        assert len({tuple(i) for _, i in ways}) == len(ways) and all(m.decode(i) == t for _, i in ways)


def test_nbest_against_enumeration():
    m = segment.Pieces(P.path("piece_bpe_32k.model"))
    for part in ("▁then", "▁cats", "日", "▁a"):
        every = []

        def grow(at, score, part=part, every=every):
            if at == len(part):
                every.append(score)
            for j in range(at + 1, len(part) + 1):
                s = m.edge(part[at:j])
                if s is not None:
                    grow(j, score + s)

        grow(0, 0.0)
        assert np.allclose([s for s, _ in segment.nbest(m, part, 5)], sorted(every, reverse=True)[:5])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 1000), max_size=40), st.integers(1, 8))
def test_differencing_places_every_item(weights, k):
    place, loads = kk.items(np.array(weights, np.int64), k)
    assert np.array_equal(np.bincount(place, weights=weights, minlength=k).astype(int) if weights else np.zeros(k, int), loads)
    assert list(loads) == sorted(loads, reverse=True)


@pytest.mark.parametrize("few", [graph.FEW_EDGES, 0])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW_EDGES", few)
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (160, 2))] + [(i, i + 1) for i in range(400, 460)]
    got = {r["id"]: r["label"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = root_of(pairs, {x for p in pairs for x in p})
    assert all(got.get(i, i) == r for i, r in want.items())


def test_pipeline(spark, sf):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, docs
    for name, stage in pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, left, sf).toPandas(), docs.schema)
        assert after.columns == columns and 0 < after.count() <= left.count(), name
        left = after
    got = pipeline.run(spark, sf).toPandas()
    assert set(got.doc_id) == {r["doc_id"] for r in left.select("doc_id").collect()}
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    bare = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema)
    for name, stage in pipeline.STAGES:
        assert stage(spark, bare, sf).count() >= (0 if name == "quality" else 1), name
        stage(spark, bare.limit(0), sf).collect()
