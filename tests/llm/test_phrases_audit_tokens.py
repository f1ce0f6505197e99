"""Phrases, the filter audit and cached token counts against brute force, with edge cases."""

import collections
import itertools
import random
import re

import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lattica.llm import audit, collocations, token_cache

MODEL = P.path("piece_bpe_32k.model")


def brute_phrases(rows, most, least, keep, lowest=2, covered=50):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {k: a for k, a in f.items() if a >= least and lowest <= len(k[1]) <= most}
    out = collections.defaultdict(list)
    for (lang, p), a in candidates.items():
        if any(lang == other and len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (other, q), b in candidates.items()):
            continue
        score, _, left, right = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:keep])}


@pytest.mark.parametrize("large", [2_000_000, 20])
@pytest.mark.parametrize(("most", "keep"), [(3, 2000), (4, 25)])
def test_phrases_are_those_of_brute_force(spark, monkeypatch, large, most, keep):
    """Also where frequent prefixes are grown by Spark; words with marks, tabs and capitals, ends of pieces, ties."""
    monkeypatch.setattr(collocations, "LARGE", large)
    rnd = random.Random(5)
    words = ["The", "of", "a", "Été", "été", "b|c", "x y", "日本", "in", " z"]
    weights = [9, 6, 4, 2, 2, 1, 1, 1, 3, 1]
    rows = [(rnd.choice(["en", "fr", None, ""]), "".join(w + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\x0b", "\r\n"]) for w in rnd.choices(words, weights, k=rnd.randrange(60)))) for _ in range(150)]
    rows += [("en", None), (None, None), ("fr", ""), ("de", " .,; \n"), ("en", "the of a " * 3000)]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("f", F.lit("x")).repartition(3)
    got = collocations.collocations(docs, max_words=most, least=5, keep=keep)
    assert {tuple(r) for r in got.collect()} == brute_phrases(rows, most, 5, keep)


def test_phrases_of_nothing(spark, empty):
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", "a b")] * 9, "lang string, text string")).count() == 0


def test_phrase_scores_pass_64_bits(spark):
    """A product of counts over 2^64 is divided exactly."""
    row = spark.sql("select (1000000BD * cast(a as decimal(16, 0)) * cast(a as decimal(16, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) s from values (999999999999L, 1000000000000L, 1000000000007L) t(a, l, r)").first()
    assert row["s"] == 1_000_000 * 999_999_999_999**2 // (10**12 * (10**12 + 7))


def test_growth_is_depth_first_in_ranges_of_the_pointers():
    import numpy as np

    rows = sorted([(0, 0), (0, 1), (0, 1), (1, -1), (1, 0), (-1, -1)])
    columns, times = [np.array(c) for c in zip(*rows, strict=True)], np.array([4, 1, 1, 1, 2, 3])
    want = collections.Counter()
    for (a, b), t in zip(rows, times.tolist(), strict=True):
        if a >= 0:
            want[(a,)] += t
            if b >= 0:
                want[a, b] += t
    got = list(collocations.grow(columns, times, 3, 0, len(rows)))
    assert dict(got) == {k: v for k, v in want.items() if v >= 3}
    assert [p for p, _ in got] == sorted(p for p, _ in got)


def brute_audit(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    failed = []
    for i, lang, text in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
        fails["E"] = i is not None and any(j is not None and j < i and (other or "") == text for j, _, other in rows)
        failed.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out, shapley = {}, collections.Counter()
    for part in {x[0] for x in failed}:
        mine = [x[1:] for x in failed if x[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order):
                gone = [x for x in left if letter in x[0]]
                left = [x for x in left if letter not in x[0]]
                redundant = sum(letter in x[0] and bool(x[0] & set(order[:step])) for x in mine)
                out[part, order, step + 1] = [len(left), len(gone), redundant, sum(x[0] == {letter} for x in mine), sum(x[1] for x in gone), sum(x[2] for x in gone)]
                shapley[part, letter] += len(gone)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_is_that_of_brute_force(spark):
    """Nulls in ids, languages, texts and labels; repeated ids, rows and labels; long texts; clashing columns."""
    rnd = random.Random(3)
    words = ["alpha", "Beta", "beta", "GAMMA", "d#e", "ü", "|", "x y"]
    texts = [None, "", " \t\n", "A" * 40, " ".join(f"w{i}" for i in range(120)), " ".join(f"w{i}" for i in range(5000)) + " $"]
    texts += [" ".join(rnd.choices(words + [f"v{i}" for i in range(rnd.choice([20, 400]))], k=rnd.randrange(180))) for _ in range(40)]
    rows = [(rnd.choice([None, *range(60)]), rnd.choice(["en", "de", None, ""]), rnd.choice(texts)) for _ in range(150)]
    rows += rows[:5]
    labels = [(rnd.choice([None, *range(60)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("part", F.lit("x")).withColumn("words", F.lit(1)).withColumn("good", F.lit(2)).repartition(3)
    got = audit.filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {tuple(r) for r in got.collect()} == brute_audit(rows, [x for x in labels if x[0] is not None])


def test_audit_of_nothing(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.filter_audit(empty, labels).count() == 0
    one = audit.filter_audit(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string"), labels)
    assert one.count() == 600 and one.agg(F.sum("kept"), F.sum("removed")).first() == (600 - 360, 120)


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/cache"


def test_counts_are_the_librarys(spark, docs, empty, folder):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    odd = ["<s> x </s> <unk>", "a  b", "a ▁▁b", "\x00 nul", "ﬁ  ", "𝒳🙂", "a" * 100_000, "word " * 30_000, " ", "▁"]
    more = docs.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"), allowMissingColumns=True)
    texts = collections.Counter((r["doc_id"], r["text"]) for r in more.collect())
    want = collections.Counter()
    for (i, text), n in texts.items():
        count = len(model.encode(text or ""))
        want[i, len((text or "").encode()), count, count > 4096] += n
    for _ in range(2):
        assert collections.Counter(tuple(r) for r in token_cache.token_counts(more.withColumn("digest", F.lit("x")), MODEL, folder).collect()) == want
    assert token_cache.token_counts(empty, MODEL, folder).count() == 0


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_only_distinct_misses_are_encoded_and_appended(spark, folder, monkeypatch, broadcast):
    monkeypatch.setattr(token_cache, "BROADCAST_MISSES", broadcast)
    cache, version = token_cache.TokenCache(spark, folder), token_cache.tokenizer_version(MODEL)
    first = spark.createDataFrame([(i, f"text {i % 7}") for i in range(40)], "doc_id long, text string")
    assert token_cache.token_counts(first, MODEL, folder).count() == 40
    assert spark.read.parquet(folder).count() == 7
    token_cache.token_counts(first.unionByName(spark.createDataFrame([(50, "new"), (51, "new"), (52, None), (53, "")], first.schema)), MODEL, folder).count()
    assert spark.read.parquet(folder).count() == 9
    # what is stored is what is answered: a count changed in the cache shows
    digest = first.where("doc_id = 3").select(F.unhex(F.sha2(token_cache.normalised(F.col("text"), MODEL), 256)).alias("digest"), F.lit(-5).cast("long").alias("n_tokens"))
    cache.append(digest, version)
    assert {r["n_tokens"] for r in token_cache.token_counts(first, MODEL, folder).where("doc_id = 3").collect()} == {-5}


def test_another_tokenizer_has_its_own_counts(spark, folder):
    from tokenizers import Tokenizer

    other = P.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "some words <|endoftext|> here"), (2, "")], "doc_id long, text string")
    read = Tokenizer.from_file(other)
    for path, count in ((MODEL, lambda t: len(sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(t))), (other, lambda t: len(read.encode(t, add_special_tokens=False).ids))):
        assert {r["doc_id"]: r["n_tokens"] for r in token_cache.token_counts(docs, path, folder).collect()} == {1: count("some words <|endoftext|> here"), 2: 0}
    assert spark.read.parquet(folder).count() == 4 and token_cache.tokenizer_version(MODEL) != token_cache.tokenizer_version(other)
