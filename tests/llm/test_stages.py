"""The stage near_duplicates with its own parameters against all pairs, and each stage on odd rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lattica.llm import jaccard


def shingled(text, k=5):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").split(" ") if w]
    return frozenset(" ".join(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([" ".join(words)] if words else [])


def texts(n):
    rnd = random.Random(12)
    made = []
    for i in range(n):
        if made and rnd.random() < 0.5:
            words = rnd.choice(made).split(" ")
            for _ in range(rnd.randrange(4)):
                words[rnd.randrange(len(words))] = f"x{i}"
            made.append(" ".join(words))
        else:
            made.append(" ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.choice([3, 5, 40, 90, 200]))))
    return made


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_one_of_each_group_stays(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts(120))]
    sets = {i: shingled(t) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, COLUMNS), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in sets if find(i) == i)


@pytest.mark.parametrize("ids", [[7, 7, 7, 8, None, None], [1, 2, 3, 4, 5, None]])
def test_rows_of_one_id_are_judged_by_their_texts(spark, ids):
    """Different texts under one id both stay; equal ones, whatever their ids, leave one row."""
    words = [" ".join(f"{a}{i}" for i in range(30)) for a in "abc"]
    rows = [(i, t, "en", "s", 1) for i, t in zip(ids, [words[0], words[1], words[0], words[1], words[2], words[2]], strict=True)] + [(9, None, None, None, None), (10, "", None, None, 0), (11, " ", None, None, 1)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, COLUMNS), "")
    assert kept.columns == [c.split()[0] for c in COLUMNS.split(", ")]
    got = [r["text"] for r in kept.collect()]
    assert sorted(t for t in got if t and t.strip()) == sorted(words) and len(got) == 6


def test_calls_hold_the_copied_rows(spark):
    """A tile of 20,000 members is copied 20 times; a call gets no more rows on average than it may hold."""
    told = spark.range(20_000).select(F.lit(1).alias("tile"), F.col("id").alias("node"), F.ceil(F.lit(20_000) / jaccard.CHUNK).cast("int").alias("parts"))
    calls = jaccard.calls_for(told)
    assert calls == 20_000 * 20 // jaccard.CALL_MEMBERS
    part = told.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    met = part.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("tile", F.least("part", "other").alias("c"), F.greatest("part", "other").alias("d"))
    most = met.groupBy(F.pmod(F.xxhash64("tile", "c", "d"), F.lit(calls)).alias("call")).count().agg(F.max("count")).first()[0]
    assert most < 5 * jaccard.CALL_MEMBERS
    assert jaccard.calls_for(told.limit(0)) == 1


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_on_odd_rows(spark, sf, docs, stage):
    """Nulls, long texts, repeated rows and empty tables; extra columns of clashing names stay."""
    more = docs.drop("node", "token").withColumn("label", F.lit("x")).withColumn("component_id", F.lit(1)).withColumn("keep", F.lit(False))
    step = dict(corpus_pipeline.STAGES)[stage]
    got = step(spark, more, sf)
    assert got.columns == more.columns and got.count() <= more.count()
    assert {r["label"] for r in got.collect()} <= {"x"}
    assert step(spark, more.limit(0), sf).count() == 0
