"""What each of several filters removes, in every order in which they can be applied.

Relational throughout: texts are exploded into words, counted by document and
word, then by document for totals and distinct words; the other flags are
joined from outside.  A document's failed filters are bits of a number, so each
part of the corpus is described by as many conditional counts as there are
numbers, and every order of the filters is answered from these counts alone.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The five filters, by letter.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITAL_PERCENT = 100, 80, 10
WORD_BREAK, ODD_MARKS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"


def word_totals(rows: DataFrame, key: list[str], text_col: str = "text") -> DataFrame:
    """``key``, words and distinct_words of every text, exploded and counted by (key, word), then by key.

    A null among the words stands for the row itself: it keeps rows without
    words, and tells how many rows share a key.  Rows that share one must hold
    the same text; their common words are counted once.
    """
    words = F.concat(F.array(F.lit(None).cast("string")), F.split(text_col, WORD_BREAK))
    exploded = rows.select(*key, F.explode(words).alias("__word")).where("__word is null or __word <> ''")
    by_word = exploded.groupBy(*key, "__word").agg(F.count("*").alias("__n"))
    return by_word.groupBy(*key).agg(F.expr("sum(if(__word is null, 0, __n)) div sum(if(__word is null, __n, 0))").alias("words"), F.count("__word").alias("distinct_words"))


def failed_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row a document: doc_id, part, failed (bit i for filter i), good, toxic.

    A row is known by its id; where ids repeat or are null, by its id and a 64-bit
    hash of its text, so that rows of other texts stay apart.  E compares by SHA-256: a text fails if
    a smaller id holds it; a null id is no smaller one and has none.  A null
    text is empty, a null language the empty part.  Labels that repeat count
    if any of them does; a document without labels is neither good nor toxic.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("part"))
    ids = docs.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.count("*").alias("rows"))
    apart = ids.where("doc_id is null or rows > 1").isEmpty()
    rows = rows.withColumn("text_hash", F.lit(0).cast("long") if apart else F.xxhash64("text"))
    key = ["doc_id"] if apart else ["doc_id", "text_hash"]
    totals = word_totals(rows, key)
    flags = rows.select(
        "doc_id", "text_hash", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        (100 * F.regexp_count("text", F.lit("[A-Z]")) > MOST_CAPITAL_PERCENT * F.length("text")).alias("c"),
        F.col("text").rlike(ODD_MARKS).alias("d"),
    )
    first = flags.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("holders")).where("holders > 1").drop("holders")
    flags = flags.join(first, "digest", "left")
    if not apart:
        same = F.struct(F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("n"), F.col("text_hash").alias("h"))
        flags, totals, key = flags.withColumn("key", same), totals.select(same.alias("key"), "words", "distinct_words"), ["key"]
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = flags.join(totals, key, "left").join(marks, "doc_id", "left")
    failing = [
        F.col("words") < LEAST_WORDS, 100 * F.col("distinct_words") < LEAST_DISTINCT_PERCENT * F.col("words"), F.col("c"), F.col("d"), F.col("doc_id") > F.col("first_id"),
    ]
    bits = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(failing)), F.lit(0))
    return joined.select("doc_id", "part", bits.alias("failed"), (F.coalesce("good", F.lit(0)) == 1).alias("good"), (F.coalesce("toxic", F.lit(0)) == 1).alias("toxic"))


def failure_counts(failed: DataFrame, filters: int) -> DataFrame:
    """part, and arrays n, n_good, n_toxic: the documents that failed exactly the filters of each number."""
    numbers = range(1 << filters)
    kinds = {"n": F.lit(True), "n_good": F.col("good"), "n_toxic": F.col("toxic")}
    counts = [F.count_if((F.col("failed") == m) & kind).alias(f"{name}_{m}") for name, kind in kinds.items() for m in numbers]
    return failed.groupBy("part").agg(*counts).select("part", *[F.array(*[f"{name}_{m}" for m in numbers]).alias(name) for name in kinds])


def _total(counts: str, filters: int, wanted) -> Column:
    """The sum of ``counts`` over the numbers that ``wanted``, a function of the number's column, holds for."""
    held = F.filter(F.sequence(F.lit(0), F.lit((1 << filters) - 1)), wanted)
    return F.aggregate(held, F.lit(0).cast("long"), lambda sum_, m: sum_ + F.get(F.col(counts), m))


def filter_orders(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """``failure_counts`` told for every order of the filters and each step: see ``filter_audit``."""
    size, every = len(letters), ["".join(p) for p in permutations(letters)]
    steps = F.array(*[
        F.struct(F.lit(order).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(1 << letters.index(order[k])).alias("own"), F.lit(sum(1 << letters.index(x) for x in order[:k])).alias("before"))
        for order in every for k in range(size)
    ])
    told = counts.select("*", F.explode(steps).alias("s")).select(*counts.columns, "s.*")
    own, before = F.col("own"), F.col("before")
    removed = lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) == 0)
    #: In how many of all orders one given filter comes first among those that a document failed.
    first_in = F.array(*[F.lit(len(every) // max(m.bit_count(), 1)).cast("long") for m in range(1 << size)])
    failing = F.filter(F.sequence(F.lit(1), F.lit((1 << size) - 1)), lambda m: m.bitwiseAND(own) != 0)
    return told.select(
        "part", "filter_order", "step",
        _total("n", size, lambda m: m.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        _total("n", size, removed).alias("removed"),
        _total("n", size, lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        F.get("n", own).alias("unique_fails"),
        _total("n_good", size, removed).alias("good_lost"), _total("n_toxic", size, removed).alias("toxic_lost"),
        F.aggregate(failing, F.lit(0).cast("long"), lambda sum_, m: sum_ + F.get("n", m) * F.get(first_in, m)).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row for each part, order of the five filters and step: part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley; zeros included.

    A: under 100 words; B: under 80 % of them distinct; C: over 10 % capitals;
    D: holds one of ``#$%&*|``; E: a smaller id has the same text.  Nulls,
    repeated ids and missing labels: see ``failed_filters``.  An empty table
    has no parts, so no rows.  Other columns of ``docs`` are not read.
    """
    return filter_orders(failure_counts(failed_filters(docs, labels, id_col, text_col, lang_col), len(FILTERS)))
