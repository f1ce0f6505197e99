"""Collocations: contiguous phrases grown from frequent prefixes, scored by their weakest cut.

Phrases grow to the right only, as in PrefixSpan.  Every occurrence of a word
points at the words that follow it inside its piece; these pointers are
projected by prefix, alike ones of a block of documents once, with their
number.  A task holds whole prefixes and grows each depth first: the pointers
of a phrase are a range of the sorted ones, which splits at the next word.

A prefix that holds one in ``SHARE`` of all words, or ``LARGE`` of them, is no
single task's work.  It is grown by Spark, level by level, with counts that combine before they are
shuffled, so that no word, however frequent, meets in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_rows, discard, materialise

#: Bytes of text whose alike pointers become one; occurrences that a task grows, on average.
BLOCK, TASK = 12 << 20, 250_000
#: Which prefixes no task grows, and how many of them are named to the tasks at most.
SHARE, LARGE, MOST_LARGE = 100, 2_000_000, 1_000_000
#: Parts of a language that find their own best phrases before all of it does.
PARTS = 16

#: Bytes that end a piece, bytes between words.
BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
#: What stands for the words behind the end of a piece; no word holds it.
END = b"\t"
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _kinds(breaks: bytes, spaces: bytes) -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[list(spaces)] = 1
    kinds[list(breaks)] = 2
    return kinds


TEXT, PROJECTED = _kinds(BREAKS, SPACES), _kinds(b"", b" \n")


def tokens(raw: bytes, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of ``raw`` as an Arrow array, and the number of the piece that each is in."""
    data = np.frombuffer(raw, np.uint8)
    kind = kinds[data]
    inside = kind == 0
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, np.searchsorted(np.flatnonzero(kind == 2), starts)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes]]:
    """(language, folded texts) of about ``BLOCK`` bytes in all; a break stands between two texts."""
    held: dict[bytes, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text.translate(FOLD))
            size += len(text)
            if size >= BLOCK:
                yield from ((k, b"\n".join(v)) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, b"\n".join(v)) for k, v in held.items())


def _text(array) -> pa.Array:
    return array.cast(pa.binary())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, raw in _blocks(batches):
        found = tokens(raw, TEXT)[0].value_counts()
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.binary()), _text(found.field(0)), found.field(1)], ["lang", "phrase", "f"])


def _pointers(raw: bytes, words: int, chosen: pa.Array, named: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the block, one row a distinct pointer (codes of prefix and followers, -1 behind an end), and their numbers.

    Prefixes are those of ``chosen`` if ``named``, else all others.
    """
    found, piece = tokens(raw, TEXT)
    coded, piece = found.dictionary_encode(), piece.astype(np.int32)
    code, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    del found, coded
    at = np.flatnonzero(pc.is_in(names, value_set=chosen).to_numpy(zero_copy_only=False)[code] == named) if len(code) else np.zeros(0, np.int64)
    columns, key, wide = [], code[at], np.int64(1)
    for ahead in range(words):
        there = np.minimum(at + ahead, max(len(code) - 1, 0))
        same = (at + ahead < len(code)) & (piece[there] == piece[at])
        columns.append(np.where(same, code[there], np.int32(-1)))
    key = columns[-1].astype(np.int64) + 1
    for column in columns[-2::-1]:
        wide = np.int64(key.max(initial=0) + 1)
        key = np.unique((column + 1) * wide + key, return_inverse=True)[1]
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    return names, np.column_stack([c[first] for c in columns]), times


def _named(names: pa.Array, codes: np.ndarray) -> pa.Array:
    """Words by their codes, ``END`` for -1."""
    return pc.fill_null(names.take(pa.array(codes, mask=codes < 0)), END)


def _project(words: int, large: dict[bytes, list[bytes]]):
    """Rows (language, prefix, pointers): a pointer is its following words and its number, in one line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, raw in _blocks(batches):
            names, rows, times = _pointers(raw, words, pa.array(large.get(lang, []), pa.large_binary()), False)
            if not len(rows):
                continue
            lines = pc.binary_join_element_wise(*[_named(names, rows[:, k]) for k in range(1, words)], pa.array(times).cast(pa.large_string()).cast(pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
            starts = np.flatnonzero(np.diff(rows[:, 0], prepend=-2))
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([*starts, len(rows)], pa.int64()), lines), pa.scalar(b"\n", pa.large_binary()))
            prefixes = _text(names.take(pa.array(rows[starts, 0])))
            for a in range(0, len(starts), 20_000):
                part = joined.slice(a, 20_000)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.binary()), prefixes.slice(a, 20_000), _text(part)], ["lang", "prefix", "pointers"])

    return run


def _widen(words: int, large: dict[bytes, list[bytes]]):
    """Rows (language, w0 .. , number) of the pointers of the named prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, raw in _blocks(batches):
            if lang not in large:
                continue
            names, rows, times = _pointers(raw, words, pa.array(large[lang], pa.large_binary()), True)
            for a in range(0, len(rows), 50_000):
                part = rows[a : a + 50_000]
                columns = [_text(names.take(pa.array(c, mask=c < 0))) for c in part.T]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.binary()), *columns, pa.array(times[a : a + 50_000])], ["lang", *[f"w{k}" for k in range(words)], "f"])

    return run


def grow(columns: list[np.ndarray], times: np.ndarray, least: int, lo: int, hi: int, depth: int = 0) -> Iterator[tuple[tuple[int, ...], int]]:
    """Frequent continuations of one prefix, depth first.

    Its pointers are the rows ``lo`` to ``hi``, sorted by ``columns``; those of
    a continuation are a range of them.  A code of -1 is the end of a piece.
    """
    here = columns[depth][lo:hi]
    starts = np.concatenate(([0], np.flatnonzero(here[1:] != here[:-1]) + 1))
    sums = np.add.reduceat(times[lo:hi], starts)
    ends = np.concatenate((starts[1:], [hi - lo]))
    for k in np.flatnonzero((sums >= least) & (here[starts] >= 0)):
        word = int(here[starts[k]])
        yield (word,), int(sums[k])
        if depth + 1 < len(columns):
            for more, f in grow(columns, times, least, lo + int(starts[k]), lo + int(ends[k]), depth + 1):
                yield (word, *more), f


def _mine(words: int, least: int):
    """All that one task's prefixes grow to: (language, phrase, words, f), without the prefixes by themselves."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("prefix", "ascending")])
        langs, prefixes = table["lang"].to_pylist(), table["prefix"].to_pylist()
        lines = table["pointers"].to_pylist()
        new = np.array([k == 0 or (langs[k], prefixes[k]) != (langs[k - 1], prefixes[k - 1]) for k in range(len(lines))], bool)
        owner = np.repeat(np.cumsum(new, dtype=np.int32) - 1, [x.count(b"\n") + 1 for x in lines])
        coded = tokens(b"\n".join(lines), PROJECTED)[0]
        del table, lines
        times = pc.cast(pc.cast(coded.take(pa.array(np.arange(words - 1, len(coded), words))), pa.large_string()), pa.int64()).to_numpy(zero_copy_only=False)
        coded = coded.dictionary_encode()
        names = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy(zero_copy_only=False).reshape(-1, words)[:, :-1]
        code = np.where(code == (names.index(END) if END in names else -1), -1, code)
        order = np.lexsort((*code.T[::-1], owner))
        columns, times, owner = [np.ascontiguousarray(c[order]) for c in code.T], times[order], owner[order]
        bounds, first = np.flatnonzero(np.diff(owner, prepend=-1, append=-1)), np.flatnonzero(new)
        out: tuple[list, list, list, list] = ([], [], [], [])
        for n in np.flatnonzero(np.add.reduceat(times, bounds[:-1]) >= least).tolist():
            k = int(first[n])
            for more, f in grow(columns, times, least, int(bounds[n]), int(bounds[n + 1])):
                for column, value in zip(out, (langs[k], b" ".join([prefixes[k], *[names[m] for m in more]]), len(more) + 1, f), strict=True):
                    column.append(value)
        return pa.table([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int64())], ["lang", "phrase", "words", "f"])

    return run


def frequent_phrases(docs: DataFrame, max_words: int = 3, least: int = 10, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): lang, phrase, words, f of every phrase that occurs ``least`` times; lang, n of all words.

    Both are written to the shared folder.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).cast("binary").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    counted = source.mapInArrow(_word_counts, "lang binary, phrase binary, f long")
    words = materialise(counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "phrase-words")
    totals = materialise(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    single = words.where(F.col("f") >= least).select("lang", "phrase", F.lit(1).alias("words"), "f")
    if max_words == 1:
        return materialise(single, "phrases"), totals
    every = totals.agg(F.sum("n")).first()[0] or 0
    large: dict[bytes, list[bytes]] = {}
    for r in words.where(F.col("f") > min(every // SHARE, LARGE)).orderBy(F.desc("f"), "lang", "phrase").limit(MOST_LARGE).collect():
        large.setdefault(bytes(r["lang"]), []).append(bytes(r["phrase"]))
    tasks = 1 + every // TASK
    found = (
        source.mapInArrow(_project(max_words, large), "lang binary, prefix binary, pointers binary")
        .groupBy(F.pmod(F.xxhash64("lang", "prefix"), F.lit(tasks)).alias("task"))
        .applyInArrow(_mine(max_words, least), "lang binary, phrase binary, words int, f long")
    )
    found = single.unionByName(found)
    if large:
        names = [f"w{k}" for k in range(max_words)]
        wide = source.mapInArrow(_widen(max_words, large), ", ".join(["lang binary", *[f"{c} binary" for c in names], "f long"]))
        level = materialise(wide.groupBy("lang", *names).agg(F.sum("f").alias("f")), "phrase-large")
        for k in range(2, max_words + 1):
            grown = level.where(F.col(names[k - 1]).isNotNull()).groupBy("lang", *names[:k]).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
            spaced = [x for c in names[:k] for x in (F.lit(b" "), F.col(c))][1:]
            found = found.unionByName(grown.select("lang", F.concat(*spaced).alias("phrase"), F.lit(k).alias("words"), "f"))
    phrases = materialise(found.select(F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"), "words", "f"), "phrases")
    totals_named = materialise(totals.select(F.col("lang").cast("string").alias("lang"), "n"), "phrase-totals")
    discard(words, totals, *([level] if large else []))
    return phrases, totals_named


def _part(phrase: Column, first: int | Column, count: int | Column) -> Column:
    """``count`` words of ``phrase`` from the one numbered ``first``, from 1."""
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def collocations(docs: DataFrame, min_words: int = 2, max_words: int = 3, least: int = 10, keep: int = 2000, covered_percent: int = 50, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The ``keep`` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of ``min_words`` to ``max_words`` words that occurs a >= ``least``
    times is cut in two everywhere; with l and r the occurrences of both parts,
    a cut scores floor(1,000,000 a a / (l r)), in decimals of 38 places.  The
    lowest cut counts, the first of equal ones.  A phrase inside a longer one
    that has ``covered_percent`` of its occurrences or more is dropped.

    A null text is empty, a null language is ``und``; rows that repeat count
    each time; ids are not read, nor other columns.  No words: no rows.  Ties
    go by score, a, and the phrase's bytes.  Whole texts are read.
    """
    phrases, totals = frequent_phrases(docs, max_words, least, lang_col, text_col)
    candidates = phrases.where(F.col("words") >= min_words).withColumnRenamed("f", "a")
    cuts = candidates.where("words > 1").select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("left", _part(F.col("phrase"), 1, F.col("k"))).withColumn("right", _part(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k")))
    known = phrases.select("lang", "phrase", "f")
    for side in ("left", "right"):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(side[0])), ["lang", side])
    score = F.expr("(1000000BD * cast(a as decimal(16, 0)) * cast(a as decimal(16, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    lowest = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    spans = [(n, at) for n in range(min_words, max_words) for at in range(1, max_words - n + 2)]
    if spans:
        inside = [F.when((F.col("words") > n) & (F.col("words") >= at + n - 1), _part(F.col("phrase"), at, n)) for n, at in spans]
        covered = candidates.select("lang", F.col("a").alias("longer"), F.explode(F.array_distinct(F.array(*inside))).alias("phrase")).where("phrase is not null")
        covered = covered.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        scored = scored.join(covered, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a"))).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= keep)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= keep)
    return best.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
