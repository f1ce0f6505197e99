"""Near-duplicate lines by an exact set-similarity join, in DataFrame functions only.

A line's tokens are its words.  They are ordered by rarity, so that a short
prefix of the rarest decides which lines can be alike at all; prefix, position,
length and parity filters leave few pairs, which are verified by their Jaccard
similarity.  A line that an earlier line matches is removed.

Lines with the same tokens are one set, held by its first line.  Sets meet under
the tokens of their prefixes.  A token in the prefixes of many sets is taken
together with a second token of a prefix longer by one: sets that are alike have
two tokens of those in common.  Under a key each set meets the key's first set
and the few just before it; only a set that none of these removes meets all earlier ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise

#: A token's frequency class is looked up by so many bits of its hash, in a table of fixed size (1 MB).
BUCKET_BITS = 20
#: A token of this frequency class or above (seen more than 1,024 times) is taken together with a second one.
MANY_CLASS = 11
#: Sets just before it under a key that a set is compared with at once.
BEFORE = 3
#: Documents and lines in a list that is broadcast, beyond which it is joined by shuffle.
BROADCAST_IDS, BROADCAST_LINES = 500_000, 4_000_000
#: Words stand between white space, whatever its kind (that of Python's ``str.split``).
SPACE = r"\s\x1c-\x1f\x85\p{Z}"


def words(line: str) -> Column:
    """The words of a line; empty ones stand where white space begins, ends or repeats."""
    odd = F.rlike(F.col(line), F.lit(f"[{SPACE}&&[^ ]]"))
    return F.when(odd, F.split(line, f"[{SPACE}]+")).otherwise(F.split(line, " "))


def _lines(text: str) -> Column:
    return F.split(text, "\n")


def rarity(docs: DataFrame, text_col: str) -> DataFrame:
    """One row: an array with the class of every token bucket, that of its most frequent token over all texts.

    The class is the logarithm of the count, rounded up: 0 is for tokens seen once.
    """
    tokens = docs.select(F.explode(_lines(text_col)).alias("line")).select(F.explode(words("line")).alias("t"))
    counts = tokens.groupBy(F.xxhash64("t").alias("h")).agg(F.count("*").alias("n"))
    counts = counts.groupBy(F.shiftrightunsigned("h", 64 - BUCKET_BITS).cast("int").alias("bucket")).agg(F.max("n").alias("n"))
    every = docs.sparkSession.range(1 << BUCKET_BITS).select(F.col("id").cast("int").alias("bucket"))
    classes = every.join(counts, "bucket", "left").select("bucket", F.least(F.ceil(F.log2(F.coalesce("n", F.lit(1)))), F.lit(63)).cast("tinyint").alias("c"))
    return classes.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "c"))), lambda x: x["c"]).alias("classes"))


def tokens(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """``lines`` (doc, place, line) with ``tokens``: the distinct words as numbers, the rarest first.

    A word's number is its frequency class (its six top bits, the first of them
    turned so that numbers sort as signed) and 58 bits of its hash.
    """
    grade = lambda w: F.get("classes", F.shiftrightunsigned(F.xxhash64(w), 64 - BUCKET_BITS).cast("int")).cast("long")
    number = lambda w: F.shiftleft(grade(w) - 32, 58).bitwiseOR(F.shiftrightunsigned(F.xxhash64(w), 6))
    held = lines.select("doc", "place", "line", classes.select("classes").scalar().alias("classes"))
    made = held.select("doc", "place", F.sort_array(F.array_distinct(F.transform(F.array_remove(words("line"), ""), number))).alias("made"))
    # explode keeps a filter on the tokens from computing them a second time
    return made.select("doc", "place", F.explode(F.array("made")).alias("tokens"))


def _least_overlap(n: Column, num: int, den: int) -> Column:
    """ceil(n num / den)."""
    return F.call_function("div", n * num + (den - 1), F.lit(den)).cast("int")


def _posts(sets: DataFrame, num: int, den: int) -> DataFrame:
    """key, doc, place, n, parity, at: every set under each key of its prefix; ``at`` is the place of the key's first token.

    A token of class 0 is in one line only and is no key.
    """
    low = lambda grade: (grade - 32) << 58
    width = F.col("n") - _least_overlap(F.col("n"), num, den) + 1
    later = lambda t, i: F.transform(F.slice("prefix", i + 2, F.size("prefix")), lambda b: F.struct(i.alias("at"), F.xxhash64(t, b).alias("key")))
    keys = lambda t, i: F.when(t < low(1), F.array()).when(t < low(MANY_CLASS), F.array(F.struct(i.alias("at"), t.alias("key")))).otherwise(later(t, i))
    made = F.flatten(F.transform(F.slice("prefix", F.lit(1), width), keys))
    return sets.select("doc", "place", "n", "parity", F.explode(made).alias("s")).select("doc", "place", "n", "parity", "s.at", "s.key")


def line_dedup(docs: DataFrame, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` without the lines that an earlier line matches (Jaccard of their sets of words >= num/den).

    Lines end at line feeds, words stand between white space, order is that of
    (id, place in the text); rows that repeat an id stand in the order they are
    read.  A line is removed if any earlier line matches, also one that is
    removed itself.  Lines without a word stay.  ``count_col``: if given, a
    column with the number of removed lines.  Null texts stay null; a text all
    of whose lines go becomes empty; rows without an id keep their text.  No
    rows in: no rows out.  All columns stay, whatever their names, but one
    already called ``count_col`` is replaced.

    Words are compared by 64-bit hashes, sets of words by 128 bits.
    """
    out = [c for c in docs.columns if c != count_col]
    rows = docs.select(F.struct(*out).alias("row"), F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    if not rows.where("doc is not null").groupBy("doc").count().where("count > 1").isEmpty():
        rows = materialise(rows.withColumn("doc", F.when(F.col("doc").isNotNull(), F.struct("doc", F.monotonically_increasing_id().alias("read")))), "line-rows")
    source = rows.select("doc", "text").where("doc is not null and text is not null")
    classes = materialise(rarity(source, "text"), "line-rarity")

    # one line for each token set, the first, with its prefix; partial aggregation takes copies where they lie
    cut = source.select("doc", F.posexplode(_lines("text")).alias("place", "line"))
    n = F.size("tokens")
    prefix = F.slice("tokens", F.lit(1), n - _least_overlap(n, num, den) + 2)
    # parity of the tokens at each of 64 places: sets differ in no fewer tokens than their parities in bits
    parity = F.aggregate("tokens", F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int"))))
    described = tokens(cut, classes).where(n > 0).select(F.xxhash64("tokens").alias("set"), F.xxhash64(F.lit(7), "tokens").alias("set2"), F.struct("doc", "place", n.alias("n"), parity.alias("parity"), prefix.alias("prefix")).alias("first"))
    sets = materialise(described.groupBy("set", "set2").agg(F.min("first").alias("first")).select("first.*"), "line-sets")

    # parity, length and position filters: the least by which two sets differ, and the most that they have in common given the places of their first common token
    def may(x: str, y: str) -> Column:
        return F.expr(
            f"bit_count({x}.parity ^ {y}.parity) * {num + den} <= ({x}.n + {y}.n) * {den - num} and {x}.n * {den} >= {y}.n * {num} and {y}.n * {den} >= {x}.n * {num} "
            f"and least({x}.n - {x}.at, {y}.n - {y}.at) * {num + den} >= ({x}.n + {y}.n) * {num}"
        )

    # sets of fewer tokens than that have no match but themselves
    least = next(n for n in range(1, 10 * den) if (n + 1) * num <= n * den) if num < den else 1 << 30
    posts = _posts(sets.where(F.col("n") >= least), num, den).repartition("key")

    def pair(x: str, y: str) -> list[Column]:
        return [F.expr(f"struct({y}.doc, {y}.place)").alias("earlier"), F.expr(f"struct({x}.doc, {x}.place)").alias("later")]

    def matched(pairs: DataFrame) -> DataFrame:
        """Of pairs (earlier, later), the later lines whose sets are alike enough; only lines in pairs are cut into tokens again."""
        asked = pairs.select("earlier.*").unionByName(pairs.select("later.*"))
        places = materialise(asked.groupBy("doc").agg(F.collect_set("place").alias("places")), "line-asked")
        size = places.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("places")), F.lit(0)).alias("lines")).first()
        wanted = source.join(F.broadcast(places) if size["docs"] <= BROADCAST_IDS and size["lines"] <= BROADCAST_LINES else places, "doc")
        lines = wanted.select("doc", "places", F.posexplode(_lines("text")).alias("place", "line")).where(F.array_contains("places", F.col("place")))
        whole = materialise(tokens(lines.select("doc", "place", "line"), classes), "line-tokens")
        side = lambda s: whole.select(F.struct("doc", "place").alias(s), F.col("tokens").alias(f"{s}_tokens"))
        both = pairs.join(side("earlier"), "earlier").join(side("later"), "later")
        common = F.size(F.array_intersect("earlier_tokens", "later_tokens"))
        alike = both.where(common * (num + den) >= (F.size("earlier_tokens") + F.size("later_tokens")) * num)
        found = materialise(alike.select("later.doc", "later.place").distinct(), "line-matched")
        discard(places, whole)
        return found

    # under each key every set meets the first one and those just before it
    inorder = Window.partitionBy("key").orderBy("x.doc", "x.place")
    star = posts.select("key", F.struct("doc", "place", "n", "parity", "at").alias("x"))
    star = star.select("x", F.first("x").over(inorder).alias("y0"), *[F.lag("x", k).over(inorder).alias(f"y{k}") for k in range(1, BEFORE + 1)]).where("y1 is not null")
    met = [F.when(may("x", f"y{k}"), F.expr(f"struct(y{k}.doc, y{k}.place)")) for k in range(BEFORE + 1)]
    star = star.select(F.expr("struct(x.doc, x.place)").alias("later"), F.explode(F.array_compact(F.array(*met))).alias("earlier"))
    star = materialise(star.select("earlier", "later").distinct(), "line-star")
    gone = matched(star)
    # what that leaves meets every earlier set
    few = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    left = posts.join(few, ["doc", "place"], "left_anti").alias("x")
    rest = left.join(posts.alias("y"), F.expr("x.key = y.key") & may("x", "y") & F.expr("(y.doc < x.doc or y.doc = x.doc and y.place < x.place)"))
    rest = materialise(rest.select(*pair("x", "y")).distinct().join(star, ["earlier", "later"], "left_anti"), "line-rest")
    gone = gone.unionByName(matched(rest))
    discard(star, rest)

    kept = materialise(sets.join(gone, ["doc", "place"], "left_anti").groupBy("doc").agg(F.collect_set("place").alias("kept")), "line-kept")
    discard(sets)
    size = kept.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("kept")), F.lit(0)).alias("lines")).first()
    joined = rows.join(F.broadcast(kept) if size["docs"] <= BROADCAST_IDS and size["lines"] <= BROADCAST_LINES else kept, "doc", "left")
    lines = _lines("text")
    stays = lambda line, i: F.coalesce(F.array_contains("kept", i), F.lit(False)) | ~F.rlike(line, F.lit(f"[^{SPACE}]"))
    joined = joined.select("row", "text", F.when(F.col("doc").isNull(), lines).otherwise(F.filter(lines, stays)).alias("left"))
    counted = [F.coalesce(F.size(lines) - F.size("left"), F.lit(0)).cast("long").alias(count_col)] if count_col else []
    return joined.select(*[F.array_join("left", "\n").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in out], *counted)
