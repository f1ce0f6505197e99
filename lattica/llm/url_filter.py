"""URL filters: rules on host and path, and a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise

#: Bits for each listed URL, words of 64 bits in a block, bits set for a URL, and the largest filter (in blocks) that is broadcast: 64 KB.
BITS_PER_URL, WORDS, HASHES, BROADCAST_BLOCKS = 16, 8, 6, 1_000


def _rest(url: Column) -> Column:
    """What stands behind the first ``://``."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; path: then up to ``?``, ``#`` or the end."""
    rest = _rest(url)
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """``host/path?query``: no scheme, no leading ``www.`` or ``m.``, no closing ``/`` or ``.html``, no fragment, no ``utm_*`` or ``ref`` parameter."""
    host, path = host_and_path(url)
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, r"(^|&)(utm_[^&=]*|ref)(=[^&]*)?(?=&|\z)", ""), r"^&+", "")
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(/|\.html)\z", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def _hashes(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block, and its mask for each of the block's words."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("long").alias("block")
    h = F.xxhash64(F.lit(7), key)
    bits = [F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(511)) for i in range(HASHES)]
    masks = []
    for w in range(WORDS):
        mask = F.lit(0).cast("long")
        for b in bits:
            mask = mask.bitwiseOR(F.when(F.shiftright(b, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long")))
        masks.append(mask.alias(f"w{w}"))
    return block, masks


def bloom_blocks(listed: DataFrame, key_col: str, blocks: int) -> DataFrame:
    """The filter as rows: block, w0..w7; one aggregation with partial sums, whatever the list's size."""
    block, masks = _hashes(F.col(key_col), blocks)
    marked = listed.where(F.col(key_col).isNotNull()).select(block, *masks)
    return marked.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)])


def url_verdicts(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", key_col: str = "canonical") -> DataFrame:
    """Judge every url: the longest fitting rule, else block if its canonical form is listed, else allow.

    ``rules``: (verdict, host, path) triples, a short list held in the plan.
    ``listed``: canonical URLs in ``key_col``; nulls and repeats in it change
    nothing.  Returns id, host, path, rule (``host + path``, else null),
    verdict, and listed (whether the exact list has the url).  A null url, or
    one without ``://``, has an empty host and path, fits no rule, is not
    listed and is allowed.  Every row of ``pages`` gives one row, repeated rows
    too; other columns are not read.

    The list's Bloom filter is keyed by block, so a probe is an equi-join that
    reads one block.  A filter of up to ``BROADCAST_BLOCKS`` blocks is broadcast,
    a larger one is joined by shuffle, distinct canonical URLs against blocks.
    """
    listed = materialise(listed.select(F.col(key_col).alias("canonical")).where(F.col("canonical").isNotNull()).distinct(), "url-listed")
    n = listed.count()
    blocks = max(1, -(-n * BITS_PER_URL // (64 * WORDS)))
    bloom = bloom_blocks(listed, "canonical", blocks)

    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    rows = rows.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("ruled"), canonical_url(F.col("url")).alias("canonical"))

    # each canonical url once, with how many rows have it: a hot url is one probe
    wanted = rows.where(F.col("ruled").isNull() & (F.col("canonical") != "")).select("canonical").distinct()
    block, masks = _hashes(F.col("canonical"), blocks)
    probes = wanted.select("canonical", block, *[m.alias(f"p{w}") for w, m in enumerate(masks)])
    passed = probes.join(F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom, "block")
    for w in range(WORDS):
        passed = passed.where(F.col(f"w{w}").bitwiseAND(F.col(f"p{w}")) == F.col(f"p{w}"))
    hits = passed.select("canonical").join(listed.hint("shuffle_hash"), "canonical", "left_semi").withColumn("listed", F.lit(True))
    # only rows that no rule decides ask the list
    asks = F.col("ruled").isNull() & (F.col("canonical") != "")
    told = rows.where(asks).join(hits, "canonical", "left").select("page_id", "host", "path", "rule", "ruled", "listed")
    told = told.unionByName(rows.where(~asks).select("page_id", "host", "path", "rule", "ruled", F.lit(None).cast("boolean").alias("listed")))
    return told.select(
        F.col("page_id").alias(id_col), "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"),
    )
