"""Queries that apply each operator to its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import shared_dir, table

#: The judged rules.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url_feed(pages):
    """The listed URLs, derived from the pages: canonical forms whose MD5 begins with 0, and of those that begin with 1 a near miss."""
    from .url_filter import canonical_url

    forms = pages.select(canonical_url(F.col("url")).alias("canonical")).where("canonical <> ''").distinct()
    first = F.substring(F.md5("canonical"), 1, 1)
    return forms.where(first.isin("0", "1")).select(F.when(first == "0", F.col("canonical")).otherwise(F.concat("canonical", F.lit("x"))).alias("canonical"))


#: The surrogates' secret in the registered queries.
PII_KEY = b"registered-query-key"


def op1_pii(spark, sf_dir):
    from .pii import replace_pii

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_pii(docs, PII_KEY, count_col="n_replaced")


def op2_segmentation(spark, sf_dir):
    import public_tokenizers

    from .segment import segmentations

    return segmentations(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), n=4)


def op3_line_dedup(spark, sf_dir):
    from .line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), count_col="n_removed")


def op4_url_filters(spark, sf_dir):
    from .url_filter import url_verdicts

    pages = table(spark, sf_dir, "pages")
    return url_verdicts(pages, url_feed(pages), URL_RULES)


def op5_quality(spark, sf_dir):
    from .quality import classify_quality

    scored = classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "source", "lang", "quality_evidence", "quality_site", "quality_score", "keep")


def op6_sharding(spark, sf_dir):
    from .sharding import karmarkar_karp_shards

    return karmarkar_karp_shards(table(spark, sf_dir, "documents"), shards=24)


def op7_packing(spark, sf_dir):
    import public_tokenizers

    from .packing import pack, word_bpe

    return pack(table(spark, sf_dir, "documents"), word_bpe(public_tokenizers.path("word_bpe_49k.json")))


def op8_ann(spark, sf_dir):
    from .ann import permutation_search

    return permutation_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_media(spark, sf_dir):
    from .media import image_copies, rendered

    return image_copies(rendered(table(spark, sf_dir, "embeddings"), "vec_id"))


def op10_jaccard(spark, sf_dir):
    from .jaccard import similarity_components

    return similarity_components(table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    from .collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark, sf_dir):
    from .audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_counts(spark, sf_dir):
    import zlib

    import public_tokenizers

    from .token_cache import token_counts

    folder = f"{shared_dir(spark)}/token-counts-{zlib.crc32(sf_dir.encode()):08x}"
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), folder)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_segmentation": op2_segmentation,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_filters": op4_url_filters,
    "op5_quality": op5_quality,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_ann": op8_ann,
    "op9_media": op9_media,
    "op10_jaccard": op10_jaccard,
    "op11_collocations": op11_collocations,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_counts": op13_token_counts,
}

SQL = {
    "op4_url_filters": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce(rest, ''), '^[^?#]*\?([^#]*)', 1) AS query
  FROM cut
), keyed AS (
  SELECT page_id, host, path,
    regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/|\.html)$', '')
      || CASE WHEN q = '' THEN '' ELSE '?' || q END AS canonical
  FROM (SELECT *, regexp_replace(array_to_string(list_filter(string_split(query, '&'), lambda x: NOT regexp_matches(x, '^(utm_[^=]*|ref)(=.*)?$')), '&'), '^&+', '') AS q FROM parts)
), feed AS (
  SELECT DISTINCT CASE WHEN starts_with(md5(canonical), '0') THEN canonical ELSE canonical || 'x' END AS canonical
  FROM keyed WHERE canonical <> '' AND (starts_with(md5(canonical), '0') OR starts_with(md5(canonical), '1'))
), ruled AS (
  SELECT k.page_id, k.host, k.path, k.canonical, r.rule, r.verdict
  FROM keyed k
  LEFT JOIN LATERAL (
    SELECT h || p AS rule, v AS verdict
    FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS t(v, h, p)
    WHERE (k.host = h OR ends_with(k.host, '.' || h)) AND starts_with(k.path, p)
    ORDER BY length(h || p) DESC LIMIT 1
  ) r ON true
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN canonical IN (SELECT canonical FROM feed) THEN 'block' ELSE 'allow' END) AS verdict,
  verdict IS NULL AND canonical IN (SELECT canonical FROM feed) AS listed
FROM ruled
""",
    "op11_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), phrases AS (
  SELECT lang, w[i] AS phrase, 1 AS size FROM starts
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM starts WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3 FROM starts WHERE i + 2 <= len(w)
), f AS (
  SELECT lang, phrase, size, count(*) AS f FROM phrases GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT lang, phrase, a, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM candidates
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE size = 3
), cut_scores AS (
  SELECT c.lang, c.phrase, c.a, k, p.f AS l, q.f AS r, (1000000::HUGEINT * c.a * c.a) // (p.f::HUGEINT * q.f) AS score
  FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = c.x JOIN f q ON q.lang = c.lang AND q.phrase = c.y
), lowest AS (
  SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), covered AS (
  SELECT lang, part AS phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM candidates WHERE size = 3) GROUP BY ALL
), ranked AS (
  SELECT l.lang, row_number() OVER (PARTITION BY l.lang ORDER BY l.score DESC, l.a DESC, l.phrase) AS rank, l.phrase, l.a, l.l, l.r, t.n, l.score::BIGINT AS score
  FROM lowest l JOIN totals t ON t.lang = l.lang LEFT JOIN covered c ON c.lang = l.lang AND c.phrase = l.phrase
  WHERE c.longer IS NULL OR 100 * c.longer < 50 * l.a
)
SELECT * FROM ranked WHERE rank <= 2000
""",
    "op12_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT d.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN marks USING (doc_id)
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || e.x || f.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x) JOIN letters f ON f.x NOT IN (a.x, b.x, c.x, e.x)
), steps AS (
  SELECT filter_order, s::INT AS step, substr(filter_order, s, 1) AS own, substr(filter_order, 1, s - 1) AS before FROM orders, range(1, 6) AS r(s)
), seen AS (
  SELECT part, filter_order, step, own, good, toxic, fails = own AS lone, contains(fails, own) AS hit, translate(fails, before, '') <> fails AS gone FROM failed, steps
), told AS (
  SELECT part, filter_order, step, own,
    count(*) FILTER (NOT hit AND NOT gone) AS kept, count(*) FILTER (hit AND NOT gone) AS removed, count(*) FILTER (hit AND gone) AS redundant,
    count(*) FILTER (lone) AS unique_fails, count(*) FILTER (hit AND NOT gone AND good) AS good_lost, count(*) FILTER (hit AND NOT gone AND toxic) AS toxic_lost
  FROM seen GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM told
""",
}
