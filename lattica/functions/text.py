"""Keys, JSON, hashes and small text functions as column expressions."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def composite_key(*parts: Column, sep: str = "|") -> Column:
    """Parts joined; a null part counts as empty, so that places stay."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def split_key(key: Column, n: int = 3) -> Column:
    """The parts of a composite key; another number of parts fails."""
    parts = F.split(key, r"\|")
    return F.when(F.size(parts) == n, parts).otherwise(F.raise_error(F.concat(F.lit("malformed key: "), F.coalesce(key, F.lit("null")))).cast("array<string>"))


def zfill(value: Column, width: int) -> Column:
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def compact_json(**columns: Column) -> Column:
    """A compact JSON object with its names in order."""
    return F.to_json(F.struct(*[columns[k].alias(k) for k in sorted(columns)]))


def ordered_hash(seq: Column, key: Column) -> Column:
    """Aggregate: SHA-256 of the JSON list of keys in order."""
    return F.sha2(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(seq.alias("s"), key.alias("k")))), lambda x: x["k"])), 256)


def sorted_json(value: Column) -> Column:
    """Aggregate: JSON list of the distinct values in order."""
    return F.to_json(F.array_sort(F.collect_set(value)))


def joined_set(value: Column, default: str = "", sep: str = "+") -> Column:
    """Aggregate: the distinct values in order, joined; a default where there are none."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set(value)), sep), F.lit("")), F.lit(default))


def all_tokens(haystack: Column, query: str) -> Column:
    """Every token of the query occurs; an empty query fits all."""
    out = F.lit(True)
    for token in query.split():
        out = out & F.contains(F.lower(haystack), F.lit(token.lower()))
    return out


def safe_member(path: Column) -> Column:
    """An archive path that stays inside: not absolute, no backslash, no ``..`` part."""
    return ~path.startswith("/") & ~F.contains(path, F.lit("\\")) & ~F.array_contains(F.split(path, "/"), "..") & (path != "")


def url_host_in(url: Column, hosts: list[str]) -> Column:
    return F.coalesce(F.lower(F.call_function("try_parse_url", url, F.lit("HOST"))).isin(*hosts), F.lit(False))


def opaque_id_faults(entity_id: Column, prefix: str, source_key: Column | None = None) -> Column:
    """Reasons why an identity is not opaque: form, prefix, or a source key inside it; a null one lacks form and prefix."""
    fails = lambda good: ~F.coalesce(good, F.lit(False))
    reasons = [F.when(fails(entity_id.rlike("^[a-z]{3}_[0-9a-f]{32}$")), "form"), F.when(fails(entity_id.startswith(prefix)), "prefix")]
    if source_key is not None:
        reasons.append(F.when(F.contains(entity_id, source_key), "source_key_inside"))
    return F.array_compact(F.array(*reasons))


def excel_cell(column: Column, row: Column) -> Column:
    """``A1`` style name of a 1-based column and row (up to ZZ)."""
    letter = lambda n: F.chr(n + 64)
    high, low = F.floor((column - 1) / 26), (column - 1) % 26 + 1
    return F.concat(F.when(high > 0, letter(high)).otherwise(F.lit("")), letter(low), row.cast("string"))


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility normal form; SQL has none."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(T.StringType())
def html_unescape(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else html.unescape(t))


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def forbidden_source(text: Column, pattern: str) -> Column:
    """A forbidden name, whatever its width or case."""
    return F.coalesce(nfkc(text).rlike(f"(?i){pattern}"), F.lit(False))
