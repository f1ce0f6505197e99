"""Read models: search, facets, suggestions, guarded metrics and documents for a reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import all_tokens
from ..schema import NUMERIC


def search(df: DataFrame, text: Column, query: str = "", lines: Sequence = (), line: str | None = None, prefectures: Sequence = (), prefecture: str | None = None, favourites: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Rows that hold every token of the query and fit every facet that is given."""
    out = df.where(all_tokens(text, query))
    if lines:
        out = out.where(F.col(line).isin(*lines))
    if prefectures:
        out = out.where(F.col(prefecture).isin(*prefectures))
    if favourites is not None:
        out = out.join(favourites.select(key), key, "left_semi")
    return out


def comparable(components: str, codes: str, status: str, value: str) -> Column:
    """A station's value: only of one component in one partition, and available."""
    return F.when((F.size(components) == 1) & (F.size(codes) == 1) & F.col(status).isin(*NUMERIC), F.col(value))


def unknown_facet(df: DataFrame, components: DataFrame, key: str) -> DataFrame:
    """Rows without any published component."""
    return df.join(components.select(key), key, "left_anti")


def child_selects_group(areas: DataFrame, members: DataFrame, area: str, matches: Column) -> DataFrame:
    """Areas of which any member matches."""
    return areas.join(members.where(matches).select(area), area, "left_semi")


def suggestions(query: str, **sources: tuple[DataFrame, str, str]) -> DataFrame:
    """Typed suggestions (kind, id, label) of every source whose label holds the query; an empty query gives none."""
    out = None
    for kind, (df, key, label) in sorted(sources.items()):
        one = df.where(all_tokens(F.col(label), query) & F.lit(bool(query.strip()))).select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), F.col(label).alias("label")).distinct()
        out = one if out is None else out.unionByName(one)
    return out


def quantity_features(df: DataFrame, cell: str, value: str) -> DataFrame:
    """One feature for each cell; a missing value is -1 and says so, so that it is not a zero."""
    return df.groupBy(cell).agg(F.max(value).alias("__v")).select(cell, F.coalesce("__v", F.lit(-1)).alias("value"), F.col("__v").isNull().alias("missing"))


def metric_coverage(*values: Column) -> Column:
    """How many of the values there are."""
    return F.size(F.filter(F.array(*[v.isNotNull() for v in values]), lambda x: x))


def caption(operator: Column, routes: Column) -> Column:
    return F.concat_ws(" / ", operator, F.array_join(routes, "・"))


def document(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """One compact JSON text for each key, names in order, lists in order."""
    item = F.struct(*[F.col(c) for c in sorted(columns)])
    return df.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(item))).alias("json"))
