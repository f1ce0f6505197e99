"""The constraints of canonical relations, compiled into one scan and one count for each relation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ENUMS, RELATIONS, Relation
from .constraints import GateError, gate, require_columns


def row_checks(relation: Relation) -> list[tuple[str, Column]]:
    """(constraint, fault) of every constraint that a row alone decides.  A check that is null holds."""
    kinds = {f.name: f.dataType for f in relation.columns}
    value = {c: F.col(c).try_cast(kind) for c, kind in kinds.items()}
    made = [(f"required:{f.name}", F.col(f.name).isNull()) for f in relation.columns if not f.nullable]
    made += [(f"type:{c}", F.col(c).isNotNull() & value[c].isNull()) for c in kinds]
    made += [(f"like:{c}", ~F.col(c).like(p)) for c, p in relation.like.items()]
    made += [(f"one_of:{c}", ~F.col(c).isin(*ENUMS[e])) for c, e in relation.one_of.items()]
    made += [(f"length:{c}", F.length(c) != n) for c, n in relation.sizes.items()]
    made += [(f"least:{c}", value[c] < n) for c, n in relation.least.items()]
    made += [(f"share:{c}", ~value[c].between(0, 1)) for c in relation.shares]
    made += [(f"flag:{c}", ~value[c].isin(0, 1)) for c in relation.flags]
    return made + [(f"rule:{name}", F.expr(f"not ({predicate})")) for name, predicate in relation.rules.items()]


def _text(columns: tuple[str, ...]) -> Column:
    """A key as text; keys of several columns as a JSON array."""
    return F.col(columns[0]).cast("string") if len(columns) == 1 else F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))


def _entries(df: DataFrame, name: str, relation: Relation) -> DataFrame:
    """(relation, constraint, target, key, rows): what each row offends, claims and refers to, read once and counted once."""
    require_columns(df, relation.columns.fieldNames(), name)
    entry = lambda constraint, target, key: F.struct(F.lit(constraint).alias("constraint"), F.lit(target).cast("string").alias("target"), key.alias("key"))
    key = _text(relation.key)
    offends = [F.when(fault, entry(constraint, "", key)) for constraint, fault in row_checks(relation)]
    all_there = lambda columns: reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    claims = [F.when(all_there(u), entry("unique:" + "+".join(u), None, _text(u))) for u in (relation.key, *relation.unique)]
    refers = [F.when(F.col(c).isNotNull(), entry(f"refers:{c}", target, F.col(c).cast("string"))) for c, target in relation.refers.items()]
    found = df.select(F.explode(F.array_compact(F.array(*offends, *claims, *refers))).alias("e")).select("e.*")
    return found.groupBy("constraint", "target", "key").agg(F.count("*").alias("rows")).select(F.lit(name).alias("relation"), "*")


def canonical_faults(tables: Mapping[str, DataFrame], relations: Mapping[str, Relation] = RELATIONS) -> DataFrame:
    """relation, constraint, key, rows: everything by which ``tables`` break the constraints of their relations.

    ``key`` is that of the rows for a constraint of single rows, the repeated
    one for a unique one, and the one looked for in vain for a reference.  As
    in SQL, a check of a null holds, keys with a null do not repeat, and a null
    refers to nothing; required columns must be there, those of a key included.
    References to relations that are not given are not followed.  A relation
    that is not known, or a column that lacks, fails; further columns are free.
    """
    unknown = sorted(set(tables) - set(relations))
    if unknown or not tables:
        raise GateError(f"relations that are not known: {unknown}" if unknown else "no relation is given")
    entries = reduce(DataFrame.unionByName, [_entries(df, name, relations[name]) for name, df in tables.items()])
    targets = sorted({t for name in tables for t in relations[name].refers.values()} & set(tables))
    told = entries.where(F.col("target").isNull() & (F.col("rows") > 1) | F.col("target").isin("", *targets))
    if targets:
        # one join over all that is left, so that no relation is read again for its references
        known = reduce(DataFrame.unionByName, [tables[t].select(F.lit(t).alias("target"), _text(relations[t].key).alias("key")) for t in targets])
        # not an anti join, which Spark would push below the counts, to every row
        told = told.join(known.withColumn("__known", F.lit(True)), ["target", "key"], "left").where("__known is null")
    return told.select("relation", "constraint", "key", "rows")


def canonical_gate(tables: Mapping[str, DataFrame], relations: Mapping[str, Relation] = RELATIONS) -> dict[str, int]:
    """Fails, with examples, if ``tables`` break any constraint."""
    return gate([("canonical constraints", canonical_faults(tables, relations))])


def conformed(df: DataFrame, name: str, relations: Mapping[str, Relation] = RELATIONS) -> DataFrame:
    """The columns of relation ``name`` in their order and types, for its sink; a value of another type fails."""
    columns = relations[name].columns
    return require_columns(df, columns.fieldNames(), name).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns])
