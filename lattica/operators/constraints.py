"""Gates: each constraint is a DataFrame of violations; a gate fails the run if there are any."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import opaque_id_faults
from ..schema import NUMERIC, STATUSES, VALUED, VALUELESS


class GateError(AssertionError):
    """A gate found violations."""


def gate(checks: Iterable[tuple[str, DataFrame]], show: int = 5) -> dict[str, int]:
    """Count every check's violations; all empty returns the counts, else the run fails with examples."""
    counts, words = {}, []
    for name, bad in checks:
        counts[name] = n = bad.count()
        if n:
            words.append(f"{name}: {n}, such as {[r.asDict() for r in bad.limit(show).collect()]}")
    if words:
        raise GateError("; ".join(words))
    return counts


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "table") -> DataFrame:
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise GateError(f"{what} lacks columns {lacking}")
    return df


def not_empty(df: DataFrame, what: str = "artifact") -> DataFrame:
    if df.isEmpty():
        raise GateError(f"{what} is empty")
    return df


def observation_faults(raw: Column, value: Column, status: Column) -> Column:
    """Why a stored triplet is not valid; an empty array if it is."""
    zero_raw = F.regexp_replace(raw, ",", "").try_cast("decimal(38,6)") == 0
    return F.array_compact(F.array(
        F.when(status.isNull() | ~status.isin(*STATUSES), "unknown_status"),
        F.when(status == "invalid", "invalid_stored"),
        F.when((status == "observed") & ~F.coalesce(value > 0, F.lit(False)), "observed_needs_positive"),
        F.when((status == "observed_zero") & ~F.coalesce(value == 0, F.lit(False)), "zero_needs_zero"),
        F.when((status == "observed_zero") & ~F.coalesce(zero_raw, F.lit(False)), "zero_needs_zero_token"),
        F.when(status.isin(*VALUED) & ~status.isin(*NUMERIC) & value.isNull(), "value_needed"),
        F.when(status.isin(*VALUELESS) & value.isNotNull(), "value_with_missing_status"),
        F.when(value < 0, "negative"),
    ))


def violations(df: DataFrame, reasons: Column, *keep: str) -> DataFrame:
    return df.select(*keep, F.array_join(reasons, "+").alias("reasons")).where("reasons <> ''")


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def foreign_key(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.where(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias("__p")), F.col(child_key) == F.col("__p"), "left_anti")


def allowed(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is not in the set; a null is not in it either."""
    return df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows out of range; null is no violation."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).between(low, high))


def schema_faults(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences of a table's columns and types from a declared schema."""
    got = dict(df.dtypes)
    want = {f.name: f.dataType.simpleString() for f in schema}
    return [f"{n}: {got.get(n, 'absent')} instead of {k}" for n, k in want.items() if got.get(n) != k] + [f"{n}: not declared" for n in got if n not in want]


def required_nulls(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with a null in a required column."""
    needed = [f.name for f in schema if not f.nullable and f.name in df.columns]
    reasons = F.array_compact(F.array(*[F.when(F.col(n).isNull(), n) for n in needed])) if needed else F.array().cast("array<string>")
    return df.withColumn("reasons", F.array_join(reasons, "+")).where("reasons <> ''")


def opaque_ids(df: DataFrame, entity_id: str, prefix: str, source_key: str | None = None) -> DataFrame:
    return violations(df, opaque_id_faults(F.col(entity_id), prefix, F.col(source_key) if source_key else None), entity_id)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in only one of the two, with which."""
    return a.exceptAll(b).withColumn("only_in", F.lit("left")).unionByName(b.exceptAll(a).withColumn("only_in", F.lit("right")))


def drift(left: DataFrame, right: DataFrame, key: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys of a full join whose columns differ (null-safe), with the names of those that do; a key may have several columns."""
    keys = [key] if isinstance(key, str) else list(key)
    a = left.select(*keys, *columns, F.lit(True).alias("__left"))
    b = right.select(*[F.col(c).alias(f"__{c}") for c in (*keys, *columns)], F.lit(True).alias("__right"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    both = F.col("__left") & F.col("__right")
    reasons = F.array_compact(F.array(F.when(F.col("__left").isNull(), "only_right"), F.when(F.col("__right").isNull(), "only_left"), *[F.when(both & ~F.col(c).eqNullSafe(F.col(f"__{c}")), c) for c in columns]))
    return a.join(b, on, "full").select(*[F.coalesce(k, f"__{k}").alias(k) for k in keys], F.array_join(reasons, "+").alias("drift")).where("drift <> ''")


def control_totals(children: DataFrame, parents: DataFrame, parent_key: str, value: str, total: str) -> DataFrame:
    """Parents whose total is not the sum of their children."""
    sums = children.groupBy(parent_key).agg(F.sum(value).alias("child_sum"))
    j = parents.select(parent_key, total).join(sums, parent_key, "left")
    return j.where(~F.col(total).eqNullSafe(F.col("child_sum")))


def domain_isolation(metrics: DataFrame, code: str, domain: str, used: Sequence[str], forbidden: str = "access") -> DataFrame:
    """Metrics of a forbidden domain that are used in a score."""
    return metrics.where((F.col(domain) == forbidden) & F.col(code).isin(*used))


def config_pins(config: dict, pins: dict) -> list[str]:
    """Dotted paths of a configuration whose values are not as pinned."""
    out = []
    for path, want in pins.items():
        at = config
        for part in path.split("."):
            at = at.get(part) if isinstance(at, dict) else None
        if at != want:
            out.append(f"{path}: {at!r} instead of {want!r}")
    return out


def walk(value, path: str = "") -> Iterable[tuple[str, object]]:
    """Every key and item of a nested configuration, with its path."""
    items = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    for k, v in items:
        at = f"{path}.{k}" if path else str(k)
        yield at, v
        yield from walk(v, at)
