"""Assembly of published records: merged features, provenance, context, declared counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constraints import walk


def merge_features(df: DataFrame, key: str, index: str, lon: str, lat: str, *variants: str) -> DataFrame:
    """One record for each source key: mean point, count, indexes in order, and each variant column's values as first seen."""
    seen = F.array_sort(F.collect_list(F.struct(F.col(index).alias("__i"), *variants)))
    merged = df.groupBy(key).agg(F.avg(lon).alias("lon"), F.avg(lat).alias("lat"), F.count("*").alias("feature_count"), seen.alias("__seen"))
    of = lambda c: F.transform("__seen", lambda x: x[c])
    return merged.select(key, "lon", "lat", "feature_count", of("__i").alias("feature_indexes"), *[F.array_distinct(of(v)).alias(f"{v}_variants") for v in variants])


def must_hit(left: DataFrame, right: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(inner join, rows of ``left`` that hit nothing); a gate holds the second to be empty."""
    return left.join(right, list(on)), left.join(right.select(*on).distinct(), list(on), "left_anti")


def with_provenance(df: DataFrame, artifacts: DataFrame, artifact: str, recovered_at: str | None = None) -> DataFrame:
    """``df`` with the block of source columns of its artifact; ``recovered_at`` names a column of ``df``."""
    block = artifacts.select(
        F.col("artifact_id").alias(artifact),
        "source_release_id",
        F.col("artifact_id").alias("source_artifact_id"),
        F.col("sha256").alias("source_archive_sha256"),
        F.col("reference_date_or_period").cast("string").alias("source_reference_period"),
        F.col("publication_date_or_period").cast("string").alias("source_published_at"),
        F.col("retrieved_at").alias("source_lock_retrieved_at"),
    )
    recovered = F.col(recovered_at).alias("raw_recovered_at") if recovered_at else F.lit(None).cast("string").alias("raw_recovered_at")
    return df.withColumn("raw_recovered_at", recovered).join(block, artifact, "left")


def recovery_window(df: DataFrame, artifact: str, recovered_at: str) -> DataFrame:
    return df.groupBy(artifact).agg(F.min(recovered_at).alias("recovered_first"), F.max(recovered_at).alias("recovered_last"))


def context_records(items: DataFrame, sources: DataFrame, source: str) -> DataFrame:
    """Items with their source's address, licence and credit; the period is the reference period, else the date."""
    links = sources.select(source, F.col("url").alias("source_url"), F.col("license_id").alias("license"), "attribution", "terms_url")
    note = F.trim(F.concat_ws(" ", "interpretation", "scope_note"))
    return items.join(links, source).withColumns({"period_label": F.coalesce("reference_period", "reference_date"), "display_note": note})


def declared_counts(df: DataFrame, by: Sequence[str], declared: DataFrame, count: str = "declared") -> DataFrame:
    """Groups whose number of rows is not the declared one; a group on one side only has 0 on the other."""
    found = df.groupBy(*by).agg(F.count("*").alias("found"))
    j = found.join(declared.select(*by, count), list(by), "full")
    return j.select(*by, F.coalesce("found", F.lit(0)).alias("found"), F.coalesce(count, F.lit(0)).alias(count)).where(F.col("found") != F.col(count))


def partition_union(contexts: DataFrame, components: DataFrame, others: DataFrame, cell: str, code: str) -> DataFrame:
    """For each context cell the partition codes of two families of components together, and whether the first has any."""
    both = components.select(cell, F.col(code).alias("__code"), F.lit(1).alias("__own")).unionByName(others.select(cell, F.col(code).alias("__code"), F.lit(0).alias("__own")))
    told = both.groupBy(cell).agg(F.array_sort(F.collect_set("__code")).alias("__codes"), F.sum("__own").alias("__n"))
    status = F.when(F.coalesce("__n", F.lit(0)) > 0, "available").otherwise("source_absent")
    empty = F.array().cast(told.schema["__codes"].dataType)
    return contexts.select(cell).distinct().join(told, cell, "left").select(cell, F.coalesce("__codes", empty).alias("source_partition_codes"), F.coalesce("__n", F.lit(0)).alias("components"), status.alias("status"))


def open_reviews(queue: DataFrame, status: str = "status") -> DataFrame:
    """Cases that are not closed; a case without a status is open."""
    return queue.where(F.coalesce(F.col(status), F.lit("open")) == "open")


def flag_faults(manifests: dict[str, dict], flag: str, want=False) -> list[str]:
    """Manifests in which a flag is absent, or anywhere not as it must be."""
    out = []
    for name, config in sorted(manifests.items()):
        found = [v for at, v in walk(config) if at.rpartition(".")[2] == flag]
        if not found or any(v is not want for v in found):
            out.append(f"{name}: {flag} is {found or 'absent'}")
    return out


def activity_surface(df: DataFrame, kinds: dict[str, tuple[str, str, float, float]], train: Column) -> DataFrame:
    """``df`` with ``activity``: the sum over kinds (employees, establishments, weight, alpha) of weighted z-scores of their logarithms.

    Means and deviations come from the training rows only.  A missing value
    makes the surface missing, not zero; a column without spread scores 0.
    """
    used = sorted({c for e, n, _, _ in kinds.values() for c in (e, n)})
    fitted = df.where(train).agg(*[f(F.log1p(c)).alias(f"{k}_{c}") for c in used for k, f in (("m", F.avg), ("s", F.stddev_pop))])

    def z(c: str) -> Column:
        mean, spread = (fitted.select(f"{k}_{c}").scalar() for k in "ms")
        return F.when(F.col(c).isNotNull(), F.when(spread > 0, (F.log1p(c) - mean) / spread).otherwise(0.0))

    total = F.lit(0.0)
    for e, n, weight, alpha in kinds.values():
        total = total + F.lit(weight) * (F.lit(alpha) * z(e) + F.lit(1 - alpha) * z(n))
    return df.withColumn("activity", total)


def access_score(riders: Column, routes: Column, position: Column, weights: Sequence[float] = (1.0, 1.0, 1.0)) -> Column:
    """Logarithm of riders, with the number of routes and the place on the line; null if any is missing."""
    return weights[0] * F.log1p(riders) + weights[1] * routes + weights[2] * position
