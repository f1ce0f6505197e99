"""Grid components: rows of one cell in several partitions, never merged, summed complete-case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import NUMERIC


def annotate_overlap(df: DataFrame, cell: str, partition: str) -> DataFrame:
    """Each row with its cell's size, sorted partitions and whether it needs a roll-up.

    Two rows of one cell and partition are an error of the source: ``cell_faulty``.
    """
    w = Window.partitionBy(cell)
    return (
        df.withColumn("component_count", F.count("*").over(w))
        .withColumn("partition_codes", F.array_sort(F.collect_set(partition).over(w)))
        .withColumn("needs_rollup", F.col("component_count") > 1)
        .withColumn("cell_faulty", F.size("partition_codes") != F.col("component_count"))
    )


def overlap_summary(df: DataFrame, cell: str) -> DataFrame:
    """One row: component rows, cells, cells of several components, and their rows."""
    cells = df.groupBy(cell).agg(F.count("*").alias("n"))
    return cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("component_rows"), F.count("*").alias("cells"), F.count_if(F.col("n") > 1).alias("cross_cells"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("cross_rows"))


def complete_case(df: DataFrame, keys: Sequence[str], value: str, status: str, order: str, allowed: Sequence[str] = NUMERIC) -> DataFrame:
    """Sum of a group whose every member is available; else null with the missing members named.

    Columns: keys, total, complete, observed, expected, missing (``order:status`` joined), has_rounding.
    """
    ok = F.coalesce(F.col(status).isin(*allowed), F.lit(False))
    lacking = F.array_sort(F.collect_list(F.when(~ok, F.concat_ws(":", F.col(order).cast("string"), F.coalesce(F.col(status), F.lit("null"))))))
    return df.groupBy(*keys).agg(
        F.when(F.count_if(ok) == F.count("*"), F.sum(value)).alias("total"),
        (F.count_if(ok) == F.count("*")).alias("complete"),
        F.count_if(ok).alias("observed"),
        F.count("*").alias("expected"),
        F.array_join(lacking, ",").alias("missing"),
        F.bool_or(F.col(status) == "below_rounding_unit").alias("has_rounding"),
    )


def status_histogram(df: DataFrame, metric: str, status: str, value: str) -> DataFrame:
    """Rows and sum of present values for each metric and status; destinations' values are in the sum."""
    return df.groupBy(metric, status).agg(F.count("*").alias("rows"), F.sum(value).alias("value_sum"))


def roll_up(lattice: DataFrame, components: DataFrame, cell: str, partition: str, value: str, status: str, order: str, display: Sequence, expected: DataFrame | None = None, acquired: Sequence = ()) -> DataFrame:
    """Scope roll-up of every enumerated cell and partition, with or without a source row.

    ``lattice``: the (cell, partition) pairs in scope; one without a row is
    ``source_absent``.  A cell's analysis sum takes all components, the display
    sum those of the ``display`` partitions.  A sum needs every member available,
    else it is null and the status names the first that blocks, in ``order``.
    ``expected``: (cell, partition) pairs that can touch a cell; if one is not
    ``acquired``, the analysis status is ``partition_coverage_incomplete``.
    """
    rows = lattice.join(components.select(cell, partition, value, status, order), [cell, partition], "left")
    rows = rows.withColumn(status, F.coalesce(status, F.lit("source_absent"))).withColumn("__at", F.coalesce(F.col(order).cast("long"), F.lit((1 << 62))))
    shown = F.col(partition).isin(*display)

    def parts(of, prefix):
        bad = of & ~F.col(status).isin(*NUMERIC)
        first = F.min(F.when(bad, F.struct("__at", F.col(partition), status)))
        return [
            F.count_if(of).alias(f"{prefix}_members"),
            F.when((F.count_if(bad) == 0) & (F.count_if(of) > 0), F.sum(F.when(of, F.col(value)))).alias(f"{prefix}_sum"),
            F.when(F.count_if(of) == 0, "outside_scope").when(F.count_if(bad) == 0, "complete").otherwise(F.concat(F.lit("contains_"), first[status])).alias(f"{prefix}_status"),
        ]

    out = rows.groupBy(cell).agg(*parts(shown, "display"), *parts(F.lit(True), "analysis"))
    if expected is not None:
        gap = expected.where(~F.col(partition).isin(*acquired)).select(cell).distinct().withColumn("__gap", F.lit(True))
        out = out.join(gap, cell, "left")
        out = out.withColumn("analysis_status", F.when(F.col("__gap"), "partition_coverage_incomplete").otherwise(F.col("analysis_status"))).withColumn("analysis_sum", F.when(F.col("__gap").isNull(), F.col("analysis_sum"))).drop("__gap")
    return out


def single_authority(df: DataFrame, key: str, value: str, status: str, eligible) -> DataFrame:
    """One value for each key: that of its only eligible record; more are ambiguous; none takes a common status."""
    n = F.count_if(eligible)
    common = F.when(F.count_distinct(status) == 1, F.min(status)).otherwise(F.lit("source_absent"))
    return df.groupBy(key).agg(
        F.when(n == 1, F.max(F.when(eligible, F.col(value)))).alias("value"),
        F.when(n == 1, F.max(F.when(eligible, F.col(status)))).when(n > 1, F.lit("ambiguous_multiple_records")).otherwise(common).alias("status"),
        F.count("*").alias("records"),
    )


def context_assembly(families: dict[str, DataFrame], cell: str, partition: str, value: str, status: str, display: Sequence) -> DataFrame:
    """A cell's components of every family as arrays, its partition codes taken before the display filter."""
    rows = None
    for name, df in sorted(families.items()):
        one = df.select(F.lit(name).alias("family"), F.col(cell).alias("cell"), F.col(partition).alias("partition"), F.col(value).alias("value"), F.col(status).alias("status"))
        rows = one if rows is None else rows.unionByName(one)
    shown = F.col("partition").isin(*display)
    item = F.when(shown, F.struct("family", "partition", "value", "status"))
    return rows.groupBy("cell").agg(
        F.array_sort(F.collect_list(item)).alias("components"),
        F.array_sort(F.collect_set("partition")).alias("partition_codes"),
        F.array_sort(F.collect_set(F.when(~shown, F.col("partition")))).alias("outside_codes"),
        F.bool_or(shown & F.col("status").isin(*NUMERIC)).alias("available"),
    ).withColumn("needs_rollup", F.size("partition_codes") > 1)
