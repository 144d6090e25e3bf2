"""Counts, progress figures and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import notices as N


def status_counts(results: DataFrame, keys: list[str] | None = None, *more: Column) -> DataFrame:
    """success, failed, skipped and total, and more aggregates of the same pass, overall or by keys."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "skipped")]
    return results.groupBy(*(keys or [])).agg(F.count("*").alias("total"), *counts, *more)


def with_progress(counts: DataFrame) -> DataFrame:
    """Adds current, pct and a bar to status counts."""
    current = F.col("success") + F.col("failed") + F.col("skipped")
    return counts.withColumn("current", current).withColumn("pct", N.percent(F.col("current"), F.col("total"))).withColumn("bar", N.bar(F.col("current"), F.col("total")))


def with_eta(counts: DataFrame, elapsed: str = "elapsed_s") -> DataFrame:
    """Adds seconds a task and the remaining minutes; null before the first task is done."""
    each = F.when(F.col("current") > 0, F.col(elapsed) / F.col("current"))
    return counts.withColumn("avg_s", each).withColumn("eta_min", each * (F.col("total") - F.col("current")) / 60)


def _failed(order: str) -> Column:
    """Aggregate: ids that failed, in task order."""
    rows = F.array_sort(F.collect_list(F.when(F.col("status") == "failed", F.struct(order, "task_id"))))
    return F.transform(rows, lambda r: r["task_id"]).alias("failed_ids")


def failed_ids(results: DataFrame, order: str = "ord") -> DataFrame:
    """One row with the ids that failed, in task order."""
    return results.agg(_failed(order))


def summary(results: DataFrame, elapsed_min: float, order: str = "ord") -> DataFrame:
    """One row, one pass: counts, failed ids and elapsed minutes."""
    return status_counts(results, None, _failed(order)).withColumn("elapsed_min", F.lit(float(elapsed_min)))


def call_stats(calls: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Calls and failures, each call counted once."""
    return calls.groupBy(*(keys or [])).agg(F.count("*").alias("total_calls"), F.count_if(~F.col("ok")).alias("total_failures"))


def call_delta(stats: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Change of total_calls against the row before."""
    before = F.lag("total_calls").over(Window.partitionBy(*keys).orderBy(order))
    return stats.withColumn("delta_calls", F.col("total_calls") - F.coalesce(before, F.lit(0)))


def dry_run(tasks: DataFrame, partition: list[str] | None = None) -> DataFrame:
    """Labels in order, each with a heading where a new non-empty group begins."""
    by = Window.partitionBy(*(partition or [])).orderBy("ord")
    before = F.last(F.nullif("grp", F.lit("")), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    group = F.nullif("grp", F.lit(""))
    heading = F.when(group.isNotNull() & ~group.eqNullSafe(before), group)
    return tasks.withColumn("heading", heading)
