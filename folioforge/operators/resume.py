"""Resume, retry and upsert as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DONE = ("success", "skipped")
_FIELDS = ("status", "error", "elapsed", "updated")


def pending(tasks: DataFrame, progress: DataFrame, resume: bool = True, retry_failed: bool = False) -> DataFrame:
    """Tasks that a run has to do.

    Resuming leaves out tasks that are done; retrying keeps failed tasks only
    (new ones wait for an ordinary run).  The planner broadcasts the progress
    side only while it is small.
    """
    out = tasks
    if resume:
        out = out.join(progress.where(F.col("status").isin(*DONE)).select("task_id"), "task_id", "left_anti")
    if retry_failed:
        out = out.join(progress.where("status = 'failed'").select("task_id"), "task_id", "left_semi")
    return out


def upsert(progress: DataFrame, results: DataFrame) -> DataFrame:
    """Progress with new results put in; a new row wins.  Ids are unique on either side."""
    new = results.select("task_id", F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in _FIELDS if c in results.columns])
    pick = lambda c: F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in results.columns else F.when(F.col("_new"), F.lit(None)).otherwise(F.col(c)).alias(c)
    return progress.join(new, "task_id", "full_outer").select("task_id", *[pick(c) for c in _FIELDS if c in progress.columns])


def initial_counts(tasks: DataFrame, progress: DataFrame, resume: bool = True) -> DataFrame:
    """One row: total, resumed (done before, only when resuming), pending."""
    joined = tasks.select("task_id").join(progress.select("task_id", "status"), "task_id", "left")
    done = F.count_if(F.col("status").isin(*DONE)) if resume else F.lit(0).cast("long")
    return joined.agg(F.count("*").alias("total"), done.alias("resumed")).withColumn("pending", F.col("total") - F.col("resumed"))
