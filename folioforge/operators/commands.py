"""Commands in batch form: newest, retention, waiting for a reply."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def latest(commands: DataFrame, keys: list[str], order: list[str], after: F.Column | None = None) -> DataFrame:
    """The newest command of each key, one pass with partial aggregation (no sort)."""
    rows = commands.where(after) if after is not None else commands
    rest = [c for c in commands.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def keep_newest(commands: DataFrame, keys: list[str], order: list[str], keep: int = 10) -> DataFrame:
    """The newest ``keep`` of each key; a row-number limit that Spark applies before the shuffle too."""
    by = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return commands.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= keep).drop("_n")


def wait_for_reply(waits: DataFrame, commands: DataFrame, keys: list[str], time: str, expected: list[str] | None = None, tie: str | None = None) -> DataFrame:
    """waits (keys, t0, timeout): the newest command in (t0, t0 + timeout), null if none or not expected.

    Only the newest command is looked at, so an unexpected one hides an
    earlier expected one.
    """
    bounded = commands.join(waits, keys).where((F.col(time) > F.col("t0")) & (F.col(time) < F.col("t0") + F.col("timeout")))
    newest = bounded.groupBy(*keys).agg(F.max_by(F.struct("action", time), F.struct(time, *([tie] if tie else []))).alias("_b"))
    action = F.col("_b.action")
    shown = action if expected is None else F.when(action.isin(*expected), action)
    return waits.join(newest, keys, "left").select(*keys, shown.alias("action"), F.when(shown.isNotNull(), F.col(f"_b.{time}")).alias("replied"))
