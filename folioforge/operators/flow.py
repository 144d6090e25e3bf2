"""Flow control as data: rate schedules, run lengths, breaker, throttle, back-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def rate_schedule(calls: DataFrame, interval: int, keys: list[str] | None = None, arrival: str = "arrival", order: str | None = None) -> DataFrame:
    """Adds the start of each call when starts are at least ``interval`` apart.

    ``start_k = k * I + max over j <= k of (arrival_j - j * I)``: a running
    maximum instead of a loop.  Times are integers (micro- or milliseconds).
    """
    by = Window.partitionBy(*(keys or [])).orderBy(order or arrival)
    k = (F.row_number().over(by) - 1).cast("long")
    slack = calls.withColumn("_k", k).withColumn("_slack", F.col(arrival) - F.col("_k") * interval)
    start = F.col("_k") * interval + F.max("_slack").over(by.rowsBetween(Window.unboundedPreceding, 0))
    return slack.withColumn("start", start).withColumn("delay", F.col("start") - F.col(arrival)).drop("_k", "_slack")


def failure_runs(calls: DataFrame, keys: list[str], order: str, failed: Column) -> DataFrame:
    """(keys, run_start, run_length) of each run of failures (gaps and islands)."""
    by = Window.partitionBy(*keys).orderBy(order)
    marked = calls.withColumn("_f", failed.cast("int")).withColumn("_n", F.row_number().over(by) - F.sum("_f").over(by))
    return marked.where("_f = 1").groupBy(*keys, "_n").agg(F.min(order).alias("run_start"), F.count("*").alias("run_length")).drop("_n")


def _folded(items: Column, begin: list[Column], step, kind: str) -> Column:
    """Array with a value for each item, from a state that is carried through them in order.

    ``begin`` are the fields of the first state and ``step(state, item)`` gives
    (fields of the next state, value).  Values are gathered in blocks of about
    the cube root of the number of items, since appending copies an array: n
    items cost some n ** (4 / 3) copies.
    """
    block = F.greatest(F.lit(1), F.ceil(F.cbrt(F.size(items)))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), ((F.size(items) - 1) / block).cast("int")), lambda b: F.slice(items, b * block + 1, block))
    names = [f"s{i}" for i in range(len(begin))]
    state = lambda fields, values: F.struct(*[f.alias(n) for f, n in zip(fields, names, strict=True)], values.alias("values"))

    def one(s: Column, item: Column) -> Column:
        fields, value = step([s[n] for n in names], item)
        return state(fields, F.concat(s["values"], F.array(value)))

    def many(s: Column, part: Column) -> Column:
        fresh = state([s[n] for n in names], F.array().cast(f"array<{kind}>"))
        return F.aggregate(part, fresh, one, lambda r: state([r[n] for n in names], F.concat(s["values"], F.array(r["values"]))))

    return F.aggregate(blocks, state(begin, F.array().cast(f"array<array<{kind}>>")), many, lambda s: F.flatten(s["values"]))


def breaker(calls: DataFrame, keys: list[str], order: list[str], at: str, failed: str, threshold: int, open_for: int) -> DataFrame:
    """Adds ``outcome``: success, failed or rejected, by a circuit breaker for each key.

    A failed call counts once; ``threshold`` failures in a row open the
    breaker for ``open_for``; a success resets the count; after the open time
    the count stands, so one more failure opens it again; rejected calls
    change nothing.  Calls of one client are folded in order inside the JVM;
    a client's calls must fit one row.
    """
    item = F.struct(*order, F.col(at).cast("long").alias("_at"), F.col(failed).alias("_failed"))
    listed = calls.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_calls"))

    def step(state: list[Column], c: Column) -> tuple[list[Column], Column]:
        count, until = state
        shut = until.isNotNull() & (c["_at"] < until)
        failures = F.when(shut, count).when(c["_failed"], count + 1).otherwise(F.lit(0).cast("long"))
        opened = F.when(shut, until).when(c["_failed"] & (failures >= threshold), c["_at"] + F.lit(open_for).cast("long")).when(~c["_failed"], F.lit(None).cast("long")).otherwise(until)
        return [failures, opened], F.when(shut, "rejected").when(c["_failed"], "failed").otherwise("success")

    folded = listed.withColumn("_out", _folded(F.col("_calls"), [F.lit(0).cast("long"), F.lit(None).cast("long")], step, "string"))
    zipped = folded.select(*keys, F.explode(F.arrays_zip("_calls", "_out")).alias("z"))
    return zipped.select(*keys, *[F.col(f"z._calls.{o}").alias(o) for o in order], F.col("z._out").alias("outcome"))


def throttle(progress: DataFrame, keys: list[str], order: str, at: str, total: str, every: int, seconds: int) -> DataFrame:
    """Adds ``emit``: is a notice sent for this step?

    Sent for the first count 0, the last, every ``every``-th, or ``seconds``
    after the last one sent (the first step counts as long after).
    """
    item = F.struct(F.col(order).cast("long").alias("n"), F.col(at).cast("long").alias("at"), F.col(total).cast("long").alias("total"))
    listed = progress.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_steps"))

    def step(state: list[Column], c: Column) -> tuple[list[Column], Column]:
        (last,) = state
        emit = (c["n"] == 0) | (c["n"] == c["total"]) | (c["n"] % every == 0) | last.isNull() | (c["at"] - last >= seconds)
        return [F.when(emit, c["at"]).otherwise(last)], emit

    folded = listed.withColumn("_out", _folded(F.col("_steps"), [F.lit(None).cast("long")], step, "boolean"))
    return folded.select(*keys, F.explode(F.arrays_zip("_steps", "_out")).alias("z")).select(*keys, F.col("z._steps.n").alias(order), F.col("z._steps.at").alias(at), F.col("z._steps.total").alias(total), F.col("z._out").alias("emit"))


def backoff(base: float, attempts: int) -> Column:
    """Array of (attempt, wait, waited in all) for failed attempts: base, 2 base, 4 base ..."""
    return F.transform(F.sequence(F.lit(0), F.lit(attempts - 1)), lambda a: F.struct((a + 1).alias("attempt"), (F.lit(base) * F.pow(F.lit(2.0), a)).alias("wait_s"), (F.lit(base) * (F.pow(F.lit(2.0), a + 1) - 1)).alias("waited_s")))


def error_class(message: Column) -> Column:
    """Kind of an error message: rate, timeout, breaker or other."""
    low = F.lower(message)
    return F.when(message.isNull(), F.lit(None)).when(F.contains(low, F.lit("rate")), "rate_limit").when(F.contains(low, F.lit("timeout")) | F.contains(low, F.lit("timed out")), "timeout").when(F.contains(low, F.lit("circuit")), "breaker").otherwise("error")
