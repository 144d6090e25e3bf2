"""Commands as streams: newest command, waiting for a reply, throttled notices."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources import mailbox


def latest(commands: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest command of each key; for output mode ``complete`` or ``update``."""
    rest = [c for c in commands.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return commands.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def wait_for_reply(commands: DataFrame, key: str, time: str, t0: float, timeout: float, expected: list[str] | None = None) -> DataFrame:
    """(key, action, replied): the first accepted command after ``t0`` within the timeout.

    ``time`` is event time in seconds.  State for a key is one flag: a key that
    has answered stays silent.  There is no processing-time timer, which would
    keep a drained query running for ever.  ``newest_reply`` lets a newer
    unexpected command hide an earlier expected one, as a look into the mailbox does.
    """

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames))
        if state.exists:
            return
        rows = rows[(rows[time] > t0) & (rows[time] < t0 + timeout)]
        if expected is not None:
            rows = rows[rows["action"].isin(expected)]
        if len(rows):
            hit = rows.sort_values(time).iloc[0]
            state.update((True,))
            yield pd.DataFrame({key: [k[0]], "action": [hit["action"]], "replied": [float(hit[time])]})

    kind = commands.schema[key].dataType.simpleString()
    return commands.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, action string, replied double", "answered boolean", "append", GroupStateTimeout.NoTimeout)


def newest_reply(commands: DataFrame, key: str, time: str, t0: float, timeout: float, expected: list[str] | None = None) -> DataFrame:
    """(key, action, replied): the reply after ``t0`` within the timeout; a key that has answered stays silent.

    A batch is a look into the mailbox: only the newest command so far counts,
    so an unexpected one hides earlier ones, and a later expected one still
    answers.  ``time`` is event time in seconds.  State for a key is a flag and
    the time of its newest command.  There is no processing-time timer, which
    would keep a drained query running for ever.
    """

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames))
        answered, newest = state.get if state.exists else (False, float("-inf"))
        rows = rows[(rows[time] > t0) & (rows[time] < t0 + timeout) & (rows[time] > newest)]
        if answered or not len(rows):
            return
        last = rows.sort_values(time, kind="stable").iloc[-1]
        answered = expected is None or last["action"] in expected
        state.update((bool(answered), float(last[time])))
        if answered:
            yield pd.DataFrame({key: [k[0]], "action": [last["action"]], "replied": [float(last[time])]})

    kind = commands.schema[key].dataType.simpleString()
    return commands.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, action string, replied double", "answered boolean, newest double", "append", GroupStateTimeout.NoTimeout)


def throttle(steps: DataFrame, key: str, every: int, seconds: float) -> DataFrame:
    """steps (key, current, total, at) to those a notice is sent for; state is the time of the last one."""

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for r in pd.concat(list(frames)).sort_values(["current", "at"]).itertuples(index=False):
            if r.current == 0 or r.current == r.total or r.current % every == 0 or last is None or r.at - last >= seconds:
                last = float(r.at)
                out.append((k[0], int(r.current), int(r.total), float(r.at)))
        if last is not None:
            state.update((last,))
        if out:
            yield pd.DataFrame(out, columns=[key, "current", "total", "at"])

    kind = steps.schema[key].dataType.simpleString()
    return steps.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, current bigint, total bigint, at double", "last double", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, checkpoint: str, path: str, mode: str = "append", each=None) -> None:
    """Process all that is there into Parquet (append) or through ``each(batch, id)``."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.foreachBatch(each) if each else writer.format("parquet").option("path", path)).start()
    query.awaitTermination()


class Listener:
    """Takes chat events from a stream into the mailbox; starting twice and stopping twice do nothing."""

    def __init__(self, events: DataFrame, folder: str, checkpoint: str):
        self.events, self.folder, self.checkpoint, self.query = events, folder, checkpoint, None

    @property
    def running(self) -> bool:
        return self.query is not None and self.query.isActive

    def start(self) -> bool:
        if not self.running:
            commands = mailbox.from_events(self.events)
            self.query = commands.writeStream.outputMode("append").option("checkpointLocation", self.checkpoint).foreachBatch(lambda batch, _: mailbox.append(batch, self.folder)).start()
        return self.running

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()
            self.query = None
