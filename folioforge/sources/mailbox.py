"""Command mailbox: one JSON row a command, appended to a folder."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .progress import _fs

SCHEMA = "action string, value string, time double, open_id string, user_id string"


def append(commands: DataFrame, folder: str) -> None:
    """Add commands; files get unique names, so commands of one millisecond stay apart."""
    commands.write.mode("append").json(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All commands with the time their file was written."""
    return spark.read.schema(SCHEMA).json(folder).withColumn("written", F.col("_metadata.file_modification_time"))


def stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream."""
    return spark.readStream.schema(SCHEMA).json(folder)


def from_events(events: DataFrame) -> DataFrame:
    """Commands from chat events (kind, content, action, label, open_id, user_id, time).

    A card event carries its action; a text message is classified by its
    words, and dropped when it is empty.
    """
    from ..functions import notices as N

    text = N.message_text(F.col("content"))
    is_card = F.col("kind") == "card"
    action = F.when(is_card, N.action_or_default(F.col("action"))).otherwise(N.classify(text))
    value = F.when(is_card, N.label_or_action(F.col("label"), F.col("action"))).otherwise(text)
    return events.where(is_card | ((F.col("kind") == "text") & (text != ""))).select(action.alias("action"), value.alias("value"), "time", F.coalesce("open_id", F.lit("")).alias("open_id"), F.coalesce("user_id", F.lit("")).alias("user_id"))


def newest(spark: SparkSession, folder: str, after: float | None = None) -> dict | None:
    """The newest command by the time its file was written, if it came after ``after``."""
    try:
        row = read(spark, folder).orderBy(F.desc("written"), F.desc("time")).limit(1).first()
    except AnalysisException:  # no folder yet
        return None
    return row.asDict() if row is not None and (not after or row["time"] > after) else None


def retain(spark: SparkSession, folder: str, keep: int = 10) -> int:
    """Delete all but the newest ``keep`` command files (none for 0); the number deleted."""
    fs, path = _fs(spark, folder)
    if not keep or not fs.exists(path):
        return 0
    files = sorted((s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(path) if s.getPath().getName().endswith(".json"))
    for _, name in files[:-keep]:
        fs.delete(_fs(spark, f"{folder}/{name}")[1], False)
    return max(0, len(files) - keep)


def wait_for_reply(spark: SparkSession, folder: str, timeout: float = 300.0, poll: float = 2.0, expected: list[str] | None = None, clock=time.time, sleep=time.sleep) -> dict | None:
    """Wait for a command that comes after this call; None when the time is over."""
    began = clock()
    while clock() - began < timeout:
        command = newest(spark, folder, began)
        if command is not None and (expected is None or command["action"] in expected):
            retain(spark, folder)
            return command
        sleep(poll)
    return None


# Fixed values --------------------------------------------------------------
DEFAULT_BUTTONS = [("确认全量执行", "confirm"), ("修改后重试", "retry"), ("取消任务", "cancel")]
# ---------------------------------------------------------------------------


def send_and_wait(spark: SparkSession, notifier, title: str, lines: list[str], folder: str, buttons: list[tuple[str, str]] | None = None, timeout: float = 300.0, expected: list[str] | None = None, **waiting) -> dict | None:
    """Send a card with buttons, then wait for the reply."""
    from ..functions import notices as N

    elements = F.array(*[F.struct(F.lit("markdown").alias("tag"), F.lit(x).alias("content")) for x in lines]) if lines else F.array().cast("array<struct<tag:string,content:string>>")
    card = F.to_json(F.struct(F.lit(title).alias("title"), elements.alias("elements"), N.buttons(buttons or DEFAULT_BUTTONS).alias("actions")))
    notifier.send(spark.range(1).select(card.alias("c")).first()["c"])
    return wait_for_reply(spark, folder, timeout, expected=expected, **waiting)
