"""Sinks: markdown files, notifications, project folders."""

from __future__ import annotations

import json
import os
import shutil
import time
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text as T
from . import config as C
from .scratch import file_system, qualified

# Fixed values --------------------------------------------------------------
SUB_FOLDERS = ("输入", "脚本", "测试", "输出", "日志")
# ---------------------------------------------------------------------------


def with_content(results: DataFrame) -> DataFrame:
    """Adds the text of each output file from content, titles, title_line and kind."""
    return results.withColumn("body", F.when(F.col("kind") == "titles", T.title_list("titles")).when(F.col("kind") == "titled", F.concat("title_line", F.lit("\n"), "content")).otherwise(F.col("content")))


OUTPUTS = "task_id string, file string, body string, chars int"


def load_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """The product of the runs so far; none gives an empty table."""
    fs, path = file_system(spark, folder)
    new = file_system(spark, f"{folder}.new")[1]
    # A run that ended between writing the new table and taking the old one's place.
    if not fs.exists(path) and fs.exists(file_system(spark, f"{folder}.new/_SUCCESS")[1]):
        fs.rename(new, path)
    return spark.read.schema(OUTPUTS).parquet(folder) if fs.exists(path) else spark.createDataFrame([], OUTPUTS)


def write_outputs(outputs: DataFrame, folder: str) -> None:
    """The product: a Parquet table (task_id, file, body, chars) with one row a task; a new row wins.

    The new table is written whole beside the old one and then takes its place.
    """
    spark = outputs.sparkSession
    fresh = outputs.select("task_id", "file", "body", F.length("body").alias("chars"))
    kept = load_outputs(spark, folder).join(fresh.select("task_id"), "task_id", "left_anti")
    kept.select(fresh.columns).union(fresh).write.mode("overwrite").parquet(f"{folder}.new")
    fs, path = file_system(spark, folder)
    fs.delete(path, True)
    fs.rename(file_system(spark, f"{folder}.new")[1], path)


def export_markdown(outputs: DataFrame, folder: str) -> DataFrame:
    """Optional: one file a row, written by the executors to a shared folder; (file, chars) of each.

    A file is written under another name and renamed, so a repeated task
    leaves whole files only.
    """

    place = qualified(outputs.sparkSession, folder)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = (pyarrow.fs.LocalFileSystem(), "/" + place.removeprefix("file:").lstrip("/")) if place.startswith("file:") else pyarrow.fs.FileSystem.from_uri(place)
        for frame in frames:
            fs.create_dir(root, recursive=True)
            for name, body in zip(frame["file"], frame["body"], strict=True):
                part = f"{root}/.{name}.{time.time_ns()}"
                with fs.open_output_stream(part) as s:
                    s.write(body.encode())
                fs.move(part, f"{root}/{name}")
            yield pd.DataFrame({"file": frame["file"], "chars": frame["body"].str.len().astype("int64")})

    return outputs.select("file", "body").mapInPandas(run, "file string, chars bigint")


class Notifier(Protocol):
    def send(self, card: str) -> bool: ...


@dataclass
class LogNotifier:
    """Keeps the cards; for tests and dry runs."""

    cards: list[str] = field(default_factory=list)

    def send(self, card: str) -> bool:
        self.cards.append(card)
        return True


@dataclass
class HttpNotifier:
    """Posts cards to a chat service; spaced, with a cached token; never raises."""

    url: str
    token_url: str = ""
    credentials: dict = field(default_factory=dict)
    spacing: float = 0.25
    timeout: float = 10.0
    early: float = 60.0
    _token: str = ""
    _until: float = 0.0
    _last: float = float("-inf")

    def _post(self, url: str, body: bytes, headers: dict) -> dict:
        with urllib.request.urlopen(urllib.request.Request(url, body, {"Content-Type": "application/json", **headers}), timeout=self.timeout) as answer:
            return json.loads(answer.read() or b"{}")

    def token(self) -> str:
        if self.token_url and time.time() >= self._until - self.early:
            got = self._post(self.token_url, json.dumps(self.credentials).encode(), {})
            self._token, self._until = got.get("token", ""), time.time() + float(got.get("expire", 0))
        return self._token

    def send(self, card: str) -> bool:
        try:
            wait = self._last + self.spacing - time.monotonic()
            if wait > 0:
                time.sleep(wait)
            self._last = time.monotonic()
            token = self.token()
            self._post(self.url, card.encode(), {"Authorization": f"Bearer {token}"} if token else {})
            return True
        except Exception:  # noqa: BLE001  a notice must not stop a run
            return False


def send_all(cards: DataFrame, notifier: Notifier, column: str = "card") -> int:
    """Send the cards of a small table in order from the driver; the number that arrived."""
    return sum(notifier.send(r[column]) for r in cards.select(column).toLocalIterator())


def scaffold(folder: str, name: str = "") -> dict[str, str]:
    """Make a project's folders."""
    root = os.path.join(folder, name) if name else folder
    out = {"root": root}
    for sub in SUB_FOLDERS:
        out[sub] = os.path.join(root, sub)
        os.makedirs(out[sub], exist_ok=True)
    return out


def placed_names(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, name): target names; later holders of a name get ``_1``, ``_2``."""
    df = spark.createDataFrame(list(enumerate(files)), "ord int, file string").withColumn("name", T.base_name("file"))
    n = F.row_number().over(Window.partitionBy("name").orderBy("ord")) - 1
    return df.withColumn("_n", n).withColumn("name", F.when(F.col("_n") > 0, F.concat(T.file_stem("name"), F.lit("_"), F.col("_n").cast("string"), T.extension("name"))).otherwise(F.col("name"))).drop("_n")


def place_inputs(spark: SparkSession, folders: dict[str, str], files: list[str], sub: str = SUB_FOLDERS[0]) -> list[str]:
    """Copy the files that exist into a project folder."""
    there = [f for f in files if isinstance(f, str) and os.path.exists(f)]
    out = []
    for r in placed_names(spark, there).orderBy("ord").collect() if there else []:
        target = os.path.join(folders[sub], r["name"])
        shutil.copy(r["file"], target)
        out.append(target)
    return out


def save_rule(folders: dict[str, str], text: str, name: str = "提取规则.md") -> str:
    path = os.path.join(folders["root"], name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def save_config(folders: dict[str, str], raw: dict, name: str = "config.json") -> str:
    """Save a configuration without its secret."""
    return save_rule(folders, json.dumps(C.from_base64(C.to_base64(raw)), ensure_ascii=False, indent=2), name)


def save_script(folders: dict[str, str], raw: dict, name: str = "run.py") -> str:
    """A small start script with the configuration in base64; the key comes from the environment."""
    body = f"from folioforge.plans.run import main_base64\n\nCONFIG = {C.to_base64(raw)!r}\n\nif __name__ == '__main__':\n    main_base64(CONFIG)\n"
    return save_rule(folders, body, name)
