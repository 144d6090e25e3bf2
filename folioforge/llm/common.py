"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import math
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see.

    Taken from ``spark.checkpoint.dir``.  Only where that is unset and the
    master is local (a test session, one machine) a temporary folder is made and
    remembered in the session; on a cluster it is an error.
    """
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("folioforge.shared.dir", None)
    if not place:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        place = tempfile.mkdtemp(prefix="folioforge-")
        spark.conf.set("folioforge.shared.dir", place)
    return place.rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark resolves it to, so that other libraries mean the same place."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


#: Scratch paths of this driver that have not been dropped.
_made: list[str] = []


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder."""
    _made.append(f"{shared_dir(spark)}/folioforge/{what}-{uuid.uuid4().hex}")
    return _made[-1]


def release(spark: SparkSession) -> int:
    """Delete this driver's scratch tables; call it once results that read them are written."""
    n = len(_made)
    for path in list(_made):
        drop_path(spark, path)
    return n


def cut_at(df: DataFrame, what: str = "cut") -> tuple[DataFrame, str]:
    """Write ``df`` as a table in the shared folder; the table read back, and its path.

    Unlike ``checkpoint()`` this runs the plan once; the copy survives lost
    executors because it is in the shared folder.
    """
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, what: str = "cut") -> DataFrame:
    """``cut_at`` without the path."""
    return cut_at(df, what)[0]


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Hadoop's file systems."""
    if path in _made:
        _made.remove(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold while an action runs."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column (one column-pruned aggregate)."""
    return int(docs.agg(F.sum(F.octet_length(column).cast("long")).alias("b")).first()["b"] or 0)


def spread(total_bytes: int, per_part: int, least: int = 1) -> int:
    """Number of parts so that each holds about ``per_part`` bytes; grows with the input."""
    return max(least, math.ceil(total_bytes / per_part))


def is_held_out(doc_id):
    """True where crc32 of the id as text is divisible by 5: such rows are never learnt from."""
    return (F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5) == 0


def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each value of the first column in a task; a training sample bounds the values."""
    seen: set = set()
    for batch in batches:
        fresh = [v not in seen and not seen.add(v) for v in batch.column(0).to_pylist()]
        if any(fresh):
            yield batch.filter(pa.array(fresh))


#: Bytes of text that a training sample holds at most; a documented bound, as is the number of its documents.
SAMPLE_BYTES = 128 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label_column: str, most: int, id_column: str = "doc_id", text_column: str = "text", most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(id, text, label) of at most ``most`` labelled documents that are not held out, one row an id.

    Both bounds are documented parameters, so the chosen ids may be broadcast.
    The order in which documents are chosen depends on their ids alone; the
    first ones whose texts fit ``most_bytes`` are taken.  A document with
    several labels has the largest, one with several texts that of the smallest
    hash; null labels and ids take no part.  Rows of one id come to one task,
    where ``first_of_each`` leaves one of them.
    """
    usable = labels.where(F.col(label_column).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out("doc_id"))
    chosen = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max(label_column).cast("int").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    own = plain.select("id", F.struct(F.xxhash64("text").alias("print"), F.octet_length("text").cast("long").alias("size")).alias("own"))
    # At most ``most`` rows of some bytes from here to the join.
    sized = own.join(F.broadcast(chosen), F.col("id") == F.col("_id")).groupBy("_id", "label").agg(F.min("own").alias("own"))
    before = F.sum("own.size").over(Window.orderBy(F.xxhash64("_id"), "_id"))
    fitting = sized.withColumn("total", before).where(F.col("total") <= most_bytes).select("_id", "label", F.col("own.print").alias("print"))
    found = plain.join(F.broadcast(fitting), (F.col("id") == F.col("_id")) & (F.xxhash64("text") == F.col("print"))).select("id", "text", "label")
    # Repeated rows go in the scan, then those of several tasks; no sort of texts.
    return found.mapInArrow(first_of_each, found.schema).repartition("id")


def with_decision(scored: DataFrame, id_column: str, threshold: float) -> DataFrame:
    """Adds held_out, and predicted = 1 where the score reaches the threshold."""
    return scored.select(id_column, is_held_out(id_column).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
