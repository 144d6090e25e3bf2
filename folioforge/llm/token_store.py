"""Token ids in ORC files.

One row a document: doc_id, first (ids of all documents before it in its
file), n_tokens and the ids.  Files are written in rising doc_id order with
integer run-length encoding, row indexes every 1,000 rows and a Bloom filter
on doc_id, so readers split them by stripe and skip stripes and row groups by
metadata.

Texts are encoded in the scan and only packed ids are shuffled, once, straight
to the file that owns their range of ids.  The ranges come from the id column
alone.  Global starts need only one total for each file.

Defined cases: a null text counts as empty and gives the end id alone; rows
with equal ids stay separate rows, ordered by a digest of their ids, over which
an id with many rows is spread to several files; a null id comes first; an empty
table gives an empty result; a very long text is encoded in pieces (see
``bpe``) and is one row; other columns are not read, so their names may clash.
Ids are integers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import id_lists, slices, tokenizer
from .common import cut, scratch, settings, spread

END_ID = 2
#: UTF-8 bytes of text of a file.
FILE_BYTES = 32 << 20
#: Ids that are gathered for each file's range; the bounds alone are broadcast, 8 bytes a file.
KEYS = 64
_LEAST = -(2**63)
ORC = {"compression": "zstd", "orc.stripe.size": str(8 << 20), "orc.rows.between.memory.checks": "64", "orc.row.index.stride": "1000", "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}
#: Rows that ORC and Arrow hold at a time, writing and reading: a row may have a hundred thousand ids.
ROWS = {"spark.sql.orc.columnarWriterBatchSize": "64", "spark.sql.orc.columnarReaderBatchSize": "256", "spark.sql.execution.arrow.maxRecordsPerBatch": "512"}


def range_bounds(docs: DataFrame, id_column: str, text_column: str, file_bytes: int) -> np.ndarray:
    """Ids at which a new file begins: about ``file_bytes`` of text a file.

    Where the files begin depends on a sample of ids; what is read back does not.
    """
    counts = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(text_column).cast("long")).alias("b")).first()
    files = spread(counts["b"] or 0, file_bytes)
    keys = docs.select(F.coalesce(F.col(id_column).cast("bigint"), F.lit(_LEAST)).alias("k"))
    wanted = files * KEYS
    if files > 1 and counts["n"] > 2 * wanted:
        keys = keys.sample(2 * wanted / counts["n"], seed=1)
    found = np.sort(keys.toArrow()["k"].to_numpy()) if files > 1 else np.zeros(0, np.int64)
    return found[np.arange(1, files) * len(found) // files] if len(found) else found


def _file_of(ids: np.ndarray, ties: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """File of each row; an id that is the bound of several files is spread by its tie, in its order."""
    low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    share = (ties.astype(np.float64) + 2.0**63) / 2.0**64
    return np.minimum(low + (share * (high - low + 1)).astype(np.int64), high).astype(np.int32)


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_column: str = "doc_id", text_column: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> str:
    """Write the token files of a document table; returns their folder."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    held = range_bounds(docs, id_column, text_column, file_bytes)
    bounds = spark.sparkContext.broadcast(held)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = tokenizer(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for part in slices(batches):
            packed = [p + end for p in bpe.encode_batch(part.column(1).to_pylist())]
            ids = part.column(0).fill_null(_LEAST).to_numpy(zero_copy_only=False)
            ties = np.frombuffer(b"".join(blake2b(p, digest_size=8).digest() for p in packed), "<i8")
            small = [np.frombuffer(p, "<u4").astype("<u2").tobytes() if bpe.size <= 1 << 16 else p for p in packed]
            yield pa.RecordBatch.from_arrays([pa.array(_file_of(ids, ties, bounds.value)), part.column(0), pa.array(ties), pa.array(small, pa.binary())], names=["file", "doc_id", "tie", "packed"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small, before = tokenizer(tokenizer_path).size <= 1 << 16, 0
        for part in slices(batches, 1):
            packed = [np.frombuffer(p, "<u2").astype("<u4").tobytes() if small else p for p in part.column(1).to_pylist()]
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            stops = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(stops - sizes), pa.array(sizes), id_lists(packed)], names=["doc_id", "first", "n_tokens", "ids"])
            before = int(stops[-1])

    encoded = plain.mapInArrow(encode, "file int, doc_id bigint, tie bigint, packed binary")
    ordered = encoded.repartitionById(len(held) + 1, "file").sortWithinPartitions("doc_id", "tie").select("doc_id", "packed")
    with settings(spark, ROWS):
        ordered.mapInArrow(number, "doc_id bigint, first bigint, n_tokens bigint, ids array<int>").write.options(**ORC).orc(folder)
    return folder


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): start counts the ids of all documents before, over all files."""
    rows = spark.read.schema("doc_id bigint, first bigint, n_tokens bigint, ids array<int>").orc(folder).withColumn("file", F.col("_metadata.file_name"))
    # One row a file; the totals need no ids (column pruning).  Files are numbered in the order of their ranges.
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.regexp_extract("file", r"^part-(\d+)", 1).cast("int").alias("number"))
    before = totals.select("file", F.coalesce(F.sum("total").over(Window.orderBy("number", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    # Written down, so that Spark sees its size and broadcasts it only if it is small.
    return rows.join(cut(before, "bases"), "file").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")


def ids_crc32(ids):
    """Unsigned crc32 of an id array as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("bigint")
    def crc(column):
        return column.map(lambda x: zlib.crc32(np.asarray(x, "<u4").tobytes()) if x is not None else 0)

    return crc(ids)
