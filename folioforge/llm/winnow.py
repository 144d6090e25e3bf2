"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item (an item with
fewer words is one window).  Both sides are fingerprinted by winnowing: of
every ``SPAN`` neighbouring k-gram hashes the smallest is kept, with
``K + SPAN - 1 == WINDOW``, so any shared run of a window's length shares a
fingerprint.  Document fingerprints are matched with the benchmark's through a
bitmap of fixed size, hits are extended to the longest runs of candidate
windows, and the distinct runs are joined with the benchmark's windows on
their words, which makes the result exact.

Nothing is broadcast but the two bitmaps, whose size follows the benchmark's
number of windows between 2 and 32 MB each; with more than 30 million windows
they only pass more candidates.  A passage that many documents share becomes one run, which
is looked up once; the join back to the documents is an ordinary shuffle join
whose hot keys Spark splits.

Defined cases: a null or wordless text has no words, hits or items; a null
item id is ignored; repeated document rows give repeated result rows; repeated
items count once; an empty benchmark leaves every document clean, and an empty
table gives an empty result; a very long text is hashed alone, in memory of some
50 times its size; other columns are not read, so their names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut
from .textkernel import ALNUM_LOWER, LOWER, U64, Poly, Words, chunks

WINDOW = 10
K = 5
SPAN = WINDOW - K + 1
#: Bits of a bitmap's positions, at least and at most, and bits of a bitmap for each window.
BITS, MOST_BITS, BITS_EACH = 24, 28, 8
_POLY, _GRAM = Poly(11), Poly(12)


def _salted(grams: np.ndarray, kind: int) -> np.ndarray:
    """Hashes whose high bits are positions in a bitmap; kind tells apart k-grams, windows and short items."""
    return grams * U64(2 * kind + 1) + U64(kind)


def _words(buf: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(LOWER[buf], offsets, ALNUM_LOWER, _POLY)


def _winnow(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints (the last smallest of each span)."""
    grams = words.grams(K, _GRAM)
    spans = words.whole(WINDOW)
    if not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    view = np.lib.stride_tricks.sliding_window_view(grams, SPAN)[spans]
    at = np.unique(spans + (SPAN - 1 - view[:, ::-1].argmin(axis=1)))
    return at, grams[at]


def _join_words(words: Words, start: int, n: int) -> str:
    data = words.buf
    return b" ".join([data[a:b].tobytes() for a, b in zip(words.starts[start : start + n], words.ends[start : start + n], strict=True)]).decode("utf-8", "replace")


def item_windows(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, n, phrase, words): every window of every item; the hashes of its fingerprints and its own."""
    kind = benchmark.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, buf, offsets in chunks(batches, [id_column, text_column]):
            words = _words(buf, offsets)
            marks, _ = _winnow(words)
            chosen, grams = set(marks.tolist()), words.grams(K, _GRAM)
            out = {"item": [], "n": [], "phrase": [], "gram_hashes": [], "window_hash": []}
            for i, item in enumerate(ids.to_pylist()):
                lo, hi = int(words.bounds[i]), int(words.bounds[i + 1])
                n = min(WINDOW, hi - lo)
                if not n or item is None:
                    continue
                whole = words.grams(n, _GRAM)
                for s in range(lo, hi - n + 1):
                    own = [g for g in range(s, s + SPAN) if g in chosen] if n == WINDOW else []
                    out["item"].append(item)
                    out["n"].append(n)
                    out["phrase"].append(_join_words(words, s, n))
                    out["gram_hashes"].append(_salted(grams[own], 0).view(np.int64).tolist() if own else [])
                    out["window_hash"].append(int(_salted(whole[s : s + 1], n).view(np.int64)[0]))
            yield pa.RecordBatch.from_arrays([pa.array(out["item"], ids.type), pa.array(out["n"], pa.int32()), pa.array(out["phrase"], pa.string()), pa.array(out["gram_hashes"], pa.list_(pa.int64())), pa.array(out["window_hash"], pa.int64())], names=list(out))

    return benchmark.select(id_column, text_column).mapInArrow(run, f"item {kind}, n int, phrase string, gram_hashes array<bigint>, window_hash bigint")


def bits_for(windows: int) -> int:
    """Bits of a position in bitmaps for so many windows."""
    return min(MOST_BITS, max(BITS, (BITS_EACH * windows).bit_length()))


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of ``2**bits`` bits from a column of hashes; at most ``2**(bits - 6)`` rows reach the driver, as Arrow."""
    bit = hashes.select(F.shiftrightunsigned("hash", 64 - bits).alias("bit"))
    rows = bit.select(F.shiftright("bit", 6).alias("at"), F.expr("shiftleft(1L, CAST(bit & 63 AS INT))").alias("b")).groupBy("at").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), U64)
    out[rows["at"].to_numpy()] = rows["b"].to_numpy().astype(np.int64).view(U64)
    return out


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = hashes >> U64(64 - (len(bitmap) * 64).bit_length() + 1)
    return (bitmap[(bits >> U64(6)).astype(np.int64)] >> (bits & U64(63))) & U64(1) == 1


def _runs(starts: np.ndarray, words: Words, n: int) -> list[tuple[int, int]]:
    """First and last of each run of neighbouring window starts in one text."""
    if not len(starts):
        return []
    fresh = np.flatnonzero((np.diff(starts) > 1) | (np.diff(words.text_of(starts)) > 0)) + 1
    edges = [0, *fresh.tolist(), len(starts)]
    return [(int(starts[a]), int(starts[b - 1])) for a, b in zip(edges, edges[1:], strict=False)]


def candidate_runs(docs: DataFrame, gram_map: np.ndarray, window_map: np.ndarray, short: list[int], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, runs array<struct<start, n, phrase>>): one row for each document."""
    kind = docs.schema[id_column].dataType.simpleString()
    spark = docs.sparkSession
    maps = spark.sparkContext.broadcast((gram_map, window_map))
    run_type = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("phrase", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram_map, window_map = maps.value
        for ids, buf, offsets in chunks(batches, [id_column, text_column]):
            words = _words(buf, offsets)
            found: list[list[dict]] = [[] for _ in range(len(ids))]
            at, grams = _winnow(words)
            near = at[_has(gram_map, _salted(grams, 0))]
            # Extend: the windows around a matched fingerprint, then runs of those.
            near = np.unique((near[:, None] - np.arange(SPAN)[None, :]).ravel()) if len(near) else near
            kinds = [(WINDOW, np.intersect1d(near, words.whole(WINDOW), assume_unique=True))]
            kinds += [(n, words.whole(n)) for n in short]
            for n, starts in kinds:
                if len(starts):
                    starts = starts[_has(window_map, _salted(words.grams(n, _GRAM)[starts], n))]
                for first, last in _runs(starts, words, n):
                    doc = int(words.text_of(np.array([first]))[0])
                    found[doc].append({"start": first - int(words.bounds[doc]), "n": n, "phrase": _join_words(words, first, last - first + n)})
            yield pa.RecordBatch.from_arrays([ids, pa.array(words.counts, pa.int64()), pa.array(found, run_type)], names=[id_column, "n_words", "runs"])

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, n_words bigint, runs array<struct<start:int,n:int,phrase:string>>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, n_hit, items array<string>, hits array<struct<first,stop>>) of every document row."""
    bench = cut(item_windows(benchmark), "windows")
    bits = bits_for(bench.count())
    gram_map = _bitmap(bench.select(F.explode("gram_hashes").alias("hash")), bits)
    window_map = _bitmap(bench.select(F.col("window_hash").alias("hash")), bits)
    short = sorted(r["n"] for r in bench.where(F.col("n") < WINDOW).select("n").distinct().collect())

    found = cut(candidate_runs(docs, gram_map, window_map, short, id_column, text_column).withColumn("_row", F.monotonically_increasing_id()), "runs")
    runs = found.where(F.size("runs") > 0).select("_row", F.explode("runs").alias("r")).select("_row", "r.start", "r.n", "r.phrase")
    phrases = runs.select("n", "phrase").distinct()
    # Windows of each distinct run, looked up by their words.
    parts = phrases.withColumn("w", F.split("phrase", " ")).select("n", "phrase", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("n"))).alias("at"))
    parts = parts.select("n", F.col("phrase").alias("run"), "at", F.array_join(F.slice("w", F.col("at") + 1, F.col("n")), " ").alias("phrase"))
    windows = bench.select("n", "phrase", F.col("item").cast("string").alias("item")).distinct()
    known = parts.join(windows, ["n", "phrase"]).groupBy("n", "run").agg(F.collect_set("at").alias("ats"), F.collect_set("item").alias("items"))
    hits = (
        runs.join(known.withColumnRenamed("run", "phrase"), ["n", "phrase"])
        .select("_row", "items", F.transform("ats", lambda a: F.struct((F.col("start") + a).alias("first"), (F.col("start") + a + F.col("n")).alias("stop"))).alias("spans"))
        .groupBy("_row")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("hits"))
    )
    covered = F.aggregate("hits", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda a, h: F.struct((a["n"] + F.greatest(F.lit(0), h["stop"] - F.greatest(h["first"], a["to"]))).alias("n"), F.greatest(a["to"], h["stop"]).alias("to")))["n"]
    out = found.select("_row", id_column, "n_words").join(hits, "_row", "left")
    return out.select(id_column, "n_words", F.coalesce(covered.cast("long"), F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("hits", F.array().cast("array<struct<first:int,stop:int>>")).alias("hits"))
