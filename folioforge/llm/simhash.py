"""SimHash near-duplicate detection.

Fingerprints: 64 majority bits over the XXH64 of every 4-word shingle.
Distinct fingerprints are sorted by the population counts of their four
16-bit quarters and cut into tiles; two tiles are compared exactly (exclusive
or and bit counts in numpy) unless their population counts differ beyond the
radius, and inside a tile the same test skips blocks.  Every comparison keeps a
spanning forest of its links only, so a group of n near copies gives fewer
than n links a tile pair and no list of all pairs.  Components come from
alternating star contraction on the forests, as DataFrame joins with every
round written to the shared folder.

Defined cases: null or wordless text has fingerprint zero, linked like any
other; repeated rows and exact copies share a fingerprint and so a component;
null ids keep their row, and a component whose ids are all null has none;
an empty table gives an empty result; a very long text is hashed alone, in
memory of some 100 times its size; other columns are not read, so their names
may clash.

The comparison of all tiles is the method's quadratic part.  A tile goes to the
tiles within the radius, some two thirds of all: about 0.2 TB are shuffled for
100 million distinct fingerprints and 20 TB for a billion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import cut, cut_at, drop_path
from .textkernel import LOWER, NON_SPACE, U64, Poly, Words, chunks

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a tile, at least and at most: with more of them tiles grow, since each is copied to many.
TILE, MOST_TILE = 65_536, 262_144
_POLY = Poly(21)


def fingerprints_of(buf: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints of a run of texts."""
    words = Words(LOWER[buf], offsets, NON_SPACE, _POLY)
    n_docs = len(words.counts)
    if not len(words.starts):
        return np.zeros(n_docs, U64)
    # One space between words: keep each word and the byte after it.
    keep = NON_SPACE[words.buf]
    after = words.ends[words.ends < len(keep)]
    # A word that ends with its text has no separator of its own; it also starts no shingle that goes on.
    keep[after] = True
    kept = np.cumsum(keep) - 1
    line = words.buf[keep].copy()
    starts, stops = kept[words.starts], kept[words.ends - 1] + 1
    gaps = stops[stops < len(line)]
    gaps = gaps[~np.isin(gaps, starts)]
    line[gaps] = 0x20
    sizes = np.minimum(words.counts, shingle)
    per_doc = np.where(words.counts > 0, words.counts - sizes + 1, 0)
    lead = np.repeat(words.bounds[:-1] - (np.cumsum(per_doc) - per_doc), per_doc) + np.arange(per_doc.sum())
    tail = lead + np.repeat(sizes, per_doc) - 1
    data, digest = line.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(data[a:b], SEED) for a, b in zip(starts[lead].tolist(), stops[tail].tolist(), strict=True)], U64, len(lead))
    full = np.flatnonzero(per_doc)
    begins = (np.cumsum(per_doc) - per_doc)[full]
    counts = np.zeros((len(full), 64), np.int64)
    step = 1 << 16
    for lo in range(0, len(hashes), step):
        bits = np.unpackbits(hashes[lo : lo + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        a, b = np.searchsorted(begins, lo, side="right") - 1, np.searchsorted(begins, lo + len(bits), side="left")
        counts[a:b] += np.add.reduceat(bits, np.maximum(begins[a:b] - lo, 0), axis=0, dtype=np.int64)
    ones = (2 * counts > per_doc[full][:, None]).astype(np.uint8)
    out = np.zeros(n_docs, U64)
    out[full] = np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprint(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp bigint): the fingerprint's 64 bits of every row."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, buf, offsets in chunks(batches, [id_column, text_column], 1 << 20):
            yield pa.RecordBatch.from_arrays([ids, pa.array(fingerprints_of(buf, offsets).view(np.int64))], names=[id_column, "fp"])

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, fp bigint")


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.astype("<u8").view("<u2").reshape(-1, 4)).astype(np.int16)


class _Forest:
    """Union-find over array indices that keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def roots(self) -> np.ndarray:
        while True:
            higher = self.up[self.up]
            if np.array_equal(higher, self.up):
                return self.up
            self.up = higher

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            i, j = x, y
            while self.up[i] != i:
                i = self.up[i]
            while self.up[j] != j:
                j = self.up[j]
            if i != j:
                self.up[max(i, j)] = min(i, j)
                self.links.append((x, y))


def forest(fps: np.ndarray, half: int | None, radius: int = RADIUS) -> np.ndarray:
    """Spanning-forest links (pairs of indices) of all fingerprints within the radius.

    With ``half`` only pairs across ``fps[:half]`` and ``fps[half:]`` count.
    Both sides are ordered by quarter population counts; blocks of equal
    counts are compared unless the counts differ by more than the radius.
    """
    quarters = _quarters(fps)
    cells = quarters @ np.array([17**3, 17**2, 17, 1])
    sides = [np.arange(len(fps))] * 2 if half is None else [np.arange(half), np.arange(half, len(fps))]
    blocks = []
    for side in sides:
        order = side[np.argsort(cells[side], kind="stable")]
        edges = np.flatnonzero(np.diff(cells[order], prepend=-1, append=-1))
        blocks.append((order, edges, quarters[order[edges[:-1]]]))
    (left, cut_l, box_l), (right, cut_r, box_r) = blocks
    out = _Forest(len(fps))
    for i in range(len(box_l)):
        rows = left[cut_l[i] : cut_l[i + 1]]
        near = np.flatnonzero(np.abs(box_r - box_l[i]).sum(axis=1) <= radius)
        if half is None:
            near = near[near >= i]
        if not len(near):
            continue
        columns = np.concatenate([right[cut_r[j] : cut_r[j + 1]] for j in near])
        for lo in range(0, len(rows), 512):
            part = rows[lo : lo + 512]
            for at in range(0, len(columns), 8192):
                other = columns[at : at + 8192]
                linked = np.bitwise_count(fps[part][:, None] ^ fps[other][None, :]) <= radius
                # Each round links every row once; what is in one tree already drops out.
                while linked.any():
                    roots = out.roots()
                    linked &= roots[part][:, None] != roots[other][None, :]
                    has = np.flatnonzero(linked.any(axis=1))
                    out.join(part[has], other[linked[has].argmax(axis=1)])
    return np.array(out.links, np.int64).reshape(-1, 2)


def plan_tiles(sizes: dict[int, int], tile: int) -> dict[int, tuple[int, int]]:
    """For each population count its first tile and its number of tiles.

    A count with more than ``tile`` fingerprints gets tiles of its own; small
    neighbouring counts share one.
    """
    plan, at, held = {}, 0, 0
    for p in sorted(sizes):
        n = -(-sizes[p] // tile)
        if held and held + sizes[p] > tile:
            at, held = at + 1, 0
        plan[p] = (at, n)
        at, held = (at + n, 0) if n > 1 else (at, held + sizes[p])
    return plan


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between distinct fingerprints that span every group within the radius."""
    pop = F.bit_count("fp").cast("int")
    # One row a population count (65 at most) tells how many tiles there are.
    sizes = {r["p"]: r["n"] for r in distinct.groupBy(pop.alias("p")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return distinct.sparkSession.createDataFrame([], "a bigint, b bigint")
    plan = plan_tiles(sizes, max(tile, min(MOST_TILE, sum(sizes.values()) // 256)))
    # Population counts rise with the tile number, so a tile meets a run of tiles, which its counts (65 at most) tell.
    reach = {p: max(at + n - 1 for q, (at, n) in plan.items() if q <= p + radius) for p in plan}
    lowest = {p: min(at for q, (at, _) in plan.items() if q >= p - radius) for p in plan}
    first = F.create_map(*[F.lit(x) for p, (at, _) in plan.items() for x in (p, at)])
    count = F.create_map(*[F.lit(x) for p, (_, n) in plan.items() for x in (p, n)])
    placed = distinct.select("fp", pop.alias("p"), (first[pop] + F.pmod(F.xxhash64("fp"), count[pop].cast("long")).cast("int")).alias("tile"))
    packed = placed.groupBy("tile").applyInPandas(lambda pdf: pd.DataFrame({"tile": [int(pdf["tile"].iloc[0])], "least": [int(pdf["p"].min())], "most": [int(pdf["p"].max())], "fps": [np.sort(pdf["fp"].to_numpy()).tobytes()]}), "tile int, least int, most int, fps binary")
    of = lambda values, c: F.create_map(*[F.lit(x) for item in values.items() for x in item])[F.col(c)]
    as_first = packed.select("tile", "fps", F.explode(F.sequence(F.col("tile"), of(reach, "most"))).alias("other")).select(F.col("tile").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), "fps")
    as_second = packed.where(of(lowest, "least") < F.col("tile")).select("tile", "fps", F.explode(F.sequence(of(lowest, "least"), F.col("tile") - 1)).alias("other")).select(F.col("other").alias("i"), F.col("tile").alias("j"), F.lit(1).alias("side"), "fps")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, np.int64).view(U64) for x in pdf.sort_values("side")["fps"]]
        if len(parts) == 1 and pdf["i"].iloc[0] != pdf["j"].iloc[0]:  # no such other tile
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        fps = np.concatenate(parts)
        found = forest(fps, len(parts[0]) if len(parts) > 1 else None, radius)
        signed = fps.view(np.int64)
        return pd.DataFrame({"a": signed[found[:, 0]], "b": signed[found[:, 1]]})

    return as_first.unionByName(as_second).groupBy("i", "j").applyInPandas(compare, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating large and small stars.

    ``edges`` (a, b) without loops.  Each star is a grouped minimum and a join,
    so a hub's links are never gathered in one task; every round is a table in
    the shared folder.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if large:
            least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = both.where(F.col("b") < F.col("a"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(least, "a")
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    path, before = None, None
    current = edges
    while True:
        following, place = cut_at(star(star(current, True), False), "star")
        # Converged once the edge set is a set of stars that no longer changes.
        mark = tuple(following.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if path:
            drop_path(spark, path)
        current, path = following, place
        if mark == before:
            break
        before = mark
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp, component_id): component_id is the smallest id reachable over links, its own included."""
    marked = cut(fingerprint(docs, id_column, text_column), "fingerprints")
    distinct = cut(marked.groupBy("fp").agg(F.min(id_column).alias("least")), "distinct")
    found = cut(links(distinct), "links")
    roots = components(found)
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(id_column, "fp", "component_id")
