"""Removal of repeated passages by fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document.  Every document is
cut into non-overlapping reference blocks of ``BLOCK`` words; since
``WINDOW >= 2 * BLOCK - 1``, any window holds a whole block of its document.
So a repeated window's other occurrence meets that block with one of its own
rolling ``BLOCK``-word windows.

Texts are dealt once to homes, some megabytes each, and that exchange is read
by three steps; inside a home rows are ordered by id, and a word is addressed
by its number in the home.

1. Probe: the hash of every rolling block goes to the part that owns it, each
   distinct hash of a home once.  There a reference block is an anchor if its
   hash came twice.  Blocks that meet inside their own home are anchors at once.
2. Extend: the windows around the anchors are told apart by a 128-bit BLAKE2b
   digest of their words.  Of equal windows of a home all but the first are
   marked at once; the first goes to the part that owns its digest, which marks
   those that start earlier in another home.  Neighbouring windows join up to
   the maximal repeats.
3. Remove: the words below marked windows go, judged on the input.

Block hashes only propose; a removal rests on the digest of the words.  A
passage with n copies costs one entry a home, not one a copy, so a passage
that every document holds weighs no more than others.

Defined cases: null or empty texts have no words, and the kept text is the
empty string; texts of fewer than ``WINDOW`` words keep all; of rows with equal
ids neither is earlier at the same start, and positions found in one are never
applied to another text; a null id is ordered before all others; an empty table
gives an empty result; other columns are not read, so their names may clash. A
very long text is worked on alone, with some 50 times its size in memory.  Ids
are integers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import spread, text_bytes
from .textkernel import NON_SPACE, U64, Poly, Words, chunks

WINDOW = 20
BLOCK = 10
#: UTF-8 bytes of text of a home, at least and at most; see ``home_bytes``.
PART_BYTES, MOST_BYTES = 8 << 20, 64 << 20
#: Bytes of text that are hashed at a time; working memory is some 50 times this.
CHUNK_BYTES = 2 << 20
#: Bits of a block hash that its part sees.
SHORT = 28
_WORD, _GRAM = Poly(31), Poly(32)
_LEAST = -(2**63)

_PROBES = {"part": pa.int32(), "home": pa.int32(), "at": pa.binary(), "asked": pa.binary(), "others": pa.binary(), "known": pa.binary()}
_WINDOWS = {"part": pa.int32(), "home": pa.int32(), "at": pa.binary(), "ids": pa.binary(), "counts": pa.binary(), "bases": pa.binary(), "digests": pa.binary(), "known": pa.binary()}
_MARKS = {"home": pa.int32(), "at": pa.binary()}


def _ddl(columns: dict) -> str:
    return ", ".join(f"{c} {'int' if t == pa.int32() else 'binary'}" for c, t in columns.items())


def _table(rows: list[dict], columns: dict) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in columns.items()], names=list(columns))


def home_bytes(total: int, least: int = PART_BYTES) -> int:
    """Bytes of text a home: with n homes there are up to n * n packed rows, which should stay of some size."""
    return max(least, min(MOST_BYTES, int((1536 * total) ** 0.5)))


# -- packing: byte planes, whose high ones are nearly all zero and so compress away
def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _unplanes(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _pack(rising: np.ndarray) -> bytes:
    """Rising 32-bit numbers as differences."""
    return _planes(np.diff(rising, prepend=0).astype("<u4"))


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, "<u4").astype(np.int64))


def _split(parts_of: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """(part, slice) for each part that has any, of part numbers in rising order."""
    edges = np.searchsorted(parts_of, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edges)):
        yield int(p), slice(int(edges[p]), int(edges[p + 1]))


# -- texts of a home
def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_LEAST).to_numpy(zero_copy_only=False)


def _pieces(home: pa.Table) -> Iterator[tuple[int, pa.RecordBatch, Words]]:
    """(number of its first word, rows, words) of the runs of a home's rows, in the order of ids and texts."""
    batch = home.combine_chunks().to_batches()
    if not batch:
        return
    rows = batch[0]
    rows = rows.take(pa.array(np.lexsort((rows.column("_print").to_numpy(zero_copy_only=False), _ids(rows.column("_name"))))))
    row = first = 0
    for names, buf, offsets in chunks([rows], ["_name", "_text"], CHUNK_BYTES):
        words = Words(buf, offsets, NON_SPACE, _WORD)
        yield first, rows.slice(row, len(names)), words
        row, first = row + len(names), first + len(words.starts)


def _joined(arrays: Iterable[np.ndarray], dtype=np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *arrays])


def _probe(home: int, table: pa.Table, parts: int) -> pa.Table:
    """The home's distinct block hashes, to the parts that own them."""
    keys, places, blocks = [], [], []
    for first, _, words in _pieces(table):
        starts = words.whole(BLOCK)
        doc = words.text_of(starts)
        long = words.counts[doc] >= WINDOW
        starts, doc = starts[long], doc[long]
        if len(starts):
            grams = words.grams(BLOCK, _GRAM)[starts]
            keys.append(((grams >> U64(SHORT)) % U64(parts)) << U64(SHORT) | grams & U64((1 << SHORT) - 1))
            places.append(starts + first)
            blocks.append((starts - words.bounds[doc]) % BLOCK == 0)
    key, at, block = _joined(keys, U64), _joined(places), _joined(blocks, bool)
    order = np.argsort(key, kind="stable")
    key, at, block = key[order].astype(np.int64), at[order], block[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    alone = fresh & np.append(fresh[1:], True)
    rows = {p: {"part": p, "home": home, "at": b"", "asked": b"", "others": b""} for p in range(parts)}
    asks = alone & block
    mine, whose, rest = at[asks].astype("<u4"), key[asks], key[fresh & ~asks]
    mask = (1 << SHORT) - 1
    for p, s in _split(whose >> SHORT, parts):
        rows[p] |= {"at": _planes(mine[s]), "asked": _pack(whose[s] & mask)}
    for p, s in _split(rest >> SHORT, parts):
        rows[p] |= {"others": _pack(rest[s] & mask)}
    # Blocks that were met in this home need no answer.
    rows[home % parts]["known"] = _pack(np.sort(at[block & ~alone]))
    return _table([r for r in rows.values() if r["asked"] or r["others"] or r.get("known")], _PROBES)


def _anchors(table: pa.Table) -> pa.Table:
    """Per home the reference blocks whose hash came from another one as well."""
    rows = table.to_pylist()
    asked = [_unpack(r["asked"]) for r in rows]
    every = np.sort(np.concatenate([*asked, *(_unpack(r["others"]) for r in rows)]).astype(np.uint32))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for r, hashes in zip(rows, asked, strict=True):
        near = np.searchsorted(twice, hashes.astype(np.uint32))
        hit = twice[np.minimum(near, len(twice) - 1)] == hashes if len(twice) else np.zeros(len(hashes), bool)
        marks = np.sort(_unplanes(r["at"], "<u4")[hit].astype(np.int64))
        out += [{"home": r["home"], "at": a} for a in (_pack(marks), r["known"]) if a]
    return _table(out, _MARKS)


def _marks(table: pa.Table) -> np.ndarray:
    return np.unique(_joined(_unpack(x) for x in table.column("at").to_pylist()))


def _digests(words: Words, starts: np.ndarray) -> np.ndarray:
    """Digest of the words of each window, one space between them."""
    data, begins, ends = words.spaced()
    return np.frombuffer(b"".join([blake2b(data[a:b], digest_size=16).digest() for a, b in zip(begins[starts].tolist(), ends[starts + WINDOW - 1].tolist(), strict=True)]), "<u8").reshape(-1, 2)


def _windows(home: int, table: pa.Table, anchors: pa.Table, parts: int) -> pa.Table:
    """Windows around the anchors: the first of each kind to the part of its digest, the others as marks."""
    marks, found, before = _marks(anchors), [], 0
    for first, rows, words in _pieces(table):
        at = marks[np.searchsorted(marks, first) : np.searchsorted(marks, first + len(words.starts))] - first
        starts = at[:, None] - np.arange(WINDOW - BLOCK)[None, :]
        starts = np.unique(starts[starts >= words.bounds[words.text_of(at)][:, None]])
        starts = np.intersect1d(starts, words.whole(WINDOW), assume_unique=True)
        if len(starts):
            doc = words.text_of(starts)
            found.append((starts + first, doc + before, _ids(rows.column("_name"))[doc], words.bounds[doc] + first, _digests(words, starts)))
        before += rows.num_rows
    if not found:
        return _table([], _WINDOWS)
    at, doc, ids, base, digest = (np.concatenate(x) for x in zip(*found, strict=True))
    order, first = _first_of_kind(digest, ids, at - base)
    earlier = (ids[order] == ids[first]) & (at[order] - base[order] == at[first] - base[first])
    # First of its kind: to the owner, in the order of words.
    asks = np.sort(order[earlier])
    part = (digest[asks, 1] % U64(parts)).astype(np.int64)
    asks = asks[np.argsort(part, kind="stable")]
    rows = {home % parts: {"part": home % parts, "home": home, "known": _pack(np.sort(at[order[~earlier]]))}}
    for p, s in _split(np.sort(part), parts):
        own = asks[s]
        edges = np.flatnonzero(np.diff(doc[own], prepend=-1))
        lead = own[edges]
        rows.setdefault(p, {"part": p, "home": home})
        rows[p] |= {"at": _pack(at[own]), "ids": _planes(np.diff(ids[lead], prepend=0)), "counts": np.diff(edges, append=len(own)).astype("<u4").tobytes(), "bases": _pack(base[lead]), "digests": digest[own].tobytes()}
    return _table(list(rows.values()), _WINDOWS)


def _first_of_kind(digest: np.ndarray, ids: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices ordered by digest, id and position, and for each of them the first index of its digest."""
    order = np.lexsort((position, ids, digest[:, 1], digest[:, 0]))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (digest[order[1:]] != digest[order[:-1]]).any(axis=1)
    return order, order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]


def _later(table: pa.Table) -> pa.Table:
    """Per home the windows whose words start earlier in another one, and the marks that it sent along."""
    rows = table.to_pylist()
    out = [{"home": r["home"], "at": r["known"]} for r in rows if r["known"]]
    rows = [r for r in rows if r["at"]]
    if rows:
        at, counts = [_unpack(r["at"]) for r in rows], [np.frombuffer(r["counts"], "<u4").astype(np.int64) for r in rows]
        ids = np.concatenate([np.repeat(np.cumsum(_unplanes(r["ids"], "<i8")), c) for r, c in zip(rows, counts, strict=True)])
        base = np.concatenate([np.repeat(_unpack(r["bases"]), c) for r, c in zip(rows, counts, strict=True)])
        position = np.concatenate(at) - base
        order, first = _first_of_kind(np.concatenate([np.frombuffer(r["digests"], "<u8").reshape(-1, 2) for r in rows]), ids, position)
        hit = np.zeros(len(order), bool)
        hit[order] = (ids[order] != ids[first]) | (position[order] != position[first])
        for r, own, gone in zip(rows, at, np.split(hit, np.cumsum([len(a) for a in at])[:-1]), strict=True):
            if gone.any():
                out.append({"home": r["home"], "at": _pack(own[gone])})
    return _table(out, _MARKS)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """(id, n_words, n_removed, kept_text) of every row; kept words are joined by one space."""
    total = text_bytes(docs, text_column)
    parts = spread(total, home_bytes(total, part_bytes), 2)
    kind = docs.schema[id_column].dataType.simpleString()
    plain = docs.select(F.col(id_column).alias("_name"), F.xxhash64(text_column).alias("_print"), F.col(text_column).alias("_text"))
    # One exchange of the text, used by all three steps; rows of one id are dealt by their texts.
    texts = plain.withColumn("home", F.pmod(F.xxhash64("_name", "_print"), F.lit(parts)).cast("int")).repartitionById(parts, "home").groupBy("home")
    probes = texts.applyInArrow(lambda key, table: _probe(key[0].as_py(), table, parts), _ddl(_PROBES))
    anchors = probes.repartitionById(parts, "part").groupBy("part").applyInArrow(_anchors, _ddl(_MARKS))
    windows = texts.cogroup(anchors.repartitionById(parts, "home").groupBy("home")).applyInArrow(lambda key, table, marks: _windows(key[0].as_py(), table, marks, parts), _ddl(_WINDOWS))
    later = windows.repartitionById(parts, "part").groupBy("part").applyInArrow(_later, _ddl(_MARKS))

    def remove(table: pa.Table, later: pa.Table) -> pa.Table:
        marks, out = _marks(later), []
        for first, rows, words in _pieces(table):
            at = marks[np.searchsorted(marks, first) : np.searchsorted(marks, first + len(words.starts))] - first
            edge = np.zeros(len(words.starts) + 1, np.int64)
            edge[at] += 1
            edge[at + WINDOW] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            sums = np.concatenate([[0], np.cumsum(gone)])[words.bounds]
            out.append(pa.RecordBatch.from_arrays([rows.column("_name"), pa.array(words.counts, pa.int64()), pa.array(np.diff(sums), pa.int64()), pa.array(words.joined(~gone), pa.string())], names=[id_column, "n_words", "n_removed", "kept_text"]))
        schema = pa.schema([(id_column, table.schema.field("_name").type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
        return pa.Table.from_batches(out, schema)

    return texts.cogroup(later.repartitionById(parts, "home").groupBy("home")).applyInArrow(remove, f"`{id_column}` {kind}, n_words bigint, n_removed bigint, kept_text string")
