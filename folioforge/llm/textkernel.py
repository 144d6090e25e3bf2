"""Vectorised word kernel over UTF-8 buffers.

All separators that the operators use are ASCII, so words can be found on
bytes.  Hashes are polynomial prefix sums modulo 2**64 followed by a mixer, so
the hash of any word or of any run of words costs a constant number of numpy
operations whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MASK = (1 << 64) - 1


def _table(is_word) -> np.ndarray:
    return np.fromiter((is_word(b) for b in range(256)), bool, 256)


#: Everything but space and \t \n \v \f \r.
NON_SPACE = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: ASCII digits, lower-case letters and every byte of a non-ASCII character.
ALNUM_LOWER = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Lower-casing of A-Z only.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


class Poly:
    """A polynomial hash: random byte values, an odd base and its inverse."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 2**64, 256, dtype=U64)
        self.base = int(rng.integers(0, 2**62)) * 2 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self._up = self._down = np.ones(1, U64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n + 1:
            size = max(n + 1, 1 << 16)
            self._up, self._down = (np.concatenate([np.ones(1, U64), np.cumprod(np.full(size, x & _MASK, U64))]) for x in (self.base, self.inverse))
        return self._up, self._down

    def spans(self, terms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of ``terms[s:e]`` for each pair, independent of where it stands."""
        n = len(terms)
        up, down = self.powers(n)
        sums = np.zeros(n + 1, U64)
        np.cumsum(terms * up[:n], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a run of texts: byte spans, and the range of words of each text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray, poly: Poly):
        self.buf, self.poly = buf, poly
        inside = table[buf]
        first, last = inside.copy(), inside.copy()
        if len(buf):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            at = offsets[:-1][offsets[:-1] < len(buf)]
            first[at] = inside[at]
            before = at[at > 0] - 1
            last[before] = inside[before]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: word range of text i is bounds[i]:bounds[i + 1]
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = self.poly.spans(self.poly.values[self.buf], self.starts, self.ends) + (self.ends - self.starts).astype(U64)
        return self._hashes

    def grams(self, n: int, poly: Poly | None = None) -> np.ndarray:
        """Hash of words i..i+n-1 for every i, also where it crosses into the next text (see ``whole``)."""
        m = len(self.starts) - n + 1
        if m <= 0:
            return np.zeros(0, U64)
        at = np.arange(m)
        return (poly or self.poly).spans(self.hashes, at, at + n)

    def whole(self, n: int) -> np.ndarray:
        """Indices i for which words i..i+n-1 lie in one text."""
        m = max(0, len(self.starts) - n + 1)
        stop = np.repeat(self.bounds[1:], self.counts)[:m]
        return np.flatnonzero(np.arange(m) + n <= stop)

    def text_of(self, words: np.ndarray) -> np.ndarray:
        """Index of the text that holds each word index."""
        return np.searchsorted(self.bounds, words, side="right") - 1

    def spaced(self, at: np.ndarray | slice = slice(None)) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words one after the other, one space behind each; their starts and ends in that."""
        starts, sizes = self.starts[at], self.ends[at] - self.starts[at] + 1
        ends = np.cumsum(sizes)
        # A word's bytes and the one behind it, which becomes the space.
        data = np.append(self.buf, np.uint8(0x20))[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        data[ends - 1] = 0x20
        return data.tobytes(), ends - sizes, ends - 1

    def joined(self, keep: np.ndarray) -> list[str]:
        """For each text its kept words, joined by one space."""
        at = np.flatnonzero(keep)
        whole, _, ends = self.spaced(at)
        stops = np.concatenate([[0], ends + 1])[np.searchsorted(at, self.bounds)]
        return [whole[a : max(a, b - 1)].decode() for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


def chunks(batches: Iterable[pa.RecordBatch], columns: list[str], most: int = 1 << 20) -> Iterator[tuple]:
    """(ids, bytes, offsets) of runs of rows with about ``most`` bytes of text; a longer text stands alone."""
    id_column, text_column = columns
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index(id_column))
        buf, offsets = utf8(batch.column(batch.schema.get_field_index(text_column)))
        row = 0
        while row < len(ids):
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
            stop = min(stop, len(ids))
            yield ids.slice(row, stop - row), buf[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
            row = stop


def positions_in_group(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, concatenated."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
