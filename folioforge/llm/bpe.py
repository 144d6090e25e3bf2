"""BPE encoding and decoding with a public merge table.

Encoder: leftmost-longest token matches from an Aho-Corasick automaton, each
neighbouring pair checked against a pair-compatibility table; where a pair is
not compatible the encoder backs up to shorter tokens.  The result is exactly
what applying the merges in rank order gives, in time linear in the word.
Decoder: one byte blob of all token strings and an offset table.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to the empty string; repeated rows are encoded alike; an empty table
gives an empty result; other columns of the input are not read, so their names
may clash.  A text of more than ``LONG`` characters is cut at blanks, which no
token crosses, so memory is bounded by ``LONG`` or the longest run without a
blank.  Texts with characters that Python's Unicode tables do not know are
normalised and cut into pre-tokens by the library's own tables.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .textkernel import U64, Poly, positions_in_group

_SUFFIX = "</w>"
#: A text of more characters is encoded in pieces; so many rows or bytes of text are encoded at a time.
LONG, ROWS, BYTES = 1 << 20, 128, 1 << 20
#: Bounds of a worker's caches: words, their units, and pairs of tokens.
WORDS, UNITS, PAIRS = 700_000, 16 << 20, 1_000_000


def _byte_letters() -> list[str]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordTable:
    """Encoded words in arrays: an open-addressing table from word hashes to (units, ids).

    Look-ups are whole-array operations; a full table is emptied.
    """

    def __init__(self, most: int, most_units: int = UNITS):
        self.most, self.most_units = most, most_units
        self.mask = (1 << (2 * most).bit_length()) - 1
        self.clear()

    def clear(self) -> None:
        self.entry, self.key = np.full(self.mask + 1, -1, np.int32), np.zeros(self.mask + 1, U64)
        self.count = 0
        self.unit_ends, self.id_ends = np.zeros(self.most + 1, np.int64), np.zeros(self.most + 1, np.int64)
        self.units, self.ids = np.zeros(1 << 16, np.uint16), np.zeros(1 << 16, np.uint32)

    def has_room(self, words: int, units: int) -> bool:
        return self.count + words <= self.most and int(self.unit_ends[self.count]) + units <= self.most_units

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, or -1."""
        out, todo, at = np.full(len(keys), -1, np.int32), np.arange(len(keys)), (keys & U64(self.mask)).astype(np.int64)
        while len(todo):
            entry = self.entry[at]
            used = entry >= 0
            same = used & (self.key[at] == keys[todo])
            out[todo[same]] = entry[same]
            on = used & ~same
            todo, at = todo[on], (at[on] + 1) & self.mask
        return out

    def add(self, keys: np.ndarray, words: list[np.ndarray], ids: list[bytes]) -> None:
        """Add distinct new keys; the caller keeps their number within ``most``."""
        first, n = self.count, len(keys)
        for name, ends, new in (("units", self.unit_ends, np.concatenate(words)), ("ids", self.id_ends, np.frombuffer(b"".join(ids), "<u4"))):
            begin, blob = int(ends[first]), getattr(self, name)
            if begin + len(new) > len(blob):
                blob = np.concatenate([blob, np.zeros(max(len(blob), len(new)), blob.dtype)])
                setattr(self, name, blob)
            blob[begin : begin + len(new)] = new
        self.unit_ends[first + 1 : first + n + 1] = self.unit_ends[first] + np.cumsum([len(w) for w in words])
        self.id_ends[first + 1 : first + n + 1] = self.id_ends[first] + np.cumsum([len(p) // 4 for p in ids])
        self.count += n
        todo, at = np.arange(n), (keys & U64(self.mask)).astype(np.int64)
        while len(todo):
            free = np.flatnonzero(self.entry[at] < 0)
            _, one = np.unique(at[free], return_index=True)  # of those that want one place the first gets it
            placed = free[one]
            self.entry[at[placed]], self.key[at[placed]] = first + todo[placed], keys[todo[placed]]
            rest = np.ones(len(todo), bool)
            rest[placed] = False
            todo, at = todo[rest], (at[rest] + 1) & self.mask


#: Class of characters that Python's Unicode tables do not know.
_NEW = 4


def _classes() -> np.ndarray:
    """0 blank, 1 letter, 2 number, 3 other, 4 unknown for each 16-bit code unit."""
    out = np.full(1 << 16, 3, np.uint8)
    every = "".join(chr(c) for c in range(1 << 16) if not 0xD800 <= c < 0xE000)
    for kind, pattern in enumerate((r"\p{White_Space}", r"\p{L}", r"\p{N}")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    out[[ord(c) for c in every if unicodedata.category(c) == "Cn"]] = _NEW
    return out


def _library(spec: dict):
    """The tokenizer file's own normaliser and pre-tokenizer, without its vocabulary."""
    from tokenizers import Tokenizer

    bare = spec | {"added_tokens": [], "model": spec["model"] | {"vocab": {}, "merges": []}}
    return Tokenizer.from_str(json.dumps(bare))


class WordBpe:
    """One tokenizer file of the kind "BPE with word ends".

    A word is a string over 512 symbols: code b for byte b, code 256 + b for
    byte b at the end of the word.
    """

    def __init__(self, path: str, cached_words: int = WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model.get("end_of_word_suffix") != _SUFFIX or kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder"):
            raise ValueError(f"{path}: not a word-end BPE of the supported kind")
        vocab: dict[str, int] = model["vocab"]
        code = self.code = {c: b for b, c in enumerate(_byte_letters())}
        self.rules = {k: spec[k] for k in spec if k != "model"} | {"model": {k: v for k, v in model.items() if k not in ("vocab", "merges")}}

        def symbols(token: str) -> str:
            body = [code[c] for c in token.removesuffix(_SUFFIX)]
            if token.endswith(_SUFFIX) and body:
                body[-1] += 256
            return "".join(map(chr, body))

        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        self.size = max(tokens) + 1
        self.spelled = {i: symbols(t) for t, i in vocab.items()}
        self.ids = {s: i for i, s in self.spelled.items()}
        #: Merges are ranked by id: a merged token's id rises with its rank.
        self.merged: dict[tuple[int, int], int] = {}
        self.left, self.right = list(range(self.size)), list(range(self.size))
        before = -1
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            one, two, both = vocab[a], vocab[b], vocab[a + b]
            if both <= before or both <= max(one, two):
                raise ValueError(f"{path}: token ids do not follow the merge ranks")
            before = both
            self.merged[one, two] = both
            self.left[both], self.right[both] = one, two
        self.length = {i: len(x) for i, x in self.spelled.items()}
        self.widest = max(self.length.values())
        self.shorter = {i: self._prefix(x) for i, x in self.spelled.items()}
        self.automaton = ahocorasick.Automaton()
        for s, i in self.ids.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.compatible: dict[int, bool] = {}
        self.table, self.classes, self.poly = WordTable(cached_words), _classes(), Poly(61)
        self.unit_values = np.random.default_rng(62).integers(0, 2**64, 1 << 16, dtype=U64)
        # Offset tables for decoding: every entry is stored with a space before it.
        self.strings, self.numbers = (self._table([" " + x for x in entries]) for entries in ([tokens.get(i, "") for i in range(self.size)], map(str, range(self.size))))

    @staticmethod
    def _table(entries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces = [e.encode() for e in entries]
        return np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    # -- pair compatibility --------------------------------------------------
    def _pair_ok(self, one: int, two: int) -> bool:
        """Do the tokens stay apart when their symbols stand side by side?

        Undo the merges of both, latest first; the pair is broken if, at a
        time when both halves were there, a merge across the gap ranked
        before the merge that was really made.
        """
        bound = self.size
        while True:
            if self.merged.get((one, two), bound) < bound:
                return False
            left_turn = one > two
            for side in (left_turn, not left_turn):
                if side and self.right[one] != one:
                    bound, one = one, self.right[one]
                    break
                if not side and self.left[two] != two:
                    bound, two = two + 1, self.left[two]
                    break
            else:
                return True

    def _ok(self, one: int, two: int) -> bool:
        """Work out an entry of the pair table; the table is bounded."""
        if len(self.compatible) > PAIRS:
            self.compatible.clear()
        ok = self.compatible[one * self.size + two] = self._pair_ok(one, two)
        return ok

    def _prefix(self, s: str) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        for n in range(len(s) - 1, 0, -1):
            if s[:n] in self.ids:
                return self.ids[s[:n]]
        return -1

    # -- encoding ------------------------------------------------------------
    def _back_up(self, word: str, out: list[int]) -> list[int]:
        """Go on from a compatible prefix ``out`` of the longest matches."""
        length, shorter, known, size, widest, matches = self.length, self.shorter, self.compatible, self.size, self.widest, self.automaton.iter_long
        at, stop, dead = sum([length[t] for t in out]), len(word), set()
        before = out[-1] if out else -1
        token = next(matches(word[at : at + widest]))[1]
        while True:
            to = at + length[token]
            if to not in dead:
                ok = before < 0 or known.get(before * size + token)
                if ok is None:
                    ok = self._ok(before, token)
                if ok:
                    out.append(token)
                    if to == stop:
                        return out
                    at, before = to, token
                    token = next(matches(word[at : at + widest]))[1]
                    continue
            token = shorter[token]
            while token < 0:
                dead.add(at)
                last = out.pop()
                before = out[-1] if out else -1
                at -= length[last]
                token = shorter[last]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of distinct words, all at once.

        The longest matches of all words come from one pass of the automaton;
        words whose neighbouring matches are all compatible are done, the
        others are backed up from their first incompatible pair.
        """
        data = np.frombuffer("\n".join([*words, ""]).encode(), np.uint8).astype("<u2")
        stops = np.flatnonzero(data == 0x0A)
        begins = np.append(0, stops[:-1] + 1)
        data[stops - 1] += 256  # a word's last symbol
        data[stops] = 0x2FF  # stands in no token
        text = data.tobytes().decode("utf-16-le")
        found = np.array(list(self.automaton.iter_long(text)), np.int64)
        ends, ids = found[:, 0], found[:, 1]
        word = np.searchsorted(stops, ends)
        keys = ids[:-1] * self.size + ids[1:]
        inside = word[1:] == word[:-1]
        pairs, where = np.unique(keys[inside], return_inverse=True)
        known, ok = self.compatible, []
        for key in pairs.tolist():
            good = known.get(key)
            ok.append(self._ok(*divmod(key, self.size)) if good is None else good)
        broken = np.flatnonzero(inside)[~np.array(ok, bool)[where]] if len(pairs) else np.zeros(0, np.int64)
        bounds = np.searchsorted(word, np.arange(len(words) + 1))
        packed, edges = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
        out = [packed[i:j] for i, j in zip(edges, edges[1:], strict=False)]
        bad, first = np.unique(word[broken], return_index=True)
        for w, at, i, j in zip(bad.tolist(), broken[first].tolist(), begins[bad].tolist(), stops[bad].tolist(), strict=True):
            out[w] = array("I", self._back_up(text[i:j], ids[bounds[w] : at + 1].tolist())).tobytes()
        return out

    @staticmethod
    def _normal(text: str) -> str:
        """NFC and lower case; lower-casing is per character (no final-sigma rule)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    @functools.cached_property
    def library(self):
        return _library(self.rules)

    def _words_of(self, text: str) -> list[str]:
        """Pre-tokens of one text, with the library's tables where Python's are older."""
        if not any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self.pattern.findall(self._normal(text))
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.code[c] for c in w).decode() for w, _ in found]

    def _plain(self, text: str) -> bytes:
        """Ids of one text, pre-token by pre-token: for special tokens and rare characters."""
        out = []
        for part in self.special_pattern.split(text) if self.special_pattern else [text]:
            if part in self.specials:
                out.append(array("I", [self.specials[part]]).tobytes())
            elif words := self._words_of(part):
                own = list(dict.fromkeys(words))
                known = dict(zip(own, self.encode_words(own), strict=True))
                out += [known[w] for w in words]
        return b"".join(out)

    def _pre_tokens(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens: letter runs, single numbers, runs of other signs, contractions."""
        kind = self.classes[units]
        change = np.flatnonzero(np.diff(kind, prepend=0, append=0) != 0)
        first = np.zeros(len(kind) + 1, bool)
        first[change] = True
        last = first[1:].copy()
        number = kind == 2
        first = (first[:-1] | number) & (kind != 0)
        last = (last | number) & (kind != 0)
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        # An apostrophe that is a run of its own takes s, t, m, d, re, ve or ll along.
        lone = np.flatnonzero((units[starts] == 0x27) & (ends - starts == 1))
        lone = lone[lone + 1 < len(starts)]
        lone = lone[(starts[lone + 1] == ends[lone]) & (kind[ends[lone]] == 1)]
        if len(lone):
            one = units[ends[lone]]
            two = np.where(ends[lone + 1] - ends[lone] > 1, units[np.minimum(ends[lone] + 1, len(units) - 1)], 0)
            is_ = lambda x, c: x == ord(c)
            long = (is_(one, "r") & is_(two, "e")) | (is_(one, "v") & is_(two, "e")) | (is_(one, "l") & is_(two, "l"))
            taken = np.where(long, 2, np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64))
            ends[lone] += taken
            starts[lone + 1] += taken
            full = ends > starts
            starts, ends = starts[full], ends[full]
        return starts, ends

    @staticmethod
    def _pieces(text: str) -> Iterator[str]:
        """A long text in pieces that begin with a blank: no pre-token and no composed character crosses one."""
        at = 0
        while len(text) - at > LONG:
            cut = max(text.rfind(" ", at + 1, at + LONG), text.rfind("\n", at + 1, at + LONG))
            if cut < 0:
                found = re.compile(r"[ \n]").search(text, at + LONG)
                if not found:
                    break
                cut = found.start()
            yield text[at:cut]
            at = cut
        yield text[at:]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(texts)
        held, parts = [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            if len(text) > LONG and len(pieces := list(self._pieces(text))) > 1:
                out[i] = b"".join(self.encode_batch([p])[0] for p in pieces)
                continue
            if "<|" in text and self.special_pattern and self.special_pattern.search(text):
                out[i] = self._plain(text)
                continue
            normal = self._normal(text)
            data = normal.encode("utf-16-le", "surrogatepass")
            if len(data) != 2 * len(normal):  # characters of two units
                out[i] = self._plain(text)
                continue
            units = np.frombuffer(data, "<u2")
            if not text.isascii() and (self.classes[units] == _NEW).any():
                out[i] = self._plain(text)
                continue
            held.append(i)
            parts.append(data)
        if not held:
            return out
        units = np.frombuffer(b"\n\0".join(parts), "<u2")
        offsets = np.cumsum([0, *[len(p) // 2 + 1 for p in parts]])
        starts, ends = self._pre_tokens(units)
        if not len(starts):
            return out
        sizes = ends - starts
        keys = self.poly.spans(self.unit_values[units], starts, ends) ^ sizes.astype(U64)
        entries = self.table.find(keys)
        new = np.flatnonzero(entries < 0)
        if len(new):
            fresh, first = np.unique(keys[new], return_index=True)
            if not self.table.has_room(len(fresh), int(sizes[new[first]].sum())):
                if self.table.count == 0:  # one batch with more words than the table holds
                    for i in held:
                        out[i] = self._plain(texts[i])
                    return out
                self.table.clear()
                return self.encode_batch(texts)
            text, at = units.tobytes().decode("utf-16-le"), new[first]
            begins, stops = starts[at].tolist(), ends[at].tolist()
            packed = self.encode_words([text[a:b] for a, b in zip(begins, stops, strict=True)])
            self.table.add(fresh, [units[a:b] for a, b in zip(begins, stops, strict=True)], packed)
            entries[new] = self.table.find(keys[new])
        # Hashes only propose: the words themselves must be the same.
        t = self.table
        begin = t.unit_ends[entries]
        whole = bool(np.array_equal(t.unit_ends[entries + 1] - begin, sizes))
        if whole:
            inner = positions_in_group(sizes)
            whole = np.array_equal(t.units[np.repeat(begin, sizes) + inner], units[np.repeat(starts, sizes) + inner])
        if not whole:
            for i in held:
                out[i] = self._plain(texts[i])
            return out
        begin = t.id_ends[entries]
        n_ids = t.id_ends[entries + 1] - begin
        stops = np.concatenate([[0], np.cumsum(n_ids)])
        packed = t.ids[np.repeat(begin, n_ids) + positions_in_group(n_ids)].astype("<u4").tobytes()
        edges = (4 * stops[np.searchsorted(starts, offsets)]).tolist()
        for i, a, b in zip(held, edges, edges[1:], strict=False):
            out[i] = packed[a:b]
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_batch([text])[0], "<u4")

    # -- decoding ------------------------------------------------------------
    @staticmethod
    def _gather(table: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> bytes:
        """The ids' entries of an offset table one after the other, without the first blank."""
        if not len(ids):
            return b""
        blob, offsets = table
        ids = ids.astype(np.int64)
        begin = offsets[ids]
        size = offsets[ids + 1] - begin
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)
        return blob[at].tobytes()[1:]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the token strings joined by one space."""
        return self._gather(self.strings, ids)

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by one space."""
        return self._gather(self.numbers, ids)


@functools.cache
def tokenizer(path: str) -> WordBpe:
    """One instance for each worker process and file."""
    return WordBpe(path)


def id_lists(packed: list[bytes]) -> pa.ListArray:
    """Packed ids as a column of integer lists."""
    stops = np.cumsum([0, *[len(p) // 4 for p in packed]])
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def slices(batches: Iterator[pa.RecordBatch], text_at: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``ROWS`` rows and about ``BYTES`` bytes of text; a longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, row = np.cumsum(sizes), 0
        while row < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[row] - sizes[row] + BYTES, side="right"))
            stop = min(max(stop, row + 1), row + ROWS, batch.num_rows)
            yield batch.slice(row, stop - row)
            row = stop


def encode_documents(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids array<int>, n_tokens [, decoded]) of every whole text."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(tokenizer_path)
        for part in slices(batches):
            packed = bpe.encode_batch(part.column(1).to_pylist())
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            columns = [part.column(0), id_lists(packed), pa.array(sizes)]
            if decoded:
                columns.append(pa.array([bpe.decode(np.frombuffer(p, "<u4")).decode() for p in packed], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "ids", "n_tokens", "decoded"][: len(columns)])

    schema = f"`{id_column}` {kind}, ids array<int>, n_tokens bigint" + ", decoded string" * decoded
    return docs.select(id_column, text_column).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, tokenizer_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, decoded) of every row of ids; null ids count as none."""
    kind = encoded.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(tokenizer_path)
        for batch in batches:
            texts = [bpe.decode(np.array(x.as_py() or [], np.uint32)).decode() for x in batch.column(1)]
            yield pa.RecordBatch.from_pydict({id_column: batch.column(0), "decoded": pa.array(texts, pa.string())})

    return encoded.select(id_column, ids_column).mapInArrow(run, f"`{id_column}` {kind}, decoded string")


def digest_documents(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): the encode-decode round trip as digests.

    Encoding and decoding run in one narrow stage, so neither ids nor decoded
    texts are shuffled or stored.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(tokenizer_path)
        for part in slices(batches):
            sizes, ids_sha, decoded_sha = [], [], []
            for packed in bpe.encode_batch(part.column(1).to_pylist()):
                ids = np.frombuffer(packed, "<u4")
                sizes.append(len(ids))
                ids_sha.append(hashlib.sha256(bpe.decimal(ids)).hexdigest())
                decoded_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())], names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
