"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words over its whole text.
Every passage is encoded (byte-class shares, word shapes and repetition, then
a learned layer); gated attention learns from document labels alone which
passages matter, and the document's score is a logistic of the
attention-weighted passage representation.

Training runs on the driver on at most ``SAMPLE`` labelled documents, one text
an id and ``common.SAMPLE_BYTES`` of text in all (bounds, not shares), of which
only passage vectors are gathered; scoring is one narrow pass over all whole
texts with a model of some kilobytes.

Defined cases: a null or empty text is one empty passage; repeated rows score
alike, and are learnt from once; without labels of both kinds every score is
the labels' mean (0.5 without any); rows with a null id are scored, held_out
null; an empty table gives an empty result; a very long text is scored alone,
in memory of some 100 times its size; language, source, labels and ids are
never inputs of a score, and other columns' names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import first_of_each, labelled_sample, with_decision
from .textkernel import NON_SPACE, Poly, Words, chunks, positions_in_group, utf8

PASSAGE = 100
SAMPLE = 12_000
THRESHOLD = 0.3
HIDDEN, GATE = 32, 16
_POLY = Poly(51)
_PUNCTUATION = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
#: Byte classes: lower, upper, digit, blank, line end, control, high, then each ASCII sign.
_CLASS = np.array([0 if 97 <= b <= 122 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 3 if b in (32, 9) else 4 if b in (10, 13) else 6 if b >= 128 else 7 + _PUNCTUATION.index(b) if b in _PUNCTUATION else 5 for b in range(256)])
_CLASSES = 7 + len(_PUNCTUATION)
WIDTH = _CLASSES + 8


def passages(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of passages of each text, one feature row a passage)."""
    words = Words(buf, offsets, NON_SPACE, _POLY)
    n_docs, n_words = len(words.counts), len(words.starts)
    per_doc = np.maximum(1, -(-words.counts // PASSAGE))
    first = np.cumsum(per_doc) - per_doc
    doc = np.repeat(np.arange(n_docs), words.counts)
    of_word = first[doc] + positions_in_group(words.counts) // PASSAGE
    total = int(per_doc.sum())
    # Bytes belong to the passage of the word that they follow or stand in.
    byte_doc = np.repeat(np.arange(n_docs), np.diff(offsets))
    word_at = np.searchsorted(words.starts, np.arange(len(buf)), side="right") - 1
    of_byte = first[byte_doc]
    held = (word_at >= 0) & (word_at >= words.bounds[:-1][byte_doc])
    of_byte[held] = of_word[word_at[held]]
    shares = np.bincount(of_byte * _CLASSES + _CLASS[buf], minlength=total * _CLASSES).reshape(total, _CLASSES).astype(float)
    shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1)
    count = np.bincount(of_word, minlength=total).astype(float)
    some = np.maximum(count, 1)
    mean = lambda x: np.bincount(of_word, weights=x, minlength=total) / some
    size = (words.ends - words.starts).astype(float)
    last = _CLASS[buf[words.ends - 1]] if n_words else np.zeros(0, int)
    head = _CLASS[buf[words.starts]] if n_words else np.zeros(0, int)

    def distinct(group: np.ndarray) -> np.ndarray:
        """1 at the first word of each value in its group."""
        order = np.lexsort((words.hashes, group))
        new = np.ones(n_words)
        if n_words:
            same = (np.diff(group[order]) == 0) & (np.diff(words.hashes[order]) == 0)
            new[order[1:][same]] = 0
        return new

    upper = np.add.reduceat((_CLASS[buf] == 1).astype(np.int64), words.starts) if n_words else np.zeros(0)
    extra = [count / PASSAGE, mean(size) / 10, np.sqrt(np.maximum(mean(size**2) - mean(size) ** 2, 0)) / 10, mean(last >= 7), mean(head == 1), mean(upper >= np.maximum(size - 3, 2)), mean(distinct(of_word)), mean(distinct(doc))]
    return per_doc, np.hstack([shares, np.stack(extra, axis=1)])


@dataclass
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, per_doc: np.ndarray) -> dict[str, np.ndarray]:
        p, begins = self.parts, np.cumsum(per_doc) - per_doc
        h = np.tanh(x @ p["enc"] + p["enc_b"])
        v, u = np.tanh(h @ p["att"]), 1 / (1 + np.exp(-(h @ p["gate"])))
        e = (v * u) @ p["pick"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begins), per_doc))
        a = e / np.repeat(np.add.reduceat(e, begins), per_doc)
        z = np.add.reduceat(a[:, None] * h, begins, axis=0)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "score": 1 / (1 + np.exp(-(z @ p["out"] + p["out_b"][0])))}

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        per_doc, x = passages(buf, offsets)
        return self.forward((x - self.centre) / self.scale, per_doc)["score"]

    def score_texts(self, texts: list[str]) -> np.ndarray:
        return self.score(*utf8(pa.array(texts, pa.string())))


def fit(x: np.ndarray, per_doc: np.ndarray, labels: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 5e-3, seed: int = 7) -> QualityModel:
    """Train on bags of passage vectors; deterministic."""
    y, n = np.asarray(labels, float), len(per_doc)
    rng = np.random.default_rng(seed)
    parts = {"enc": rng.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)), "enc_b": np.zeros(HIDDEN), "att": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "gate": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "pick": rng.normal(0, GATE**-0.5, GATE), "out": np.zeros(HIDDEN), "out_b": np.zeros(1)}
    centre, scale = (x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)) if n else (np.zeros(WIDTH), np.ones(WIDTH))
    model = QualityModel(centre, scale, parts)
    if not n or y.min() == y.max():
        mean = float(y.mean()) if n else 0.5
        parts["out_b"][0] = np.log((mean + 1e-3) / (1 - mean + 1e-3))
        return model
    x = (x - centre) / scale
    begins = np.cumsum(per_doc) - per_doc
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in parts.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            docs = order[lo : lo + batch]
            sizes = per_doc[docs]
            xb = x[np.repeat(begins[docs], sizes) + positions_in_group(sizes)]
            f = model.forward(xb, sizes)
            at = np.cumsum(sizes) - sizes
            d_raw = (f["score"] - y[docs]) / len(docs)
            d_z = np.repeat(d_raw[:, None] * parts["out"], sizes, axis=0)
            d_a = (d_z * f["h"]).sum(axis=1)
            d_e = f["a"] * (d_a - np.repeat(np.add.reduceat(f["a"] * d_a, at), sizes))
            d_v = d_e[:, None] * parts["pick"] * f["u"] * (1 - f["v"] ** 2)
            d_u = d_e[:, None] * parts["pick"] * f["v"] * f["u"] * (1 - f["u"])
            d_h = (f["a"][:, None] * d_z + d_v @ parts["att"].T + d_u @ parts["gate"].T) * (1 - f["h"] ** 2)
            grads = {"enc": xb.T @ d_h, "enc_b": d_h.sum(axis=0), "att": f["h"].T @ d_v, "gate": f["h"].T @ d_u, "pick": (f["v"] * f["u"]).T @ d_e, "out": f["z"].T @ d_raw, "out_b": np.array([d_raw.sum()])}
            step += 1
            for k, g in grads.items():
                g = g + 1e-4 * parts[k]
                one, two = moments[k]
                one += 0.1 * (g - one)
                two += 0.01 * (g * g - two)
                parts[k] -= rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text") -> QualityModel:
    """Fit on a bounded sample; its passage vectors, not its texts, come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in first_of_each(batches):
            row = 0
            for ids, buf, offsets in chunks([batch], ["id", "text"]):
                per_doc, x = passages(buf, offsets)
                stops = np.cumsum(per_doc)
                blobs = [x[a:b].astype("<f4").tobytes() for a, b in zip(stops - per_doc, stops, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, batch.column(2).slice(row, len(ids)), pa.array(blobs, pa.binary())], names=["id", "label", "passages"])
                row += len(ids)

    rows = labelled_sample(docs, labels, "quality", sample, id_column, text_column)
    kind = rows.schema["id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"id {kind}, label int, passages binary").toArrow()
    blobs, ids = got["passages"].to_pylist(), got["id"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], blobs[i]))
    bags = [np.frombuffer(blobs[i], "<f4").reshape(-1, WIDTH) for i in order]
    y = got["label"].to_numpy()[np.array(order, np.int64)]
    return fit(np.concatenate(bags).astype(float) if bags else np.zeros((0, WIDTH)), np.array([len(b) for b in bags], np.int64), y)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample, id_column, text_column))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, buf, offsets in chunks(batches, [id_column, text_column]):
            yield pa.RecordBatch.from_arrays([ids, pa.array(model.value.score(buf, offsets))], names=[id_column, "score"])

    return with_decision(docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, score double"), id_column, threshold)
