"""Counterfactual-regularised toxicity classifier.

A logistic model over hashed words and word beginnings of the whole text (met
at all, at least twice, at least four times).  Besides the label loss it is
trained on counterfactual pairs: in each labelled sentence with an identity
term the term is swapped for the next one of its group, and the squared change
of the sentence's score is penalised, so a neutral mention of a group does not
raise the score.

Training runs on the driver on at most ``SAMPLE`` labelled documents, one text
an id and ``common.SAMPLE_BYTES`` of text in all (bounds, not shares); both
labels weigh the same in the loss.  The model has ``KEPT`` features, those with
the largest log odds in the sample: with more it learns mislabelled documents
by heart.  Scoring is one narrow pass over all whole texts, with a weight table
of fixed size.

Defined cases: null and empty texts are scored from the bias; repeated rows
score alike, and are learnt from once; without labels of both kinds every score
is the labels' mean (0 without any); rows with a null id are scored, held_out
null; an empty table gives an empty result; a very long text is scored alone,
in memory of some 100 times its size; other columns (language, source, labels)
are never inputs of a score and their names may clash.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import first_of_each, labelled_sample, with_decision
from .textkernel import ALNUM_LOWER, LOWER, U64, Poly, Words, chunks, mix, utf8

SAMPLE = 8_000
TABLE = 1 << 20
#: Features of the model.
KEPT = 1_000
THRESHOLD = 0.5
FAIRNESS = 1.0
#: Identity terms, in groups whose members may stand for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("old", "young", "disabled", "blind", "deaf"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch"),
    ("schwul", "lesbisch", "bisexuell", "heterosexuell"),
    ("ausländer", "flüchtlinge", "einwanderer", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("gays", "lesbiennes", "bisexuels", "hétérosexuels"),
    ("immigrés", "réfugiés", "étrangers", "natifs"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("gais", "lesbianas", "bisexuales", "heterosexuales"),
    ("inmigrantes", "refugiados", "extranjeros", "nativos"),
)
_BEGINNINGS = (4, 5, 6, 7, 8)
_POLY = Poly(41)
_SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, term in enumerate(group)}


#: A stem that occurs so often in a text gives a further feature; the odd factors map the table onto itself.
_LEVELS = ((2, 3, 1), (4, 5, 2))


def _level(feature: np.ndarray, factor: int, shift: int) -> np.ndarray:
    return (feature * factor + shift) % TABLE


def stems_of(known: np.ndarray) -> np.ndarray:
    """Mask of the stems that lead to one of the known features."""
    every, out = np.arange(TABLE), known.copy()
    for _, factor, shift in _LEVELS:
        out |= known[_level(every, factor, shift)]
    return out


def features(buf: np.ndarray, offsets: np.ndarray, known: np.ndarray | None = None, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) pairs, each once: whole words, their first bytes, and those met often.

    With ``known`` (a mask over the table) and its ``stems_of`` other features are left out at once.
    """
    words = Words(LOWER[buf], offsets, ALNUM_LOWER, _POLY)
    values, doc = _POLY.values[words.buf], words.text_of(np.arange(len(words.starts)))
    out = []
    for k in (0, *_BEGINNINGS):
        at = np.flatnonzero(words.ends - words.starts >= k) if k else slice(None)
        hashes = mix(_POLY.spans(values, words.starts[at], words.starts[at] + k) * U64(2 * k + 1)) if k else words.hashes
        feature = (hashes % U64(TABLE)).astype(np.int64)
        where = doc[at]
        if wanted is not None:
            mask = wanted[feature]
            feature, where = feature[mask], where[mask]
        out.append(where * TABLE + feature)
    keys, times = np.unique(np.concatenate(out), return_counts=True)
    where, feature = keys // TABLE, keys % TABLE
    often = [(where * TABLE + _level(feature, factor, shift))[times >= least] for least, factor, shift in _LEVELS]
    keys = np.unique(np.concatenate([keys, *often]))
    where, feature = keys // TABLE, keys % TABLE
    return (where, feature) if known is None else (where[known[feature]], feature[known[feature]])


def counterfactuals(text: str) -> Iterator[tuple[str, str]]:
    """(sentence, the sentence with each identity term swapped) for sentences that have one."""
    for sentence in text.replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
        words = sentence.lower().split()
        swapped = [_SWAP.get(w.strip(",;:\"'()"), w) for w in words]
        if swapped != words:
            yield " ".join(words), " ".join(swapped)


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    @functools.cached_property
    def masks(self) -> tuple[np.ndarray, np.ndarray]:
        known = self.weights != 0
        return known, stems_of(known)

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, feature = features(buf, offsets, *self.masks)
        raw = np.bincount(doc, weights=self.weights[feature], minlength=len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-raw))

    def score_texts(self, texts: list[str]) -> np.ndarray:
        return self.score(*utf8(pa.array(texts, pa.string())))


@dataclass
class Examples:
    """Sparse training rows: features of each document, and of its sentence pairs."""

    labels: np.ndarray
    sizes: np.ndarray  # features of each document
    feature: np.ndarray
    pair: np.ndarray  # number of the pair of each difference
    changed: np.ndarray  # feature that differs
    sign: np.ndarray  # 1 only in the sentence, -1 only in its counterfactual


def _differences(text: str) -> list[tuple[int, int, int]]:
    """(pair, feature, sign) of the sentences with identity terms of one text."""
    pairs = list(counterfactuals(text))
    if not pairs:
        return []
    own, swapped = ({*zip(*map(np.ndarray.tolist, features(*utf8(pa.array([p[i] for p in pairs])))), strict=True)} for i in (0, 1))
    return sorted([(r, f, 1) for r, f in own - swapped] + [(r, f, -1) for r, f in swapped - own])


def example_rows(ids: pa.Array, buf: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """For each text its features (int32) and its differences (int32 triples)."""
    doc, feature = features(buf, offsets)
    at = 4 * np.searchsorted(doc, np.arange(len(offsets)))
    packed = feature.astype("<i4").tobytes()
    texts = [buf[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return [packed[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], [np.array(_differences(t), "<i4").tobytes() for t in texts]


def examples(labels: np.ndarray, packed: list[bytes], differences: list[bytes]) -> Examples:
    sizes = np.array([len(p) // 4 for p in packed], np.int64)
    triples, pair, before = [], [], 0
    for d in differences:
        if d:
            t = np.frombuffer(d, "<i4").reshape(-1, 3)
            triples.append(t)
            pair.append(t[:, 0] + before)
            before += int(t[:, 0].max()) + 1
    t = np.concatenate(triples) if triples else np.zeros((0, 3), np.int32)
    return Examples(np.asarray(labels, float), sizes, np.frombuffer(b"".join(packed), "<i4"), np.concatenate(pair).astype(np.int64) if pair else np.zeros(0, np.int64), t[:, 1], t[:, 2].astype(float))


def fit_examples(x: Examples, fairness: float = FAIRNESS, steps: int = 300, ridge: float = 1e-3, kept: int = KEPT) -> ToxicityModel:
    """Train; deterministic.  Working memory is a few times the features' four bytes each."""
    y, n = x.labels, len(x.labels)
    if not n or y.min() == y.max():
        mean = float(y.mean()) if n else 0.0
        return ToxicityModel(np.zeros(TABLE), float(np.log((mean + 1e-3) / (1 - mean + 1e-3))))
    edges = np.concatenate([[0], np.cumsum(x.sizes)])
    total, positive = np.zeros(TABLE, np.int64), np.zeros(TABLE, np.int64)
    for i in range(n):
        own = x.feature[edges[i] : edges[i + 1]]
        total[own] += 1
        if y[i] == 1:
            positive[own] += 1
    odds = np.log((positive + 0.5) / (y.sum() + 1) / ((total - positive + 0.5) / (n - y.sum() + 1))) * np.sqrt(total)
    often = np.flatnonzero(total >= min(3, max(1, n // 100)))
    top = often[np.argsort(-np.abs(odds[often]), kind="stable")[:kept]]
    slot = np.full(TABLE, -1, np.int32)
    slot[top] = np.arange(len(top))
    docs, cells = [], []
    for lo in range(0, n, 500):
        own = slot[x.feature[edges[lo] : edges[min(n, lo + 500)]]]
        docs.append(np.repeat(np.arange(lo, min(n, lo + 500)), x.sizes[lo : lo + 500])[own >= 0])
        cells.append(own[own >= 0])
    doc, feature = np.concatenate(docs), np.concatenate(cells)
    cell = slot[x.changed]
    row, sign, cell = x.pair[cell >= 0], x.sign[cell >= 0], cell[cell >= 0]
    pairs = int(row.max()) + 1 if len(row) else 0
    k = len(top)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    w, first, second = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(np.bincount(doc, weights=w[feature], minlength=n) + w[k])))
        err = (p - y) * share
        grad = np.append(np.bincount(feature, weights=err[doc], minlength=k) + ridge * w[:k], err.sum())
        if pairs:  # fairness * mean of squared score changes
            change = np.bincount(row, weights=w[cell] * sign, minlength=pairs)
            grad[:k] += 2 * fairness / pairs * np.bincount(cell, weights=sign * change[row], minlength=k)
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(TABLE)
    weights[top] = w[:k]
    return ToxicityModel(weights, float(w[k]))


def fit(texts: list[str], labels: np.ndarray, fairness: float = FAIRNESS) -> ToxicityModel:
    """Train on whole texts in memory."""
    return fit_examples(examples(labels, *example_rows(None, *utf8(pa.array(texts, pa.string())))), fairness)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text") -> ToxicityModel:
    """Fit on a bounded sample; its features, not its texts, come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in first_of_each(batches):
            row = 0
            for ids, buf, offsets in chunks([batch], ["id", "text"], 1 << 20):
                packed, differences = example_rows(ids, buf, offsets)
                yield pa.RecordBatch.from_arrays([ids, batch.column(2).slice(row, len(ids)), pa.array(packed, pa.binary()), pa.array(differences, pa.binary())], names=["id", "label", "packed", "differences"])
                row += len(ids)

    rows = labelled_sample(docs, labels, "toxic", sample, id_column, text_column)
    got = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, label int, packed binary, differences binary").toArrow()
    ids, packed, differences, label = (got[c].to_pylist() for c in ("id", "packed", "differences", "label"))
    del got
    order = sorted(range(len(ids)), key=lambda i: (ids[i], packed[i]))
    return fit_examples(examples(np.array([label[i] for i in order], float), [packed[i] for i in order], [differences[i] for i in order]))


def score_documents(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, buf, offsets in chunks(batches, [id_column, text_column]):
            yield pa.RecordBatch.from_arrays([ids, pa.array(held.value.score(buf, offsets))], names=[id_column, "score"])

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    model = train(docs, labels, sample, id_column, text_column)
    return with_decision(score_documents(docs, model, id_column, text_column), id_column, threshold)
