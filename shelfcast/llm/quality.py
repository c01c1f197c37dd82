"""Quality: supervised subword embeddings, averaged per document, trained in numpy.

A document is the mean of the learned vectors of its words, of the character n-grams inside
them and of its word pairs, all hashed into one table; a softmax layer scores the mean. A word
followed by itself is a pair of its own kind, the same for all words. Since the output layer
is linear, scoring needs one number per feature.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from shelfcast.llm.common import record_batch, ship, slices, texts
from shelfcast.llm.labelled import balanced_sample, label_share
from shelfcast.llm.pieces import OTHER, SPACE, class_table, code_points, span_hashes

SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class QualityParams:
    """Sizes of the model and bounds of the sample it is fitted on."""

    per_class: int = 2000
    max_chars: int = 60_000
    buckets: int = 1 << 18
    dim: int = 10
    grams: tuple = (1, 2, 3, 4)
    epochs: int = 6
    rate: float = 4.0
    seed: int = 5


_STEP = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xC2B2AE3D27D4EB4F)


def feature_rows(many, params):
    """Table rows of all features of the texts, and the text each belongs to.

    Yields one pair of arrays per kind of feature: words, pairs of neighbouring words (equal
    neighbours share row 0), and character n-grams inside a word and its two borders.
    """
    points, text_starts = code_points(many)
    blank = class_table()[points] >= SPACE
    blank[class_table()[points] == OTHER] = False
    owner = np.zeros(len(points), np.int32)
    owner[text_starts[1:]] = 1
    owner = np.cumsum(owner, dtype=np.int32)
    shift = np.uint64(64 - (params.buckets.bit_length() - 1))

    change = np.diff(blank.astype(np.int8))
    starts, ends = np.flatnonzero(change == -1) + 1, np.flatnonzero(change == 1) + 1
    words = span_hashes(points, starts, ends)
    yield ((words * _TURN) >> shift).astype(np.int64), owner[starts]
    left, right, of = words[:-1], words[1:], owner[starts]
    rows = (((left * _STEP + right) * _TURN) >> shift).astype(np.int64)
    inside = of[:-1] == of[1:]
    yield np.where(left == right, 0, rows)[inside], of[:-1][inside]

    marked = np.where(blank, 32, points).astype(np.uint64)
    inner = np.concatenate([[0], np.cumsum(blank)])
    running = np.zeros(len(points), np.uint64)
    for n in range(1, max(params.grams) + 1):
        size = len(points) - n + 1
        running = running[:size] * _STEP + marked[n - 1 :] + np.uint64(n)
        if n not in params.grams or size <= 0:
            continue
        # No blank but at one of the borders, and not in a single character.
        clean = inner[n - 1 : n - 1 + size] - inner[1 : 1 + size] == 0 if n > 1 else ~blank
        if n == 2:
            clean = ~(blank[:-1] & blank[1:])
        elif n > 2:
            clean &= ~(blank[:size] & blank[n - 1 :])
        at = np.flatnonzero(clean)
        # A gram that begins with the blank before a text's first word belongs to that text.
        yield ((running[at] * _TURN) >> shift).astype(np.int64), owner[at + (blank[at] & (n > 1))]


def document_features(text, params):
    """Distinct table rows of a text and how often each occurs."""
    rows = np.concatenate([rows for rows, _ in feature_rows([text], params)])
    distinct, counts = np.unique(rows, return_counts=True)
    return distinct, counts.astype(np.float32)


@dataclass
class QualityModel:
    """The fitted vectors as one number per feature: the softmax of two classes needs no more."""

    params: QualityParams
    value: np.ndarray
    offset: float


def train(sample, params, prior=0.5):
    """Stochastic gradient descent on (text, label) pairs with a falling rate."""
    rng = np.random.default_rng(params.seed)
    table = rng.uniform(-1, 1, (params.buckets, params.dim)).astype(np.float32) / params.dim
    out, bias = np.zeros((params.dim, 2), np.float32), np.zeros(2, np.float32)
    data = [(*document_features(t, params), y) for t, y in sample]
    steps = params.epochs * len(data)
    done = 0
    for _ in range(params.epochs):
        for k in rng.permutation(len(data)):
            rows, counts, y = data[k]
            rate = params.rate * (1 - done / steps)
            done += 1
            if not len(rows):
                continue
            share = counts / counts.sum()
            mean = share @ table[rows]
            raw = mean @ out + bias
            p = np.exp(raw - raw.max())
            error = p / p.sum()
            error[y] -= 1
            back = out @ error
            out -= 0.1 * rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            table[rows] -= rate * share[:, None] * back
    offset = float(bias[1] - bias[0])
    share = float(np.mean([y for *_, y in data])) if data else 0.5
    if 0 < share < 1 and 0 < prior < 1:
        offset += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return QualityModel(params, (table @ (out[:, 1] - out[:, 0])).astype(np.float64), offset)


def scores(many, model):
    """Scores of many texts; a text without features has the score of the offset."""
    total, number = np.zeros(len(many)), np.zeros(len(many))
    for rows, owner in feature_rows(many, model.params):
        total += np.bincount(owner, model.value[rows], len(many))
        number += np.bincount(owner, minlength=len(many))
    raw = total / np.maximum(number, 1) + model.offset
    return 1 / (1 + np.exp(-np.clip(raw, -60, 60)))


def fit_quality(docs, labels, label="quality", params=QualityParams()):
    """Train on a balanced sample of labelled documents of at most 2 * params.per_class ids.

    Without labelled documents every score is the share of label 1 (a half if unknown).
    """
    sample = balanced_sample(docs, labels, label, params.per_class, params.max_chars)
    rows = sorted(sample.collect(), key=lambda r: (r["doc_id"], r["text"]))
    pairs = [(r["text"], r[label]) for r in rows]
    return train(pairs, params, label_share(labels, label))


def score_quality(docs, model):
    """doc_id and score of every row; whole texts are read.

    Null and empty texts have no features: their score is that of the offset alone. doc_id may be
    null or repeated; other columns are left behind.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for part in slices(batches, limit=SLICE_BYTES):
            found = scores(texts(part), shared.value)
            yield record_batch(schema, doc_id=part.column("doc_id"), score=found)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
