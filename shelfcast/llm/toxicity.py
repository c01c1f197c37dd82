"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is the concatenation of two learned vectors, one of a hash of the whole word and one of
another hash of its beginning, so a clash in one table alone does not imitate a word. Filters
of several widths slide over the whole text, the largest response of each is kept, and a logistic
layer scores them. Every labelled document is learned from or, a fifth of them, sets the thresholds by
language: shards of documents are learned from beside each other, and their changes averaged.
"""

import pickle
from collections import namedtuple
from copy import deepcopy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.common import discard, keep, record_batch, ship, slices, texts
from shelfcast.llm.labelled import label_share, one_label
from shelfcast.llm.pieces import DIGIT, LETTER, class_table, code_points, span_hashes

SLICE_BYTES = 1 << 20
# Words of one step over a long text.
BLOCK_WORDS = 1 << 15
# Characters of a shard, about; shards of long texts have fewer documents.
SHARD_CHARS = 32 << 20
# Numbers of the model in one row of the exchange that averages it.
SLICE_NUMBERS = 1 << 12
# Thresholds that are tried.
GRID = np.arange(5, 96) / 100


@dataclass(frozen=True)
class ToxicityParams:
    """Sizes of the model and of the shards it learns from."""

    # A shard has about twice as many documents; the number of shards has no bound.
    per_class: int = 3000
    buckets: int = 1 << 16
    half_dim: int = 8
    prefix: int = 4
    # Share of the words left out of a text at each step, so that no word hides the others.
    dropout: float = 0.5
    widths: tuple = (1, 2, 3)
    filters: int = 8
    # Gradient steps on the first shard, as many for a small one as for a full one.
    steps: int = 1500
    # Passes over all shards after that.
    passes: int = 2
    batch: int = 32
    rate: float = 0.08
    seed: int = 11
    threshold: float = 0.3


def word_rows(many, params):
    """Per text an array with two table rows per word: of the whole word, and of its beginning.

    Words are runs of letters and digits of the lower-cased text.
    """
    points, text_starts = code_points([t.lower() for t in many])
    kind = class_table()[points]
    change = np.diff(((kind == LETTER) | (kind == DIGIT)).astype(np.int8))
    starts, ends = np.flatnonzero(change == 1) + 1, np.flatnonzero(change == -1) + 1
    size = np.uint64(params.buckets)
    whole = span_hashes(points, starts, ends) % size
    begin = (span_hashes(points, starts, np.minimum(ends, starts + params.prefix)) >> 20) % size
    rows = np.stack([whole, begin], axis=1).astype(np.int32)
    return np.split(rows, np.searchsorted(starts, text_starts[1:])) if len(many) else []


@dataclass
class ToxicityModel:
    params: ToxicityParams
    tables: list  # two arrays, buckets x half_dim
    kernels: list  # per width an array, width x dim x filters
    biases: list  # per width an array of filters
    out: np.ndarray
    offset: float
    thresholds: dict = field(default_factory=dict)

    def vectors(self, ids):
        return np.concatenate([self.tables[0][ids[:, 0]], self.tables[1][ids[:, 1]]], axis=1)

    def responses(self, x):
        """Filter responses at every start, per width; texts are followed by empty words."""
        for kernel, bias in zip(self.kernels, self.biases):
            width = len(kernel)
            padded = np.concatenate([x, np.zeros((width - 1, x.shape[1]), x.dtype)])
            yield sum(padded[k : k + len(x)] @ kernel[k] for k in range(width)) + bias

    def pooled(self, ids, places=False):
        """Largest response of every filter, none below 0, and where it is."""
        size = len(self.params.widths) * self.params.filters
        best, at = np.zeros(size, np.float32), np.full(size, -1)
        reach = max(self.params.widths) - 1
        for start in range(0, len(ids), BLOCK_WORDS):
            x = self.vectors(ids[start : start + BLOCK_WORDS + reach])
            found = np.concatenate([r[:BLOCK_WORDS] for r in self.responses(x)], axis=1)
            top = found.max(axis=0)
            if places:
                at = np.where(top > best, start + found.argmax(axis=0), at)
            best = np.maximum(best, top)
        return (best, at) if places else best

    def score(self, ids):
        return float(1 / (1 + np.exp(-(self.pooled(ids) @ self.out + self.offset))))


def new_model(params):
    rng = np.random.default_rng(params.seed)
    dim = 2 * params.half_dim

    def normal(scale, *shape):
        return rng.normal(0, scale, shape).astype(np.float32)

    return ToxicityModel(
        params,
        [normal(0.1, params.buckets, params.half_dim) for _ in range(2)],
        [normal(0.5 / w**0.5, w, dim, params.filters) for w in params.widths],
        [np.zeros(params.filters, np.float32) for _ in params.widths],
        normal(0.3, len(params.widths) * params.filters),
        0.0,
    )


class Learner:
    """A model in training, with the squared gradients that Adagrad has seen."""

    def __init__(self, model):
        self.model = model
        self.dense = [*model.kernels, *model.biases, model.out]
        self.seen = [np.full_like(a, 1e-2) for a in self.dense]
        self.seen_tables = [np.full(model.params.buckets, 1e-2, np.float32) for _ in range(2)]
        self.seen_offset = 1e-2

    def step(self, batch, rng, weights=(1.0, 1.0)):
        """One gradient step on pairs (word rows, label); `weights` are those of labels 0 and 1.

        Only the places that won a filter pass their error on, so a step touches few words.
        """
        model, params, dense = self.model, self.model.params, self.dense
        f, half = params.filters, params.half_dim
        grads = [np.zeros_like(a) for a in dense]
        grad_offset, rows, row_grads = 0.0, ([], []), ([], [])
        for words, y in batch:
            words = words[rng.random(len(words)) >= params.dropout]
            best, at = model.pooled(words, places=True)
            p = 1 / (1 + np.exp(-(best @ model.out + model.offset)))
            error = weights[y] * (p - y) / len(batch)
            grads[-1] += error * best
            grad_offset += error
            back = error * model.out
            for j in np.flatnonzero((best > 0) & (at >= 0)):
                w, c = divmod(int(j), f)
                span = words[at[j] : at[j] + params.widths[w]]
                grads[w][: len(span), :, c] += back[j] * model.vectors(span)
                grads[len(params.widths) + w][c] += back[j]
                to_words = back[j] * model.kernels[w][: len(span), :, c]
                for side in range(2):
                    rows[side].append(span[:, side])
                    row_grads[side].append(to_words[:, side * half : (side + 1) * half])
        for a, g, s in zip(dense, grads, self.seen):
            s += g * g
            a -= params.rate * g / np.sqrt(s)
        self.seen_offset += grad_offset**2
        model.offset -= params.rate * grad_offset / self.seen_offset**0.5
        for side in range(2):
            if not rows[side]:
                continue
            row, place = np.unique(np.concatenate(rows[side]), return_inverse=True)
            g = np.zeros((len(row), half), np.float32)
            np.add.at(g, place, np.concatenate(row_grads[side]))
            self.seen_tables[side][row] += (g * g).mean(axis=1)
            step = params.rate * g / np.sqrt(self.seen_tables[side][row])[:, None]
            model.tables[side][row] -= step

    def repeat(self, data, weights=(1.0, 1.0)):
        """params.steps steps over the same pairs, in a new order each time."""
        params = self.model.params
        rng = np.random.default_rng(params.seed + 1)
        left = params.steps if data else 0
        while left > 0:
            order = rng.permutation(len(data))
            for first in range(0, len(order), params.batch)[:left]:
                left -= 1
                self.step([data[k] for k in order[first : first + params.batch]], rng, weights)

    def _arrays(self):
        return [*self.model.tables, *self.dense, *self.seen_tables, *self.seen]

    def numbers(self):
        """All numbers of the model and of its squared gradients in one array."""
        single = [self.model.offset, self.seen_offset]
        return np.concatenate([np.ravel(a) for a in (*self._arrays(), single)]).astype(np.float32)

    def move(self, change):
        """Add a change of numbers()."""
        start = 0
        for a in self._arrays():
            a += change[start : start + a.size].reshape(a.shape)
            start += a.size
        self.model.offset += float(change[start])
        self.seen_offset += float(change[start + 1])


def _log_odds(share):
    return float(np.log(share / (1 - share)))


def train(sample, params, prior=0.5):
    """Fit on a list of (text, label) pairs; `prior` is the true share of label 1."""
    model = new_model(params)
    data = [(word_rows([t], params)[0], y) for t, y in sample]
    if not data:
        model.offset = _log_odds(min(max(prior, 1e-6), 1 - 1e-6))
        return model
    Learner(model).repeat(data)
    share = float(np.mean([y for _, y in data]))
    if 0 < share < 1 and 0 < prior < 1:
        model.offset += _log_odds(prior) - _log_odds(share)
    return model


_STATE = pa.schema([("state", pa.binary())])
_CHANGE = pa.schema([("shard", pa.int64()), ("slice", pa.int32()), ("change", pa.binary())])


def _pairs(batches, label, params):
    """(shard, word rows, label) of every row, one slice of texts after the other."""
    for part in slices(batches, limit=SLICE_BYTES):
        words = word_rows(texts(part), params)
        yield from zip(part.column("shard").to_pylist(), words, part.column(label).to_pylist())


def _started(rows, label, params, weights):
    """A learner that has gone over the rows of one shard again and again, in one task."""

    def run(batches):
        data = [(words, y) for _, words, y in _pairs(batches, label, params)]
        learner = Learner(new_model(params))
        learner.repeat(data, weights)
        yield record_batch(_STATE, state=[pickle.dumps(learner)])

    one = rows.repartition(1).sortWithinPartitions("place")
    return pickle.loads(one.mapInArrow(run, "state binary").first()["state"])


def _mean_change(rows, label, learner, weights, turn):
    """Change of the learner's numbers by one pass over all shards, each from the same start.

    `rows` lie in files by shard, in order, so that a pass moves no texts.

    A number changes by the mean over the shards that move it, so a word of one shard is learned
    like one of all. One change per shard is shuffled; what the driver gets has a fixed size.
    """
    params = learner.model.params
    shared = rows.sparkSession.sparkContext.broadcast(learner)

    def changed(shard, pupil):
        change = pupil.numbers() - shared.value.numbers()
        starts = range(0, len(change), SLICE_NUMBERS)
        cut = [change[k : k + SLICE_NUMBERS].tobytes() for k in starts]
        return record_batch(_CHANGE, shard=[shard] * len(cut), slice=range(len(cut)), change=cut)

    def run(batches):
        current, pupil, batch, rng = None, None, [], None
        for shard, words, y in _pairs(batches, label, params):
            if shard != current:
                if batch:
                    pupil.step(batch, rng, weights)
                if pupil:
                    yield changed(current, pupil)
                current, pupil, batch = shard, deepcopy(shared.value), []
                rng = np.random.default_rng([params.seed, turn, shard])
            batch.append((words, y))
            if len(batch) == params.batch:
                pupil.step(batch, rng, weights)
                batch = []
        if batch:
            pupil.step(batch, rng, weights)
        if pupil:
            yield changed(current, pupil)

    def mean(found):
        found = found.sort_by("shard")
        changes = [np.frombuffer(c, np.float32) for c in found.column("change").to_pylist()]
        total, moved = 0.0, 0
        for change in changes:
            total, moved = total + change.astype(np.float64), moved + (change != 0)
        change = (total / np.maximum(moved, 1)).astype(np.float32).tobytes()
        return pa.table({"slice": found.column("slice")[:1], "change": [change]})

    changes = rows.mapInArrow(run, "shard long, slice int, change binary")
    means = changes.groupBy("slice").applyInArrow(mean, "slice int, change binary").collect()
    return np.frombuffer(b"".join(r["change"] for r in sorted(means)), np.float32)


def train_shards(rows, label, params, prior):
    """Fit on all rows of dealt(), however many; `prior` is the true share of label 1.

    The first shard is gone over until the model has made its steps; from there, each pass learns
    from all rows of all shards, beside each other, and takes the mean of the changes. Both labels
    weigh the same; the offset is then moved to the prior.
    """
    n, positive, first = rows.agg(F.count(F.lit(1)), F.sum(label), F.min("shard")).first()
    if not n:
        return train([], params, prior)
    share = positive / n
    weights = (0.5 / (1 - share), 0.5 / share) if 0 < share < 1 else (1.0, 1.0)
    learner = _started(rows.where(F.col("shard") == first), label, params, weights)
    for turn in range(params.passes):
        learner.move(_mean_change(rows, label, learner, weights, turn))
    if 0 < share < 1 and 0 < prior < 1:
        learner.model.offset += _log_odds(prior)
    return learner.model


# Documents of a language and label whose scores pass the same thresholds, and the last of these.
Tally = namedtuple("Tally", "score n")


def tallies(rows, label, model):
    """(Tally, label, lang) of all rows: at most 92 for each language and label."""
    scored = score_toxicity(rows, model)
    passed = sum((F.col("score") >= float(g)).cast("int") for g in GRID).alias("passed")
    counted = scored.groupBy("lang", label, passed).agg(F.count(F.lit(1)).alias("n")).collect()
    reached = [0.0, *GRID.tolist()]
    return [(Tally(reached[r["passed"]], r["n"]), r[label], r["lang"]) for r in counted]


def calibrate(model, sample, prior=None):
    """Thresholds by language from (text, label, lang): the best F1, ties to the nearest of
    the default; languages with under five of either label keep the default.

    A Tally may stand for its texts. `prior` is the true share of label 1 (that of the sample if
    None). Rows count by the true share of their label over its share of the whole sample, so F1
    does not depend on the sample's balance. Labels are sampled alike in all languages: the weights
    hold for each of them.
    """
    by, sizes = {}, [0, 0]
    for text, y, lang in sample:
        if not isinstance(text, Tally):
            text = Tally(model.score(word_rows([text], model.params)[0]), 1)
        by.setdefault(lang, []).append((*text, y))
        sizes[y] += text.n
    good = bad = 1.0
    if prior is not None and min(sizes) > 0 and 0 < prior < 1:
        good, bad = prior / sizes[1] * sum(sizes), (1 - prior) / sizes[0] * sum(sizes)
    for lang, found in by.items():
        scores, n, y = (np.array(column) for column in zip(*found))
        if min(n[y == 1].sum(), n[y == 0].sum()) < 5:
            continue
        hits = np.array([n[(scores >= g) & (y == 1)].sum() for g in GRID])
        false = np.array([n[(scores >= g) & (y == 0)].sum() for g in GRID])
        f1 = 2 * good * hits / (good * (hits + n[y == 1].sum()) + bad * false)
        best = np.flatnonzero(f1 == f1.max())
        default = model.params.threshold
        model.thresholds[lang] = float(GRID[best[np.abs(GRID[best] - default).argmin()]])
    return model


def dealt(docs, labels, label, params):
    """Text, lang and label of every labelled document, kept in files by shard, in a fixed order.

    Labels travel as rows of their own to the shard of their document and are read there, so that
    texts move once. The partitions are made by shard: whatever their number, a shard lies in one of
    them; there are more than shards, so that few share one. `held` marks a fifth of the documents,
    chosen by a hash.
    """
    found = keep(one_label(labels, label), "labels")
    many = docs.agg(F.count("text"), F.sum(F.length("text").cast("long"))).first()
    n = min(found.count(), many[0])
    chars = n * (many[1] or 0) // max(many[0], 1)
    shards = 1 + max(n // (2 * params.per_class), chars // SHARD_CHARS)
    texts = docs.select(F.col("doc_id").cast("long"), "text", "lang").where(F.col("text").isNotNull())
    found_by = found.select(F.col("doc_id").cast("long"), label)
    both = (
        texts.unionByName(found_by, allowMissingColumns=True)
        .where(F.col("doc_id").isNotNull())
        .withColumn("shard", F.pmod(F.hash("doc_id"), F.lit(shards)).cast("long"))
        .repartition(4 * shards, "shard")
    )
    labelled = both.withColumn(label, F.max(label).over(Window.partitionBy("shard", "doc_id")))
    rows = labelled.where(F.col("text").isNotNull() & F.col(label).isNotNull()).select(
        "text",
        "lang",
        label,
        "shard",
        F.xxhash64(F.lit(params.seed), "doc_id", "text").alias("place"),
        (F.xxhash64("doc_id") % 5 == 0).alias("held"),
    )
    kept = keep(rows.sortWithinPartitions("shard", "place"), "labelled", compression="zstd")
    discard(found)
    return kept


def fit_toxicity(docs, labels, label="toxic", params=ToxicityParams()):
    """Train on all labelled documents, whole texts of any length.

    A fifth of them, chosen by a hash, is kept for the thresholds; they weight it to the true
    share of label 1. Without labelled documents every score is that share (a half if unknown).
    """
    ship(docs.sparkSession)
    rows = dealt(docs, labels, label, params)
    prior = label_share(labels, label)
    model = train_shards(rows.where("NOT held"), label, params, prior)
    model = calibrate(model, tallies(rows.where("held"), label, model), prior)
    discard(rows)
    return model


SCORE_SCHEMA = pa.schema([("score", pa.float64()), ("threshold", pa.float64())])


def score_toxicity(docs, model):
    """The rows and columns of `docs` with score and threshold; whole texts are read.

    Null and empty texts have no words: their score is that of the model without any response.
    Languages without a threshold of their own, null included, take the default. Columns of
    `docs` named score or threshold are replaced. Rows are independent of each other.
    """
    docs = docs.drop("score", "threshold")
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        default = fitted.params.threshold
        for part in slices(batches, limit=SLICE_BYTES):
            scores = [fitted.score(rows) for rows in word_rows(texts(part), fitted.params)]
            limits = [fitted.thresholds.get(x, default) for x in part.column("lang").to_pylist()]
            new = record_batch(SCORE_SCHEMA, score=scores, threshold=limits)
            names = [*part.schema.names, *SCORE_SCHEMA.names]
            yield pa.RecordBatch.from_arrays([*part.columns, *new.columns], names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join([*fields, "score double", "threshold double"]))
