"""Secret scans: a linear-chain conditional random field beside fixed patterns.

Tokens are runs of letters and digits, or single other characters, each outside a secret, at its begin or
inside. A learned secret has no blanks and a least length, so all tokens elsewhere are outside and
only those of solid runs of that length are scored, with what stands around them. A token's scores come from its shape, length and characters, the
words and shapes around it, and features of the whole file; neighbouring tags have scores of their
own. The field is fitted on the driver on a bounded sample of texts, tagged by the fixed patterns;
words are hidden at random, so that shapes must do. Decoding is Viterbi over the whole text: chains
are cut into blocks whose 3 x 3 score maps are computed side by side and joined, which is exact.
"""

import re
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm.common import discard, keep, record_batch, ship, slices, texts
from shelfcast.llm.pieces import (
    DIGIT,
    EDGE,
    LETTER,
    OTHER,
    SPACE,
    class_table,
    code_points,
    flat_spans,
    keyed_hashes,
    mix,
)

SLICE_BYTES = 1 << 20
# Kinds in their order, their patterns, the group whose length counts, and its least.
PATTERNS = (
    (
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
LEARNED = "crf"
KINDS = (*(kind for kind, *_ in PATTERNS), LEARNED)
# Texts that may hold a match; keeps long runs of short ones out of the sample.
HINTS = r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}|(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]"

OUTSIDE, BEGIN, INSIDE = range(3)
NEVER = -1e6


@dataclass(frozen=True)
class SecretParams:
    """Bounds of the sample and of the fit.

    per_class    texts with and without a hint that are learned from, at most;
    max_chars    longer texts are not learned from;
    size         hashed weights per tag;  hidden  share of tokens whose word features are dropped;
    shortest     characters of a learned span, at least;  margin  score by which it must win.
    """

    per_class: int = 1500
    max_chars: int = 20_000
    size: int = 1 << 16
    window: int = 24
    quiet: int = 2
    rounds: int = 6
    batch: int = 256
    rate: float = 0.2
    decay: float = 1e-6
    hidden: float = 0.8
    block: int = 256
    shortest: int = 12
    margin: float = 0.5
    seed: int = 12


_COMPILED = tuple(
    (re.compile(pattern, re.ASCII | (re.IGNORECASE if kind == "assign" else 0)), group, least)
    for kind, pattern, group, least in PATTERNS
)
_KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", re.ASCII | re.IGNORECASE)
_LONG_HEX = re.compile(r"[0-9a-f]{16,}", re.ASCII)


def base_spans(text):
    """(start, kind number, end, secret's start) of the fixed patterns, by start, then kind."""
    found = []
    for kind, (pattern, group, least) in enumerate(_COMPILED):
        if kind == 0 and not _KEYWORD.search(text):
            continue
        # A run of hex digits is long enough exactly if it matches as a long one.
        matcher = _LONG_HEX if kind == 2 else pattern
        for m in matcher.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), kind, m.end(), m.start(group)))
    return sorted(found)


# Features of tokens ------------------------------------------------------------------------------

# Classes of characters in a shape: capital, small, digit, other letter, other.
_SHAPE = np.full(0x110001, 4, np.uint8)
_SHAPE[ord("A") : ord("Z") + 1] = 0
_SHAPE[ord("a") : ord("z") + 1] = 1
_SHAPE[ord("0") : ord("9") + 1] = 2
_LONGEST_WORD = 14
FEATURES = (
    "one", "shape", "length", "word", "before", "after", "second before", "shape before",
    "shape after", "mixture", "variety", "runs", "file signs", "file size",
)
WORDLY = (3, 4, 5, 6)


class Tokens:
    """The tokens of long solid runs of some texts, their feature numbers and their chain.

    `line` lists the tokens in order with -1, a token outside, after every run.
    """

    def __init__(self, many, size, shortest):
        points, self.text_starts = code_points(many)
        kind = class_table()[points]
        word = (kind == LETTER) | (kind == DIGIT)
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        single = kind == OTHER
        starts = np.flatnonzero(begins | single)
        stops = word
        stops[:-1] &= ~word[1:]
        ends = np.flatnonzero(stops | single) + 1
        solid = (kind != SPACE) & (kind != EDGE)
        change = np.diff(solid.astype(np.int8))
        first, last = np.flatnonzero(change == 1) + 1, np.flatnonzero(change == -1) + 1
        long = last - first >= shortest
        run = np.searchsorted(first, starts, "right") - 1
        chosen = np.flatnonzero(long[run]) if len(run) else run
        self.starts, self.ends = starts[chosen], ends[chosen]
        self.text = np.searchsorted(self.text_starts, self.starts, "right") - 1
        closes = np.flatnonzero(np.diff(np.append(run[chosen], -1)))
        self.line = np.insert(np.arange(len(chosen)), closes + 1, -1)
        self.features = np.zeros((len(FEATURES), 0), np.int32)
        if len(chosen):
            self.features = self._features(points, kind, starts, ends, chosen, size)

    def _features(self, points, kind, starts, ends, chosen, size):
        n, length = len(chosen), self.ends - self.starts
        near = chosen[:, None] + np.arange(-2, 2)
        near = near[(near >= 0) & (near < len(starts))]
        need = np.unique(near)
        flat, at = flat_spans(starts[need], ends[need])
        letters, kinds = points[flat], kind[flat]
        shape = _SHAPE[letters]
        shape[(shape == 4) & (kinds == LETTER)] = 3
        # A shape names each run of one class once; signs stand for themselves.
        coded = np.where(kinds == OTHER, letters.astype(np.int64) + 8, shape)
        change = np.ones(len(flat), bool)
        change[1:] = coded[1:] != coded[:-1]
        change[at[:-1]] = True
        kept = np.flatnonzero(change)
        bounds = np.searchsorted(kept, at)
        stop = np.minimum(at[1:], at[:-1] + _LONGEST_WORD + 1)
        named = keyed_hashes(letters + 32 * (shape == 0), at[:-1], stop, 9)
        named[np.diff(at) > _LONGEST_WORD] = 1
        shapes, words = np.zeros((2, len(starts)), np.uint64)
        shapes[need] = keyed_hashes(coded[kept], bounds[:-1], bounds[1:], 7)
        words[need] = named
        own = np.searchsorted(need, chosen)
        runs = np.diff(bounds)[own]
        low, high = at[own], at[own + 1]
        shares = []
        for c in (0, 1, 2):
            sums = np.append(0, np.cumsum(shape == c))
            shares.append(4 * (sums[high] - sums[low]) // length)
        coarse = np.minimum(length, 40) // 4
        mixture = ((shares[0] * 5 + shares[1]) * 5 + shares[2]) * 8 + np.minimum(runs, 7)
        # Features of the file: its share of signs and its size.
        edges = np.append(self.text_starts, len(points))
        signs = np.append(0, np.cumsum(kind == OTHER))[edges]
        solid = np.append(0, np.cumsum((kind != SPACE) & (kind != EDGE)))[edges]
        share_of_signs = 16 * np.diff(signs) // np.maximum(np.diff(solid), 1)
        log_size = np.log2(np.diff(edges) + 1).astype(np.int64)

        def beside(values, by):
            """The value of the token `by` further on, 0 where that lies in another text."""
            place = np.clip(chosen + by, 0, len(starts) - 1)
            other = np.searchsorted(self.text_starts, starts[place], "right") - 1 != self.text
            return np.where(other | (place != chosen + by), np.uint64(0), values[place])

        columns = [
            np.zeros(n, np.uint64), shapes[chosen], np.minimum(length, 48), words[chosen],
            beside(words, -1), beside(words, 1), beside(words, -2),
            beside(shapes, -1), beside(shapes, 1), mixture,
            self._variety(points) * 16 + coarse, np.minimum(runs, 15) * 16 + coarse,
            share_of_signs[self.text] * 16 + coarse, log_size[self.text] * 16 + coarse,
        ]
        out = np.empty((len(columns), n), np.int32)
        for k, column in enumerate(columns):
            key = np.asarray(column).astype(np.uint64)
            out[k] = mix(key + np.uint64((k + 1) * 0xD1B54A32D192ED03 & (2**64 - 1))) % np.uint64(size)
        return out

    def _variety(self, points):
        """Number of different characters of longer tokens, up to 15."""
        out = np.zeros(len(self.starts), np.int64)
        long = np.flatnonzero(self.ends - self.starts >= 8)
        if len(long):
            flat, at = flat_spans(self.starts[long], self.ends[long])
            owner = np.repeat(np.arange(len(long)), np.diff(at))
            met = np.unique(owner << 21 | points[flat]) >> 21
            out[long] = np.minimum(np.bincount(met, minlength=len(long)), 15)
        return out

    def tags(self, spans):
        """Tags along the line from (text, start, end) of secrets in code points of their text."""
        tags = np.zeros(len(self.starts), np.int8)
        for text, start, end in spans:
            origin = self.text_starts[text]
            first = np.searchsorted(self.ends, origin + start, "right")
            last = np.searchsorted(self.starts, origin + end, "left")
            if first < last:
                tags[first:last] = INSIDE
                tags[first] = BEGIN
        return np.where(self.line < 0, OUTSIDE, np.append(tags, 0)[self.line])


# The field --------------------------------------------------------------------------------------


@dataclass
class SecretModel:
    params: SecretParams
    weights: np.ndarray  # size x 3
    moves: np.ndarray  # 3 x 3, from tag to tag


def _no_moves():
    moves = np.zeros((3, 3))
    moves[OUTSIDE, INSIDE] = NEVER
    return moves


def log_likelihood(scores, moves, tags):
    """Log-likelihood of tagged chains, tag and move probabilities; chains are (n, steps, 3).

    Forward and backward sums; a chain can't start inside a secret that began before it.
    """
    n, steps, _ = scores.shape
    forward = np.empty_like(scores)
    backward = np.zeros_like(scores)
    forward[:, 0] = scores[:, 0]
    for t in range(1, steps):
        forward[:, t] = scores[:, t] + _log_sum(forward[:, t - 1, :, None] + moves, 1)
    for t in range(steps - 2, -1, -1):
        backward[:, t] = _log_sum(moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
    total = _log_sum(forward[:, -1], 1)
    tag_share = np.exp(forward + backward - total[:, None, None])
    pair = (
        forward[:, :-1, :, None]
        + moves
        + (scores[:, 1:] + backward[:, 1:])[:, :, None, :]
        - total[:, None, None, None]
    )
    rows = np.arange(n)[:, None]
    path = scores[rows, np.arange(steps), tags].sum(1) + moves[tags[:, :-1], tags[:, 1:]].sum(1)
    return path - total, tag_share, np.exp(pair)


def _log_sum(values, axis):
    top = values.max(axis=axis)
    return top + np.log(np.exp(values - np.expand_dims(top, axis)).sum(axis=axis))


def _windows(tags, params, rng):
    """Starts of the chains to learn from: around every secret, and some elsewhere."""
    spots = np.flatnonzero(tags == BEGIN)
    quiet = rng.integers(0, len(tags), -(-len(tags) * params.quiet // params.window))
    return np.maximum(np.concatenate([spots - rng.integers(2, 12, len(spots)), quiet]), 0)


# Letters that redrawn secrets are made of.
ALPHABETS = (
    "0123456789abcdef",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-/+",
)


def _redrawn(text, spans, rng):
    """The text with its secrets replaced by random ones of other alphabets, of the same length."""
    out = list(text)
    for start, end in spans:
        letters = ALPHABETS[rng.integers(len(ALPHABETS))]
        out[start:end] = [letters[k] for k in rng.integers(0, len(letters), end - start)]
    return "".join(out)


def _chains(many, params, rng):
    """Feature numbers (chains x window x features) and tags of the chains of some texts.

    Each text with secrets is learned a second time with redrawn ones.
    """
    marked = [[(secret, end) for _, _, end, secret in base_spans(text)] for text in many]
    many = list(many)
    for k in [k for k, spans in enumerate(marked) if spans]:
        many.append(_redrawn(many[k], marked[k], rng))
        marked.append(marked[k])
    tokens = Tokens(many, params.size, params.shortest)
    tags = tokens.tags([(k, *span) for k, spans in enumerate(marked) for span in spans])
    if not len(tags):
        return np.zeros((0, params.window, len(FEATURES)), np.int32), np.zeros((0, params.window), np.int8)
    places = _windows(tags, params, rng)[:, None] + np.arange(params.window)
    # Steps beyond the end are outside, like those between two runs.
    line = np.append(tokens.line, -1)[np.minimum(places, len(tags))]
    chains = np.append(tokens.features, np.full((len(FEATURES), 1), params.size, np.int32), 1)
    chains = chains[:, line].transpose(1, 2, 0)
    wanted = np.append(tags, OUTSIDE)[np.minimum(places, len(tags))].astype(np.int8)
    # A secret that is cut by the window's start begins there.
    wanted[:, 0] = np.where(wanted[:, 0] == INSIDE, BEGIN, wanted[:, 0])
    broken = (wanted[:, 1:] == INSIDE) & (wanted[:, :-1] == OUTSIDE)
    wanted[:, 1:][broken] = BEGIN
    return chains.astype(np.int32), wanted


def fit_tagged(many, params=SecretParams()):
    """Fit the field on texts tagged by the fixed patterns, by stochastic gradients in numpy."""
    rng = np.random.default_rng(params.seed)
    weights = np.zeros((params.size + 1, 3))  # the last row stands for no feature
    moves = _no_moves()
    parts = [_chains(many[k : k + 100], params, rng) for k in range(0, len(many), 100)]
    if not any(wanted.any() for _, wanted in parts):
        weights[:, BEGIN:] = NEVER  # nothing to learn from: no learned spans
        return SecretModel(params, weights[:-1].astype(np.float32), moves)
    chains, wanted = (np.concatenate(p) for p in zip(*parts))
    del parts
    squares, move_squares = np.full_like(weights, 1e-6), np.full((3, 3), 1e-6)
    for _ in range(params.rounds):
        order = rng.permutation(len(chains))
        for k in range(0, len(order), params.batch):
            part = order[k : k + params.batch]
            ids, truth = chains[part], wanted[part].astype(np.int64)
            between = ids[:, :, 0] == params.size
            hide = rng.random(truth.shape) < params.hidden
            for f in WORDLY:
                ids[:, :, f][hide] = params.size
            scores = weights[ids].sum(axis=2)
            scores[:, 0, INSIDE] = NEVER
            scores[between, BEGIN:] = NEVER
            _, tag_share, pair = log_likelihood(scores, moves, truth)
            slope = np.eye(3)[truth] - tag_share
            gradient = np.zeros_like(weights)
            flat = ids.reshape(-1)
            spread = np.repeat(slope.reshape(-1, 3), ids.shape[2], axis=0)
            for tag in range(3):
                gradient[:, tag] = np.bincount(flat, spread[:, tag], len(weights))
            gradient[-1] = 0
            gradient -= params.decay * weights * len(part)
            squares += gradient**2
            weights += params.rate * gradient / np.sqrt(squares)
            seen = np.zeros((3, 3))
            np.add.at(seen, (truth[:, :-1], truth[:, 1:]), 1)
            move_slope = seen - pair.sum(axis=(0, 1))
            move_squares += move_slope**2
            step = params.rate * move_slope / np.sqrt(move_squares)
            moves = np.where(moves <= NEVER, NEVER, moves + step)
    return SecretModel(params, weights[:-1].astype(np.float32), moves)


def viterbi(scores, moves, block):
    """Best tags of one long chain, (n, 3) scores; the first tag can't be inside.

    The chain is cut into blocks. All blocks advance together and give the best score from every
    tag before the block to every tag at its end; the short chain of blocks is joined, and
    the way back is read in all blocks at once.
    """
    n = len(scores)
    if not n:
        return np.zeros(0, np.int8)
    count = -(-n // block)
    padded = np.zeros((count * block, 3))
    padded[:n] = scores
    steps = padded.reshape(count, block, 3).transpose(1, 0, 2)
    # Steps beyond the end leave every tag as it is.
    real = (np.arange(count * block) < n).reshape(count, block).T
    stay = np.where(np.eye(3, dtype=bool), 0.0, 3 * NEVER)
    maps = stay + np.zeros((count, 1, 1))
    for step, live in zip(steps, real):
        turned = (maps[:, :, :, None] + moves).max(axis=2) + step[:, None, :]
        maps = np.where(live[:, None, None], turned, maps)
    best = np.empty((count, 3))
    before = np.array([0.0, 3 * NEVER, 3 * NEVER])  # outside, before the first token
    for k in range(count):
        best[k] = before
        before = (before[:, None] + maps[k]).max(axis=0)
        before = before - before.max()
    came = np.empty((block, count, 3), np.int8)
    value = best
    for t, (step, live) in enumerate(zip(steps, real)):
        paths = value[:, :, None] + np.where(live[:, None, None], moves, stay)
        came[t] = paths.argmax(axis=1)
        value = paths.max(axis=1) + step
    # For each tag at a block's end, the tag before the block.
    back = np.broadcast_to(np.arange(3, dtype=np.int8), (count, 3))
    rows = np.arange(count)
    for t in range(block - 1, -1, -1):
        back = came[t][rows[:, None], back]
    ends = np.empty(count, np.int8)
    tag = int(value[-1].argmax())
    for k in range(count - 1, -1, -1):
        ends[k] = tag
        tag = int(back[k, tag])
    tags = np.empty((block, count), np.int8)
    now = ends
    for t in range(block - 1, -1, -1):
        tags[t] = now
        now = came[t][rows, now]
    return tags.T.reshape(-1)[:n]


class SecretScanner:
    def __init__(self, model):
        self.model = model

    def learned_spans(self, many):
        """(start, end) of the spans the field finds in each text, in code points.

        All runs follow each other in one chain, each with an outside token after it.
        """
        params = self.model.params
        tokens = Tokens(many, params.size, params.shortest)
        scores = np.zeros((len(tokens.starts) + 1, 3))
        for row in tokens.features:
            scores[:-1] += self.model.weights[row]
        # A margin in favour of outside keeps doubtful spans out.
        scores[:, BEGIN] -= params.margin
        scores[-1] = 0.0, NEVER, NEVER
        tags = viterbi(scores[tokens.line], self.model.moves, params.block)
        first = np.flatnonzero(tags == BEGIN)
        closed = np.flatnonzero(tags != INSIDE)
        nexts = closed[np.searchsorted(closed, first, "right")] if len(first) else first
        spans = [[] for _ in many]
        for f, e in zip(tokens.line[first].tolist(), tokens.line[nexts - 1].tolist()):
            text = int(tokens.text[f])
            origin = tokens.text_starts[text]
            start, end = int(tokens.starts[f] - origin), int(tokens.ends[e] - origin)
            if end - start >= params.shortest:
                spans[text].append((start, end))
        return spans

    def scan(self, many):
        """(base spans, all spans) of each text as (start, kind number, end), in order."""
        out = []
        for text, learned in zip(many, self.learned_spans(many)):
            base = [(s, kind, e) for s, kind, e, _ in base_spans(text)]
            more = [
                (s, len(PATTERNS), e)
                for s, e in learned
                if not any(s < b_end and b_start < e for b_start, _, b_end in base)
            ]
            out.append((base, sorted(base + more)))
        return out


def span_list(spans):
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def fit_secrets(docs, params=SecretParams()):
    """Fit on at most 2 * per_class texts of `docs` (text), chosen by a hash of the text.

    Half of them may hold a match of the patterns. Null and longer texts are not learned from.
    """
    bounded = docs.select("text").where(
        F.col("text").isNotNull() & (F.length("text") <= params.max_chars)
    )
    coded = bounded.select("text", F.xxhash64("text").alias("order"))
    hinted = keep(coded.select("order", F.col("text").rlike(HINTS).alias("hinted")), "hinted")
    orders = hinted.select("hinted", "order").distinct()
    parts = [
        orders.where(F.col("hinted") == value).orderBy("order").limit(params.per_class)
        for value in (True, False)
    ]
    # At most 2 * per_class numbers; copies of a text are one.
    picked = coded.join(F.broadcast(parts[0].union(parts[1])), "order")
    rows = picked.groupBy("hinted", "order").agg(F.min("text").alias("text")).collect()
    discard(hinted)
    chosen = [r["text"] for r in sorted(rows, key=lambda r: (r["hinted"], r["order"]))]
    return fit_tagged(chosen, params)


SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)


def scan_secrets(docs, model):
    """Secrets of every row of `docs`: counts by pattern, digest of their spans, all spans.

    Spans are kind:start:end in code points, end exclusive, comma-joined by start, then kind. Spans
    of the patterns always stay; the field adds spans (crf) that touch none of them. Null and
    empty texts have none ('' and its digest). Rows are independent; repeated rows stay, doc_id
    may be null, other columns are ignored.
    """
    ship(docs.sparkSession)
    source = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scanner = SecretScanner(source.value)
        for part in slices(batches, limit=SLICE_BYTES):
            found = scanner.scan(texts(part))
            counts = [[sum(k == kind for _, k, _ in base) for base, _ in found] for kind in range(3)]
            digests = [sha256(span_list(base).encode()).hexdigest() for base, _ in found]
            yield record_batch(
                SCANNED,
                doc_id=part.column("doc_id"),
                n_assign=counts[0],
                n_access=counts[1],
                n_hex=counts[2],
                base_sha256=digests,
                spans=[span_list(spans) for _, spans in found],
            )

    kind = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, kind)
