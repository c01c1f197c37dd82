"""Cross-tokenizer alignment: the token ends of two tokenizers merged by merge-path partitioning.

Both tokenizers cut the same bytes; their tokens' end offsets are two sorted lists. Diagonals of equal
distance through the grid of both lists are searched by bisection for the place where the merged order
crosses them. They divide the merging into pieces of equal work that don't depend on each other;
all pieces advance together, each emits the offsets where both lists end a token, and groups that
cross a piece border are stitched from the pieces' first and last such offsets.

Tokens that end together have bytes of which one is the end of the other. So the vocabularies alone
bound the number of different id pairs, and the corpus-wide count of every pair fits a broadcast.
"""

import json
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from shelfcast.llm.bpe_rules import byte_letters, read_tokenizer
from shelfcast.llm.common import keep, record_batch, ship, slices, texts

SLICE_BYTES = 1 << 20
# Merge steps of one piece.
WORK = 64
# Fixed value: how byte-level vocabularies of this kind split a text before merging.
SPLIT = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
BLANK = "▁"


class ByteSide:
    """Ids and token bytes of a byte-level BPE file; special strings in texts are plain text."""

    def __init__(self, source):
        spec = json.loads(source)
        special = {t["content"] for t in spec["added_tokens"]}
        to_byte = {letter: b for b, letter in byte_letters().items()}
        vocab = {w: i for w, i in spec["model"]["vocab"].items() if w not in special}
        self.token_bytes = [b""] * (max(vocab.values()) + 1)
        for word, token in vocab.items():
            self.token_bytes[token] = bytes(to_byte[c] for c in word)
        self._check(spec, vocab)
        ranks = {self.token_bytes[i]: i for i in vocab.values()}
        self.encoding = tiktoken.Encoding(
            "bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
        )

    @staticmethod
    def _check(spec, vocab):
        """Refuse files whose ids don't follow the order of their merges or that split otherwise."""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        built = [vocab["".join(p)] for p in pairs]
        splitter = spec.get("pre_tokenizer") or {}
        if (
            built != sorted(built)
            or splitter.get("type") != "ByteLevel"
            or splitter.get("add_prefix_space")
            or spec.get("normalizer")
        ):
            raise ValueError("not a byte-level BPE file whose ids are the ranks of its merges")

    def encode_many(self, many):
        return [self.encoding.encode_ordinary(" " + t) for t in many]


class PieceSide:
    """Ids and token bytes of a sentencepiece model, which puts a blank before the text itself."""

    def __init__(self, model):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.token_bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, token):
        piece = self.model.id_to_piece(token)
        if self.model.is_byte(token):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(BLANK, " ").encode()

    def encode_many(self, many):
        return self.model.encode(many, num_threads=1)


def suffix_pairs(left, right):
    """Sorted codes a << 32 | b of all ids whose bytes could end together.

    One token's bytes end with the other's, so there are at most as many as both
    vocabularies have bytes (times the ids that share their bytes).
    """
    codes = set()
    for tokens, others, swap in ((left, right, False), (right, left, True)):
        ids = {}
        for token, word in enumerate(others):
            if word:
                ids.setdefault(word, []).append(token)
        for token, word in enumerate(tokens):
            for start in range(len(word)):
                for other in ids.get(word[start:], ()):
                    codes.add((other << 32 | token) if swap else (token << 32 | other))
    return np.array(sorted(codes), np.int64)


def diagonal_cuts(a, b, work):
    """Where every `work`-th diagonal is crossed: ends of `a` and of `b` merged by then.

    An end of `a` goes before an equal end of `b`.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while True:
        searched = np.flatnonzero(low < high)
        if not len(searched):
            return low, diagonal - low
        middle = (low[searched] + high[searched]) // 2
        first = a[middle] <= b[diagonal[searched] - middle - 1]
        low[searched[first]] = middle[first] + 1
        high[searched[~first]] = middle[~first]


def common_ends(a, b, work=WORK):
    """Indexes (i, j) of all equal ends a[i] == b[j] of two sorted lists, in order.

    All pieces advance step by step together; a piece sees an end of `a` merged by the piece before it
    through the list itself. Joining what the pieces emit, in their order, stitches the
    groups that cross a border: a group starts after the last common end of any earlier piece.
    """
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut_a, cut_b = diagonal_cuts(a, b, work)
    beyond = max(a[-1], b[-1]) + 1
    a, b = np.append(a, beyond), np.append(b, beyond)
    i, j = cut_a[:-1].copy(), cut_b[:-1].copy()
    steps = (cut_a + cut_b)[1:] - (i + j)
    pieces = len(i)
    found_i = np.full((pieces, work), -1, np.int64)
    found_j = np.full((pieces, work), -1, np.int64)
    for step in range(int(steps.max())):
        active = steps > step
        from_a = a[i] <= b[j]
        met = active & ~from_a & (i > 0)
        met &= a[i - 1] == b[j]
        found_i[met, step], found_j[met, step] = i[met] - 1, j[met]
        i += active & from_a
        j += active & ~from_a
    emitted = found_i >= 0
    return found_i[emitted], found_j[emitted]


@dataclass
class SliceAlignment:
    """Groups of the texts of one slice; token and group bounds of each text."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    tokens_a: np.ndarray  # per text: its first token among ids_a, one more at the end
    tokens_b: np.ndarray
    last_a: np.ndarray  # per group: its last token
    last_b: np.ndarray
    groups: np.ndarray  # per text: its first group, one more at the end


class Aligner:
    """Encodes with both tokenizers and aligns."""

    def __init__(self, byte_source, piece_model):
        self.a, self.b = ByteSide(byte_source), PieceSide(piece_model)
        self.codes = suffix_pairs(self.a.token_bytes, self.b.token_bytes)
        self.size_a = np.array([len(t) for t in self.a.token_bytes], np.int64)
        self.size_b = np.array([len(t) for t in self.b.token_bytes], np.int64)
        names_a = [str(k) for k in range(len(self.size_a))]
        names_b = [str(k) for k in range(len(self.size_b))]
        self.inside_a, self.last_a = (np.array([n + m for n in names_a], object) for m in ",|")
        self.inside_b, self.last_b = (np.array([n + m for n in names_b], object) for m in ",;")

    def _usable(self, text, ids_a, ids_b):
        wanted = b" " + text.encode()
        joined_a = b"".join(map(self.a.token_bytes.__getitem__, ids_a))
        return joined_a == wanted and wanted == b"".join(
            map(self.b.token_bytes.__getitem__, ids_b)
        )

    def align(self, many):
        """Alignment of many texts; texts that the tokenizers don't cut alike have no tokens."""
        full = [k for k, t in enumerate(many) if t]
        some = [many[k] for k in full]
        lists_a, lists_b = [[] for _ in many], [[] for _ in many]
        for k, x, y in zip(full, self.a.encode_many(some), self.b.encode_many(some)):
            if self._usable(many[k], x, y):
                lists_a[k], lists_b[k] = x, y
        ids_a, tokens_a = _joined(lists_a)
        ids_b, tokens_b = _joined(lists_b)
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        last_a, last_b = common_ends(ends_a, ends_b)
        groups = np.searchsorted(last_a, tokens_a)
        return SliceAlignment(
            ids_a, ids_b, ends_a, ends_b, tokens_a, tokens_b, last_a, last_b, groups
        )

    def pairs(self, found):
        """Number of the id pair of every link, among all pairs the vocabularies allow."""
        wanted = found.ids_a[found.last_a] << 32 | found.ids_b[found.last_b]
        return np.searchsorted(self.codes, wanted)

    def group_texts(self, found):
        """`a1,a2|b1;a3|b2` of every text."""
        group_a = np.searchsorted(found.last_a, np.arange(len(found.ids_a)))
        group_b = np.searchsorted(found.last_b, np.arange(len(found.ids_b)))
        part_a, part_b = self.inside_a[found.ids_a], self.inside_b[found.ids_b]
        part_a[found.last_a] = self.last_a[found.ids_a[found.last_a]]
        part_b[found.last_b] = self.last_b[found.ids_b[found.last_b]]
        order = np.argsort(np.append(2 * group_a, 2 * group_b + 1), kind="stable")
        parts = np.append(part_a, part_b)[order].tolist()
        bounds = (found.tokens_a + found.tokens_b).tolist()
        return ["".join(parts[s:e])[:-1] for s, e in zip(bounds[:-1], bounds[1:])]


def _joined(lists):
    bounds = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int64)
    flat = np.fromiter(chain.from_iterable(lists), np.int64, int(bounds[-1]))
    return flat, bounds


_aligners = {}


def aligner_of(sources):
    """The aligner of two tokenizer files' contents, built once per worker process."""
    key = hash(sources)
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(*sources)
    return _aligners[key]


def read_sources(byte_path, piece_path):
    with open(piece_path, "rb") as file:
        return read_tokenizer(byte_path), file.read()


ALIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()),
        ("pairs", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
    ]
)
ALIGNED_SQL = (
    "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "pairs array<int>, times array<int>"
)


def _aligned(docs, source):
    """Counts, digest and the distinct id pairs with their links, of every row."""

    def run(batches):
        aligner = aligner_of(source.value)
        for part in slices(batches, limit=SLICE_BYTES):
            found = aligner.align(texts(part))
            n_groups = np.diff(found.groups)
            owner = np.repeat(np.arange(part.num_rows), n_groups)
            codes, times = np.unique(
                owner << 32 | aligner.pairs(found), return_counts=True
            )
            bounds = np.searchsorted(codes >> 32, np.arange(part.num_rows + 1)).astype(np.int32)
            pairs = pa.ListArray.from_arrays(bounds, (codes & 0xFFFFFFFF).astype(np.int32))
            times = pa.ListArray.from_arrays(bounds, times.astype(np.int32))
            digests = [sha256(t.encode()).hexdigest() if t else "" for t in aligner.group_texts(found)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(found.tokens_a)),
                    pa.array(np.diff(found.tokens_b)),
                    pa.array(n_groups.astype(np.int64)),
                    pa.array(digests, pa.string()),
                    pairs,
                    times,
                ],
                schema=ALIGNED,
            )

    return docs.select("doc_id", "text").mapInArrow(run, ALIGNED_SQL)


COUNTED = pa.schema([("pair", pa.int32()), ("links", pa.int64())])


def pair_links(aligned, pairs):
    """pair and links over the whole table; each task adds up its rows before the exchange."""

    def run(batches):
        sums = np.zeros(pairs, np.int64)
        for batch in batches:
            numbers = batch.column("pairs").flatten().to_numpy(zero_copy_only=False)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False)
            sums += np.bincount(numbers, times, pairs).astype(np.int64)
        met = np.flatnonzero(sums)
        if len(met):
            yield record_batch(COUNTED, pair=met, links=sums[met])

    counted = aligned.select("pairs", "times").mapInArrow(run, "pair int, links long")
    return counted.groupBy("pair").agg(F.sum("links").alias("links"))


SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("n_best", pa.int64()),
        ("count_sum", pa.int64()),
        ("groups_sha256", pa.string()),
    ]
)
SCORED_SQL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)


def align_digest(docs, byte_path, piece_path):
    """Alignment of every row of `docs` under both tokenizers, with corpus-wide link counts.

    n_a, n_b: tokens; n_groups: groups between common ends; n_links: token pairs that end together;
    n_best: links whose id pair has the highest count of its B id in all rows, ties included;
    count_sum: sum of those counts over the links; groups_sha256: digest of the groups' ids. Null and
    empty texts, and texts whose bytes the tokenizers don't both keep, have zeros and ''. Rows
    are independent but for the counts; repeated rows count and stay, doc_id may be null.
    """
    spark = docs.sparkSession
    ship(spark)
    sources = read_sources(byte_path, piece_path)
    codes = aligner_of(sources).codes
    aligned = keep(_aligned(docs, spark.sparkContext.broadcast(sources)), "aligned")
    # At most one row per pair the vocabularies allow, whatever the number of documents.
    found = pair_links(aligned, len(codes)).toPandas()
    links = np.zeros(len(codes), np.int64)
    links[found["pair"].to_numpy()] = found["links"].to_numpy()
    b_ids = codes & 0xFFFFFFFF
    highest = np.zeros(int(b_ids.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, b_ids, links)
    counts = spark.sparkContext.broadcast((links, links == highest[b_ids]))

    def run(batches):
        links, best = counts.value
        for batch in batches:
            lists = batch.column("pairs")
            bounds = np.append(
                0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            )
            numbers = lists.flatten().to_numpy(zero_copy_only=False)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)

            def per_row(values):
                sums = np.append(0, np.cumsum(values))
                return sums[bounds[1:]] - sums[bounds[:-1]]

            yield record_batch(
                SCORED,
                **{n: batch.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256")},
                n_links=per_row(times),
                n_best=per_row(times * best[numbers]),
                count_sum=per_row(times * links[numbers]),
            )

    return aligned.mapInArrow(run, SCORED_SQL)


GROUPS = pa.struct(
    [
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("a", pa.list_(pa.int32())),
        ("b", pa.list_(pa.int32())),
    ]
)


def aligned_groups(docs, byte_path, piece_path):
    """doc_id and groups of every row: byte range in blank + text, ids of A and ids of B."""
    spark = docs.sparkSession
    ship(spark)
    source = spark.sparkContext.broadcast(read_sources(byte_path, piece_path))
    schema = pa.schema([("doc_id", pa.int64()), ("groups", pa.list_(GROUPS))])

    def run(batches):
        aligner = aligner_of(source.value)
        for part in slices(batches, limit=SLICE_BYTES):
            found = aligner.align(texts(part))
            bounds = np.append(0, found.ends_a[found.last_a])
            firsts = [
                pa.ListArray.from_arrays(
                    np.append(0, last + 1).astype(np.int32), ids.astype(np.int32)
                )
                for ids, last in ((found.ids_a, found.last_a), (found.ids_b, found.last_b))
            ]
            owner = np.repeat(np.arange(part.num_rows), np.diff(found.groups))
            offset = np.append(0, found.ends_a)[found.tokens_a[:-1]][owner]
            groups = pa.StructArray.from_arrays(
                [pa.array(bounds[:-1] - offset), pa.array(bounds[1:] - offset), *firsts],
                fields=list(GROUPS),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.ListArray.from_arrays(found.groups.astype(np.int32), groups),
                ],
                schema=schema,
            )

    kind = "doc_id long, groups array<struct<start:long, end:long, a:array<int>, b:array<int>>>"
    return docs.select("doc_id", "text").mapInArrow(run, kind)
