"""Phrase collocations from a weighted de Bruijn graph of words.

The graph's edges are the grams of the greatest length between two nodes that overlap in all but one
word. Every place of a text gives one edge, the longest gram that starts there; near the end of a piece
it is shorter. Counts of shorter phrases are not collected from the texts: a phrase's count is the
flow out of its node, the weights of all edges that start with it, plus what ends there.

Two steps keep the graph small without changing a count that matters. A pair of neighbouring words
that is rare cannot lie in a frequent phrase, so texts are cut there as well. And the walk between two
cuts travels whole: equal walks, such as a passage that many documents share, become one row with a
weight before they are taken apart into edges (an unary path is compact). In the same sense a phrase
is dropped when all its flow passes on through one longer phrase.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.common import keep, record_batch, ship, slices, texts
from shelfcast.llm.pieces import keyed_hashes, mix

SLICE_BYTES = 2 << 20
# Rows a task holds before it hands them on.
HELD_ROWS = 150_000
# Fixed value: what stands in for a missing language.
NO_LANGUAGE = "und"
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
# Characters that end a piece become line ends, tabs become blanks.
_MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\x09", b"\n" * 9 + b" ")


@dataclass(frozen=True)
class CollocationParams:
    """Phrases of 2 to `words` words with `least` occurrences; `keep` per language.

    absorbed   a phrase goes where a longer one has this percentage of its count;
    bits       bound of the filter of frequent pairs, as a power of two; a full one cuts less.
    """

    words: int = 5
    least: int = 100
    absorbed: int = 100
    keep: int = 2000
    bits: int = 28
    salts: int = 64


class Words:
    """The words of the texts of one slice and their languages."""

    def __init__(self, many, langs):
        raw = [t.encode().lower().translate(_MARKS) for t in many]
        self.bytes = b"\n" + b"\n".join(raw) + b"\n"
        self.values = np.frombuffer(self.bytes, np.uint8)
        self.names = sorted(set(langs))
        number = {lang: k for k, lang in enumerate(self.names)}
        outside = (self.values == 32) | (self.values == 10)
        change = np.diff(outside.astype(np.int8))
        self.starts = np.flatnonzero(change == -1) + 1
        self.ends = np.flatnonzero(change == 1) + 1
        first = np.cumsum([1] + [len(r) + 1 for r in raw])[:-1]
        text = np.searchsorted(first, self.starts, "right") - 1
        self.lang = np.array([number[lang] for lang in langs], np.int64)[text]
        piece = np.cumsum(self.values == 10)[self.starts]
        self.joined = piece[1:] == piece[:-1]

    def pair_hashes(self):
        """Hash of every word with the one after it, and which of them lie in one piece."""
        words = keyed_hashes(self.values, self.starts, self.ends, 3)
        tongues = np.array([_text_hash(n) for n in self.names], np.uint64)
        pairs = mix(words[:-1] * _STEP + words[1:] + tongues[self.lang[:-1]])
        return pairs, self.joined

    def walks(self, linked):
        """(language, words joined by blanks) of each run of words whose neighbours are linked."""
        if not len(self.starts):
            return []
        first = np.append(0, np.flatnonzero(~linked) + 1)
        last = np.append(first[1:] - 1, len(self.starts) - 1)
        begin, end = self.starts[first], self.ends[last]
        # More than one blank between two words is one.
        sizes = np.append(0, np.cumsum(self.ends - self.starts))
        loose = end - begin != sizes[last + 1] - sizes[first] + last - first
        raw = self.bytes
        spans = [raw[s:e] for s, e in zip(begin.tolist(), end.tolist())]
        for k in np.flatnonzero(loose).tolist():
            spans[k] = b" ".join(w for w in spans[k].split(b" ") if w)
        return zip(self.lang[first].tolist(), spans)


def _text_hash(text):
    values = np.frombuffer(text.encode() + b" ", np.uint8)
    return keyed_hashes(values, np.array([0]), np.array([len(values)]), 5)[0]


def _slices(batches):
    for part in slices(batches, limit=SLICE_BYTES):
        langs = [NO_LANGUAGE if g is None else g for g in part.column("lang").to_pylist()]
        yield Words(texts(part), langs)


PAIRS = pa.schema([("pair", pa.int64()), ("n", pa.int32())])


def frequent_pairs(docs, least):
    """Hashes of the pairs of neighbouring words with `least` occurrences in a language.

    A shared hash can only add a pair, never lose one.
    """

    def run(batches):
        for words in _slices(batches):
            hashes, inside = words.pair_hashes() if len(words.starts) else (np.zeros(0, np.uint64),) * 2
            found, counts = np.unique(hashes[inside.astype(bool)], return_counts=True)
            yield record_batch(PAIRS, pair=found.view(np.int64), n=counts)

    counted = docs.select("lang", "text").mapInArrow(run, "pair long, n int")
    return counted.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("pair")


def pair_filter(pairs, most_bits):
    """A bit table that holds every pair of the table: its bits as bytes, and how far to shift.

    16 bits per pair up to 2**most_bits bits (32 MB by default), which bounds it for any corpus.
    """
    pairs = keep(pairs, "pairs")
    bits = min(max(16, int(16 * pairs.count()).bit_length()), most_bits)
    place = F.shiftrightunsigned("pair", 64 - bits)
    rows = (
        pairs.select(F.shiftright(place, 5).alias("cell"), (place % 32).cast("int").alias("bit"))
        .groupBy("cell")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
        .toPandas()
    )
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[rows["cell"].to_numpy()] = rows["mask"].to_numpy().astype(np.uint32)
    return table, 64 - bits


WALKS = pa.schema([("lang", pa.string()), ("walk", pa.string()), ("n", pa.int64())])


def walks(docs, frequent):
    """lang, walk and n: the walks of all texts between rare pairs, equal ones summed up."""
    source = docs.sparkSession.sparkContext.broadcast(frequent)

    def batch_of(held):
        langs, spans = zip(*held)
        return record_batch(
            WALKS, lang=langs, walk=[s.decode() for s in spans], n=list(held.values())
        )

    def run(batches):
        table, shift = source.value
        held = Counter()
        for words in _slices(batches):
            linked = np.zeros(max(len(words.starts) - 1, 0), bool)
            if len(linked):
                hashes, inside = words.pair_hashes()
                place = (hashes >> np.uint64(shift)).astype(np.int64)
                linked = inside & ((table[place >> 5] >> (place & 31).astype(np.uint32)) & 1 > 0)
            names = words.names
            held.update((names[g], span) for g, span in words.walks(linked))
            if len(held) > HELD_ROWS:
                yield batch_of(held)
                held.clear()
        if held:
            yield batch_of(held)

    found = docs.select("lang", "text").mapInArrow(run, "lang string, walk string, n long")
    return found.groupBy("lang", "walk").agg(F.sum("n").alias("n"))


def flows(walked, longest):
    """lang, phrase, size and n: counts of all phrases of 1 to `longest` words.

    Walks become edges, one per word; each edge flows through every phrase it starts with.
    """
    edges = (
        walked.withColumn("w", F.split("walk", " "))
        .select(
            "lang",
            "n",
            F.explode(
                F.expr(
                    "transform(sequence(1, size(w)), i -> array_join(slice(w, i, "
                    f"{longest}), ' '))"
                )
            ).alias("edge"),
        )
        .groupBy("lang", "edge")
        .agg(F.sum("n").alias("n"))
    )
    starts = "transform(sequence(1, size(w)), k -> struct(k AS size, array_join(slice(w, 1, k), ' ') AS phrase))"
    return (
        edges.withColumn("w", F.split("edge", " "))
        .select("lang", "n", F.inline(F.expr(starts)))
        .groupBy("lang", "phrase", "size")
        .agg(F.sum("n").alias("n"))
    )


def _absorbed(counted, percent):
    """Phrases through whose node `percent` of the flow passes to one longer phrase.

    A phrase inside a longer one of enough occurrences lies in one that is longer by a word and has at
    least as many, so the next words on both sides decide.
    """
    parts = F.array(
        F.expr("substring_index(phrase, ' ', size - 1)"),
        F.expr("substring(phrase, locate(' ', phrase) + 1)"),
    )
    longer = (
        counted.where("size > 2")
        .select("lang", F.explode(parts).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longer"))
    )
    return (
        counted.where("size > 1")
        .join(longer, ["lang", "phrase"])
        .where(F.lit(100) * F.col("longer") >= F.lit(percent) * F.col("n"))
        .select("lang", "phrase")
    )


def _cuts(candidates, counted):
    """The lowest-scoring cut of every candidate, with the counts of both parts."""
    sides = candidates.select(
        "lang",
        "phrase",
        F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring(phrase, length(substring_index(phrase, ' ', k)) + 2)").alias("right"),
    )
    parts = counted.select("lang", "phrase", "n")
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    return sides.join(left, ["lang", "left"]).join(right, ["lang", "right"])


def collocations(docs, params=CollocationParams()):
    """The first phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A missing text is empty, a missing lang is `und`; rows without doc_id count and repeated rows count
    repeatedly; other columns are ignored. Numbers are exact (products in 38 digits). Equal scores
    go by a, then by phrase. A language without frequent phrases has no rows.
    """
    ship(docs.sparkSession)
    docs = docs.select("lang", "text")
    frequent = pair_filter(frequent_pairs(docs, params.least), params.bits)
    walked = keep(walks(docs, frequent), "walks")
    totals = walked.groupBy("lang").agg(
        F.sum(F.col("n") * F.size(F.split("walk", " "))).alias("total")
    )
    counted = keep(
        flows(walked, params.words).where(F.col("n") >= params.least), "flows"
    )
    candidates = counted.where("size > 1").join(
        _absorbed(counted, params.absorbed), ["lang", "phrase"], "left_anti"
    )
    # Few rows: one per language.
    scored = _cuts(candidates, counted).join(totals, "lang").withColumn(
        "score",
        F.expr(
            "(cast(1000 AS decimal(4, 0)) * cast(a AS decimal(19, 0)) * cast(total AS decimal(19, 0)))"
            " div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0)))"
        ),
    )
    best = (
        scored.groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r", "total")).alias("cut"))
        .select("lang", "phrase", "cut.*")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(params.salts)))
    near = salted.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    ).where(F.col("rank") <= params.keep)
    # At most `salts` times `keep` rows per language are left.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (
        near.withColumn("rank", place.cast("long"))
        .where(F.col("rank") <= params.keep)
        .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
    )
