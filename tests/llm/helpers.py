"""Small tables with every awkward row the operators must bear, and brute-force versions."""

import hashlib
import re
from collections import Counter

import numpy as np

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.001"


def awkward(spark, texts=()):
    """Null ids, texts, languages and sources; empty, blank, long and repeated texts and rows."""
    long = "lorem ipsum dolor sit amet consectetur " * 400
    rows = [
        (1, "", "en", "a"),
        (2, None, "en", "a"),
        (None, "no id at all but some words here to see", "de", None),
        (None, None, None, None),
        (3, "  \n\t ", None, "b"),
        (4, long, "en", "b"),
        (5, long, "en", None),
        (6, "é" * 300 + " 漢字 😀", "fr", "b"),
        (7, "same row", "en", "a"),
        (7, "same row", "en", "a"),
        (7, "same id, other text", "es", "c"),
        (8, "<|endoftext|> in the <|endoftext|> middle", "en", "a"),
        *[(100 + k, t, "en", "abc"[k % 3]) for k, t in enumerate(texts)],
    ]
    rows = [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows]
    return spark.createDataFrame(rows, DOCUMENTS)


def with_clashes(docs):
    """The same documents with more columns, named like those that operators make."""
    from pyspark.sql import functions as F

    names = ("score", "threshold", "block", "bucket", "id", "group", "ids", "component", "term")
    return docs.select("*", *[F.lit(7).alias(n) for n in names])


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(SMALL))
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def brute_components(rows, size, percent=80):
    """(doc_id, shingles, component) of (doc_id, text) rows with unique ids."""
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = {}
    for i in sorted(sets):
        hits = Counter(j for s in sets[i] for j in inverted.get(s, ()))
        for j, n in hits.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            inverted.setdefault(s, []).append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def brute_kept(rows, length):
    """(doc_id, bytes, mark per byte that goes, between two zeros) of (doc_id, text) rows."""
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - length + 1) if i is not None else ():
            gram = raw[k : k + length]
            first[gram] = min(first.get(gram, i), i)
    for i, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 2, bool)
        for k in range(len(raw) - length + 1) if i is not None else ():
            if first[raw[k : k + length]] < i:
                gone[k + 1 : k + 1 + length] = True
        yield i, raw, gone


def brute_repeats(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows."""
    out = []
    for i, raw, gone in brute_kept(rows, length):
        kept = bytes(b for b, g in zip(raw, gone[1:-1]) if not g)
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)
