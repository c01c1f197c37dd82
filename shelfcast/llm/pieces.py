"""Cutting many texts into the pieces of a byte-level vocabulary at once, with array operations.

The splitting pattern is a rule about neighbouring character classes: runs of letters, digits or
other characters, each with one space before it; an apostrophe ending such as 's; and white space.
Pieces of one slice are grouped by a 64-bit hash of their characters and then compared character by
character, so that equal pieces are computed once and a hash alone decides nothing.
"""

from functools import lru_cache

import numpy as np
import regex

LETTER, DIGIT, SPACE, OTHER, EDGE = range(5)
# Stands between two texts; no character has this number.
EDGE_MARK = 0x110000
# Code points that are classified together; divides the bounds of the surrogates.
CLASS_BLOCK = 0x800
_BASE = 0x9E3779B97F4A7C17  # its predecessor is twice an odd number
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(1)
def class_table():
    """Class of every code point."""
    table = np.full(EDGE_MARK + 1, OTHER, np.uint8)
    # Some code points at a time: a string of each at once would be this table's size a hundred times.
    for start in range(0, EDGE_MARK, CLASS_BLOCK):
        if 0xD800 <= start < 0xE000:  # no characters
            continue
        some = "".join(map(chr, range(start, start + CLASS_BLOCK)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
            for found in regex.finditer(pattern, some):
                table[start + found.start() : start + found.end()] = kind
    table[EDGE_MARK] = EDGE
    return table


@lru_cache(1)
def _powers(size):
    """Powers of the base and of its inverse, modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for step in (_BASE, inverse):
        steps = np.full(size, step, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out


def mix(x):
    """Scramble 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def span_hashes(values, starts, ends):
    """Hash of values[start:end] for many spans at once; equal spans have equal hashes.

    A linear polynomial: unequal spans of some regular texts share a hash. It serves as a group to be
    compared and as an index of hashed weights; keyed_hashes() tells spans apart.
    """
    # One table serves all slices of usual size.
    powers, inverses = _powers(max(1 << 21, 1 << int(len(values)).bit_length()))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values.astype(np.uint64) + np.uint64(1)) * powers[: len(values)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(raw ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def flat_spans(starts, ends):
    """Positions of all spans one after the other, and where each span begins among them."""
    sizes = ends - starts
    at = np.append(0, np.cumsum(sizes))
    return np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes), at


def keyed_hashes(values, starts, ends, seed):
    """64-bit hash of values[start:end] per span: a sum of scrambled (place, value) pairs.

    Places and values enter a one-to-one scrambling together, so that no regular text makes sums
    meet; two unequal spans share a hash once in 2**64.
    """
    flat, at = flat_spans(starts, ends)
    place = (np.arange(len(flat)) - np.repeat(at[:-1], ends - starts)).astype(np.uint64)
    key = np.uint64((seed * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) & (2**64 - 1))
    pairs = ((place << np.uint64(21)) + values[flat].astype(np.uint64)) ^ key
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(mix(pairs), out=sums[1:])
    return mix(sums[at[1:]] - sums[at[:-1]] + (ends - starts).astype(np.uint64) * _MIX)


def equal_spans(values, starts, ends):
    """A sample span of each group of equal spans, and the group of every span."""
    _, sample, which = np.unique(
        span_hashes(values, starts, ends), return_index=True, return_inverse=True
    )
    like = sample[which]
    other = (ends - starts) != (ends - starts)[like]
    like = np.where(other, np.arange(len(like)), like)
    flat, at = flat_spans(starts, ends)
    differs = values[flat] != values[flat - np.repeat(starts - starts[like], ends - starts)]
    sums = np.append(0, np.cumsum(differs))
    other |= sums[at[1:]] > sums[at[:-1]]
    strays = np.flatnonzero(other)
    if len(strays):
        groups = {}
        for k in strays.tolist():
            group = groups.setdefault(values[starts[k] : ends[k]].tobytes(), len(groups))
            which[k] = len(sample) + group
        first = {which[k]: k for k in strays[::-1].tolist()}
        sample = np.append(sample, [first[len(sample) + g] for g in range(len(groups))])
    return sample, which


def code_points(texts):
    """Code points of the texts, an edge before each and at the end; starts of the texts."""
    edge = np.array([EDGE_MARK], np.uint32)
    parts, starts, at = [edge], [], 1
    for text in texts:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts.append(at)
        at += len(points) + 1
        parts += [points, edge]
    return np.concatenate(parts), np.array(starts, np.int64)


def cut(points):
    """Starts and ends of the pieces of an array made by code_points()."""
    kind = class_table()[points]
    change = np.empty(len(kind), bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    first = np.flatnonzero(change)  # starts of runs of one class
    what = kind[first]
    begins = change.copy()
    # White space before a word: its last character starts a piece, alone or as the word's space.
    word = (what != SPACE) & (what != EDGE)
    after = np.flatnonzero(word[1:] & (what[:-1] == SPACE)) + 1
    last = first[after] - 1
    begins[last] = True
    led = points[last] == 0x20
    begins[first[after[led]]] = False
    # Apostrophe endings, if nothing else belongs to the apostrophe's piece.
    bounds = np.append(first, len(kind))
    length = np.diff(bounds)
    mark = np.flatnonzero(
        (what[:-1] == OTHER) & (length[:-1] == 1) & (what[1:] == LETTER) & (points[first[:-1]] == 0x27)
    )
    mark = mark[begins[first[mark]]]
    at = first[mark]
    one = points[at + 1]
    two = points[np.minimum(at + 2, len(points) - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(at), bool)
    for pair in ("re", "ve", "ll"):
        long |= (one == ord(pair[0])) & (two == ord(pair[1]))
    for chosen, size in ((short, 2), (long, 3)):
        begins[at[chosen] + 1] = False
        begins[at[chosen] + size] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(kind))
    real = kind[starts] != EDGE
    return starts[real], ends[real]


class PieceValues:
    """Values of pieces, computed once each and remembered up to a bound of entries."""

    def __init__(self, compute, limit):
        self.compute, self.limit = compute, limit
        self.known = {}

    def of(self, texts):
        """Values of all pieces of the texts in order, and the pieces' bounds of each text."""
        points, text_starts = code_points(texts)
        starts, ends = cut(points)
        sample, which = equal_spans(points, starts, ends)
        names = [
            points[s:e].tobytes() for s, e in zip(starts[sample].tolist(), ends[sample].tolist())
        ]
        known = self.known
        values = list(map(known.get, names))
        missing = [k for k, v in enumerate(values) if v is None]
        if len(known) + len(missing) > self.limit:
            known.clear()
        for k in missing:
            values[k] = self.compute(names[k].decode("utf-32-le").encode())
            if len(known) < self.limit:
                known[names[k]] = values[k]
        bounds = np.append(np.searchsorted(starts, text_starts), len(starts))
        return values, which, bounds
