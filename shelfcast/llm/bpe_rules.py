"""Merge rules of a byte-level BPE vocabulary and the compatibility of neighbouring tokens.

A token sequence is the encoding of its bytes exactly if each token encodes to itself and each
neighbouring pair encodes to itself. Merges happen in the order of their ranks, so a pair (a, b)
holds unless some merge would join a right part of `a` with a left part of `b` while both parts
exist, that is after both were built and before either was absorbed by its parent.
"""

import json
import math
from functools import lru_cache

import regex


def byte_letters():
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return letters


class BpeRules:
    """Tokens, merges and pair tests of one tokenizer file (the JSON text of byte-level BPE)."""

    def __init__(self, source):
        spec = json.loads(source)
        model = spec["model"]
        to_byte = {letter: b for b, letter in byte_letters().items()}
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        ids = {}
        for word, token in vocab.items():
            if word not in self.special:
                self.token_bytes[token] = bytes(to_byte[c] for c in word)
                ids[word] = token
        for word, token in self.special.items():
            self.token_bytes[token] = word.encode()
        self.merge = {}  # (left id, right id) -> (rank, merged id)
        self.built = [-1] * size  # rank of the merge that builds a token
        self.parts = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            pair = ids[left], ids[right]
            token = ids[left + right]
            self.merge[pair] = rank, token
            if token not in self.parts:
                self.parts[token] = pair
                self.built[token] = rank
        self.byte_ids = [ids[letter] for _, letter in sorted(byte_letters().items())]
        self.whole = {}
        for token in sorted(ids.values(), key=lambda t: self.built[t]):
            if self._encodes_to_itself(token):
                self.whole[self.token_bytes[token]] = token
        self.compatible = lru_cache(1 << 17)(self._compatible)
        marks = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.marks = regex.compile(f"({marks})") if marks else None

    def _spine(self, token, side):
        """Parts of a token along one edge, with the ranks between which each exists."""
        until = math.inf
        while True:
            yield token, self.built[token], until
            if token not in self.parts:
                return
            until = self.built[token]
            token = self.parts[token][side]

    def _first_crossing(self, a, b):
        """Rank of the first merge across the boundary of a and b, or None."""
        rights, lefts = list(self._spine(a, 1))[::-1], list(self._spine(b, 0))[::-1]
        i = j = 0
        while i < len(rights) and j < len(lefts):
            (x, _, x_until), (y, _, y_until) = rights[i], lefts[j]
            found = self.merge.get((x, y))
            # The left one of two equal merges goes first.
            if found and found[0] < x_until and found[0] <= y_until:
                return found[0]
            i, j = i + (x_until <= y_until), j + (y_until <= x_until)
        return None

    def _compatible(self, a, b):
        return self._first_crossing(a, b) is None

    def _encodes_to_itself(self, token):
        if token not in self.parts:
            return True
        a, b = self.parts[token]
        return (
            self.token_bytes[a] in self.whole
            and self.token_bytes[b] in self.whole
            and self._first_crossing(a, b) == self.built[token]
        )

    def segments(self, text):
        """(is_special, part) of a text, cut at the special strings."""
        if self.marks is None or not any(m in text for m in self.special):
            return [(False, text)]
        return [(k % 2 == 1, part) for k, part in enumerate(self.marks.split(text)) if part]


_loaded = {}


def rules_of(source):
    """The rules of a tokenizer file's text, compiled once per worker process."""
    key = hash(source)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = BpeRules(source)
    return _loaded[key]


def read_tokenizer(path):
    """Text of a tokenizer file, read on the driver and sent to the tasks as a broadcast."""
    with open(path, encoding="utf-8") as file:
        return file.read()
