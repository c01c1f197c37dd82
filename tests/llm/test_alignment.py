"""Alignment of two tokenizers against the libraries and a plain merge of their ends."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import awkward, empty, with_clashes
from tokenizers import Tokenizer

from shelfcast.llm.alignment import (
    Aligner,
    align_digest,
    aligned_groups,
    common_ends,
    diagonal_cuts,
    read_sources,
)

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The cat sat on the mat.", "wo  rds\t\n and more", "漢字 and 😀 emoji", "▁ blank sign ▁", "a",
    "<|endoftext|> <s> </s> <0x41>", "x" * 700, "ñandú " * 300, "\x00 nul", " lead", "trail ", "ﬁ ①",
    "The cat sat on the mat.", "​", "é é", "Ω≈ç√", "{'a': [1, 2.5e-10]}", "\r\n\r\n",
]


@pytest.fixture(scope="module")
def aligner():
    return Aligner(*read_sources(BYTES, PIECES))


@pytest.fixture(scope="module")
def brute(aligner):
    """(ids A, ids B, groups) of a text, straight from the libraries."""
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def ends(ids, table):
        return np.cumsum([len(table[i]) for i in ids]).tolist()

    def align(text):
        if not text:
            return [], [], []
        a = library.encode(" " + text, add_special_tokens=False).ids
        b = pieces.encode(text)
        joined = [
            b"".join(side.token_bytes[i] for i in ids) for side, ids in ((aligner.a, a), (aligner.b, b))
        ]
        if joined != [b" " + text.encode()] * 2:
            return [], [], []
        at, bt = ends(a, aligner.a.token_bytes), ends(b, aligner.b.token_bytes)
        groups, i, j = [], 0, 0
        for end in sorted(set(at) & set(bt)):
            ii, jj = at.index(end) + 1, bt.index(end) + 1
            groups.append((a[i:ii], b[j:jj]))
            i, j = ii, jj
        return a, b, groups

    return align


def digest(groups):
    text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    return hashlib.sha256(text.encode()).hexdigest() if groups else ""


@pytest.mark.parametrize("work", [1, 2, 7, 64])
@pytest.mark.parametrize("sizes", [(0, 0), (0, 5), (6, 0), (1, 200), (150, 150), (400, 37)])
def test_pieces_of_equal_work_find_all_common_ends(sizes, work):
    rng = np.random.default_rng(sum(sizes))
    a, b = (np.sort(rng.choice(500, n, replace=False)) for n in sizes)
    i, j = common_ends(a, b, work)
    assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_diagonals_divide_the_merging_evenly():
    rng = np.random.default_rng(5)
    a, b = np.sort(rng.choice(900, 300, replace=False)), np.sort(rng.choice(900, 500, replace=False))
    i, j = diagonal_cuts(a, b, 64)
    assert set(np.diff(i + j)[:-1]) == {64} and (i[-1], j[-1]) == (300, 500)
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    for x, y in zip(i.tolist(), j.tolist()):
        assert [side for _, side in merged[: x + y]].count(0) == x


def test_ids_and_groups_are_those_of_the_libraries(aligner, brute):
    found = aligner.align(TEXTS)
    for k, text in enumerate(TEXTS):
        a, b, groups = brute(text)
        one = slice(found.tokens_a[k], found.tokens_a[k + 1])
        assert found.ids_a[one].tolist() == a
        assert found.ids_b[found.tokens_b[k] : found.tokens_b[k + 1]].tolist() == b
        assert found.groups[k + 1] - found.groups[k] == len(groups)
    texts = aligner.group_texts(found)
    assert [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts] == [
        digest(brute(t)[2]) for t in TEXTS
    ]
    # Every link's pair is one of those that the vocabularies allow.
    numbers = aligner.pairs(found)
    assert (aligner.codes[numbers] >> 32 == found.ids_a[found.last_a]).all()
    assert (aligner.codes[numbers] & 0xFFFFFFFF == found.ids_b[found.last_b]).all()
    bound = sum(map(len, aligner.a.token_bytes)) + sum(map(len, aligner.b.token_bytes))
    assert len(aligner.codes) < bound


def test_digests_and_counts_over_all_rows(spark, brute):
    docs = awkward(spark, TEXTS * 2)
    rows = docs.collect()
    links = [[(a[-1], b[-1]) for a, b in brute(r.text)[2]] for r in rows]
    count = Counter(pair for row in links for pair in row)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    want = []
    for r, row in zip(rows, links):
        a, b, groups = brute(r.text)
        n_best = sum(count[p] == best[p[1]] for p in row)
        total = sum(count[p] for p in row)
        want.append((r.doc_id, len(a), len(b), len(groups), len(row), n_best, total, digest(groups)))
    got = align_digest(with_clashes(docs).repartition(3), BYTES, PIECES)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_groups_cover_the_bytes(spark, brute):
    docs = awkward(spark, TEXTS).where("doc_id >= 100")
    for row in aligned_groups(docs, BYTES, PIECES).collect():
        groups = brute(TEXTS[row.doc_id - 100])[2]
        assert [(g.a, g.b) for g in row.groups] == groups
        at = 0
        for g in row.groups:
            assert g.start == at < g.end
            at = g.end
        assert not groups or at == 1 + len(TEXTS[row.doc_id - 100].encode())


def test_unfit_files_are_refused():
    source, model = read_sources(BYTES, PIECES)
    with pytest.raises(ValueError):
        Aligner(source.replace('"add_prefix_space":false', '"add_prefix_space":true', 1).replace(
            '"add_prefix_space": false', '"add_prefix_space": true', 1), model)


def test_empty_tables(spark):
    assert align_digest(empty(spark), BYTES, PIECES).count() == 0
