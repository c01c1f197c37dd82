"""Phrases against counting every gram of every text."""

import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import DOCUMENTS, SMALL, awkward, empty, with_clashes

from shelfcast.llm.collocations import CollocationParams, Words, collocations


def brute(rows, least, keep, absorbed=100):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in counts.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {
            q[i:j]
            for q, b in found.items()
            for i in range(len(q))
            for j in range(i + 2, len(q) + 1)
            if j - i < len(q) and q[i:j] in found and 100 * b >= absorbed * found[q[i:j]]
        }
        ranked = []
        for p, a in found.items():
            if p not in gone:
                score, k = min(
                    (1000 * a * total[lang] // (count[p[:k]] * count[p[k:]]), k)
                    for k in range(1, len(p))
                )
                ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for place, (score, a, p, left, right) in enumerate(sorted(ranked)[:keep], 1):
            out.append((lang, place, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["The", "of", "new", "york", "city", "Über", "straße", "a", "x", "漢字", "\x1c", "n’t"]
    marks = [" "] * 12 + [". ", ", ", "  ", " \t", "\t", "\n", "! ", ";", "\r\n", " : ", "\x0b"]
    made = ["".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    passage = "one two three four five six seven eight. " * 3
    return made + [passage] * 40 + ["the the the the the the the"] * 12 + ["word " * 5000]


@pytest.mark.parametrize("least, keep, absorbed", [(3, 2000, 100), (12, 25, 100), (8, 2000, 70)])
def test_phrases_equal_counting_all_grams(spark, texts, least, keep, absorbed):
    docs = awkward(spark, texts)
    params = CollocationParams(least=least, keep=keep, absorbed=absorbed)
    want = brute([(r.text, r.lang) for r in docs.collect()], least, keep, absorbed)
    assert len(want) > 20
    assert rows_of(collocations(with_clashes(docs), params)) == want


def test_a_full_filter_only_cuts_less(spark, texts):
    docs = awkward(spark, texts[:80])
    want = brute([(r.text, r.lang) for r in docs.collect()], 3, 2000)
    assert rows_of(collocations(docs, CollocationParams(least=3, bits=16))) == want
    assert rows_of(collocations(docs.repartition(7), CollocationParams(least=3, bits=6))) == want


def test_products_beyond_64_bits_are_exact(spark):
    rows = [(1, "a b", "en", "s", 3)]
    found = collocations(spark.createDataFrame(rows, DOCUMENTS), CollocationParams(least=1))
    assert rows_of(found) == [("en", 1, "a b", 1, 1, 1, 2, 2000)]
    big = spark.sql(
        "SELECT (cast(1000 AS decimal(4, 0)) * cast(9000000000000 AS decimal(19, 0))"
        " * cast(70000000000000 AS decimal(19, 0))) div (cast(3000000000001 AS decimal(19, 0))"
        " * cast(7000000000000 AS decimal(19, 0))) AS s"
    )
    assert big.first().s == 1000 * 9000000000000 * 70000000000000 // (3000000000001 * 7000000000000)


def test_walks_are_cut_at_rare_pairs_and_pieces():
    words = Words(["A b  c.d\te", "f"], ["en", "de"])
    assert words.joined.tolist() == [True, True, False, True, False]
    linked = words.joined.copy()
    assert list(words.walks(linked)) == [(1, b"a b c"), (1, b"d e"), (0, b"f")]
    linked[1] = False
    assert list(words.walks(linked)) == [(1, b"a b"), (1, b"c"), (1, b"d e"), (0, b"f")]


def test_empty_tables(spark):
    assert collocations(empty(spark)).count() == 0
