"""Near-duplicates and repeated passages against brute force."""

import random

import numpy as np
import pytest
from helpers import (
    FOLDER,
    awkward,
    brute_components,
    brute_repeats,
    empty,
    with_clashes,
)
from pyspark.sql import functions as F

from shelfcast.llm.catalog import QUERIES
from shelfcast.llm.graph import connected_components
from shelfcast.llm.near_dup import (
    NearDupParams,
    _distinct_buckets,
    drop_near_duplicates,
    near_duplicates,
    super_min_hash,
)
from shelfcast.llm import repeats
from shelfcast.llm.repeats import (
    RepeatParams,
    drop_repeats,
    interval_tree,
    kmer_hashes,
    maximal_repeats,
    repeat_digest,
    sliding,
)


def mutated(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def groups():
    """One large group of near copies around a base, and smaller ones at all similarities."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = [mutated(rng, base, rng.randrange(0, 9)) for _ in range(80)]
    for _ in range(25):
        other = [f"v{rng.randrange(500)}" for _ in range(rng.randrange(3, 90))]
        texts += [mutated(rng, other, rng.randrange(0, 6)) for _ in range(rng.randrange(1, 5))]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [8, 256])
def test_components_are_those_of_all_pairs(spark, groups, block):
    docs = spark.createDataFrame(groups, "doc_id long, text string")
    got = near_duplicates(docs, NearDupParams(words=4, star_rounds=1, block=block)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(groups, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicate_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = QUERIES["op1_minhash_near_dup"](spark, FOLDER).collect()
    wanted = brute_components([tuple(r) for r in docs.collect()], 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted


def test_near_duplicates_bear_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    got = near_duplicates(docs).collect()
    assert len(got) == docs.count()
    kept = {r.doc_id: r.kept for r in got}
    assert kept[4] and not kept[5] and kept[1] and kept[2] and kept[None]
    assert all(r.component_id is None for r in got if r.doc_id is None)
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns and left.count() == docs.count() - 1
    assert near_duplicates(empty(spark)).count() == 0


def test_all_texts_of_a_repeated_id_are_linked(spark):
    first, second = ("".join(f"{w}{k} " for k in range(60)) for w in "xy")
    rows = [
        (3, first),
        (3, second),
        (5, second.replace("y7 ", "z ")),
        (9, first + "more"),
        (1, "something else here again"),
        (7, None),
        (7, first),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for table in (docs, docs.orderBy("text")):
        got = near_duplicates(table, NearDupParams(words=4)).collect()
        assert {(r.doc_id, r.component_id) for r in got} == {(3, 3), (5, 3), (9, 3), (1, 1), (7, 3)}


def test_words_with_equal_polynomials_are_told_apart(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{word} one two three"), (2, f"{other} one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, NearDupParams(words=4)).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for size in (1, 4, 40, 400):
        shared = rng.integers(0, 2**62, size).astype(np.uint64)
        other = rng.integers(0, 2**62, (2, size)).astype(np.uint64)
        one, two = (np.unique(np.concatenate([shared, o])) for o in other)
        signed = super_min_hash([one, two, one], 512)
        assert np.isfinite(signed).all() and (signed[0] == signed[2]).all()
        assert abs((signed[0] == signed[1]).mean() - 1 / 3) < 0.1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 99)], "a long, b long")
    found = {r.id: r.component for r in connected_components(links).collect()}
    assert {found[k] for k in range(61)} == {0} and found[100] == found[99] == 99


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(2)
    base = ["".join(rng.choice("abcde f") for _ in range(rng.randint(40, 300))) for _ in range(9)]
    rows = []
    for i in range(150):
        kind = rng.random()
        if kind < 0.1:
            text = "ab " * rng.randint(0, 80)
        elif kind < 0.2:
            text = rng.choice(base)
        elif kind < 0.25:
            text = "é" * rng.randint(0, 60)
        elif kind < 0.3:
            text = None
        else:
            text = "".join(
                rng.choice(base)[rng.randint(0, 60) : rng.randint(60, 300)]
                + rng.choice(["", "x", "é\n", "\x00"])
                for _ in range(rng.randint(1, 5))
            )
        rows.append((rng.choice([i, i, i, 5, None]) if rng.random() < 0.1 else i, text))
    return rows


@pytest.mark.parametrize("params", [RepeatParams(), RepeatParams(length=30, anchor=16)])
def test_removed_bytes_are_those_of_all_substrings(spark, passages, params):
    docs = spark.createDataFrame(passages, "doc_id long, text string")
    got = sorted(map(tuple, repeat_digest(docs, params).collect()), key=str)
    assert got == brute_repeats(passages, params.length)


def test_repeat_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = QUERIES["op10_suffix_array_dedup"](spark, FOLDER).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats([tuple(r) for r in docs.collect()], 50)


def test_repeats_bear_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(map(tuple, repeat_digest(docs).collect()), key=str)
    assert got == brute_repeats(rows, 50)
    left = drop_repeats(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    found = {r.doc_id: r for r in left.collect()}
    assert found[5].text == "" and found[5].n_chars == 0 and found[2].text is None
    assert repeat_digest(empty(spark)).count() == 0


def test_a_hot_passage_is_sent_once_per_block(spark):
    """Copies of a passage weigh one context per block and anchor, whatever their number."""
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    rows = [(i, f"{i % 3} {passage}" if i % 3 else f"{i} alone") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = docs.withColumn("_block", F.pmod("doc_id", F.lit(67)))
    params = RepeatParams()
    shared = repeats._shared_anchors(placed, params, 64)
    size = F.conv(F.hex(F.reverse(F.substring("least", 1, 8))), 16, 10).cast("long") / 8
    sent = repeats._sent_contexts(placed, shared, params, 64).select(size.alias("n")).agg(F.sum("n"))
    each = len(repeats.anchors([text.encode() for _, text in rows[1:3]], params)[0])
    assert 0 < sent.first()[0] <= 67 * each
    got = sorted(map(tuple, repeat_digest(docs, params).collect()), key=str)
    assert got == brute_repeats(rows, 50)


def test_interval_tree_lists_all_members():
    # Common lengths 60, 55, -, 70: {0,1,2} share 55, {0,1} share 60, {3,4} share 70.
    lengths = np.array([0, 60, 55, 3, 70])
    assert sorted(interval_tree(lengths, 50)) == [(0, 1, 60), (0, 2, 55), (3, 4, 70)]
    assert interval_tree(np.zeros(3, int), 50) == []


def test_maximal_repeats_hold_all_occurrences():
    params = RepeatParams(length=6, anchor=3)
    # The anchor stands at byte 3; all share 'bcXYZd', two of them more.
    text = [b"abcXYZdef", b"abcXYZdeg", b"zbcXYZdxx"]
    contexts = np.frombuffer(b"".join(text), np.uint8).reshape(3, 9)
    sizes = np.full(3, 3), np.full(3, 6)
    found = []
    for column, rows, *groups in maximal_repeats(contexts, *sizes, np.zeros(3, int), params):
        for first, last, length in zip(*groups):
            found.append(((column, int(length)), set(rows[first : last + 1].tolist())))
    assert sorted(found) == [((0, 8), {0, 1}), ((1, 6), {0, 1, 2})]


def test_array_kernels():
    values = np.frombuffer(bytes(random.Random(1).choices(range(97, 100), k=2000)), np.uint8)
    for size in (1, 2, 3, 5, 24, 26):
        hashes, seen = kmer_hashes(values, size), {}
        for k, h in enumerate(hashes.tolist()):
            assert seen.setdefault(bytes(values[k : k + size]), h) == h
        assert len(hashes) == 2001 - size and len(set(seen.values())) == len(seen)
    numbers = np.random.default_rng(0).integers(0, 99, 300)
    for size in (1, 2, 7, 27):
        wanted = [numbers[k : k + size].min() for k in range(301 - size)]
        assert sliding(numbers, size, np.minimum).tolist() == wanted


def test_buckets_whose_short_sums_agree_stay_apart(spark):
    """The 40-bit hashes of the members of buckets 1 and 2 have the same sum."""
    buckets = {1: [38, 147, 160], 2: [98, 127, 265], 3: [38, 147, 160], 4: [7, 8, 8], 5: [7, 9, 9]}
    rows = [(b, min(ids), i) for b, ids in buckets.items() for i in ids]
    table = spark.createDataFrame(rows, "bucket long, hub long, id long")
    short = F.sum(F.pmod(F.xxhash64("id"), F.lit((1 << 40) - 87))).alias("sum")
    sums = {r.bucket: r["sum"] for r in table.groupBy("bucket").agg(short).collect()}
    assert sums[1] == sums[2]
    assert sorted(r.bucket for r in _distinct_buckets(table).collect()) == [1, 2, 4, 5]
