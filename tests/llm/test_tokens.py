"""Encoding, decoding and counting against the library whose vocabulary is used."""

import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, empty, with_clashes
from tokenizers import Tokenizer

from shelfcast.llm.bpe_codec import PrefixEncoder, encode_documents, round_trip
from shelfcast.llm.bpe_rules import BpeRules, read_tokenizer
from shelfcast.llm.pieces import DIGIT, EDGE, EDGE_MARK, LETTER, OTHER, SPACE, class_table
from shelfcast.llm.token_counts import ChunkMaps, Symbols, TokenCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", " ", "the", "<|endoftext|>", "'s", "'ll", "'re", "'", "''", " '", "s", "d", "\n",
    "\t", "\x1c", "\x85", "\xa0", "é", "ß", "1", "²", "Ⅷ", "漢", "　", "😀", "a" * 18, "____",
    "  ", "\r\n", "<|", "|>", "​", "=====", "\x00", "0000000", "ing", "tion",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def rules():
    return BpeRules(read_tokenizer(PATH))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    mixed = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    plain = ["".join(rng.choice("abeinth str") for _ in range(60)) for _ in range(1000)]
    points = [chr(rng.randrange(0x20, 0xD7FF)) for _ in range(3000)]
    return mixed + plain + [f"a{c}1{c} {c}!" for c in points]


def test_ids_and_text_are_those_of_the_library(rules, library, texts):
    encoder = PrefixEncoder(rules)
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    packed = encoder.encode_many(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == wanted
    decoded = [library.decode(ids, skip_special_tokens=False) for ids in wanted]
    assert [encoder.decode(p) for p in packed] == decoded == texts


def thue_morse(letters, size=1024):
    word = letters[0]
    while len(word) < size:
        word += word.translate(str.maketrans(letters, letters[::-1]))
    return word


def test_words_with_equal_polynomials_are_told_apart(rules, library):
    pair = [thue_morse("ab"), thue_morse("ba")]
    wanted = [e.ids for e in library.encode_batch(pair * 2, add_special_tokens=False)]
    assert wanted[0] != wanted[1]
    packed = PrefixEncoder(rules).encode_many(pair * 2)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == wanted
    counter = TokenCounter(rules)
    assert counter.counts(pair * 2) == [len(ids) for ids in wanted]
    assert counter.counts(pair[::-1]) == [len(ids) for ids in wanted[1::-1]]


def test_broken_characters_are_decoded_like_the_library(rules, library):
    encoder = PrefixEncoder(rules)
    for ids in ([247], [10263], [0, 247, 0], [160, 120]):
        packed = np.array(ids, "<u4").tobytes()
        assert encoder.decode(packed) == library.decode(ids, skip_special_tokens=False)


RUNS = [
    "a" * 3000,
    "ab" * 1500,
    "漢字仮名" * 400,
    " " * 900 + "x" + "\n" * 700,
    "=-" * 800,
    "it's" * 300 + "'" * 300,
    "'re 're're" * 90,
    "😀" * 300,
    "".join(random.Random(9).choice("ACGT") for _ in range(3000)),
]


@pytest.mark.parametrize("chunk, batch", [(3, 50), (16, 997), (128, 1 << 20)])
def test_counts_do_not_depend_on_chunks_and_batches(rules, library, texts, chunk, batch):
    some = texts[::7] + RUNS
    counter = TokenCounter(rules, chunk=chunk, batch=batch)
    wanted = [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]
    assert counter.counts(some) == wanted


def test_few_states_give_the_same_counts(rules, library, texts):
    counter = TokenCounter(rules, batch=300, max_states=10)
    some = texts[:500] + RUNS[:3]
    wanted = [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]
    assert counter.counts(some) == wanted


def chunk_maps(rules, text, chunk):
    """Symbols, borders and maps of the chunks of one text, and the counter."""
    counter = TokenCounter(rules, chunk=chunk)
    symbols = Symbols.read([(text, 0, len(text))])
    borders = symbols.chunks(chunk)
    return counter, symbols, borders, counter.maps(symbols, borders, 0)


@pytest.mark.parametrize("text", RUNS)
def test_tables_of_chunks_hold_what_single_steps_give(rules, text):
    counter, symbols, borders, maps = chunk_maps(rules, text, 16)
    states = np.full(1, 0)
    total, at = 0, 0
    for k, end in enumerate(borders[1:].tolist()):
        entry, before = states.copy(), total
        for place in range(at, end):
            if place in symbols.starts:
                states[:] = 0
            states, emitted = counter.transducer.step(states, symbols.values[place : place + 1])
            total += int(emitted[0])
        row = maps.rows(np.array([k]), entry)
        assert (maps.exit[row], maps.tokens[row]) == (states, total - before)
        at = end


@pytest.mark.parametrize("text", RUNS)
def test_composing_maps_is_associative(rules, text):
    *_, maps = chunk_maps(rules, text, 16)
    count = int(maps.chunk[-1]) + 1

    def shifted(by):
        """Maps of the chunks by, by + 1, ..., numbered from 0."""
        held = (maps.chunk >= by) & (maps.chunk < count - 2 + by)
        return ChunkMaps(maps.chunk[held] - by, *(c[held] for c in maps.columns()[1:]))

    a, b, c = shifted(0), shifted(1), shifted(2)
    left, right = a.then(b).then(c), a.then(b.then(c))
    for x, y in zip(left.columns(), right.columns()):
        assert x.tolist() == y.tolist()
    scanned = maps.scan(count)
    state, total = 0, 0
    for k in range(count):
        row = maps.rows(np.array([k]), np.array([state]))[0]
        state, total = int(maps.exit[row]), total + int(maps.tokens[row])
        assert (scanned.exit[k], scanned.tokens[k]) == (state, total)


def test_awkward_rows(spark, library):
    docs = awkward(spark)
    rows = docs.collect()

    def wanted(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        return (
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest(),
        )

    expected = sorted([(r.doc_id, *wanted(r.text)) for r in rows], key=str)
    assert sorted(map(tuple, round_trip(with_clashes(docs), PATH).collect()), key=str) == expected
    sizes = [(r.doc_id, len((r.text or "").encode()), wanted(r.text)[0]) for r in rows]
    got = count_tokens(with_clashes(docs), PATH).collect()
    assert sorted(map(tuple, got), key=str) == sorted(sizes, key=str)
    lists = encode_documents(docs, PATH).collect()
    assert sorted((r.doc_id or -1, len(r.ids)) for r in lists) == sorted(
        (i or -1, n) for i, _, n in sizes
    )


def test_empty_tables(spark):
    assert round_trip(empty(spark), PATH).count() == 0
    assert count_tokens(empty(spark), PATH).count() == 0


def test_classes_of_characters_are_found_in_little_memory():
    tracemalloc.start()
    table = class_table.__wrapped__()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(table)
    for char, kind in (("a", LETTER), ("漢", LETTER), ("²", DIGIT), ("\x85", SPACE), ("\u3000", SPACE), ("😀", OTHER)):
        assert table[ord(char)] == kind
    assert (table[0xD800:0xE000] == OTHER).all() and table[EDGE_MARK] == EDGE
