"""Secret patterns against plain searches; the random field against all paths of short chains."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from helpers import FOLDER, awkward, empty, with_clashes

from shelfcast.llm.secret_scan import (
    BEGIN,
    INSIDE,
    NEVER,
    OUTSIDE,
    SecretParams,
    SecretScanner,
    Tokens,
    base_spans,
    fit_secrets,
    fit_tagged,
    log_likelihood,
    scan_secrets,
    span_list,
    viterbi,
)

ASSIGN = (
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
)
TEXTS = [
    "password=abcdefghijkl", "PassWord : 'abcdefghijk'", "password=token:abcdefghijklmnop", "api_key==x",
    'token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" end', "ſecret=abcdefghijklmn", "toKen=abcdefghijklm",
    "AKIA" + "A" * 13, "AKIA" + "A" * 14, "AKIAKIA" + "Z" * 20, "0123456789abcde", "0123456789abcdef",
    "x0123456789abcdefABCDEF 00ff" * 3, "😀 secret=ééé apikey:0123456789abcdef0", "secret:\nabcdefghijklmn",
    "passwd" + " " * 300 + "=" + " " * 300 + "A" * 30, "secret=" * 50, "token=a.b-c_d+e/f=g.h",
]


def plain_spans(text):
    spans = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m.group(2)) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(spans)


def test_pattern_spans_equal_plain_searches():
    rng = random.Random(3)
    parts = ["password", "Token", "api_key", "apikey", "=", ":", " ", "'", '"', "AKIA", "A1", "ab3", "é", "-", "9f" * 5]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    found = [[s[:3] for s in base_spans(t)] for t in made + TEXTS]
    assert found == [plain_spans(t) for t in made + TEXTS]
    assert sum(map(len, found)) > 500


@pytest.mark.parametrize("n", [1, 2, 4, 6])
@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_best_path_equals_trying_all(n, block):
    rng = np.random.default_rng(n)
    for _ in range(10):
        scores, moves = rng.normal(size=(n, 3)) * 2, rng.normal(size=(3, 3))
        moves[OUTSIDE, INSIDE] = NEVER

        def total(path):
            before = (OUTSIDE, *path)
            return sum(moves[before[k], t] + scores[k, t] for k, t in enumerate(path))

        best = max(itertools.product(range(3), repeat=n), key=total)
        assert tuple(viterbi(scores, moves, block)) == best


def test_likelihood_and_shares_equal_summing_all_paths():
    rng = np.random.default_rng(8)
    scores, moves = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))
    tags = np.array([[0, 1, 2, 0], [1, 2, 2, 1]])
    value, shares, pairs = log_likelihood(scores, moves, tags)
    for c in range(2):
        weight = {
            p: np.exp(sum(scores[c, k, t] for k, t in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:])))
            for p in itertools.product(range(3), repeat=4)
        }
        whole = sum(weight.values())
        assert value[c] == pytest.approx(np.log(weight[tuple(tags[c])] / whole))
        for t, tag in itertools.product(range(4), range(3)):
            assert shares[c, t, tag] == pytest.approx(sum(w for p, w in weight.items() if p[t] == tag) / whole)
        assert pairs[c, 1, 2, 0] == pytest.approx(
            sum(w for p, w in weight.items() if p[1:3] == (2, 0)) / whole
        )


def test_tokens_and_tags():
    tokens = Tokens(["ab-12 é_xyz", "", "z a+b+c"], 1 << 10, 5)
    assert tokens.line.tolist() == [0, 1, 2, -1, 3, 4, 5, -1, 6, 7, 8, 9, 10, -1]
    assert tokens.text.tolist() == [0] * 6 + [2] * 5
    tags = tokens.tags([(0, 3, 5), (2, 2, 7)])
    assert tags.tolist() == [0, 0, 1, 0, 0, 0, 0, 0, 1, 2, 2, 2, 2, 0]
    assert tokens.features.shape[1] == 11 and tokens.features.max() < 1 << 10
    assert not len(Tokens(["few short words", ""], 1 << 10, 12).line)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{FOLDER.replace('0.001', '0.1')}/documents.parquet")
    return fit_secrets(docs)


def test_the_field_finds_what_patterns_find_in_other_texts(spark, model):
    from shelfcast.llm.common import documents

    texts = [r.text for r in documents(spark, FOLDER).collect()]
    held = [t for t in texts if t and base_spans(t)]
    learned = SecretScanner(model).learned_spans(held)
    pairs = [(s, spans) for t, spans in zip(held, learned) for s in base_spans(t)]
    hit = sum(any(a < end and start < b for a, b in spans) for (start, _, end, _), spans in pairs)
    assert hit >= 0.9 * len(pairs)


def test_the_field_adds_secrets_and_leaves_prose_alone(model):
    scanner = SecretScanner(model)
    _, spans = scanner.scan(["key sk-live-51Hx9ZpQ2mL8vRt0Wq ok"])[0]
    assert [KIND for _, KIND, _ in spans] == [3]
    prose = ["The harbour was quiet, and nobody expected extraordinarily complicated news."] * 3
    assert scanner.scan(prose) == [([], [])] * 3


def test_texts_do_not_depend_on_their_slice(model):
    scanner = SecretScanner(model)
    together = scanner.scan(TEXTS)
    assert together == [scanner.scan([t])[0] for t in TEXTS]
    for text, (base, every) in zip(TEXTS, together):
        assert base == plain_spans(text) and set(base) <= set(every) and every == sorted(every)


def test_awkward_rows(spark, model):
    docs = awkward(spark, TEXTS)
    want = []
    for r in docs.collect():
        base = plain_spans(r.text or "")
        counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        want.append((r.doc_id, *counts, hashlib.sha256(span_list(base).encode()).hexdigest()))
    got = scan_secrets(with_clashes(docs), model)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == sorted(want, key=str)
    assert scan_secrets(empty(spark), model).count() == 0


def test_nothing_to_learn_from(spark):
    silent = fit_secrets(empty(spark))
    assert SecretScanner(silent).learned_spans(["sk-live-51Hx9ZpQ2mL8vRt0Wq"]) == [[]]
    assert not SecretScanner(fit_tagged(["plain words"], SecretParams())).learned_spans(["x" * 40])[0]
