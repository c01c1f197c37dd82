"""Nearest neighbours, fingerprints, license scans, mixing and the pipeline."""

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import FOLDER, awkward, brute_components, brute_kept, empty, with_clashes
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from shelfcast.llm import fingerprints as fp
from shelfcast.llm import licenses as lic
from shelfcast.llm.catalog import ORACLES, QUERIES
from shelfcast.llm.mixing import MixParams, find_exponent, mix_sources, mixture
from shelfcast.llm.nearest import SearchParams, fit_hashing, nearest

VECTORS = "vec_id long, embedding array<float>"


def exact_nearest(rows, query, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    distance = np.sqrt(((x - x[ids == query][0]) ** 2).sum(1))
    order = [n for n in np.lexsort((ids, distance)) if ids[n] != query]
    return [(int(ids[n]), float(distance[n])) for n in order[:k]]


@pytest.mark.parametrize("scale", ["0.001", "0.1"])
def test_recall_of_the_query(spark, scale):
    folder = FOLDER.replace("0.001", scale)
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = {}
    answers = QUERIES["op8_nearest_neighbours"](spark, folder).collect()
    assert sum(r.exact for r in answers) <= 0.01 * len(answers) or scale == "0.001"
    for r in answers:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i, _ in rows if i % 100 == 0}
    hits = 0
    for query, got in found.items():
        wanted = dict(exact_nearest(rows, query))
        got.sort()
        assert [g[0] for g in got] == list(range(1, 11))
        assert [(g[2], g[1]) for g in got] == sorted((g[2], g[1]) for g in got)
        assert all(wanted.get(i, s) == pytest.approx(s, abs=1e-12) for _, i, s in got)
        hits += sum(i in wanted for _, i, _ in got)
    assert hits / 10 / len(found) >= 0.9


def test_equal_vectors_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    same = rng.normal(size=8).tolist()
    rows = [(i, same) for i in range(0, 60)] + [(100 + i, rng.normal(size=8).tolist()) for i in range(40)]
    bad = [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (None, same), (203, [1.0]),
           (204, [None] * 8), (205, [float("inf")] + [1.0] * 7)]
    table = spark.createDataFrame(rows + bad, VECTORS)
    params = SearchParams(block_rows=16)
    got = nearest(table, F.col("id").isin(0, 5, 100), params).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found[0] == [(i, 0.0) for i in range(1, 11)]
    assert found[5] == [(i, 0.0) for i in (0, 1, 2, 3, 4, 6, 7, 8, 9, 10)]
    assert len(found[100]) == 10 and not {i for i, _ in found[100]} & set(range(200, 206))
    assert nearest(spark.createDataFrame([], VECTORS), F.col("id") >= 0).count() == 0
    few = nearest(spark.createDataFrame(rows[:1] + rows[60:62], VECTORS), F.col("id") == 0).collect()
    assert [(r["rank"], r.vec_id) for r in few] in ([(1, 100), (2, 101)], [(1, 101), (2, 100)])


@pytest.mark.parametrize("spread", [1e-5, 0.02])
def test_sparse_regions_of_skewed_vectors(spark, spread):
    """Nine tenths of the vectors in tight clusters; the others find all their neighbours, too."""
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(6, 16))
    tight = middle[np.arange(540) % 6] + rng.normal(size=(540, 16)) * spread
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([tight, rng.normal(size=(60, 16)) * 3]))]
    asked = [0, 7, *range(540, 560)]
    found = {}
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in nearest(table, F.col("id").isin(asked), SearchParams(block_rows=64)).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == set(asked)
    for query in asked[2:]:
        wanted = exact_nearest(rows, query)
        assert [i for _, i, _ in sorted(found[query])] == [i for i, _ in wanted]
        assert [s for *_, s in sorted(found[query])] == pytest.approx([s for _, s in wanted])
    assert all(len(found[query]) == 10 for query in asked)


def test_hot_cluster_of_queries_and_ties(spark):
    """Half of all rows, all of them queries, lie close together; ties go to the smaller id."""
    rng = np.random.default_rng(11)
    spots = rng.normal(size=8) + rng.normal(size=(40, 8)) * 1e-3
    hot = spots[np.arange(400) % 40]
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([hot, rng.normal(size=(400, 8))]))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(table, F.col("id") < 400, SearchParams(k=12, block_rows=32)).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(found) == set(range(400))
    for query, near in found.items():
        same = [i for i in range(query % 40, 400, 40) if i != query]
        assert [i for _, i in sorted(near)][: len(same)] == same
        assert [n for n, _ in sorted(near)] == list(range(1, 13))


def test_reach_falls_with_the_wanted_chance():
    vectors = np.random.default_rng(5).normal(size=(500, 12))
    reaches = [
        fit_hashing(vectors, 500, SearchParams(least=least)).reach() for least in (0.5, 0.9, 0.96)
    ]
    assert reaches == sorted(reaches, reverse=True) and reaches[-1] > 0.9


def edits(rows):
    """Edited text of each (doc_id, text), unique ids."""
    rows, out = sorted(rows, reverse=True), {}
    for k, (i, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        out[i] = hashlib.sha256((text[: len(text) - cut] + other[:cut]).encode()).hexdigest()
    return out


def test_edited_texts_and_likeness(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = QUERIES["op6_document_fingerprints"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.edited_sha256 for r in got} == edits(list(texts.items()))
    assert all(r.n_chars == len(texts[r.doc_id]) for r in got)
    prints = {}
    for r in got:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert np.mean([r.near_edited for r in got]) > 5 * np.mean([r.near_next for r in got])


def test_next_ids_across_groups(spark):
    ids = [3, -5, 0, 4095, 4096, 4097, 10**9, 10**13, -(10**10)]
    table = spark.createDataFrame([(i,) for i in ids], "id long")
    found = {r.id: r.next for r in fp.successors(table).collect()}
    falling = sorted(ids, reverse=True)
    assert found == dict(zip(falling, falling[1:] + falling[:1]))
    docs = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string")
    texts = fp.with_next(docs, ["text"], docs).collect()
    assert {r.doc_id: int(r.next_text) for r in texts} == found


def test_fingerprints_of_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    got = fp.compare_with_edits(docs).collect()
    assert len(got) == docs.count()
    assert len({r.fingerprint for r in got if r.doc_id in (4, 5)}) == 1
    assert all(r.near_next == 0 for r in got if r.doc_id is None)
    assert fp.compare_with_edits(empty(spark)).count() == 0


def test_templates_accept_optional_and_replaceable_wording():
    machine = lic.TemplateAutomaton.compile(
        '<<beginOptional>>this <<var;match=".*">> is<<endOptional>> under the x license'
        ' <<var;match="v|version";max=1;min=0>> <<var;match="[0-9]+";max=2>>'
    )
    def accepts(text):
        words = lic.words_of(text)
        return machine.end_of_match(words, 0) is not None
    assert accepts("This WORK is under the X-License, version 2.0")
    assert accepts("under the x license 3")
    assert not accepts("this is under the x license 3")
    assert not accepts("under the x license version")
    assert not accepts("under the y license 3")
    assert set(machine.needed_words()) == {b"under", b"the", b"x", b"license"}
    assert machine.first_words() == {b"this", b"under"}


def test_phrases_are_counted_at_all_places():
    scanner = lic.LicenseScanner()
    n_words, places, matches = scanner.scan("CC-BY cc by, occ by. All  rights\nreserved cc by-nc")
    labels = [(0, "cc-by"), (2, "cc-by"), (6, "reserved"), (9, "cc-by")]
    assert (n_words, sorted(places)) == (12, labels)
    assert matches == []
    assert scanner.scan("") == (0, [], []) and scanner.scan("état é9")[0] == 2


def test_license_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    found = con.execute(ORACLES["op9_license_scans"])
    names = [d[0] for d in found.description]
    got = QUERIES["op9_license_scans"](spark, FOLDER).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(found.fetchall())


def test_licenses_of_awkward_rows(spark):
    docs = with_clashes(awkward(spark, ["all rights reserved", "Released under the MIT License."]))
    got = {r.doc_id: r for r in lic.scan_licenses(docs).collect()}
    assert len(got) == docs.select("doc_id").distinct().count()
    assert got[100].labels == "reserved" and got[100].score == 0.5
    assert got[101].labels == "mit" and got[101].base_labels == "" and got[101].score == 1
    assert got[2].n_words == 0 and got[2].first_word is None
    assert lic.scan_licenses(empty(spark)).count() == 0


def sources(spark, sizes):
    rows = [(f"s{k}", n, n) for k, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "_source string, n_tokens long, n_docs long")


def brute_exponent(sizes, entropy, repeats):
    share = np.array(sizes) / sum(sizes)
    for a in np.linspace(1, 0, 20001):
        w = share**a / (share**a).sum()
        if -(w * np.log(w)).sum() / math.log(len(w)) >= entropy:
            break
    spread = lambda a: (share ** (a - 1)).max() / (share ** (a - 1)).min()
    while spread(a) > repeats:
        a += 0.00005
    return a


@pytest.mark.parametrize("entropy, repeats", [(0.9, 100.0), (0.99, 2.0), (0.5, 3.0)])
def test_exponent_is_that_of_a_fine_grid(spark, entropy, repeats):
    sizes = [1000, 300, 200, 90]
    got = find_exponent(sources(spark, sizes), MixParams(entropy=entropy, repeats=repeats))
    assert got == pytest.approx(brute_exponent(sizes, entropy, repeats), abs=2e-4)


@pytest.mark.parametrize("budget", [None, 3000.0, 9000.0])
def test_weights_are_realised(spark, budget):
    rows = [(k, "a b c", "en", "big" if k < 900 else f"s{k % 3}", 5) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    params = MixParams(entropy=0.97, repeats=50.0, budget=budget, block_rows=64)
    mixed = mix_sources(docs, params).collect()
    weights = {r.source: r.mix_weight for r in mixed}
    assert sum(weights.values()) == pytest.approx(1)
    tokens = Counter()
    for r in mixed:
        tokens[r.source] += r.mix_tokens * r.mix_copies
    whole = budget or sum(tokens.values())
    for source, weight in weights.items():
        assert weight * whole - 3 - 1e-6 <= tokens[source] + (0 if budget else 3)
        assert tokens[source] <= weight * whole + 6
    if budget is None:
        assert min(r.mix_copies for r in mixed) == 1
    by_doc = {r.doc_id: r.mix_copies for r in mix_sources(docs, params).collect()}
    assert by_doc == {r.doc_id: r.mix_copies for r in mixed}


def brute_copies(docs, params, weights, budget):
    """mix_copies of each doc_id: whole blocks, then documents, in the order of their hashes."""
    source = F.concat(F.lit("="), F.col("source"))
    hashed = docs.select(
        "*", source.alias("key"), F.xxhash64(F.lit(params.seed), "doc_id", "text").alias("draw")
    ).select("*", F.xxhash64(F.lit(params.seed + 1), "draw").alias("inside"))
    members = {}
    for r in hashed.collect():
        members.setdefault(r.source, []).append((r, len(r.text.split())))
    turns = docs.sparkSession.createDataFrame(
        [(f"={s}", b) for s, m in members.items() for b in range(math.ceil(len(m) / params.block_rows))],
        "key string, block long",
    )
    turn_of = {
        (r.key, r.block): r.turn
        for r in turns.select("*", F.xxhash64(F.lit(params.seed), "key", "block").alias("turn")).collect()
    }
    copies = {}
    for name, held in members.items():
        blocks = math.ceil(len(held) / params.block_rows)
        total = sum(n for _, n in held)
        tokens = weights[name] * budget * (1 + 1e-12)
        whole = math.floor(tokens / total)
        rest, used, sized = tokens - whole * total, 0, {}
        for r, n in held:
            sized.setdefault(r.draw % blocks, []).append((r.inside, r.doc_id, n))
        copies |= {r.doc_id: whole for r, _ in held}
        for block in sorted(sized, key=lambda b: (turn_of[f"={name}", b], b)):
            if used >= rest:
                break
            size = sum(n for *_, n in sized[block])
            reached = used
            for _, doc_id, n in sorted(sized[block]):
                reached += n
                if reached > rest:
                    break
                copies[doc_id] += 1
            used += size
    return copies


@pytest.mark.parametrize("bits", [1, 16])
def test_copies_against_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr("shelfcast.llm.mixing.SLAB_BITS", bits)
    rng = np.random.default_rng(8)
    rows = [
        (k, " ".join(["w"] * int(rng.integers(0, 9))), "big" if k < 1500 else f"s{k % 3}")
        for k in range(2000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    params = MixParams(entropy=0.97, repeats=50.0, budget=7777.0, block_rows=16)
    mixed = mix_sources(docs, params).collect()
    weights = {r.source: r.mix_weight for r in mixed}
    wanted = brute_copies(docs, params, weights, 7777.0)
    assert {r.doc_id: r.mix_copies for r in mixed} == wanted
    assert len(set(wanted.values())) > 2


def test_equal_rows_are_taken_or_left_together(spark):
    rows = [(1, "one two three", "a")] * 300 + [(k, "one two", "b") for k in range(2, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mix_sources(docs, MixParams(budget=1500.0, block_rows=8)).collect()
    assert len(mixed) == 398 and len({r.mix_copies for r in mixed if r.doc_id == 1}) == 1


def test_mixing_bears_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    mixed = mix_sources(docs).collect()
    assert len(mixed) == docs.count() and all(r.mix_copies >= 1 for r in mixed)
    again = mixture(docs)
    assert again.columns == docs.columns
    assert again.count() == sum(r.mix_copies for r in mixed)
    assert mixture(empty(spark)).count() == 0


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "minhash_near_dup", "suffix_array_dedup", "source_mixing", "bpe_codec"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    near = stages["minhash_near_dup"](spark, docs, FOLDER)
    groups = brute_components(rows, 5)
    left = [(i, t) for i, t in rows if groups[i][1] == i]
    assert near.columns == docs.columns
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, _ in left)
    clean = {r.doc_id: r.text for r in stages["suffix_array_dedup"](spark, docs, FOLDER).collect()}
    removed = 0
    for i, raw, gone in brute_kept(rows, pipeline.REPEATS.length):
        kept = bytes(b for b, g in zip(raw, gone[1:-1]) if not g)
        assert clean[i] == kept.decode("utf-8", "ignore")
        removed += int(gone.sum())
    assert removed


def test_pipeline_runs_and_bears_empty_tables(spark, tmp_path):
    got = pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 100
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        made = stage(spark, docs.limit(0), FOLDER)
        assert made.columns == docs.columns and made.count() == 0


@pytest.mark.parametrize("name", ["op1_minhash_near_dup", "op10_suffix_array_dedup"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    got = QUERIES[name](spark, FOLDER).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(found.fetchall())
