"""Classifiers: held-out accuracy, folds and awkward rows."""

import random
import zlib

import numpy as np
import pytest
from helpers import FOLDER, awkward, empty, with_clashes
from pyspark.sql import functions as F

from shelfcast.llm import quality as ql
from shelfcast.llm import toxicity as tx
from shelfcast.llm.catalog import QUERIES
from shelfcast.llm.labelled import balanced_sample, fold

SMALL = tx.ToxicityParams(per_class=200, buckets=1 << 12, steps=600)
BRIEF = ql.QualityParams(per_class=200, buckets=1 << 14, epochs=4)
LABELS = "doc_id long, toxic int, quality int"


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    good, bad = scores[labels == 1], scores[labels == 0]
    return (good[:, None] > bad[None]).mean() + (good[:, None] == bad[None]).mean() / 2


@pytest.fixture(scope="module")
def insults():
    """Texts with one of six bad words among neutral ones, and texts without."""
    rng, rows = random.Random(3), []
    bad = ["scum", "idiot", "moron", "trash", "loser", "clown"]
    for k in range(600):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        toxic = k % 3 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((" ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def junk():
    """Prose against shouting, symbols and repeated words."""
    rng, rows = random.Random(4), []
    for k in range(500):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        kind = k % 4
        if kind == 0:
            words = [w.upper() + "!!" for w in words]
        elif kind == 1:
            words = [w for w in words[:4] for _ in range(15)]
        rows.append((" ".join(words), int(kind > 1)))
    return rows


def test_toxicity_finds_words_it_has_not_seen_together(insults):
    model = tx.train(insults[:400], SMALL, 1 / 3)
    scores = [model.score(tx.word_rows([t], SMALL)[0]) for t, _ in insults[400:]]
    assert auc(scores, [y for _, y in insults[400:]]) > 0.95
    assert all(0 <= s <= 1 for s in scores)


def test_long_texts_are_read_whole(insults):
    model = tx.train(insults[:400], SMALL, 1 / 3)
    words = ["w1"] * (tx.BLOCK_WORDS + 10) + ["idiot"] + ["w2"] * 50
    plain = model.score(tx.word_rows([" ".join(w for w in words if w != "idiot")], SMALL)[0])
    assert model.score(tx.word_rows([" ".join(words)], SMALL)[0]) > plain + 0.1


def test_pooling_does_not_depend_on_the_blocks(insults, monkeypatch):
    model = tx.new_model(SMALL)
    rows = tx.word_rows([" ".join(t for t, _ in insults[:30])], SMALL)[0]
    whole = model.pooled(rows)
    monkeypatch.setattr(tx, "BLOCK_WORDS", 7)
    assert np.allclose(model.pooled(rows), whole, atol=1e-6)


def test_thresholds_follow_the_language(insults):
    model = tx.train(insults[:300], SMALL, 1 / 3)
    sample = [(t, y, "en" if k % 2 else "de") for k, (t, y) in enumerate(insults[300:])]
    tx.calibrate(model, sample + [("x", 1, "fr")])
    assert set(model.thresholds) == {"en", "de"}


def test_thresholds_do_not_depend_on_the_balance_of_the_sample():
    """Overlapping scores: the natural sample (a tenth toxic), and a balanced one of the same."""

    class Fixed:
        def __init__(self):
            self.params, self.thresholds = SMALL, {}

        def score(self, rows):
            return len(rows) / 100

    rng = np.random.default_rng(5)
    toxic = np.clip(rng.normal(45, 15, 500), 1, 99).astype(int).tolist()
    clean = np.clip(rng.normal(20, 12, 4500), 1, 99).astype(int).tolist()

    def sample(clean):
        return [("w " * n, y, "en") for y, many in ((1, toxic), (0, clean)) for n in many]

    natural = tx.calibrate(Fixed(), sample(clean)).thresholds["en"]
    assert tx.calibrate(Fixed(), sample(clean), 0.1).thresholds["en"] == natural
    even = tx.calibrate(Fixed(), sample(sorted(clean)[4::9]), 0.1).thresholds["en"]
    assert even == pytest.approx(natural, abs=0.03)
    assert tx.calibrate(Fixed(), sample(sorted(clean)[4::9])).thresholds["en"] < natural - 0.1


def test_fitted_thresholds_know_the_true_share(spark, monkeypatch):
    got = []
    monkeypatch.setattr(tx, "train", lambda sample, params, prior: tx.new_model(params))
    monkeypatch.setattr(tx, "calibrate", lambda model, sample, prior=None: got.append((sample, prior)))
    docs = spark.createDataFrame([(k, "x", "en") for k in range(400)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 10 == 0), 1) for k in range(400)], LABELS)
    params = tx.ToxicityParams(per_class=40, buckets=1 << 8)
    tx.fit_toxicity(docs, labels, params=params)
    assert got[0][1] == pytest.approx(0.1) and np.mean([y for _, y, _ in got[0][0]]) > 0.3


def test_all_labelled_documents_count(spark, monkeypatch):
    """Many more than one shard holds, a long text among them: learned from or in a tally, all."""
    rng, seen = random.Random(8), []
    bad = [f"bad{k}" for k in range(12)]
    rows = [(k, int(k % 4 == 0), [f"w{rng.randrange(200)}" for _ in range(15)]) for k in range(1200)]
    rows = [(k, y, " ".join([*words, bad[k // 4 % 12]] if y else words)) for k, y, words in rows]
    long = next(k for k, y, _ in rows if not y)
    rows[long] = (long, 0, rows[long][2] + " w1" * 40_000)
    docs = spark.createDataFrame([(k, t, "en") for k, _, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, y, 1) for k, y, _ in rows], LABELS)
    calibrate = tx.calibrate
    monkeypatch.setattr(tx, "calibrate", lambda m, sample, prior: seen.extend(sample) or calibrate(m, sample, prior))
    train_shards = tx.train_shards
    learned = []
    monkeypatch.setattr(
        tx, "train_shards", lambda rows, *rest: learned.append(rows.count()) or train_shards(rows, *rest)
    )
    model = tx.fit_toxicity(docs, labels, params=tx.ToxicityParams(per_class=75, buckets=1 << 12, steps=200, batch=8))
    assert learned[0] + sum(t.n for t, _, _ in seen) == len(rows)
    scores = [model.score(tx.word_rows([t], model.params)[0]) for _, _, t in rows]
    assert auc(scores, [y for _, y, _ in rows]) > 0.9 and set(model.thresholds) == {"en"}
    calls = []
    start = tx.Learner(tx.new_model(model.params))
    monkeypatch.setattr(tx, "_started", lambda rows, *rest: calls.append(rows.count()) or start)
    monkeypatch.setattr(
        tx, "_mean_change", lambda rows, *rest: calls.append(rows.count()) or 0 * start.numbers()
    )
    tx.fit_toxicity(docs, labels, params=model.params)
    assert calls[0] < 300 and calls[1:] == [learned[0]] * model.params.passes
    files = tx.dealt(docs, labels, "toxic", model.params)
    files = files.withColumn("file", F.input_file_name()).select("shard", "file").distinct()
    assert files.count() == files.select("shard").distinct().count() == 9


def test_a_shard_makes_one_change_for_any_partitions(spark, monkeypatch):
    """A pass gives one change for each shard, also where a cluster has many more partitions."""
    docs = spark.createDataFrame(
        [(k % 390 if k % 7 else None, f"w{k % 50} x", "en") for k in range(400)],
        "doc_id long, text string, lang string",
    )
    labels = spark.createDataFrame([(k, k % 2, 1) for k in range(0, 500, 2)] + [(None, 1, 1)], LABELS)
    params = tx.ToxicityParams(per_class=40, buckets=1 << 8, steps=2)
    repartition, made = type(docs).repartition, []
    monkeypatch.setattr(
        type(docs), "repartition",
        lambda df, n, *keys: repartition(df, max(n, 40) if keys else n, *keys),
    )
    rows = tx.dealt(docs, labels, "toxic", params)
    by_id = [k % 390 for k in range(400) if k % 7 and k % 390 % 2 == 0]
    assert rows.count() == len(by_id)
    shards = rows.select("shard").distinct().count()
    group = type(docs).groupBy
    monkeypatch.setattr(type(docs), "groupBy", lambda df, *by: made.append(df) or group(df, *by))
    tx._mean_change(rows, "toxic", tx.Learner(tx.new_model(params)), (1.0, 1.0), 0)
    assert shards > 1 and made[0].where("slice = 0").count() == shards


def test_tallies_give_the_thresholds_of_their_texts(spark, insults):
    model = tx.train(insults[:200], SMALL, 1 / 3)
    rows = [(t, y, "de" if k % 4 else None) for k, (t, y) in enumerate(insults[200:])]
    df = spark.createDataFrame(rows, "text string, toxic int, lang string").repartition(5)
    found = tx.tallies(df, "toxic", model)
    assert sum(t.n for t, _, _ in found) == len(rows) and len(found) < len(rows)
    by_tally = dict(tx.calibrate(model, found, 0.2).thresholds)
    model.thresholds.clear()
    assert tx.calibrate(model, rows, 0.2).thresholds == by_tally and set(by_tally) == {"de", None}


def test_quality_knows_noise(junk):
    model = ql.train(junk[:350], BRIEF, 0.5)
    scores = ql.scores([t for t, _ in junk[350:]], model)
    assert auc(scores, [y for _, y in junk[350:]]) > 0.98


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    many = ["One two two.", "", "  ", "x", "two words"]
    together = [[] for _ in many]
    for rows, owner in ql.feature_rows(many, BRIEF):
        for row, k in zip(rows.tolist(), owner.tolist()):
            together[k].append(row)
    for text, found in zip(many, together):
        rows, counts = ql.document_features(text, BRIEF)
        assert sorted(found) == np.repeat(rows, counts.astype(int)).tolist()
    assert together[1] == together[2] == []


def test_samples_are_bounded_and_clean(spark):
    docs = spark.createDataFrame([(k, "x" * k, "en") for k in range(40)], "doc_id long, text string, lang string")
    labels = [(k, k % 2, 1) for k in range(40)] + [(None, 1, 1), (3, None, 0), (3, 0, 0)]
    labels = spark.createDataFrame(labels, LABELS)
    got = balanced_sample(docs, labels, "toxic", 5, 30).collect()
    assert len(got) <= 10 and all(len(r.text) <= 30 for r in got)
    assert all(r.toxic == (r.doc_id % 2) for r in got)
    assert balanced_sample(docs, labels.limit(0), "toxic", 5, 30).count() == 0


def test_folds_are_those_of_the_ids_as_text(spark):
    got = spark.range(50).select("id", fold("id", 4).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 4 for r in got)


def test_scores_of_awkward_rows(spark, insults, junk):
    docs = with_clashes(awkward(spark))
    toxic = tx.score_toxicity(docs, tx.train(insults[:50], SMALL, 0.3)).collect()
    good = ql.score_quality(docs, ql.train(junk[:50], BRIEF, 0.5)).collect()
    assert len(toxic) == len(good) == docs.count()
    assert all(0 <= r.score <= 1 for r in [*toxic, *good])
    assert len({r.score for r in good if r.doc_id in (1, 2, 3)}) == 1
    assert tx.score_toxicity(empty(spark), tx.new_model(SMALL)).count() == 0


def test_models_without_labels_give_the_share(spark):
    docs, labels = awkward(spark), spark.createDataFrame([], LABELS)
    model = tx.fit_toxicity(docs, labels, params=SMALL)
    assert {round(r.score, 6) for r in tx.score_toxicity(empty(spark), model).collect()} <= {0.5}
    assert ql.scores([""], ql.fit_quality(docs, labels, params=BRIEF))[0] == pytest.approx(0.5)


@pytest.mark.parametrize(
    "name, label, parts, out, least",
    [("op4_toxicity", "toxic", 4, 2, 0.7), ("op5_quality", "quality", 3, 1, 0.9)],
)
def test_held_out_accuracy_of_the_queries(spark, name, label, parts, out, least):
    folder = FOLDER.replace("0.001", "0.1" if label == "toxic" else "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", label)
    scored = QUERIES[name](spark, folder)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % parts == out for r in rows)
    assert auc([r.score for r in rows], [r[label] for r in rows]) > least
    wrong = scored.where(F.col("score").isNull() | ~F.col("score").between(0, 1)).count()
    assert wrong == 0 and scored.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
