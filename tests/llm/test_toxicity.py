import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tideload.llm import toxicity as tox

LABELS = "doc_id long, toxic int"


def make(count, seed=4):
    rng = random.Random(seed)
    words = ["house", "tree", "river", "green", "walks", "often", "under", "stone", "light", "paper", "3", "Été"]
    bad = ["zorgle", "Kwixt!", "fnarb"]
    rows, labels = [], []
    for i in range(count):
        toxic = rng.random() < 0.3
        text = rng.choices(words, k=rng.randrange(5, 80))
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def fold_of(i):
    return zlib.crc32(str(i).encode()) % 3


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = make(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # Labels of the held-out fold are turned round: they must not be read.
    told = [(i, 1 - t if fold_of(i) == 1 else t) for i, t in labels]
    return docs, dict(labels), tox.fit(docs, spark.createDataFrame(told, LABELS))


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    got = {r.doc_id: r for r in tox.score(docs, model).collect()}
    held = [i for i in labels if fold_of(i) == 1]
    right = sum(got[i].predicted == labels[i] for i in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def plain_models(texts):
    """Interpolated Kneser-Ney by the formulas, with dictionaries: log ratio of a run's last sign."""
    counts = {c: Counter() for c in (0, 1)}
    for text, c in texts:
        counts[c].update(tox.runs_of([text.encode()])[0].tolist())
    levels = {tox.ORDER: counts}
    for order in range(tox.ORDER - 1, 0, -1):
        below = {c: Counter() for c in (0, 1)}
        for c in (0, 1):
            for run in levels[order + 1][c]:
                below[c][run & (1 << 8 * order) - 1] += 1
        levels[order] = below
    shared = levels[1][0] + levels[1][1]
    total = sum(shared.values())

    def p(c, order, run):
        if order == 0:
            return (shared[run & 255] + 1) / (total + 256)
        grams, run = levels[order][c], run & (1 << 8 * order) - 1
        own = [g for g in grams if g >> 8 == run >> 8]
        n = sum(grams[g] for g in own)
        if not n:
            return p(c, order - 1, run)
        return (max(grams[run] - tox.DISCOUNT, 0) + tox.DISCOUNT * len(own) * p(c, order - 1, run)) / n

    return lambda run: math.log(p(1, tox.ORDER, run)) - math.log(p(0, tox.ORDER, run))


def test_evidence_is_that_of_the_formulas(spark):
    rows, labels = make(60, seed=9)
    told = dict(labels)
    known = [(i, t) for i, t in rows if fold_of(i) == 0]
    model = tox.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))
    plain = plain_models([(t, told[i]) for i, t in known])
    unseen = tox.runs_of([b"a green zorgle kwixt never seen before, fnarb 12"])[0]
    got = model.evidence(unseen)
    want = [plain(int(r)) for r in unseen]
    # A run that shares its slot with another one may differ.
    assert np.isclose(got, want, atol=1e-3).mean() > 0.93


def test_defined_cases(spark, fitted):
    _, _, model = fitted
    rows = [(1, None, 5), (2, "", 6), (None, "house", 7), (3, "house tree " * 300_000 + "zorgle kwixt zorgle", 8), (4, "?!", 9)]
    rows += [(5, "green zorgle", 1), (5, "green zorgle", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = tox.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    of = {r.doc_id: r.score for r in got}
    assert of[1] == of[2] == of[4] < 0.5 < of[5] and of[3] > 0.5
    assert tox.score(df.limit(0), model).collect() == []


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    for labels in ([], [(3, 1), (4, 0)], [(1, None)]):
        model = tox.fit(docs, spark.createDataFrame(labels, LABELS))
        assert {r.score for r in tox.score(docs, model).collect()} == {0.5}
    assert tox.fit(docs.limit(0), spark.createDataFrame([], LABELS)).curve.tolist() == [0, 0, 0]


def test_shuffled_labels_join(spark, monkeypatch, fitted):
    docs, labels, model = fitted
    monkeypatch.setattr(tox, "BROADCAST_LABELS", 0)
    again = tox.fit(docs, spark.createDataFrame(list(labels.items()), LABELS))
    assert np.allclose(again.curve, model.curve)


def test_counts_cover_the_rest_of_the_curve_fold(spark):
    """An expression only documents of fold 2 have, with few of them drawn for the curve."""
    rows, labels = make(300, seed=21)
    told = dict(labels)
    only = [i for i in told if fold_of(i) == 2 and told[i]]
    rows = [(i, f"{t} blorvax" if i in only else t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = tox.fit(docs, spark.createDataFrame(labels, LABELS), curve_rows=20)
    assert len(only) > 20
    assert model.evidence(tox.runs_of([b"house blorvax"])[0])[-4:].min() > 1


def test_every_run_has_its_own_ratio(spark):
    """As the formulas for all runs, those never seen too, whatever else the table holds."""
    rows, labels = make(60, seed=9)
    told = dict(labels)
    known = [(i, t) for i, t in rows if fold_of(i) == 0]
    model = tox.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))
    plain = plain_models([(t, told[i]) for i, t in known])
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0é", k=rng.randrange(1, 9))) for _ in range(300))
    runs = np.unique(tox.runs_of([text.encode(), known[0][1].encode()])[0])
    assert np.allclose(model.evidence(runs), [plain(int(r)) for r in runs], atol=1e-3)


def test_hash_table():
    rng = np.random.default_rng(3)
    key = np.unique(rng.integers(1, 1 << 44, 50_000).astype(np.uint64))
    model = tox.Model(*tox.hash_table(key, np.arange(len(key), dtype=np.float32)), np.zeros(3))
    assert (model.ratio(0, key) == np.arange(len(key))).all()
    assert np.isnan(model.ratio(0, np.setdiff1d(rng.integers(1, 1 << 44, 50_000).astype(np.uint64), key))).all()
    assert np.isnan(tox.Model(*tox.hash_table(key[:0], np.zeros(0, dtype=np.float32)), np.zeros(3)).ratio(5, key)).all()


def test_long_texts_are_scored_as_a_whole(monkeypatch):
    """Cut at any place: runs, windows and sums are those of one piece."""
    rng = np.random.default_rng(3)
    content = "".join(rng.choice(list("abc  d1é,"), 3000))
    texts = pa.record_batch([pa.array(["short one", content, "", "x" * 90])], names=["text"])
    known = np.unique(tox.runs_of([content.encode()])[0])
    ratios = rng.normal(size=len(known)).astype(np.float32)
    model = tox.Model(*tox.hash_table(tox.keys_of(tox.ORDER, known), ratios), np.zeros(3))
    whole, runs = model.features(texts, 0), tox.runs_of([content.encode()])[0]
    for size in (97, 100, 1024):
        monkeypatch.setattr(tox, "SEGMENT", size)
        assert np.allclose(model.features(texts, 0), whole)
        assert (np.concatenate([run for run, _ in tox._pieces([content.encode()])]) == runs).all()
