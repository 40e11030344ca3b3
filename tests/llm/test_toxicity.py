"""Toxicity: held-out quality, and what the learner may see."""

import zlib

import numpy as np
import pytest
from llm.conftest import rows_of
from pyspark.sql import functions as F

from claimrisk.llm import toxicity as tox

LABELS = "doc_id long, quality int, toxic int"


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def auc(scores, truth):
    above = scores[truth == 1][:, None] - scores[truth == 0][None, :]
    return ((above > 0) + 0.5 * (above == 0)).mean()


@pytest.fixture(scope="module")
def world(spark):
    """Texts of random words; toxic ones hold two of five words. Labels for a half."""
    rng = np.random.default_rng(3)
    rows, truth = [], {}
    for i in range(1500):
        words = [f"w{rng.integers(0, 3000)}" for _ in range(40)]
        truth[i] = int(rng.random() < 0.15)
        if truth[i]:
            for bad in rng.choice(["idiot", "scum", "trash", "moron", "loser"], 2, replace=False):
                words[rng.integers(0, 40)] = bad
        rows.append((i, " ".join(words), "en", "web", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, truth[i]) for i in range(0, 1500, 2)], LABELS)
    return docs, labels, truth


def test_held_out_scores(world):
    docs, labels, truth = world
    found = tox.toxicity(docs, labels).collect()
    assert len(found) == 1500 and all(r.held_out == held(r.doc_id) for r in found)
    part = [r for r in found if r.held_out]
    scores, y = np.array([r.score for r in part]), np.array([truth[r.doc_id] for r in part])
    assert auc(scores, y) > 0.97
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in found)
    predicted = np.array([r.predicted for r in part])
    assert predicted[y == 1].mean() > 0.85 and predicted[y == 0].mean() < 0.03


def test_held_out_labels_and_clean_labels_teach_nothing(world, spark):
    docs, labels, _ = world
    first = tox.train(docs, labels)
    changed = labels.selectExpr(
        "doc_id", "quality", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - toxic else toxic end as toxic")
    again = tox.train(docs, changed)
    assert first.weights == again.weights and first.bias == again.bias


def slow_risks(w, bias, xp, xu, prior):
    """The clean and the toxic risk, example by example."""
    loss = lambda z: 1 / (1 + np.exp(z))
    margins = lambda rows: [sum(a * b for a, b in zip(row, w)) + bias for row in rows]
    mean = lambda values: sum(values) / len(values)
    zp, zu = margins(xp), margins(xu)
    return mean([loss(-z) for z in zu]) - prior * mean([loss(-z) for z in zp]), prior * mean([loss(z) for z in zp])


def test_risk_and_gradients_against_differences():
    rng = np.random.default_rng(4)
    xp, xu = rng.random((7, 3)), rng.random((11, 3))
    for _ in range(5):
        w, bias, prior = rng.normal(0, 2, 3), float(rng.normal()), float(rng.random())
        risk, clean, toxic = tox.risk_and_gradients(w, bias, xp, xu, prior)
        assert risk == pytest.approx(slow_risks(w, bias, xp, xu, prior)[0])
        for i in range(3):
            step = np.eye(3)[i] * 1e-6
            up, down = (slow_risks(w + s, bias, xp, xu, prior) for s in (step, -step))
            assert clean[i] == pytest.approx((up[0] - down[0]) / 2e-6, abs=1e-6)
            assert toxic[i] == pytest.approx((up[1] - down[1]) / 2e-6, abs=1e-6)


def test_a_negative_clean_risk_makes_the_step_climb():
    """The toxic rows show a feature that the few unlabelled rows hardly show: the estimate falls below zero."""
    xp, xu, w = np.array([[1.0, 0], [1, 1]]), np.array([[0.0, 0], [0, 1], [1, 0]]), np.array([4.0, 0.0])
    risk, clean, toxic = tox.risk_and_gradients(w, -2.0, xp, xu, 0.6)
    assert risk < 0 and risk == pytest.approx(slow_risks(w, -2.0, xp, xu, 0.6)[0])
    assert tox.direction(risk, clean, toxic, 0.1) == pytest.approx(-0.1 * clean + toxic)
    assert tox.direction(-risk, clean, toxic, 0.1) == pytest.approx(clean + toxic)
    # A small step against the climbing part alone brings the clean risk back up.
    after = tox.risk_and_gradients(w - 0.1 * (-0.1 * clean), -2.0, xp, xu, 0.6)[0]
    assert risk < after


def test_fit_takes_the_climbing_branch(monkeypatch):
    taken = []
    real = tox.direction
    monkeypatch.setattr(tox, "direction", lambda risk, *rest: taken.append(risk < 0) or real(risk, *rest))
    rng = np.random.default_rng(1)
    text = lambda bad: {b"w%d" % w for w in rng.integers(0, 60, 12)} | ({b"scum"} if bad else set())
    tox.fit([text(True) for _ in range(60)], [text(rng.random() < 0.1) for _ in range(60)], 0.5)
    assert any(taken)


def test_the_sample_has_a_bound(spark):
    """20,000 rows of one id, and a text with very many words, teach no more than the parameters say."""
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(9000)), lambda i: F.concat(F.lit("w"), F.chr(97 + i % 26), F.hex(i))))
    docs = spark.range(20_000).select(F.lit(4).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit("scum"), "id").alias("text"))
    docs = docs.unionByName(spark.range(1).select(F.lit(6).cast("long").alias("doc_id"), words.alias("text")))
    labels = spark.createDataFrame([(4, 1, 1), (6, 1, 1), (8, 1, 0)], LABELS)
    rows, prior = tox.sampled_words(docs, labels)
    assert sorted(zip(rows["doc_id"].to_pylist(), rows["part"].to_pylist())) in (
        [(4, "p"), (4, "u"), (6, "p"), (6, "u")], [(4, "p"), (6, "p")], [(4, "p"), (4, "u"), (6, "p")], [(4, "p"), (6, "p"), (6, "u")])
    assert max(map(len, rows["words"].to_pylist())) <= tox.SAMPLE_WORDS and prior == pytest.approx(2 / 3)


def test_risk_stays_non_negative():
    """With toxic texts among the unlabelled, weights of harmless words stay small."""
    rng = np.random.default_rng(0)
    text = lambda bad: {b"w%d" % w for w in rng.integers(0, 60, 12)} | ({b"scum"} if bad else set())
    positive = [text(True) for _ in range(150)]
    unlabelled = [text(rng.random() < 0.2) for _ in range(800)]
    model = tox.fit(positive, unlabelled, 0.2)
    assert model.weights[b"scum"] > 3
    clean, toxic = model.scores([b"w1 w2 w3", b"w1 w2 scum"])
    assert clean < 0.1 and toxic > 0.5


def test_nothing_to_learn_from(odd, clashing, empty, spark):
    none = spark.createDataFrame([], LABELS)
    found = tox.toxicity(odd, none)
    assert found.count() == odd.count() and found.filter("predicted = 1").count() == 0
    assert rows_of(tox.toxicity(clashing, none)) == rows_of(found)
    assert tox.toxicity(empty, none).count() == 0
    odd_labels = spark.createDataFrame([(None, 1, 1), (4, None, None), (5, 1, 1), (5, 1, 1), (77, 0, 0)], LABELS)
    assert tox.toxicity(odd, odd_labels).count() == odd.count()


def test_scores_of_odd_texts(odd):
    model = tox.Model({b"fox": 3.0, b"quic-": 1.0}, -2.0)
    by_id = {r.doc_id: r.score for r in tox.score(odd, model).collect()}
    bare = 1 / (1 + np.exp(2))
    assert by_id[0] == by_id[1] == by_id[2] == by_id[99] == pytest.approx(bare)
    assert by_id[6] == by_id[7] == pytest.approx(1 / (1 + np.exp(-2)))
