"""Language identification: inference against all label sequences, and held-out accuracy."""

import itertools
import zlib

import numpy as np
import pytest
from llm.conftest import rows_of

from claimrisk.llm import lang_crf as crf


def slow_posteriors(scores, transitions):
    n, k = scores.shape
    found = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        # The first word comes from a uniform start through a transition, as in the recursion.
        start = np.log(np.mean(np.exp(transitions), axis=0)[path[0]])
        weight = np.exp(start + sum(scores[i, y] for i, y in enumerate(path)) + sum(
            transitions[a, b] for a, b in zip(path, path[1:])))
        found[np.arange(n), path] += weight
    return found / found.sum(1, keepdims=True)


@pytest.mark.parametrize("block", [2, 3, 64])
def test_posteriors_same_as_all_sequences(block):
    rng = np.random.default_rng(block)
    transitions = rng.normal(size=(3, 3))
    lengths = [1, 7, 2, 6, 3]
    scores = rng.normal(scale=2, size=(sum(lengths), 3))
    sequence = np.repeat(np.arange(5), lengths)
    found = crf.posteriors(scores, sequence, transitions, block)
    expected = np.concatenate([slow_posteriors(scores[sequence == i], transitions) for i in range(5)])
    assert np.allclose(found, expected)


def test_expected_moves_same_as_all_sequences():
    rng = np.random.default_rng(0)
    transitions, scores = rng.normal(size=(2, 2)), rng.normal(size=(4, 2))
    found = crf._expected_moves(scores, None, np.arange(4)[None], transitions)
    expected = np.zeros((2, 2))
    total = 0.0
    for path in itertools.product(range(2), repeat=4):
        weight = np.exp(np.log(np.mean(np.exp(transitions), axis=0)[path[0]]) + sum(
            scores[i, y] for i, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        total += weight
        for a, b in zip(path, path[1:]):
            expected[a, b] += weight
    assert np.allclose(found, expected / total)


def test_words_know_their_text():
    words = crf.split_words([None, b"Ab, c", b"", b"  ", "é x".encode()])
    buffer = words.letters.tobytes()
    assert [buffer[a:b] for a, b in zip(words.start, words.end)] == [b"ab", b"c", "é".encode(), b"x"]
    assert words.doc.tolist() == [1, 1, 4, 4]
    same = crf.word_hashes(crf.split_words([b"ab ba ab"]))
    assert same[0] == same[2] != same[1]


@pytest.fixture(scope="module")
def table(spark):
    from claimrisk.llm.queries import documents

    return documents(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def model(table):
    return crf.train(table)


def test_held_out_accuracy(table):
    found = crf.language_id(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r.lang == r.lang_pred for r in found if r.held_out]
    assert len(found) == table.count() and np.mean(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_code_switched_words(table, model):
    texts = {lang: table.filter((table.lang == lang) & (table.n_chars > 400)).orderBy("doc_id").first().text
             for lang in ("en", "de", "fr")}
    parts = [(lang, " ".join(text.split()[:30])) for lang, text in texts.items()]
    labels = crf.label_words(model, " ".join(p for _, p in parts).encode())
    truth = [lang for lang, part in parts for _ in crf.split_words([part.encode()]).start]
    assert np.mean([found == t for (_, found, _), t in zip(labels, truth)]) > 0.85
    changes = sum(a[1] != b[1] for a, b in zip(labels, labels[1:]))
    assert changes <= 8  # transitions keep a language for a while


def test_odd_rows(odd, clashing, empty, model):
    found = crf.identify(odd, model)
    by_id = {r.doc_id: r for r in found.collect()}
    assert found.count() == odd.count()
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (0, 1, 2, 8, 99))
    assert by_id[3].lang_pred != "und" and by_id[10].lang_pred in model.languages
    assert rows_of(crf.identify(clashing, model)) == rows_of(found)
    assert crf.identify(empty, model).count() == 0
    assert crf.identify(odd, crf.fit([], [])).filter("lang_pred <> 'und'").count() == 0


def test_tables_without_languages(docs, empty):
    assert crf.language_id(empty).count() == 0
    table = docs([(1, "some text", None), (2, "— “”", "en"), (None, "text", "en")])
    found = {r.doc_id: r for r in crf.language_id(table).collect()}
    assert found[2].lang_pred == "und" and not found[None].held_out


def test_kept_rows(clashing, table):
    kept = crf.keep_identified(table)
    assert kept.columns == table.columns and kept.count() >= 0.99 * table.count()
    assert crf.keep_identified(clashing).columns == clashing.columns


SHORT = {"aa": ["baka duno", "miru kolo", "duno miru"], "zz": ["xefi wyq", "qyx fewi", "wyq xefi"],
         "ja": ["\u3053\u308c\u306f\u672c\u3067\u3059", "\u672c\u3092\u8aad\u3080", "\u3053\u308c\u3092\u8aad\u3080"]}


def test_short_texts_are_learned():
    pairs = [(t.encode(), lang) for lang, texts in SHORT.items() for t in texts * 5]
    model = crf.fit(*zip(*pairs))
    languages, scores = crf.predict_texts(model, [t for t, _ in pairs])
    assert languages == [lang for _, lang in pairs] and min(scores) > 0.5


def test_short_texts_beside_long_ones_are_learned():
    pairs = [(t.encode(), lang) for lang, texts in SHORT.items() if lang != "aa" for t in texts * 5]
    pairs += [(b"baka duno miru kolo " * 20_000, "aa"), (b"baka duno miru kolo " * 30, "aa")]
    model = crf.fit(*zip(*pairs))
    assert crf.predict_texts(model, [t[:200] for t, _ in pairs])[0] == [lang for _, lang in pairs]


def test_every_word_is_in_the_training_rows():
    doc = np.repeat(np.arange(4), [3, 24, 61, 1])
    truth = np.array([0, 1, 1, 2])[doc]
    rows = crf._training_rows(doc, truth, 3, np.random.default_rng(0))
    assert set(rows.ravel()) == set(range(len(doc))) and rows.shape[1] == crf.SEQUENCE
    assert all(len(set(truth[run])) == 1 for run in rows.reshape(-1, crf.SEGMENT))


def test_texts_without_words_teach_nothing():
    assert crf.fit([b"123", None], ["en", "de"]).languages == []


def test_every_language_is_learned(docs):
    """More languages than 64, one of them rare, in a sample of fewer documents than languages."""
    names = [f"l{i:02d}" for i in range(70)]
    text = lambda i: f"{chr(97 + i % 26)}{chr(97 + i // 26)}x{chr(122 - i % 26)} " * 6
    rows = [(10 * i + j, text(i), name, "web") for i, name in enumerate(names) for j in range(10 if i else 2)]
    table = docs(rows)
    assert crf.train(table, sample=20).languages == names
    found = {r.doc_id: r.lang_pred for r in crf.identify(table, crf.train(table)).collect()}
    assert all(found[i] == lang for i, _, lang, _ in rows)


def test_the_sample_has_a_bound(spark, monkeypatch):
    """20,000 rows of one id teach by one text, long texts by their beginnings, rare languages beyond the most not."""
    fitted = []
    monkeypatch.setattr(crf, "fit", lambda texts, labels: fitted.append((texts, labels)))
    rows = spark.range(20_000).selectExpr("0L AS doc_id", "concat('text number ', id) AS text", "'en' AS lang").unionByName(
        spark.range(40).selectExpr("10 + 3 * id AS doc_id", "repeat('word ', 30000) AS text", "'de' AS lang")).unionByName(
        spark.range(3).selectExpr("1000 + id AS doc_id", "'mot' AS text", "'fr' AS lang"))
    crf.train(rows, most=2, chars=400_000)
    texts, labels = fitted[0]
    assert labels.count("en") == 1 and set(labels) == {"en", "de"}
    assert sum(map(len, texts)) <= 400_000


def test_texts_with_letters_are_kept(docs):
    """Also texts in several languages alike, and tables without any language."""
    words = {lang: f"{a}{b}{a} {b}{a}{b} " for lang, a, b in (("a", "k", "o"), ("b", "s", "e"), ("c", "t", "i"), ("d", "m", "u"))}
    rows = [(10 * i + j, w * 10, lang, "web") for i, (lang, w) in enumerate(words.items()) for j in range(10)]
    mixed = "".join(w * 10 for w in words.values())
    table = docs([*rows, (100, mixed, None, "web"), (101, "123 —", "a", "web"), (102, None, "a", "web")])
    mixed_score = crf.language_id(table).filter("doc_id = 100").first().score
    assert mixed_score < 0.3
    assert {r.doc_id for r in crf.keep_identified(table).collect()} == {r[0] for r in rows} | {100}
    unlabelled = docs([(1, "some text", None), (2, "\u3053\u308c", None), (3, "12 — 3", None), (4, None, None)])
    assert {r.doc_id for r in crf.keep_identified(unlabelled).collect()} == {1, 2}
