"""Quality rules: measures against slow counts, the model against votes with known accuracies."""

import re
from collections import Counter

import numpy as np
from llm.conftest import rows_of

from claimrisk.llm import quality


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i:i + 3])] > 1}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered))


def test_measures_of_random_texts():
    rng = np.random.default_rng(1)
    parts = ["a", "b", "é", "#", "x|y", "\n", "\n\n", " ", "\x1c", "\xa0", "AB!!", "\r"]
    for _ in range(800):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.integers(0, 40)))
        assert quality.measure(text.encode())[:5] == slow(text), repr(text)


def test_query_same_as_slow(spark, sf_dir):
    from claimrisk.llm.queries import QUERIES, documents

    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    found = QUERIES["op6_quality_rules"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        expected = slow(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_agrees_with_labels_it_never_saw(spark):
    from claimrisk.llm.queries import documents

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.judge(documents(spark, folder)).join(labels, "doc_id").filter("not base_failed").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in found]) > 0.97
    assert all(r.kept for r in found if r.quality == 1)


def test_model_finds_accuracies():
    rng = np.random.default_rng(2)
    n_rules, docs = len(quality.RULES), 20_000
    leading = np.where(rng.random(docs) < 0.8, 0, rng.integers(1, n_rules + 1, docs))
    chance = np.full((n_rules + 1, n_rules), 0.93)
    chance[0] = 0.997
    chance[np.arange(1, n_rules + 1), np.arange(n_rules)] = 0.05
    good_vote = rng.random((docs, n_rules)) < chance[leading]
    silent = rng.random((docs, n_rules)) < 0.1
    patterns = ["".join("0" if s else "+" if g else "-" for s, g in zip(*row)) for row in zip(silent, good_vote)]
    counts = Counter(patterns)
    names = sorted(counts)
    posterior, accuracies, shares = quality.fit_votes(names, [counts[p] for p in names])
    assert abs(shares[0] - 0.8) < 0.03 and np.abs(accuracies[0] - 0.997).max() < 0.02
    at = dict(zip(names, posterior))
    right = np.mean([(at[p] >= 0.5) == (c == 0) for p, c in zip(patterns, leading)])
    assert right > 0.95


def test_odd_rows(odd, clashing, empty):
    found = quality.judge(odd)
    assert found.count() == odd.count()
    assert all(r.base_failed and not r.kept for r in found.filter("doc_id in (0, 1, 2, 99)").collect())
    assert rows_of(quality.judge(clashing)) == rows_of(found)
    assert quality.judge(empty).count() == 0
    long = found.filter("doc_id = 10").first()
    assert long.n_words == 60_000 and long.base_failed


def test_kept_rows_come_whole(clashing, docs):
    good = " ".join(f"quite ordinary{i} words" for i in range(60))
    table = docs([(1, good), (1, good), (1, "bad"), (None, good), (2, "*** " * 300), (3, None)])
    kept = quality.keep_good(table)
    assert kept.columns == table.columns
    assert sorted((str(r.doc_id), r.text == good) for r in kept.collect()) == [("1", True), ("1", True), ("None", True)]
    assert quality.keep_good(clashing).columns == clashing.columns
