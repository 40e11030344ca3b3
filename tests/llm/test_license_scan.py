"""License scan against a scan word by word."""

import random
import re

from llm.conftest import rows_of

from claimrisk.llm import license_scan as scan

PHRASES = {n.text: n.label for n in scan.NOTICES if n.base}


def slow(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [(label, i) for phrase, label in PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


def test_base_places_of_random_texts():
    rng = random.Random(4)
    parts = ["mit", "license", "License,", "CC-BY", "cc", "by", "GNU General Public License", "apache", "é", "licence", "x"]
    scanner = scan.Scanner(scan.NOTICES)
    for _ in range(1500):
        text = rng.choice([" ", "-", "\n", ". "]).join(rng.choice(parts) for _ in range(rng.randrange(25)))
        n, base, spans = scanner.scan(text.encode())
        assert (n, sorted(base)) == slow(text)
        assert {(s[0], s[1]) for s in spans if s[3] == 0} >= set(base)


def test_edits_are_found_up_to_the_limit():
    scanner = scan.Scanner(scan.NOTICES)
    labels = lambda t: {s[0] for s in scanner.scan(t.encode())[2]}
    assert labels("under the GNU Genral Public Licence, v3") == {"gpl"}
    assert labels("MIT licens applies") == {"mit"} and labels("Apache Licence") == {"apache"}
    assert labels("permision is hereby granted, free of charge") == {"mit"}
    assert labels("GNU Gxxxxal Pubxxx License") == set() and labels("cc b") == set() and labels("ccby") == set()


def test_every_edited_notice_keeps_a_seed():
    rng = random.Random(2)
    scanner = scan.Scanner(scan.NOTICES)
    for notice in scan.NOTICES:
        for _ in range(60):
            text = list(notice.text)
            for _ in range(rng.randrange(notice.edits + 1)):
                at = rng.randrange(1, len(text) - 1)  # inside, so that the words' ends stay
                if text[at] != " ":
                    text[at] = "q"
            found = scanner.scan(("some words " + "".join(text) + " and more").encode())[2]
            assert any(s[0] == notice.label for s in found), "".join(text)


def test_query_same_as_slow(spark, sf_dir):
    from claimrisk.llm.queries import QUERIES, documents

    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    for row in QUERIES["op2_license_scan"](spark, sf_dir).collect():
        n, places = slow(texts[row.doc_id])
        words = [w for _, w in places]
        assert (row.n_words, row.n_base) == (n, len(places))
        assert (row.first_word, row.last_word) == ((min(words), max(words)) if words else (None, None))
        assert row.base_labels == ",".join(sorted({label for label, _ in places}))
        assert set(row.base_labels.split(",")) <= set(row.labels.split(",")) and 0 <= row.score <= 1
        assert row.score == 1 or not places


def test_odd_rows(odd, clashing, empty):
    found = scan.summary(scan.scan(odd))
    assert found.count() == odd.count()
    first = found.filter("doc_id = 0").first()
    assert (first.n_words, first.n_base, first.first_word, first.labels, first.score) == (0, 0, None, "", 0.0)
    assert rows_of(scan.summary(scan.scan(clashing))) == rows_of(found)
    assert scan.summary(scan.scan(empty)).count() == 0


def test_very_many_places(docs):
    row = scan.summary(scan.scan(docs(["MIT License " * 20_000]))).first()
    assert (row.n_base, row.first_word, row.last_word) == (20_000, 0, 39_998)
