"""Fuzzy search for short license notices.

A notice that may have k edits is split into k + 1 seeds, one of which must stand in the text
unchanged. Exact seeds locate candidates; the regex library's bounded-error matching then verifies the
edits there and reports the span.
"""

from typing import NamedTuple

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.llm.texts import map_texts


class Notice(NamedTuple):
    text: str  # words in lower case, one space between them
    label: str
    edits: int  # characters inserted, deleted or replaced, at most
    base: bool  # its exact places are the base


# Fixed values.
NOTICES = [
    Notice("gnu general public license", "gpl", 2, True),
    Notice("apache license", "apache", 1, True),
    Notice("cc by", "cc-by", 0, True),
    Notice("mit license", "mit", 1, True),
    Notice("gnu lesser general public license", "lgpl", 2, False),
    Notice("mozilla public license", "mpl", 2, False),
    Notice("creative commons attribution", "cc-by", 2, False),
    Notice("redistribution and use in source and binary forms", "bsd", 3, False),
    Notice("permission is hereby granted free of charge", "mit", 3, False),
]

# Bytes of words: digits, lower-case letters and everything beyond ASCII.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def seeds(text, edits):
    """``text`` in edits + 1 near-equal pieces: (offset, piece)."""
    cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def _places(text, piece):
    at = text.find(piece)
    while at >= 0:
        yield at
        at = text.find(piece, at + 1)


class Scanner:
    def __init__(self, notices):
        self.notices = [(n, seeds(n.text.encode(), n.edits),
                         regex.compile(rf"(?e)\b(?:{regex.escape(n.text)}){{e<={n.edits}}}\b")) for n in notices]

    def scan(self, text):
        """(number of words, base places, spans) of one text (UTF-8 bytes or None).

        A base place is (label, word); a span is (label, first word, words, edits, matched text).
        """
        words = (text or b"").translate(_FOLD).split()
        line = b" " + b" ".join(words) + b" "
        base, spans = [], []
        for notice, pieces, pattern in self.notices:
            hits = [(at, at - offset) for offset, piece in pieces if piece in line
                    for at in _places(line, piece)]
            if not hits:
                continue
            whole = b" " + notice.text.encode() + b" "
            # An exact place holds every seed, so the first one finds it.
            starts = sorted({start for _, start in hits if line.startswith(whole, start - 1) and start > 0})
            numbers = _word_numbers(line, starts)
            spans += [(notice.label, n, notice.text.count(" ") + 1, 0, notice.text) for n in numbers]
            if notice.base:
                base += [(notice.label, n) for n in numbers]
            exact = set(starts)
            rest = [start for _, start in hits if start not in exact]
            if notice.edits and rest:
                spans += [s for s in self._verify(line, notice, pattern, rest) if s[3]]
        return len(words), base, spans

    def _verify(self, line, notice, pattern, starts):
        """Matches with edits near the candidates; windows that overlap are searched as one."""
        reach = notice.edits + 1
        windows = []
        for start in sorted(starts):
            low, high = max(0, start - reach), min(len(line), start + len(notice.text) + reach)
            low, high = line.rfind(b" ", 0, low + 1) + 1, line.find(b" ", max(high - 1, 0))
            high = len(line) if high < 0 else high
            if windows and low <= windows[-1][1]:
                windows[-1][1] = max(high, windows[-1][1])
            else:
                windows.append([low, high])
        for low, high in windows:
            window = line[low:high].decode("utf-8", "replace")
            before = line.count(b" ", 0, low) - 1
            for match in pattern.finditer(window):
                first = before + window.count(" ", 0, match.start())
                yield (notice.label, first, match[0].count(" ") + 1, sum(match.fuzzy_counts), match[0])


def _word_numbers(line, starts):
    numbers, count, done = [], -1, 0
    for start in starts:
        count += line.count(b" ", done, start)
        done = start
        numbers.append(count)
    return numbers


SCHEMA = ("n_words long, base array<struct<label string, word long>>, spans array<struct<label string, "
          "first_word long, n_words long, edits int, matched string>>")


def scan(docs: DataFrame, notices=NOTICES, keep=("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``n_words``, ``base`` (exact places) and ``spans`` (all matches) of each text.

    NULL and empty texts have no words and no matches; very long texts are scanned whole; repeated rows are scanned alike. Of matches that
    start at the same word each notice gives its own. Empty tables give empty results. Columns that are not kept are ignored.
    """
    def kernel():
        scanner = Scanner(notices)

        def run(texts):
            found = [scanner.scan(t) for t in texts]
            return {
                "n_words": [n for n, _, _ in found],
                "base": [[dict(zip(("label", "word"), p)) for p in base] for _, base, _ in found],
                "spans": [[dict(zip(("label", "first_word", "n_words", "edits", "matched"), s)) for s in spans]
                          for _, _, spans in found]}
        return run
    return map_texts(docs, kernel, SCHEMA, keep)


def summary(scanned: DataFrame) -> DataFrame:
    """A row per document: counts, first and last word of base places, labels, and the best match's score.

    The score is 1 for an exact notice, less by the share of its characters that were edited; 0 without one.
    """
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    score = F.array_max(F.transform("spans", lambda s: F.greatest(
        F.lit(0.0), 1 - s["edits"] / F.greatest(F.length(s["matched"]), F.lit(1)))))
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        names(F.col("base.label")).alias("base_labels"),
        names(F.concat("base.label", "spans.label")).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"), "spans")
