"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier on the words of a text and their beginnings is trained from texts that are known to be toxic and from unlabelled
ones. With class prior p, the risk of calling clean texts toxic is the unlabelled risk less p times that
of the toxic texts; where this estimate falls below zero the classifier overfits, and the step goes up
instead of down.
"""

from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.llm.lang_crf import remainder
from claimrisk.llm.texts import map_texts

POSITIVES = 2000  # sampled toxic documents, about
UNLABELLED = 4000  # sampled unlabelled documents, about
SAMPLE_WORDS = 4000  # different words that a sampled document teaches by, at most
FEATURES = 500  # features of the model, at most
STEMS = range(4, 10)  # lengths of beginnings, in bytes
# A feature needs this much support among the sampled texts.
LEAST_DOCUMENTS = 4  # toxic texts of the sample that hold a feature
LEAST_SHARE = 0.005
LEAST_EVIDENCE = 15.0  # log-likelihood ratio of a feature
STEPS = 300
THRESHOLD = 0.3

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text):
    return set((text or b"").translate(_FOLD).split())


def stems_of(word):
    """The word as a whole, and its beginnings; a beginning ends in a hyphen."""
    return [word, *[word[:n] + b"-" for n in STEMS if n < len(word)]]


def features_of(words, known=None, first=None):
    """How many different words of a text have each feature; only ``known`` ones, which begin like ``first``."""
    counts = {}
    for word in words:
        if first is None or word[:STEMS[0]] in first:
            for stem in stems_of(word):
                if known is None or stem in known:
                    counts[stem] = counts.get(stem, 0) + 1
    return counts


class Model:
    def __init__(self, weights, bias):
        self.weights, self.bias = weights, bias
        self.first = {stem.rstrip(b"-")[:STEMS[0]] for stem in weights}

    def scores(self, texts):
        margins = []
        for text in texts:
            found = features_of(words_of(text), self.weights, self.first)
            margins.append(self.bias + sum(self.weights[s] * np.log2(1 + n) for s, n in sorted(found.items())))
        return 1 / (1 + np.exp(-np.clip(np.array(margins, float), -500, 500)))


def choose_features(positive, unlabelled, size=FEATURES):
    """Features that toxic texts hold more often than unlabelled ones, by log-likelihood ratio."""
    toxic = Counter()
    for words in positive:
        toxic.update({stem for word in words for stem in stems_of(word)})
    least = max(LEAST_DOCUMENTS, LEAST_SHARE * len(positive))
    toxic = {stem: n for stem, n in toxic.items() if n >= least}
    others = Counter()
    for words in unlabelled:
        others.update(features_of(words, toxic).keys())
    names = sorted(toxic)
    if not names:
        return []
    held = np.array([[toxic[n] for n in names], [others[n] for n in names]], float)
    totals = np.array([[len(positive)], [len(unlabelled)]], float)
    expected = held.sum(0) / totals.sum() * totals
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda seen, due: np.where(seen > 0, seen * np.log(seen / due), 0)
        evidence = 2 * (part(held, expected) + part(totals - held, totals - expected)).sum(0)
    evidence[held[0] < expected[0]] = 0
    chosen = {}
    for i in np.argsort(-evidence, kind="stable")[:size]:
        if evidence[i] >= LEAST_EVIDENCE:  # of a word and its beginnings in the same texts the longest stands
            same = names[i].rstrip(b"-")[:STEMS[0]], *held[:, i]
            chosen[same] = max(chosen.get(same, b""), names[i], key=lambda n: (len(n.rstrip(b"-")), n))
    return sorted(chosen.values())


def sigmoid_loss(margin):
    """Loss of a margin that should be large: 1 / (1 + e^margin)."""
    return 1 / (1 + np.exp(np.clip(margin, -500, 500)))


def risk_and_gradients(w, bias, xp, xu, prior):
    """(clean risk, its gradient, gradient of the toxic risk) of weights ``w`` on toxic rows ``xp`` and unlabelled rows ``xu``.

    The clean risk is that of calling clean texts toxic: the risk of all texts less the toxic ones' part. The toxic
    risk is ``prior`` times the mean loss of the toxic rows.
    """
    zp, zu = xp @ w + bias, xu @ w + bias
    slope = lambda margin: sigmoid_loss(margin) * sigmoid_loss(-margin)
    clean_risk = sigmoid_loss(-zu).mean() - prior * sigmoid_loss(-zp).mean()
    clean = slope(zu) @ xu / len(zu) - prior * slope(zp) @ xp / len(zp)
    return clean_risk, clean, -prior * slope(zp) @ xp / len(zp)


def direction(clean_risk, clean, toxic, climb):
    """The gradient to step against. Below zero the clean risk can only be overfitted: climb back a little instead."""
    return clean * (1 if clean_risk >= 0 else -climb) + toxic


def fit(positive, unlabelled, prior, steps=STEPS, rate=0.1, penalty=2e-4, climb=0.1) -> Model:
    """Non-negative PU learning with the sigmoid loss; texts are sets of words.

    The bias is not trained but follows from the prior: the share of toxic texts among those without
    any feature. So a text that shows nothing scores that share. Weights start from the log ratio of
    a feature's share of toxic and of clean texts, the latter by the prior too, and ``penalty`` draws them there.
    """
    names = choose_features(positive, unlabelled) if positive and unlabelled else []
    column = {w: i for i, w in enumerate(names)}

    def matrix(texts):
        out = np.zeros((len(texts), len(names)), np.float32)
        for row, words in enumerate(texts):
            for stem, n in features_of(words, column).items():
                out[row, column[stem]] = np.log2(1 + n)
        return out

    xp, xu = matrix(positive), matrix(unlabelled)
    none = [((x.sum(1) == 0).sum() + 1) / (len(x) + 2) for x in (xp, xu)]
    bare = min(max(prior * none[0] / none[1], 1e-6), max(prior, 1e-6), 1 - 1e-6)
    bias = float(np.log(bare / (1 - bare)))
    if not names or prior >= 1:
        return Model({}, bias)
    toxic, all_texts = (((x > 0).sum(0) + 0.5) / (len(x) + 1) for x in (xp, xu))
    clean = np.maximum(all_texts - prior * toxic, 0.02 * all_texts) / (1 - prior)
    w = start = np.clip(np.log(toxic / clean), 0, 6)
    first, second = np.zeros(len(names)), np.zeros(len(names))
    for step in range(1, steps + 1):
        grad = direction(*risk_and_gradients(w, bias, xp, xu, prior), climb) + penalty * (w - start)
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        w = w - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Model(dict(zip(names, w.tolist())), bias)


def _sample(ids: DataFrame, size, count):
    """About ``size`` of ``count`` ids, chosen by hash."""
    return ids.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < 1_000_000 * min(
        1.0, size / max(count, 1)))


def sampled_words(docs: DataFrame, labels: DataFrame, positives=POSITIVES, unlabelled=UNLABELLED, words=SAMPLE_WORDS):
    """(Arrow table ``doc_id, part, words``, class prior): the bounded sample that the classifier is fitted on.

    About ``positives`` toxic (part p) and ``unlabelled`` other documents (part u) outside the held-out quarter, drawn by a hash of their
    id; rows that repeat an id give one text. A document teaches by its different words, of more than ``words`` by those
    with the smallest hashes. So rows and bytes that go to the driver have a bound.
    """
    known = labels.filter("toxic is not null and doc_id is not null").filter(
        remainder("doc_id", 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    outside = docs.filter(remainder("doc_id", 4) != 2)
    n_outside = outside.count()
    # The samples of ids have a proven size, so they are broadcast.
    chosen = _sample(known.filter("toxic = 1").select("doc_id"), positives, toxic)
    texts = outside.select("doc_id", "text")
    marked = _sample(texts, unlabelled, n_outside).withColumn("part", F.lit("u")).unionByName(
        texts.join(F.broadcast(chosen), "doc_id", "left_semi").withColumn("part", F.lit("p")))
    single = marked.groupBy("doc_id", "part").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def kernel():
        def run(part):
            sets = [sorted(words_of(t)) for t in part]
            return {"words": [s if len(s) <= words else sorted(s, key=lambda w: (crc32(w), w))[:words] for s in sets]}
        return run
    rows = map_texts(single, kernel, "words array<binary>", ("doc_id", "part")).toArrow()
    return rows.sort_by([("doc_id", "ascending"), ("part", "ascending")]), ((toxic or 0) / total if total else 0.0)


def train(docs: DataFrame, labels: DataFrame, positives=POSITIVES, unlabelled=UNLABELLED) -> Model:
    """Fit on bounded samples of whole documents outside the held-out quarter (``sampled_words``).

    Only ``toxic = 1`` labels are read as examples; the class prior is the share of toxic labels.
    """
    rows, prior = sampled_words(docs, labels, positives, unlabelled)
    sets = [set(w) for w in rows.column("words").to_pylist()]
    parts = rows.column("part").to_pylist()
    return fit([s for s, p in zip(sets, parts) if p == "p"], [s for s, p in zip(sets, parts) if p == "u"], prior)


def score(docs: DataFrame, model: Model, keep=("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``score``; NULL and empty texts get the score of the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel():
        return lambda texts: {"score": shared.value.scores(texts)}
    return map_texts(docs, kernel, "score double", keep)


def toxicity(docs: DataFrame, labels: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; a NULL id is not held out.

    Without labels the prior is zero and every score is near zero. NULL and empty texts score as texts without any
    feature. Very long texts are read whole. Repeated rows score alike; an empty table gives no rows. Other columns are ignored.
    """
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
