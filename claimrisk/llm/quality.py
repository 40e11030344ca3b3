"""Quality rules by weak supervision.

Every rule votes good (1), bad (-1) or abstains (0). Accuracies of the rules, for good and for bad
documents, and the share of good documents are estimated by expectation-maximisation over the counts
of vote patterns; the posterior probability of "good" replaces a filter that asks for all rules.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.llm.texts import map_texts, quoted
from claimrisk.session import store

WHITE = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_lines long, n_upper long, n_letters long, n_bare long, n_shout long")

# Column expression of a rule's measure, bad at or beyond, good at or within.
# A rule whose bad limit is below its good limit asks for large values, else for small ones.
RULES = {
    "length": ("n_words", 50, 100),
    "long_words": ("word_chars / n_words", 12, 9),
    "short_words": ("word_chars / n_words", 2, 3),
    "symbols": ("n_symbols / word_chars", 0.1, 0.02),
    "dup_lines": ("n_dup_lines / n_lines", 0.5, 0.3),
    "repeats": ("n_repeat_words / n_words", 0.5, 0.2),
    "upper_case": ("n_upper / n_letters", 0.5, 0.2),
    "bare_symbols": ("n_bare / n_words", 0.2, 0.05),
    "shouting": ("n_shout / n_words", 0.2, 0.05),
}
ROUNDS = 200


def repeated_words(words):
    """Number of words that stand in a three-word window found twice or more."""
    if len(words) < 4:
        return 0
    seen = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words])
    pair = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 2_000_000:  # three ids of one number would pass 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(seen) + ids[2:]
    order = np.argsort(window)
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    found = np.zeros(len(window), bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for step in range(3):
        covered[step:len(window) + step] |= found
    return int(covered.sum())


def repeated_lines(text):
    """(lines with a word, those of them that equal an earlier line)."""
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    return len(lines), len(lines) - len(set(lines))


def measure(text):
    """The measures of one text (UTF-8 bytes, or None for no words), in the order of MEASURES."""
    text = text or b""
    words = text.split()
    without = lambda drop: len(text.translate(None, drop))
    lines, repeats = repeated_lines(text)
    return (len(words), without(WHITE + CONTINUATION), len(text) - without(SYMBOLS), repeats,
            repeated_words(words), lines, len(text) - without(UPPER), len(text) - without(LETTERS),
            sum(not w.strip(SYMBOLS) for w in words) if len(text) != without(SYMBOLS) else 0,
            text.count(b"!!"))


def measures(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    names = [part.split()[0] for part in MEASURES.split(", ")]

    def kernel():
        return lambda texts: dict(zip(names, zip(*map(measure, texts))))
    return map_texts(docs, kernel, MEASURES, keep)


def votes(measured: DataFrame) -> DataFrame:
    """Adds ``votes``: one of +, - and 0 for each rule; a rule without a value abstains."""
    def vote(measure_of, bad, good):
        value = F.expr(f"try_divide({measure_of.replace(' / ', ', ')})" if "/" in measure_of else measure_of)
        is_bad, is_good = (value >= bad, value <= good) if bad > good else (value < bad, value >= good)
        return F.when(is_bad, "-").when(is_good, "+").otherwise("0")
    return measured.withColumn("votes", F.concat(*[vote(*rule) for rule in RULES.values()]))


def fit_votes(patterns, counts, rounds=ROUNDS, right=0.97, found=0.9, good=0.85, weight=10.0):
    """(posterior of good for each pattern, accuracies: classes x rules, shares of the classes).

    EM over a latent class model. A document is good (class 0) or has one leading defect (class r: the
    one that rule r names), because defects seldom come together and one "bad" class would learn only
    the most frequent. An accuracy is the chance that a vote of the rule is the right one for the
    class: good on class 0, bad on the rule's own class; on classes of other defects it is the chance
    of a good vote. An abstention says nothing. ``right``, ``found`` and ``good`` start the rounds and
    hold ``weight`` pseudo documents; a rule finds its own defect in half of the cases at least.
    """
    cast = np.array([[{"+": 1, "-": -1, "0": 0}[v] for v in p] for p in patterns])
    counts = np.asarray(counts, float)[:, None]
    n = cast.shape[1]
    ups, downs = (cast == 1).astype(float), (cast == -1).astype(float)
    start = np.full((n + 1, n), 0.9)  # chance of a good vote
    start[0] = right
    start[np.arange(1, n + 1), np.arange(n)] = 1 - found
    shares = np.append(good, np.full(n, (1 - good) / n))
    prior_shares, chance = shares, start
    for _ in range(rounds):
        log = np.log(shares) + ups @ np.log(chance).T + downs @ np.log(1 - chance).T
        log -= log.max(1, keepdims=True)
        posterior = np.exp(log)
        posterior /= posterior.sum(1, keepdims=True)
        mass = posterior * counts
        update = (mass.T @ ups + start * weight) / (mass.T @ (ups + downs) + weight)
        own = np.arange(1, n + 1), np.arange(n)
        update[own] = np.minimum(update[own], 0.5)
        change, chance = np.abs(update - chance).max(), update
        shares = (mass.sum(0) + prior_shares * weight) / (counts.sum() + weight)
        if change < 1e-9:
            break
    accuracies = chance.copy()
    accuracies[np.arange(1, n + 1), np.arange(n)] = 1 - chance[np.arange(1, n + 1), np.arange(n)]
    return posterior[:, 0], accuracies, shares


def fit_model(voted: DataFrame) -> DataFrame:
    """``votes, posterior`` of every vote pattern that occurs: at most 3 to the number of rules, a few in practice."""
    seen = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    rows = []
    if seen:
        posterior = fit_votes([r.votes for r in seen], [r.n for r in seen])[0]
        rows = [(r.votes, float(p)) for r, p in zip(seen, posterior)]
    return voted.sparkSession.createDataFrame(rows, "votes string, posterior double")


def _verdicts(voted: DataFrame, model: DataFrame, threshold) -> DataFrame:
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return voted.join(F.broadcast(model), "votes", "left").withColumns({
        "base_failed": failed, "kept": ~failed & (F.col("posterior") >= threshold)})


def judge(docs: DataFrame, threshold=0.5) -> DataFrame:
    """``doc_id``, the base measures, ``base_failed``, ``kept``, ``posterior`` and ``votes``, a row per document.

    NULL and empty texts have no words and fail the base. Repeated rows and ids are judged alone, each
    gets its row. An empty table gives an empty result. The texts are read once, their measures are stored; the
    model is fitted on the vote patterns of all documents.
    """
    voted = store(votes(measures(docs)))
    return _verdicts(voted, fit_model(voted), threshold).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "posterior", "votes")


def keep_good(docs: DataFrame, threshold=0.5) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all their columns as they were, whatever their names.

    NULL and empty texts fail the base and go; very long texts are read whole; repeated rows are judged alike and all stay or go. An
    empty table gives no rows.
    The texts are measured twice, once for the model and once to filter: two scans without a shuffle
    are cheaper than a join that shuffles every text.
    """
    model = fit_model(votes(measures(docs)))
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select("text", F.struct(F.lit(0).alias("__any"), *map(quoted, others)).alias("row"))
    good = _verdicts(votes(measures(packed, ("row", "text"))), model, threshold).filter("kept")
    return good.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
