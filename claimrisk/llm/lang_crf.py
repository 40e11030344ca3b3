"""Language of words in code-switched text by a linear-chain conditional random field.

A word's emission adds hashed affixes, letter trigrams and, for words of a learned lexicon, a weight of its own;
learned transitions tie neighbouring words. Forward-backward gives the posterior languages of every
word of a text; a document's language is the one with most words.

The recursions run over blocks of words: first each block's transfer matrix, all blocks at once, then
the few steps from block to block, then inside the blocks with known ends. The result is exact.
"""

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.llm.texts import map_texts, quoted

UNDETERMINED = "und"
TABLE = 1 << 16  # hashed features
LEXICON = 4096  # words with weights of their own, at most
PER_LANGUAGE = 300  # sampled documents of a language, about
SAMPLE = 64 * PER_LANGUAGE  # sampled documents, about; every language has one at least
MOST_LANGUAGES = 256  # learned languages, at most: the model has TABLE weights for each
SAMPLE_CHARS = 32_000_000  # characters of the sampled documents together, at most, about
FEW = 64  # languages; with more, slices of texts are smaller
BLOCK = 64
# Texts are labelled in slices of about this many bytes: the arrays of features are many times as large.
SLICE_BYTES = 250_000
SEGMENT = 24  # words of one language in a row in training sequences
SEQUENCE = 96  # words of a training sequence
SEQUENCES = 4000  # training sequences, at most (more only for one run of each language)
EPOCHS = 4
PLACES = 1 << 53  # of the hashes by which documents are sampled

# Bytes of words: letters in lower case and everything beyond ASCII; others separate words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(256, 0x100000001B3, np.uint64))


class Words(NamedTuple):
    """Words of several texts in one buffer; ``doc`` is the text that each word stands in."""

    letters: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


def split_words(texts) -> Words:
    buffer = b" " + b" ".join((t or b"").translate(_FOLD) for t in texts) + b"   "
    letters = np.frombuffer(buffer, np.uint8)
    inside = letters != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edges[::2], edges[1::2]
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    return Words(letters, start, end, np.searchsorted(np.cumsum(sizes) + 1, start, side="right"))


def _mix(*parts):
    """A feature number from bytes (as uint64 arrays) and a salt."""
    value = np.zeros_like(parts[0])
    for part in parts:
        value = (value + part + np.uint64(1)) * _ODD
    return ((value >> np.uint64(40)) & np.uint64(TABLE - 1)).astype(np.int64)


def word_hashes(words: Words):
    """A 64-bit hash of each word's bytes."""
    size = words.end - words.start
    first = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(first, size)
    letters = words.letters[place + np.repeat(words.start, size)].astype(np.uint64)
    terms = (letters + np.uint64(1)) * _ODD * _POWERS[place & 255]
    return np.add.reduceat(terms ^ (terms >> np.uint64(29)), first) if len(size) else np.zeros(0, np.uint64)


def word_features(words: Words):
    """(affix features: words x 6, trigram features, number of trigrams of each word)."""
    b = words.letters.astype(np.uint64)
    s, e = words.start, words.end
    salt = [np.full(len(s), 7919 * k, np.uint64) for k in range(6)]
    second, third = np.where(s + 1 < e, b[s + 1], 32), np.where(s + 2 < e, b[s + 2], 32)
    last2, last3 = np.where(e - 2 >= s, b[e - 2], 32), np.where(e - 3 >= s, b[np.maximum(e - 3, 0)], 32)
    affixes = np.stack([
        _mix(b[s], salt[0]), _mix(b[s], second, salt[1]), _mix(b[s], second, third, salt[2]),
        _mix(b[e - 1], salt[3]), _mix(last2, b[e - 1], salt[4]), _mix(last3, last2, b[e - 1], salt[5])], 1)
    size = e - s
    middle = np.repeat(s - np.cumsum(size) + size, size) + np.arange(size.sum())
    # Neighbours outside the word are separators, so the first and last trigram know the word's edge.
    trigrams = _mix(b[middle - 1], b[middle], b[middle + 1])
    return affixes, trigrams, size


class Model(NamedTuple):
    languages: list
    weights: np.ndarray  # TABLE x languages
    lexicon: np.ndarray  # sorted hashes of the lexicon's words
    lexicon_weights: np.ndarray  # (words of the lexicon + 1) x languages, the last row is zero
    transitions: np.ndarray  # languages x languages


def lexicon_rows(model: Model, words: Words):
    hashes = word_hashes(words)
    if not len(model.lexicon):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(model.lexicon, hashes), len(model.lexicon) - 1)
    return np.where(model.lexicon[at] == hashes, at, len(model.lexicon))


def emissions(model: Model, words: Words):
    if not len(words.start):
        return np.zeros((0, len(model.languages)))
    affixes, trigrams, size = word_features(words)
    total = model.lexicon_weights[lexicon_rows(model, words)].astype(np.float64)
    for column in affixes.T:
        total += model.weights[column]
    total += np.add.reduceat(model.weights[trigrams], np.cumsum(size) - size, axis=0)
    return total


def posteriors(scores, sequence, transitions, block=BLOCK):
    """Posterior labels of each word by forward-backward; ``sequence`` numbers the texts, in order."""
    n, k = scores.shape
    if not n:
        return np.zeros((0, k))
    move = np.exp(transitions - transitions.max())
    heads = np.flatnonzero(np.append(True, sequence[1:] != sequence[:-1]))
    lengths = np.diff(np.append(heads, n))
    blocks = -(-lengths // block)
    total = int(blocks.sum())
    first_block = np.cumsum(blocks) - blocks
    within = np.arange(n) - np.repeat(heads, lengths)
    row = np.repeat(first_block, lengths) + within // block
    column = within % block
    factor = np.ones((block, total, k))
    factor[column, row] = np.exp(np.maximum(scores - scores.max(1, keepdims=True), -60.0))
    real = np.zeros((block, total), bool)
    real[column, row] = True

    transfer = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(block):
        on = real[t]
        stepped = (transfer[on].reshape(-1, k) @ move).reshape(-1, k, k) * factor[t, on][:, None, :]
        transfer[on] = stepped / stepped.sum((1, 2), keepdims=True)

    # From block to block, all texts side by side.
    number = np.arange(total) - np.repeat(first_block, blocks)
    by_number = np.argsort(number, kind="stable")
    cuts = np.searchsorted(number[by_number], np.arange(number.max() + 2))
    groups = [by_number[a:b] for a, b in zip(cuts, cuts[1:])]
    into = np.full((total, k), 1.0 / k)
    for rows in groups[1:]:
        reached = np.einsum("ni,nij->nj", into[rows - 1], transfer[rows - 1])
        into[rows] = reached / reached.sum(1, keepdims=True)
    after = np.ones((total, k))
    last = np.zeros(total, bool)
    last[first_block + blocks - 1] = True
    for rows in groups[::-1]:
        rows = rows[~last[rows]]
        came = np.einsum("nij,nj->ni", transfer[rows + 1], after[rows + 1])
        after[rows] = came / came.sum(1, keepdims=True)

    ahead = np.empty((block, total, k))
    state = into
    for t in range(block):
        stepped = (state @ move) * factor[t]
        stepped /= stepped.sum(1, keepdims=True)
        state = np.where(real[t][:, None], stepped, state)
        ahead[t] = state
    state = after
    for t in range(block - 1, -1, -1):
        ahead[t] *= state
        stepped = (factor[t] * state) @ move.T
        stepped /= stepped.sum(1, keepdims=True)
        state = np.where(real[t][:, None], stepped, state)
    found = ahead[column, row]
    return found / found.sum(1, keepdims=True)


def _gradient_step(model, grads, features, delta, between):
    """AdaGrad on one batch; ``grads`` holds the sums of squares of each part."""
    affixes, trigrams, size, lexicon = features
    k = delta.shape[1]
    rows = np.concatenate([*affixes.T, trigrams])
    values = np.concatenate([np.tile(delta, (affixes.shape[1], 1)), np.repeat(delta, size, axis=0)])
    parts = [
        (model.weights, np.stack([np.bincount(rows, values[:, j], TABLE) for j in range(k)], 1)),
        (model.lexicon_weights, np.stack(
            [np.bincount(lexicon, delta[:, j], len(model.lexicon_weights)) for j in range(k)], 1)),
        (model.transitions, between)]
    parts[1][1][-1] = 0
    for (weights, grad), squares in zip(parts, grads):
        grad = grad / len(delta) - 1e-6 * weights
        squares += grad * grad
        weights += (0.3 * grad / (np.sqrt(squares) + 1e-6)).astype(weights.dtype)


def _expected_moves(scores, marginal, inner, transitions):
    """Expected label pairs of neighbouring words, from emission scores and marginals."""
    # For a chain: P(y_t, y_t+1) is proportional to forward * move * emission * backward; both factors
    # follow from recursions over sequences of equal length.
    steps, k = inner.shape[1], scores.shape[1]
    move = np.exp(transitions - transitions.max())
    e = np.exp(np.maximum(scores - scores.max(1, keepdims=True), -60.0))[inner]
    ahead = np.empty_like(e)
    state = np.full((len(inner), k), 1.0 / k)
    for t in range(steps):
        state = (state @ move) * e[:, t]
        state /= state.sum(1, keepdims=True)
        ahead[:, t] = state
    expected = np.zeros((k, k))
    state = np.ones((len(inner), k))
    for t in range(steps - 1, 0, -1):
        both = ahead[:, t - 1, :, None] * move * (e[:, t] * state)[:, None, :]
        expected += (both / both.sum((1, 2), keepdims=True)).sum(0)
        state = (e[:, t] * state) @ move.T
        state /= state.sum(1, keepdims=True)
    return expected


def _runs_per_language(available, total):
    """Runs of each language, ``total`` in all: alike, but what a language lacks goes to the others."""
    quota, left, open_ = np.zeros(len(available), np.int64), total, np.argsort(available, kind="stable")
    for i, language in enumerate(open_):
        quota[language] = min(available[language], max(1, left // (len(open_) - i)))
        left -= quota[language]
    return quota


def _training_rows(doc, truth, k, rng):
    """Training sequences as rows of word numbers: runs of SEGMENT words of one language, shuffled.

    The words of a language follow each other in pieces of SEGMENT words or fewer, so short texts and the ends of
    long ones count as well. Every text gives a piece before any gives another. The last run is filled from the first.
    """
    head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    length = np.diff(np.append(head, len(doc)))
    pieces = -(-length // SEGMENT)
    text = np.repeat(np.arange(len(head)), pieces)
    first = np.cumsum(pieces) - pieces
    start = head[text] + (np.arange(len(text)) - first[text]) * SEGMENT
    size = np.minimum(SEGMENT, (head + length)[text] - start)
    mixed = np.lexsort((rng.random(len(text)), text))
    turn = np.empty(len(text), np.int64)
    turn[mixed] = np.arange(len(text)) - first[text[mixed]]
    order = np.lexsort((rng.random(len(text)), turn))
    language = truth[start]
    per = SEQUENCE // SEGMENT
    available = -(-np.bincount(truth, minlength=k) // SEGMENT)
    runs = []
    for i, quota in enumerate(_runs_per_language(available, SEQUENCES * per)):
        chosen = order[language[order] == i]
        within = np.cumsum(size[chosen]) - size[chosen]
        at = np.repeat(start[chosen] - within, size[chosen]) + np.arange(size[chosen].sum())
        runs.append(np.resize(at, (quota, SEGMENT)))
    runs = rng.permutation(np.concatenate(runs))
    return np.resize(runs, (-(-len(runs) // per) * per, SEGMENT)).reshape(-1, SEQUENCE)


def fit(texts, labels, epochs=EPOCHS, seed=7) -> Model:
    """Train on whole texts (bytes) with one label each.

    Training sequences are made of runs of words of different languages, so that transitions learn
    how long a language lasts in code-switched text.
    """
    rng = np.random.default_rng(seed)
    words = split_words(texts)
    languages = sorted({labels[d] for d in np.unique(words.doc)})  # texts without words teach nothing
    k = len(languages)
    empty = Model(languages, np.zeros((TABLE, k), np.float32), np.zeros(0, np.uint64),
                  np.zeros((1, k), np.float32), np.zeros((k, k)))
    if not languages:
        return empty
    number = {x: i for i, x in enumerate(languages)}
    of_text = np.array([number.get(x, -1) for x in labels])
    truth = of_text[words.doc]
    hashes, counts = np.unique(word_hashes(words), return_counts=True)
    common = np.sort(np.argsort(-counts, kind="stable")[:LEXICON])
    lexicon = hashes[common][counts[common] >= 5]
    model = empty._replace(lexicon=lexicon, lexicon_weights=np.zeros((len(lexicon) + 1, k), np.float32))

    rows = _training_rows(words.doc, truth, k, rng)
    grads = [np.full(w.shape, 1e-8) for w in (model.weights, model.lexicon_weights, model.transitions)]
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(rows), max(1, len(rows) // 64)):
            at = batch.ravel()
            part = Words(words.letters, words.start[at], words.end[at], np.repeat(np.arange(len(batch)), SEQUENCE))
            scores = emissions(model, part)
            marginal = posteriors(scores, part.doc, model.transitions)
            right = np.zeros_like(marginal)
            right[np.arange(len(at)), truth[at]] = 1
            inner = np.arange(len(at)).reshape(-1, SEQUENCE)
            seen = np.zeros((k, k))
            np.add.at(seen, (truth[at][inner[:, :-1]].ravel(), truth[at][inner[:, 1:]].ravel()), 1)
            _gradient_step(model, grads, (*word_features(part), lexicon_rows(model, part)), right - marginal,
                           seen - _expected_moves(scores, marginal, inner, model.transitions))
    return model


def label_words(model: Model, text):
    """(word, language, posterior) for each word of one text (UTF-8 bytes)."""
    words = split_words([text])
    found = posteriors(emissions(model, words), words.doc, model.transitions)
    buffer = words.letters.tobytes()
    return [(buffer[s:e].decode("utf-8", "replace"), model.languages[p.argmax()], float(p.max()))
            for s, e, p in zip(words.start, words.end, found)]


def _has_letter(text):
    return any(c.isalpha() for c in (text or b"").decode("utf-8", "replace"))


def predict_texts(model: Model, texts):
    """(languages, scores): the language with most words by posterior, and its share of the words."""
    if not model.languages:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    words = split_words(texts)
    found = posteriors(emissions(model, words), words.doc, model.transitions)
    mass = np.zeros((len(texts), len(model.languages)))
    np.add.at(mass, words.doc, found)
    share = mass / np.maximum(mass.sum(1, keepdims=True), 1e-300)
    languages, scores = [], []
    for text, row, any_word in zip(texts, share, mass.sum(1) > 0):
        if not any_word or (
                not any(c in text.translate(_FOLD) for c in ASCII) and not _has_letter(text)):
            languages.append(UNDETERMINED)
            scores.append(0.0)
        else:
            languages.append(model.languages[row.argmax()])
            scores.append(float(min(1.0, row.max())))
    return languages, scores


ASCII = [bytes([c]) for c in range(97, 123)]


def remainder(column, modulus):
    """crc32 of a column as text, modulo; NULL for NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def learnable(docs: DataFrame) -> DataFrame:
    return docs.filter("lang is not null and text is not null").filter(remainder("doc_id", 3) != 1)


def train(docs: DataFrame, per_language=PER_LANGUAGE, sample=SAMPLE, most=MOST_LANGUAGES, chars=SAMPLE_CHARS) -> Model:
    """Fit on a bounded sample of ``docs``, never from the held-out third.

    Of the ``most`` most frequent languages (ties by name) about ``per_language`` documents each are drawn by a hash of their id, or fewer
    if these are more than ``sample`` in all, but one of each at least. Rows that repeat an id teach by one of their texts.
    A text teaches by its beginning: all texts together by ``chars`` characters at most, about. So the driver's sample
    has a bound in rows and in bytes, and the model grows with ``most`` alone.
    """
    known = learnable(docs)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(PLACES))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")).orderBy(
        F.desc("n"), "lang").limit(most).collect()
    if not counts:
        return fit([], [])
    each = min(per_language, max(1, sample / len(counts)))
    ends = [(r.lang, max(r.least + 1, int(PLACES * min(1.0, each / r.n)))) for r in counts]
    lookup = docs.sparkSession.createDataFrame(ends, "lang string, __end long").withColumnRenamed("lang", "__lang")
    named = known.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    drawn = named.join(F.broadcast(lookup), F.col("lang") == F.col("__lang")).filter(place < F.col("__end"))
    length = max(1, int(chars / (each * len(counts))))
    chosen = drawn.groupBy("lang", "doc_id").agg(
        F.min_by(F.substring("text", 1, length), F.xxhash64("text")).alias("text")).toArrow().sort_by(
        [("doc_id", "ascending"), ("lang", "ascending")])
    texts = chosen.column("text").cast("binary").to_pylist()
    return fit(texts, chosen.column("lang").to_pylist())


def identify(docs: DataFrame, model: Model, keep=("doc_id",), lang="lang_pred", score="score") -> DataFrame:
    """Columns ``keep`` with the predicted language and its share of the words.

    NULL texts, and texts without a letter, are ``und`` with score 0; so is everything if nothing
    could be learned. Empty tables give empty results; repeated rows are predicted alike. Very long texts are read
    whole. Other columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel():
        def run(texts):
            languages, scores = predict_texts(shared.value, texts)
            return {lang: languages, score: scores}
        return run
    # The arrays of a slice grow with the square of the number of languages.
    slice_bytes = SLICE_BYTES * FEW ** 2 // max(FEW, len(model.languages)) ** 2
    return map_texts(docs, kernel, f"`{lang}` string, `{score}` double", keep, slice_bytes=slice_bytes)


def language_id(docs: DataFrame, per_language=PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row; a NULL id is not held out.

    NULL and empty texts, and texts without a letter, are ``und`` with score 0. Ties go to the language whose name comes
    first. Repeated rows are predicted alike; an empty table gives no rows. Other columns are ignored.
    """
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return identify(docs, train(docs, per_language)).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, per_language=PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs`` that are not ``und``, columns as they were. If nothing could be learned, those with a letter."""
    columns, model = docs.columns, train(docs, per_language)
    if not model.languages:
        def kernel():
            return lambda texts: {"__letters": [_has_letter(t) for t in texts]}
        return map_texts(docs, kernel, "`__letters` boolean", columns).filter("__letters").select(*map(quoted, columns))
    marked = identify(docs, model, columns, "__lang_pred", "__lang_score")
    return marked.filter(F.col("__lang_pred") != UNDETERMINED).select(*map(quoted, columns))
