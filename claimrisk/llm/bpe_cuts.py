"""BPE with forced boundaries: word-end BPE files of the tokenizers library, encoded by fragments.

Two neighbouring symbols that never stand side by side inside any vocabulary token can't be merged, so a
word is cut between them; the fragments are encoded independently and their ids put together.
"""

import functools
import json
import re
from itertools import chain

from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.models import BPE

from claimrisk.llm.packing import byte_symbols
from claimrisk.llm.texts import map_texts

# Encoded words that a task keeps; the cache starts anew beyond it.
CACHED_WORDS = 400_000

# Plain text: ASCII, Latin-1 letters and signs, common typographic signs. For it, composing is no change and
# the classes of characters are certain; other text is normalised and split by the library.
_PLAIN = re.compile("[\t-\r -~¡-¬®-ÿ–—‘’“”…€]*")
_LETTERS = "a-zªµºß-öø-ÿ"
_NUMBERS = "0-9²³¹¼½¾"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\t-\r {_LETTERS}{_NUMBERS}]+")


class CutBpe:
    """Encoder and decoder for a BPE file whose tokens mark the end of a word by a suffix."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], [tuple(m) for m in spec["model"]["merges"]]
        self.suffix = spec["model"]["end_of_word_suffix"]
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of = {i: token for token, i in vocabulary.items()}
        self.token_of.update({i: token for token, i in self.special.items()})
        self.inner = BPE(vocabulary, merges)
        self.final = BPE(vocabulary, merges, end_of_word_suffix=self.suffix)
        self.symbol = [byte_symbols()[b] for b in range(256)]
        self.joined = self._pairs_inside(vocabulary)
        self._special_at = re.compile("(" + "|".join(map(re.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = {}

    def _pairs_inside(self, vocabulary):
        """Neighbouring symbols inside tokens; the last symbol of a word counts with its suffix."""
        pairs = set()
        for token in vocabulary:
            symbols = list(token.removesuffix(self.suffix))
            if token.endswith(self.suffix) and symbols:
                symbols[-1] += self.suffix
            pairs.update(zip(symbols, symbols[1:]))
        return pairs

    def fragments(self, symbols):
        """Cut the symbols of a word where no token can span; the last fragment ends the word."""
        ends = [*symbols[:-1], symbols[-1] + self.suffix]
        first, found = 0, []
        for place, pair in enumerate(zip(ends, ends[1:]), 1):
            if pair not in self.joined:
                found.append(symbols[first:place])
                first = place
        return [*found, symbols[first:]]

    def _encode_word(self, symbols):
        *inner, last = self.fragments(symbols)
        ids = [token.id for fragment in inner for token in self.inner.tokenize(fragment)]
        return (*ids, *[token.id for token in self.final.tokenize(last)])

    def _word(self, word, symbols=None):
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            if symbols is None:  # printable ASCII stands for itself
                symbols = word if word.isascii() else "".join([self.symbol[b] for b in word.encode()])
            found = self.words[word] = self._encode_word(symbols)
        return found

    def _encode_part(self, text):
        if _PLAIN.fullmatch(text):
            words = _WORD.findall(text.lower())
            get = self.words.get
            return list(chain.from_iterable([get(w) or self._word(w) for w in words]))
        normal = self.library.normalizer.normalize_str(text)
        parts = self.library.pre_tokenizer.pre_tokenize_str(normal)
        # Symbols of such words are kept apart from plain words by a leading space.
        return list(chain.from_iterable([self._word(" " + p, p) for p, _ in parts]))

    def encode(self, text):
        """Ids of a text; strings of special tokens in it become their ids."""
        if self._special_at is None or "<" not in text:
            return self._encode_part(text)
        ids = []
        for part in self._special_at.split(text):
            ids += [self.special[part]] if part in self.special else self._encode_part(part)
        return ids

    def decode(self, ids):
        """Tokens joined by spaces: such files name no decoder."""
        token = self.token_of
        return " ".join([token[i] for i in ids])


@functools.lru_cache(maxsize=2)
def cut_bpe(path) -> CutBpe:
    return CutBpe(path)


def encode(docs: DataFrame, tokenizer, keep=("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``ids`` (array) and ``decoded`` (the text that the ids stand for).

    NULL and empty texts have no ids and decode to an empty text; very long texts are encoded whole; repeated rows are encoded
    alike. Bytes that are not valid UTF-8 count as U+FFFD. Empty tables give empty results; other columns are ignored.
    ``tokenizer`` is the path of the file, readable on every machine.
    """
    def kernel():
        coder = cut_bpe(tokenizer)

        def run(texts):
            ids = [coder.encode((t or b"").decode("utf-8", "replace")) for t in texts]
            return {"ids": ids, "decoded": [coder.decode(i) for i in ids]}
        return run
    return map_texts(docs, kernel, "ids array<int>, decoded string", keep)
