"""BPE with forced boundaries against the tokenizers library."""

import hashlib
import os
import random

import pytest
from llm.conftest import TEXTS, rows_of

from claimrisk.llm import bpe_cuts
from claimrisk.llm.queries import QUERIES, WORD_BPE, documents

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
PARTS = [*"aàéÀÉ ßthings'll\n\t .,!?0123½²ª٣ΣσİIıǅ漢字😀‍́\x00\x01\x1c\xa0\xad\x85’“—", "<|endoftext|>", "<|startoftext|>",
         "   ", "　", "'RE", "'Ve", "é", "ﬁ", "…", "ΑΣ ", "힣", "<|", "qx", "Ünïcödé"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def coder():
    return bpe_cuts.CutBpe(WORD_BPE)


def test_random_texts(library, coder):
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids, repr(text)
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_no_token_spans_a_cut(coder):
    for token in coder.token_of.values():
        if token in coder.special:
            continue
        ends = token.endswith(coder.suffix)
        symbols = token.removesuffix(coder.suffix)
        # As the end of a word, or inside one: a token must never be cut.
        parts = coder.fragments(symbols) if ends else coder.fragments(symbols + "!")
        assert symbols in (parts if ends else ["".join(parts)[:-1]])
        if not ends:
            assert parts[0].startswith(symbols)


def test_cuts_are_forced(coder):
    word = "".join(coder.symbol[b] for b in "wçéxqj".encode())
    assert len(coder.fragments(word)) > 1 and "".join(coder.fragments(word)) == word


def test_small_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe_cuts, "CACHED_WORDS", 3)
    fresh = bpe_cuts.CutBpe(WORD_BPE)
    text = "a few words, then the same few words again and others"
    assert fresh.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_query_same_as_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    found = QUERIES["op10_bpe"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(odd, clashing, empty, library):
    found = bpe_cuts.encode(odd, WORD_BPE)
    by_id = {r.doc_id: r for r in found.collect()}
    assert found.count() == odd.count()
    assert by_id[0].ids == by_id[1].ids == [] and by_id[0].decoded == ""
    assert by_id[10].ids == library.encode(TEXTS[10], add_special_tokens=False).ids
    assert rows_of(bpe_cuts.encode(clashing, WORD_BPE)) == rows_of(found)
    assert bpe_cuts.encode(empty, WORD_BPE).count() == 0
