"""Best-fit packing: ids of the tokenizers library, bounds, and complete gapless sequences."""

import itertools
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm.conftest import rows_of
from pyspark.sql import functions as F

from claimrisk.llm import packing
from claimrisk.llm.queries import BYTE_BPE, QUERIES, documents

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_BPE)


def check_packed(packed, texts, library, capacity=1024):
    """Every piece right and every sequence gapless; returns (sequences, total length)."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc_id, rows in pieces.items():
        ids = library.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2]
        rows.sort(key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(-(-len(ids) // capacity)))
        at = 0
        for r in rows:
            part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert r.start == at and r.ids_crc32 == zlib.crc32(part)
            at += r.length
            assert r.piece == 0 or r.length == capacity
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for rows in pieces.values() for r in rows)


def test_ids_of_odd_texts(library):
    rng = random.Random(1)
    parts = [*"aàé ßthing's'll\n\t .,!?0123٣Σİ漢😀\x00\x01", "<|endoftext|>", "   ", " \n", "　", "\x85"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        assert packing.token_ids(BYTE_BPE, text).tolist() == library.encode(text, add_special_tokens=False).ids
    for text in (" " * 2_000_000, "\n" * 1_000_000 + "a", "b" * 50_000):
        assert packing.token_ids(BYTE_BPE, text).tolist() == library.encode(text, add_special_tokens=False).ids


def fewest_bins(lengths, capacity):
    """Brute force: the smallest number of bins."""
    for n in range(1, len(lengths) + 1):
        for places in itertools.product(range(n), repeat=len(lengths)):
            fill = [0] * n
            for place, size in zip(places, lengths):
                fill[place] += size
            if max(fill) <= capacity:
                return n
    return 0


def test_bounds_never_exceed_the_fewest_bins():
    rng = random.Random(3)
    sharp = 0
    for _ in range(150):
        lengths = np.array([rng.randint(1, 12) for _ in range(rng.randrange(1, 7))])
        bound = packing.lower_bound(*np.unique(lengths, return_counts=True), 12)
        best = fewest_bins(lengths.tolist(), 12)
        _, _, fill = packing.best_fit_decreasing(lengths, 12)
        assert -(-lengths.sum() // 12) <= bound <= best <= len(fill)
        sharp += bound == best
    assert sharp > 140
    assert packing.lower_bound([7], [5], 12) == 5 and packing.lower_bound([5, 7], [0, 0], 12) == 0


def test_query_is_whole_and_near_its_bound(spark, sf_dir, library):
    packed = QUERIES["op8_packing"](spark, sf_dir)
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    used, total = check_packed(packed, texts, library)
    assert (used, packing.certificate(packed)[1] <= used) == (packing.certificate(packed)[0], True)
    assert used <= -(-total // 1024) + 1


def test_groups_exchange_pieces(spark, sf_dir, library):
    """Tiny groups have gaps; exchanges and the pooled tails bring them near the bound."""
    table = documents(spark, sf_dir)
    cut = packing.store(packing.pieces(table, BYTE_BPE))
    plain = packing.pack_pieces(cut, group_rows=20, exchanges=0)
    packed = packing.pack_pieces(cut, group_rows=20, exchanges=4)
    texts = {r.doc_id: r.text for r in table.collect()}
    used, _ = check_packed(packed, texts, library)
    assert used <= check_packed(plain, texts, library)[0]
    assert used <= packing.certificate(packed)[1] * 1.05


def test_odd_rows(odd, clashing, empty, library, docs):
    unique = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_packed(packing.pack(unique, BYTE_BPE), {r.doc_id: r.text for r in unique.collect()}, library)
    packed = packing.pack(odd, BYTE_BPE)
    firsts = packed.filter("piece = 0")
    assert firsts.count() == odd.count() and firsts.filter("doc_id is null").count() == 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(packing.pack(clashing, BYTE_BPE).select(columns)) == rows_of(packed.select(columns))
    assert packing.pack(empty, BYTE_BPE).count() == 0
    large = [(None, "no id"), (2 ** 60 + 1, "an id that no double holds"), (2 ** 60 + 2, "another")]
    assert {r.doc_id for r in packing.pack(docs(large), BYTE_BPE).collect()} == {i for i, _ in large}
    same = packing.pack(docs([(i, "the same words") for i in range(600)]), BYTE_BPE)
    assert same.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n < 1020").count() <= 1
