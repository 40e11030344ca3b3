"""SimHash near-dedup against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from llm.conftest import rows_of

from claimrisk.llm import simhash
from claimrisk.llm.components import connected_components


def slow_fingerprint(text, size=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(codes, distance=4):
    """Smallest index reachable, by search over all pairs."""
    label = [None] * len(codes)
    for start in range(len(codes)):
        if label[start] is None:
            reach = [start]
            for a in reach:
                label[a] = start
                reach += [b for b in range(len(codes)) if label[b] is None and b not in reach
                          and (codes[a] ^ codes[b]).bit_count() <= distance]
    return label


def clustered(count, seed=3):
    rng = np.random.default_rng(seed)
    codes = {0}
    while len(codes) < count:
        center = int(rng.integers(0, 2 ** 63)) * 2 + 1
        for _ in range(int(rng.integers(1, 30))):
            for bit in rng.integers(0, 64, int(rng.integers(0, 5))):
                center ^= 1 << int(bit)
            codes.add(center)
    return sorted(codes)


def test_fingerprints_same_as_slow(docs):
    texts = [None, "", " ", "a b", "A b", "a b c d", "a b c d e", "x y z " * 50, "é È\x0bq\x1cr s t u", "Straße ÄB c d e f"]
    found = simhash.fingerprints_of([None if t is None else t.encode() for t in texts])
    assert found.tolist() == [slow_fingerprint(t) for t in texts]


def test_gray_ranks_are_in_gray_order():
    ranks = np.arange(64, dtype=np.uint64)
    assert simhash.gray_rank(ranks ^ (ranks >> np.uint64(1))).tolist() == ranks.tolist()


@pytest.mark.parametrize("chunk_rows", [4096, 40, 3])
def test_links_give_all_components(spark, chunk_rows):
    codes = clustered(400)
    rows = [(c - 2 ** 64 if c >= 2 ** 63 else c, i) for i, c in enumerate(codes)]
    links = simhash.links(spark.createDataFrame(rows, "fp long, node long"), 4, chunk_rows)
    labels = {r.node: r.label for r in connected_components(links).collect()}
    assert [labels.get(i, i) for i in range(len(codes))] == slow_components(codes)


def test_index_finds_every_pair_without_labels():
    codes = np.array(clustered(300), np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    index = simhash.GrayIndex(codes, np.zeros(len(codes), np.int64))
    alone = index.label_ranges(np.arange(len(codes)))
    left, right = index.search(np.arange(len(codes)), 4, alone)
    found = set(zip(left.tolist(), right.tolist()))
    assert found == {(a, b) for a in range(len(codes)) for b in range(a + 1, len(codes))
                     if (int(codes[a]) ^ int(codes[b])).bit_count() <= 4}


def test_search_prunes_groups():
    codes = np.sort(np.random.default_rng(1).integers(0, 2 ** 63, 4096).astype(np.uint64))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    index = simhash.GrayIndex(codes, np.zeros(len(codes), np.int64))
    top = index.levels[1]
    query = codes[0]
    out = np.bitwise_count((query ^ top["pattern"]) & top["mask"]) > 4
    assert out.mean() > 0.2  # whole groups go before a row of theirs is looked at


def test_hot_near_copies_in_small_chunks(docs, spark):
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(80):
        words = list(base)
        words[i % 60] = f"x{i}"
        texts.append(" ".join(words))
    table = docs(texts)
    expected = slow_components([slow_fingerprint(t) for t in texts])
    for chunk_rows in (4096, 5):
        found = simhash.near_duplicates(table, chunk_rows=chunk_rows)
        assert [r.component_id for r in found.orderBy("doc_id").collect()] == expected


def test_a_dense_group_is_not_multiplied(spark):
    """Chunks of one component don't meet again: links and rows stay in proportion to the group."""
    codes = sorted({a << 1 | b for a in range(64) for b in (0, 1)} | {1 << 40, 3 << 40, 2 ** 63 - 1})
    table = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "fp long, node long")
    found = simhash.links(table, 4, chunk_rows=8)
    labels = {r.node: r.label for r in connected_components(found).collect()}
    assert [labels.get(i, i) for i in range(len(codes))] == slow_components(codes)


def test_odd_rows(odd, clashing, empty):
    found = simhash.near_duplicates(odd)
    by_id = {r.doc_id: r for r in found.collect()}
    assert found.count() == odd.count()
    assert by_id[0].fingerprint == "0" * 16 and by_id[2].component_id == by_id[99].component_id == 0
    assert by_id[4].component_id == by_id[5].component_id == 4
    assert by_id[6].component_id == by_id[7].component_id == 6
    assert rows_of(simhash.near_duplicates(clashing)) == rows_of(found)
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each(odd, clashing):
    kept = simhash.one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    component = {r.doc_id: r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert sorted(i for i in ids if i is not None) == sorted({c for i, c in component.items() if i is not None})
    assert ids.count(None) == 1  # the one text without an id that is like no other


def slow_rows(rows, distance=4):
    """(id, fingerprint, smallest id reachable) of each (id, fingerprint), by all pairs of fingerprints."""
    codes = sorted({fp for _, fp in rows})
    label = dict(zip(codes, slow_components(codes, distance)))
    ids = {}
    for i, fp in rows:
        ids.setdefault(label[fp], []).append(i)
    return [(i, fp, min((x for x in ids[label[fp]] if x is not None), default=None)) for i, fp in rows]


@pytest.mark.parametrize("small", [False, True])
def test_rows_without_or_with_repeated_ids(docs, monkeypatch, small):
    """Fingerprints are the nodes: rows without an id link others, an id that is repeated links nothing."""
    from claimrisk.operators import lookup_join

    if small:
        monkeypatch.setattr(lookup_join, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(simhash, "fingerprints", lambda df, shingle: df.selectExpr("doc_id", "cast(text AS long) AS fp"))
    rows = [(1, 0), (None, 0x0F), (2, 0xFF), (3, 0), (5, 1), (5, 2 ** 60 - 1), (None, 2 ** 40 * 0xFFFF), (None, 2 ** 40 * 0xFFFF),
            (8, 2 ** 62 - 1), (9, 2 ** 62 - 2 ** 3), (9, 2 ** 62 - 2 ** 3)]
    rows += [(i % 7, int(c) >> 1) for i, c in enumerate(clustered(80))]
    rows += [(None, int(c) >> 1) for c in clustered(30, seed=9)]
    found = simhash.near_duplicates(docs([(i, str(fp), "en") for i, fp in rows]))
    assert rows_of(found) == sorted(((i, f"{fp:016x}", c) for i, fp, c in slow_rows(rows)), key=repr)


def test_one_row_of_components_without_ids(docs):
    first, second, third = ("the quick brown fox jumps over it", "lorem ipsum dolor sit amet et cetera", "one more text")
    kept = simhash.one_of_each(docs([(None, first, "en"), (None, first, "de"), (None, first, "en"), (7, second, "en"),
                                     (None, second, "en"), (None, third, None)]))
    assert rows_of(kept.select("doc_id", "text", "lang")) == sorted(
        [(None, first, "de"), (7, second, "en"), (None, third, None)], key=repr)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 260)] + [(300, 300)]
    labels = {r.node: r.label for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(labels[i] == 0 for i in range(101)) and all(labels[i] == 200 for i in range(200, 260))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table(spark, sf_dir):
    from claimrisk.llm.queries import QUERIES, documents

    texts = [r.text for r in documents(spark, sf_dir).orderBy("doc_id").collect()]
    codes = [slow_fingerprint(t) for t in texts]
    found = QUERIES["op1_simhash"](spark, sf_dir).orderBy("doc_id").collect()
    assert [int(r.fingerprint, 16) for r in found] == codes
    assert [r.component_id for r in found] == slow_components(codes)


def test_unlike_texts_that_repeat_an_id_stay(docs):
    first, second, third = ("the quick brown fox jumps over it", "lorem ipsum dolor sit amet et cetera", "one more text")
    table = docs([(3, first, "en"), (5, first, "en"), (5, second, "en"), (5, second, "de"), (7, second, "en"),
                  (9, third, "en"), (9, third, "en")])
    for rows in (table, table.orderBy("lang").repartition(3)):
        kept = simhash.one_of_each(rows)
        assert rows_of(kept.select("doc_id", "text", "lang")) == [(3, first, "en"), (5, second, "de"), (9, third, "en")]
