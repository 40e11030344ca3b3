"""Neighbours from the inverted multi-index against all cosines."""

import numpy as np
import pytest
from llm.conftest import rows_of

from claimrisk.llm import multi_index as mi

VECTORS = "vec_id long, embedding array<double>, label int"


def slow(rows, every=50, k=5):
    """{query row: [(score, vec_id) of the k nearest, nearest first]} by all cosines."""
    kept = [(n, i, np.array(v, float)) for n, (i, v) in enumerate(rows) if i is not None and v
            and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    width = max((len(v) for _, _, v in kept), default=0)
    x = np.array([np.pad(v, (0, width - len(v))) for _, _, v in kept]).reshape(len(kept), width)
    out = []
    for place, (n, i, _) in enumerate(kept):
        if i % every == 0:
            scores = mi.cosines(x, x[place])
            near = sorted((-scores[p], kept[p][1]) for p in range(len(kept)) if p != place)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(near, 1)]
    return sorted(out, key=repr)


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(3)


def odd_rows(rng, n=400, width=8):
    rows = [(i, rng.normal(0, 1, width).tolist()) for i in range(n)]
    rows += [(i, [0.5] * width) for i in range(n, n + 60)]  # a large group of copies, and ties
    rows += [rows[50], rows[50], (50, [0.25] * width), (100, rows[7][1])]  # repeated rows and ids
    return rows + [(None, [1.0] * width), (450, None), (500, [None] * width), (550, [float("nan")] * width), (600, []),
                   (650, [float("inf")] * width), (700, [0.0] * width), (750, [1.0] * 3), (800, [-1e200, 1e200] * (width // 2))]


def test_complete_without_a_bound_on_the_slack(spark, monkeypatch):
    monkeypatch.setattr(mi, "fit", lambda *a, real=mi.fit: real(*a)._replace(slack=np.inf))
    rows = odd_rows(np.random.default_rng(1))
    expected = slow(rows)
    assert rows_of(mi.search(table_of(spark, rows), cell_rows=4, first_rows=8)) == expected
    assert rows_of(mi.search(table_of(spark, rows), cell_rows=40, region_rows=10)) == expected


def recall(found, expected):
    """Share of the true neighbours that were found; a found one with the score of a true one counts."""
    want, got = {}, {}
    for side, rows in ((want, expected), (got, found)):
        for query, _, vec_id, score in rows:
            side.setdefault(query, []).append(score)
    hits = sum(sum(s >= min(scores) - 1e-12 for s in got.get(q, [])) for q, scores in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("spread,visited", [(0.05, 0.3), (3.0, 1.0)])
def test_recall(spark, monkeypatch, spread, visited):
    rng = np.random.default_rng(3)
    middles = rng.normal(0, 1, (40, 16))
    rows = [(i, (middles[i % 40] + rng.normal(0, spread, 16)).tolist()) for i in range(4000)]
    found = rows_of(mi.search(table_of(spark, rows)))
    expected = slow(rows)
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert recall(found, expected) >= 0.9
    sample = np.array([v for _, v in rows])
    books = mi.fit(sample, 5, 11)
    x = mi.units(sample)
    near = [d.argmin(1) for d in books.halves(x)]
    limit = 2 - 2 * expected[4][3] + books.slack
    first, second = (d[0] for d in books.halves(x[:1]))
    assert (first[near[0]] + second[near[1]] <= limit).mean() <= visited


def test_few_rows(spark):
    table = table_of(spark, [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (3, [0.0, 2.0])])
    root = 1 / np.sqrt(2)
    found = rows_of(mi.search(table))
    assert [r[:3] for r in found] == [(0, 1, 50), (0, 2, 3), (50, 1, 0), (50, 2, 3)]
    assert np.allclose([r[3] for r in found], [root, 0, root, root])
    assert mi.search(table.filter("vec_id = 0")).count() == 0
    assert mi.search(table.filter("vec_id = 3")).count() == 0
    assert mi.search(table.filter("vec_id < 0")).count() == 0
    assert rows_of(mi.search(table_of(spark, [(0, [2.0]), (1, [-1.0])]))) == [(0, 1, 1, -1.0)]


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    table = table_of(spark, odd_rows(np.random.default_rng(5), n=60))
    names = ["row", "x", "first", "second", "unit", "part", "kind", "score", "limit", "taken", "query", "a.b", "rank"]
    assert rows_of(mi.search(table.withColumns({n: F.lit("1") for n in names}))) == rows_of(mi.search(table))


def test_cells_come_by_their_sums():
    rng = np.random.default_rng(2)
    first, second = rng.integers(0, 9, 13).astype(float), rng.random(7)
    found = list(mi.cells_in_order(first, second))
    assert [t for t, _, _ in found] == sorted(t for t, _, _ in found)
    assert len({(i, j) for _, i, j in found}) == 13 * 7
    assert all(t == first[i] + second[j] for t, i, j in found)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_recall_of_the_query(spark, folder):
    from claimrisk.llm.queries import QUERIES

    path = f"/root/testdata/{folder}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = rows_of(QUERIES["op12_multi_index"](spark, path))
    expected = slow(rows)
    assert len(found) == len(expected) and recall(found, expected) >= 0.9
    scores = {(i, j): s for i, _, j, s in slow(rows, k=len(rows))}
    assert all(s == scores[q, v] for q, _, v, s in found)
