"""Hard negatives by spanning-tree bounds against all scores."""

import numpy as np
from compare import connect, differences
from llm.conftest import rows_of
from llm.test_bsi_topk import connect_rows

from claimrisk.llm import anchor_tree as at
from claimrisk.llm.queries import hard_negative_labels

VECTORS = "vec_id long, embedding array<double>, label int"


def slow(rows, every=50, positives=5, k=3):
    kept = []
    for number, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or not all(c is not None and np.isfinite(c) for c in v):
            continue
        q = [int(np.floor(c * 256)) if abs(c) < 2 ** 40 else int(c) * 256 for c in v]
        kept.append((number, i, (label + 1) % 10 if i % 7 == 0 else label, q))
    out = []
    for number, i, label, a in kept:
        if i % every:
            continue
        scored = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, b)))), j, m, other) for m, j, other, b in kept if m != number)
        for s, j, _, _ in [r for r in scored if r[3] == label][:positives]:
            fit = [r for r in scored if r[3] != label and -50 * s <= -100 * r[0] <= -95 * s]
            out += [(i, j, rank, r[1], -s, -r[0]) for rank, r in enumerate(fit[:k], 1)]
    return sorted(out, key=repr)


def odd_rows(rng, n=300, width=8):
    middles = rng.normal(0, 1, (12, width))
    rows = [(i, (middles[i % 12] + rng.normal(0, 0.2, width)).tolist(), i % 10) for i in range(n)]
    rows += [(i, [0.5] * width, i % 3) for i in range(n, n + 30)]  # ties
    rows += [rows[50], rows[50], (50, [0.25] * width, 3), (100, rows[7][1], 0)]  # repeated rows and ids
    return rows + [(None, [1.0] * width, 1), (400, [1.0] * width, None), (450, None, 1), (500, [None] * width, 1),
                   (550, [float("nan")] * width, 1), (600, [float("inf")] * width, 1), (650, [], 1), (700, [1.0] * 3, 2),
                   (751, [1.0] * (width + 2), 1), (0, [0.0] * width, 1), (-50, [-x for x in rows[5][1]], 5)]


def table_of(spark, rows):
    return spark.createDataFrame(rows, VECTORS).repartition(3)


def test_same_as_all_scores(spark, monkeypatch):
    monkeypatch.setattr(at, "TREE_ROWS", 4)
    rows = odd_rows(np.random.default_rng(2))
    table = hard_negative_labels(table_of(spark, rows))
    expected = slow(rows, every=10)
    assert rows_of(at.mine(table, every=10, block_rows=70)) == expected
    assert rows_of(at.mine(table, every=10)) == expected


def test_same_as_sql_on_odd_rows(spark):
    table = table_of(spark, odd_rows(np.random.default_rng(4)))
    assert differences(at.mine(hard_negative_labels(table)), connect_rows(table), at.ORACLE_SQL) == ""


def test_scores_beyond_doubles_and_longs(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(0, 1, 3) * 1e9).tolist(), i % 2) for i in range(120)]
    rows += [(150, [1e30, 1.0, 1.0], 0), (151, [1e30, 2.0, 1.0], 0), (152, [6e29, 1.0, 1.0], 1)]
    assert rows_of(at.mine(hard_negative_labels(table_of(spark, rows)))) == slow(rows)


def test_empty_and_clashing(spark):
    from pyspark.sql import functions as F

    rows = odd_rows(np.random.default_rng(6), n=60)
    table = table_of(spark, rows)
    assert at.mine(table.filter("vec_id < -100")).count() == 0
    assert at.mine(table.filter("vec_id % 50 <> 0")).count() == 0
    assert at.mine(table.filter("vec_id = 50")).count() >= 0
    names = ["row", "x", "block", "tree", "kind", "score", "scores", "anchor", "place", "best", "a.b", "n", "key"]
    clashing = table.withColumns({n: F.lit("1") for n in names})
    assert rows_of(at.mine(clashing)) == rows_of(at.mine(table))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(8)
    middle = rng.integers(-300, 300, 16)
    anchors = middle + rng.integers(-4, 5, (40, 16))
    candidates = rng.integers(-300, 300, (2000, 16))
    exact = candidates @ anchors.T
    scored = 0

    def wanted(anchor, low, high):
        assert (low <= exact[:, anchor]).all() and (exact[:, anchor] <= high).all()
        return (high >= np.sort(exact[:, anchor])[-5])

    for anchor, rows, scores in at.tree_scores(anchors, candidates, wanted):
        assert (scores == exact[rows, anchor]).all()
        assert set(np.argsort(-exact[:, anchor])[:5]) <= set(rows)
        scored += len(rows)
    assert scored < 0.3 * exact.size


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (7, 3))
    order, parent, edge = at.spanning_tree(points)
    place = {a: i for i, a in enumerate(order)}
    assert all(place[parent[a]] < place[a] for a in order[1:])
    away = np.sqrt(((points[:, None] - points) ** 2).sum(2))
    pairs, labels, total = sorted((away[i, j], i, j) for i in range(7) for j in range(i)), list(range(7)), 0.0
    for d, i, j in pairs:  # Kruskal
        if labels[i] != labels[j]:
            total += d
            labels = [labels[i] if x == labels[j] else x for x in labels]
    assert abs(edge[order[1:]].sum() - total) < 1e-6


def test_query_same_as_sql(spark, sf_dir):
    from claimrisk.llm.queries import ORACLES, QUERIES

    name = "op13_hard_negatives"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == ""
