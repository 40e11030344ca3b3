"""Clusters by the threshold algorithm against plain Lloyd rounds over all distances."""

import hashlib
from math import floor

import numpy as np
import pytest
from compare import connect, differences
from llm.conftest import rows_of
from llm.test_bsi_topk import connect_rows

from claimrisk.llm import threshold_clusters as tc

VECTORS = "vec_id long, embedding array<double>, label int"


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def slow(rows, width, k=8, rounds=10, scale=1024, salt="3"):
    kept = [(i, [floor(scale * c) if abs(c) < 2 ** 53 else scale * int(c) for c in v]) for i, v in rows
            if v is not None and len(v) == width and all(c is not None and np.isfinite(c) for c in v)]
    centroids = [v for _, _, v in sorted(
        (hashlib.sha256(f"{salt}:{i}".encode()).hexdigest(), v, v) for i, v in kept if i is not None)[:k]]
    if not centroids:
        return []
    for step in range(rounds + 1):
        found = [min((distance(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
        if step < rounds:
            for n in range(len(centroids)):
                mine = [v for (_, v), (_, m) in zip(kept, found) if m == n]
                if mine:
                    centroids[n] = [sum(column) // len(mine) for column in zip(*mine)]
    inertia = [sum(d for d, m in found if m == n) for n in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    top = 2 ** 63 - 1
    return sorted(((i, n, min(d, top), min(inertia[n], top), min(sum(inertia), top), digest[n])
                   for (i, _), (d, n) in zip(kept, found)), key=repr)


def odd_rows(rng, width=6):
    rows = [(i, rng.normal(0, 0.3, width).tolist()) for i in range(90)]
    rows += [(i, [0.25] * width) for i in range(90, 110)]  # ties
    rows += [(i, [-0.25, 0.25] * (width // 2)) for i in range(110, 130)]
    rows += [(7, [0.5] * width), (7, rows[7][1]), (7, rows[7][1])]  # repeated ids and rows
    return rows + [(None, [0.1] * width), (200, None), (201, []), (202, [0.1] * (width + 1)), (203, [None] * width),
                   (204, [float("nan")] * width), (205, [float("inf")] * width)]


@pytest.mark.parametrize("k,rounds", [(8, 10), (1, 2), (20, 3), (400, 2)])
def test_same_as_all_distances(spark, k, rounds):
    rows = odd_rows(np.random.default_rng(k))
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(3)
    assert rows_of(tc.cluster(table, width=6, k=k, rounds=rounds)) == slow(rows, 6, k, rounds)


def test_same_as_sql_on_odd_rows(spark):
    table = spark.createDataFrame([(i, v, 0) for i, v in odd_rows(np.random.default_rng(3))], VECTORS)
    assert differences(tc.cluster(table, width=6), connect_rows(table), tc.oracle_sql(width=6)) == ""


def test_numbers_beyond_64_bits(spark):
    rows = [(i, [s * 3.4e38, i * 1e30, -0.5]) for i in range(12) for s in (1.0, -1.0)] + [(50, [0.0, 1e307, 1.0])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    assert rows_of(tc.cluster(table, width=3, k=3, rounds=4)) == slow(rows, 3, 3, 4)


def test_empty_and_clashing(spark):
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(i, [0.5, i / 9], 0) for i in range(9)], VECTORS)
    assert tc.cluster(table.filter("vec_id < 0"), width=2).count() == 0
    assert tc.cluster(table).count() == 0  # no vector of 64 components
    assert tc.cluster(table.withColumn("vec_id", F.lit(None).cast("long")), width=2).count() == 0
    names = ["row", "x", "cluster", "distance", "digest", "a.b", "inertia"]
    clashing = table.withColumns({n: F.lit("1") for n in names})
    assert rows_of(tc.cluster(clashing, width=2)) == rows_of(tc.cluster(table, width=2))


def test_walk_stops_before_all_are_seen(monkeypatch):
    rng = np.random.default_rng(9)
    centroids = rng.integers(-1000, 1000, (60, 3))
    x = rng.integers(-1000, 1000, (500, 3))
    everything = ((x[:, None] - centroids) ** 2).sum(2)
    number, away = tc.nearest(x, centroids)
    assert (number == everything.argmin(1)).all() and (away == everything.min(1)).all()
    tested = []
    real = np.flatnonzero
    monkeypatch.setattr(tc.np, "flatnonzero", lambda a: tested.append(len(real(a))) or real(a))
    tc.nearest(centroids[:1], centroids)
    assert sum(tested) < 60


def test_tie_at_the_frontier_goes_to_the_smaller_number():
    centroids = np.array([[3, 0], [0, 0], [0, 3], [-3, 0]])
    x = np.array([[0, 0], [2, 2], [-2, 0], [0, -9]])
    number, away = tc.nearest(x, centroids)
    assert number.tolist() == [1, 0, 3, 1] and away.tolist() == [0, 5, 1, 81]


def test_query_same_as_sql(spark, sf_dir):
    from claimrisk.llm.queries import ORACLES, QUERIES

    name = "op11_threshold_clusters"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == ""
