"""Exact top-k on the bit-sliced index against plain products."""

import numpy as np
from compare import connect, differences
from llm.conftest import rows_of

from claimrisk.llm import bsi_topk as bsi
from claimrisk.session import store

VECTORS = "vec_id long, embedding array<float>, label int"


def slow(rows, every=2, k=5):
    vectors = [(i, [int(np.floor(256.0 * np.float64(np.float32(x)))) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for own, (q, a) in enumerate(vectors):
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for row, (i, b) in enumerate(vectors) if row != own)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def test_blocks_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 8)]) for i in range(60)]
    rows += [(i, [0.5] * 8) for i in range(60, 75)]  # ties
    rows += [(80, None), (81, [None] * 8), (82, [float("nan")] * 8), (83, [float("inf")] * 8), (84, []),
             (85, [0.1] * 3), (None, [0.3] * 8), (86, [1e6, -1e6] * 4), rows[4], rows[4], (4, [0.4] * 8)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    expected = slow(rows)
    assert rows_of(bsi.top_k_of_table(table, every=2)) == expected
    vectors = store(bsi.quantised(table))
    asked = vectors.filter("vec_id % 2 = 0")
    assert rows_of(bsi.top_k(vectors, asked, 5, block_rows=16)) == expected


def test_few_or_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0], 0), (50, [2.0], 0), (50, [2.0], 0)], VECTORS)
    assert rows_of(bsi.top_k_of_table(table)) == sorted([
        (0, 1, 50, 256 * 512), (0, 2, 50, 256 * 512)] + 2 * [(50, 1, 50, 512 * 512), (50, 2, 0, 256 * 512)])
    assert bsi.top_k_of_table(table.filter("vec_id = 0")).count() == 0
    assert bsi.top_k_of_table(table.filter("vec_id < 0")).count() == 0


def test_slices_add_up():
    rng = np.random.default_rng(1)
    values = rng.integers(-200, 200, (130, 5))
    least, bits, slices = bsi.build_slices(values)
    for query in rng.integers(-150, 150, (10, 5)):
        sums, constant = bsi.score_slices(query, least, bits, slices)
        scores = [bsi._score_of(sums, constant, row) for row in range(130)]
        assert scores == (values @ query).tolist()
        everything = np.packbits(np.r_[np.ones(130, np.uint8), np.zeros(62, np.uint8)], bitorder="little").view(np.uint64)
        top = bsi.top_rows(sums, everything, 5)
        assert sorted(top) == sorted(np.lexsort((np.arange(130), -(values @ query)))[:5])


def test_same_as_sql(spark, sf_dir):
    from claimrisk.llm.queries import ORACLES, QUERIES

    assert differences(QUERIES["op3_topk"](spark, sf_dir), connect(sf_dir), ORACLES["op3_topk"]) == ""


def test_repeated_ids_with_other_vectors(spark):
    from claimrisk.llm.queries import TOPK_SQL

    rng = np.random.default_rng(3)
    rows = [(i % 60, [float(x) for x in rng.normal(0, 1, 4)], 0) for i in range(150)]
    table = spark.createDataFrame(rows, VECTORS)
    con = connect_rows(table)
    assert differences(bsi.top_k_of_table(table), con, TOPK_SQL) == ""
    vectors = store(bsi.quantised(table))
    found = bsi.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5, block_rows=16)
    assert differences(found, con, TOPK_SQL) == ""


def test_equal_rows_are_rows_of_their_own(spark):
    from claimrisk.llm.queries import TOPK_SQL

    rows = [(50, [1.0, 0.5]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.75, 1.0]), (50, [0.25, 1.0]), (3, [0.5, 0.5]), (4, [0.1, 0.9])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    found = bsi.top_k_of_table(table)
    assert rows_of(found) == slow(rows, every=50)
    assert differences(found, connect_rows(table), TOPK_SQL) == ""


def connect_rows(table):
    import duckdb

    con = duckdb.connect()
    embeddings = table.toArrow()  # noqa: F841
    con.execute("CREATE TABLE embeddings AS SELECT * FROM embeddings")
    return con
