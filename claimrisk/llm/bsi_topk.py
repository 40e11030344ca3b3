"""Exact top-k inner products on a bit-sliced index.

A block of vectors is stored by bit slices: one bitmap over the block's rows for each bit of each quantised
attribute. A query adds the slices that its components select, weighted by shifts, with carry-save adders
on whole bitmaps; the sums are bit slices again. The top rows are taken from the most significant slice
downward, and rows that tie at the boundary are resolved by their ids.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimrisk.llm.vectors import matrix, meet, meetings, usable
from claimrisk.session import store

SCALE = 256
# Rows of a block at most, and at least (but for small tables).
BLOCK_ROWS = 65_536
LEAST_ROWS = 4_096
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(vectors: DataFrame, scale=SCALE, vec_id="vec_id", embedding="embedding") -> DataFrame:
    """``row, vec_id, v``: floor(scale * x) of each component. Rows without an id, and vectors that are NULL or hold NULL
    or a non-finite component, are left out. ``row`` tells rows apart that repeat an id, or all; store the result."""
    named = vectors.filter(F.col(vec_id).isNotNull())
    return usable(named, vec_id=vec_id, embedding=embedding).select(
        "row", "vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def build_slices(values):
    """(least value of each attribute, bits of each attribute, slices): slices are bitmaps over the rows as uint64
    words, attribute by attribute, lowest bit first, of the values less the least one."""
    n, width = values.shape
    least = values.min(0) if n else np.zeros(width, np.int64)
    above = values.astype(np.uint64) - least.astype(np.uint64)
    bits = np.array([int(m).bit_length() for m in (above.max(0) if n else [])], np.int64)
    padded = -(-n // 64) * 64
    rows = []
    for d in range(width):
        for bit in range(bits[d]):
            on = np.zeros(padded, np.uint8)
            on[:n] = (above[:, d] >> np.uint64(bit)) & np.uint64(1)
            rows.append(np.packbits(on, bitorder="little").view(np.uint64))
    return least, bits, np.array(rows, np.uint64).reshape(len(rows), padded // 64)


def add_slices(by_weight):
    """Sum of bitmaps with weights 2^w (a list of 2-d arrays, by w), as one bitmap for each bit of the sum."""
    total, carried, weight = [], [], 0
    while weight < len(by_weight) or carried:
        parts = carried + ([by_weight[weight]] if weight < len(by_weight) else [])
        level = np.concatenate(parts) if parts else np.zeros((0, 0), np.uint64)
        carried = []
        while len(level) > 2:  # full adders, three bitmaps of a weight at a time
            k = len(level) // 3
            a, b, c = level[:k], level[k:2 * k], level[2 * k:3 * k]
            half = a ^ b
            carried.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * k:]])
        if len(level) == 2:
            carried.append(level[:1] & level[1:])
            level = level[:1] ^ level[1:]
        total.append(level[0] if len(level) else None)
        weight += 1
    return total


def score_slices(query, least, bits, slices):
    """(bit slices of the scores, constant): a row's score is its sum of slices plus the constant."""
    constant, chosen = 0, {}
    base = np.cumsum(bits) - bits
    for d, q in enumerate(query[:len(bits)]):
        q = int(q)
        constant += q * int(least[d])
        if q < 0:  # add the complement of the attribute, which counts down
            constant += q * ((1 << int(bits[d])) - 1)
        for shift in range(abs(q).bit_length()):
            if abs(q) >> shift & 1:
                for bit in range(bits[d]):
                    chosen.setdefault(shift + bit, []).append((base[d] + bit, q < 0))
    by_weight = []
    for weight in range(max(chosen, default=-1) + 1):
        picked = chosen.get(weight, [])
        rows = np.array([r for r, _ in picked], np.int64)
        flip = np.where([f for _, f in picked], ALL, np.uint64(0)).astype(np.uint64)
        by_weight.append(slices[rows] ^ flip[:, None])
    return add_slices(by_weight), constant


def _positions(bitmap):
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(sums, candidates, k):
    """Rows with the ``k`` highest sums among the bitmap ``candidates``; ties go to earlier rows."""
    sure, edge = np.zeros_like(candidates), candidates
    n_sure = 0
    for bitmap in reversed(sums):
        if bitmap is None:
            continue
        more = edge & bitmap
        n = n_sure + int(np.bitwise_count(more).sum())
        if n > k:
            edge = more
        else:
            sure, n_sure, edge = sure | more, n, edge & ~bitmap
        if n == k:
            edge = np.zeros_like(edge)
            break
    return np.concatenate([_positions(sure), _positions(edge)[:k - n_sure]])


def _score_of(sums, constant, row):
    word, bit = row >> 6, np.uint64(row & 63)
    return constant + sum(1 << w for w, s in enumerate(sums) if s is not None and s[word] >> bit & np.uint64(1))


def search_block(numbers, ids, least, bits, slices, queries, k):
    """Top ``k`` of a block for each query (row, id, vector): (query's row, query id, row, id, score). The block's rows
    are ordered by id, then row; a query does not meet its own row."""
    valid = np.zeros(slices.shape[1] * 64 if len(slices) else -(-len(ids) // 64) * 64, np.uint8)
    valid[:len(ids)] = 1
    valid = np.packbits(valid, bitorder="little").view(np.uint64)
    for query_row, query_id, query in queries:
        sums, constant = score_slices(query, least, bits, slices)
        candidates = valid
        same = slice(np.searchsorted(ids, query_id), np.searchsorted(ids, query_id, "right"))
        own = np.flatnonzero(numbers[same] == query_row) + same.start
        if len(own):
            candidates = valid.copy()
            candidates[own[0] >> 6] &= ~(np.uint64(1) << np.uint64(own[0] & 63))
        for row in top_rows(sums, candidates, k).tolist():
            score = _score_of(sums, constant, row)
            yield query_row, query_id, int(numbers[row]), int(ids[row]), max(-2 ** 63, min(2 ** 63 - 1, score))


def _search(k):
    """Build the slices of the block that a task holds, then search them for the queries that stream past."""
    def run(batches):
        last = None
        for held, asked in meetings(batches, "block", "part"):
            if held is not last:
                last, numbers, ids = held, held.column("row").to_numpy(), held.column("vec_id").to_numpy()
                order = np.lexsort((numbers, ids))
                numbers, ids = numbers[order], ids[order]
                index = build_slices(matrix(held.column("v"), dtype=np.int64)[order])
            queries = zip(*(asked.column(c).to_pylist() for c in ("row", "vec_id", "v")))
            found = list(search_block(numbers, ids, *index, queries, k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*found) if found else ((),) * 5)],
                names=["query", "query_id", "row", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k=5, block_rows=None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query with all other rows.

    Both frames are stored ``quantised`` rows; each row of ``queries`` is a query of its own, which meets every row but itself. Rows
    are dealt to blocks evenly, each block is held by one task and all queries stream past it; only the
    best ``k`` of a block are passed on. Ties go to the smaller id, then row. Vectors of different lengths are
    filled up with zeros. Scores beyond a long are cut to its range. With one row or none there is no result.
    """
    count = vectors.count()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_rows = block_rows or min(BLOCK_ROWS, max(LEAST_ROWS, -(-count // tasks)))
    blocks = max(1, -(-count // block_rows))
    columns = ["block", F.lit(0).alias("part"), "row", "vec_id", "v"]
    held = vectors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).select(columns)
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))
    asked = queries.withColumn("block", everywhere).select(columns)
    found = meet(held, asked, "block", "part", blocks).mapInArrow(
        _search(k), "query long, query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def top_k_of_table(embeddings: DataFrame, every=50, k=5) -> DataFrame:
    """``top_k`` with the rows whose id is divisible by ``every`` as queries.

    Rows that repeat an id, or are equal, are queries and candidates of their own. Rows without an id, NULL vectors and those with a
    NULL or non-finite component take no part; empty vectors score zero. An empty table, or one without queries, gives no
    rows. Other columns are ignored, whatever their names.
    """
    vectors = store(quantised(embeddings))
    return top_k(vectors, vectors.filter(F.col("vec_id") % every == 0), k)
