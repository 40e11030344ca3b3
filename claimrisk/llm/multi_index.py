"""Approximate nearest neighbours by cosine on an inverted multi-index.

Vectors are scaled to length one and cut in two halves, each quantised by a codebook of its own; a cell of the index is a
pair of centroids. A query takes the pairs in order of their summed distances with a heap. It first takes
enough cells to rank some entries exactly; their k-th distance, and how much farther the cells of true neighbours
lie than the neighbours themselves (learned from a sample), then say how far it has to go. No number of
cells or candidates is fixed: in data without clusters a query goes through much of the index, in clustered data through little.
"""

from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimrisk.llm.vectors import matrix, meet, meetings, usable
from claimrisk.session import store

# The sample that codebooks and slack are fitted on: rows and components, at most.
SAMPLE_ROWS = 20_000
SAMPLE_VALUES = 2_000_000
# Entries that a cell should hold on average, and centroids of a codebook at most: a million cells' counts go to the tasks.
CELL_ROWS = 32
MOST_CENTROIDS = 512
# Entries whose cells a query takes before it knows how far to go; it changes the work and, slightly, the recall.
FIRST_ROWS = 256
# Share of the sample's true neighbours whose cells lie within the slack.
CONFIDENCE = 0.98
# Components of the entries that a task holds; a larger region of the index is split.
REGION_VALUES = 2 ** 21


def units(x):
    """Rows scaled to length one. They are scaled by a power of two first, so that no square overflows."""
    exponent = np.frexp(np.abs(x).max(axis=1, initial=0.0))[1]
    x = np.ldexp(x, -exponent[:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosines(x, y):
    """Cosine of each row of ``x`` with the vector ``y`` in doubles: equal rows get equal values wherever they stand."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])
    y = np.ldexp(y, -np.frexp(np.abs(y).max(initial=0.0))[1])
    return np.clip((x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum())), -1.0, 1.0)


def squares(x, centroids):
    """Squared distances of rows to centroids."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1), 0.0)


def codebook(points, k, rounds=10, seed=7):
    """``k`` centroids of the rows of ``points`` by Lloyd's rounds; fewer if there are fewer different rows."""
    if not points.shape[1]:
        return np.zeros((1, 0))
    different = np.unique(points, axis=0)
    centroids = different[np.random.default_rng(seed).permutation(len(different))[:k]].copy()
    for _ in range(rounds):
        number = squares(points, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, number, points)
        count = np.bincount(number, minlength=len(centroids))
        centroids[count > 0] = sums[count > 0] / count[count > 0, None]
    return centroids


class Codebooks(NamedTuple):
    """Centroids of both halves, and the slack: how much farther (in squares) cells lie than the neighbours in them."""

    first: np.ndarray
    second: np.ndarray
    width: int
    slack: float

    def halves(self, x):
        """Squared distances of rows of length one to the centroids of either half."""
        cut = self.width // 2
        return squares(x[:, :cut], self.first), squares(x[:, cut:], self.second)


def fit(sample, k, centroids, confidence=CONFIDENCE, asked=400) -> Codebooks:
    """Codebooks of ``centroids`` each, and the slack from the ``k`` nearest rows of ``asked`` rows, all within the sample."""
    x = units(sample)
    cut = x.shape[1] // 2
    books = Codebooks(codebook(x[:, :cut], centroids), codebook(x[:, cut:], centroids), x.shape[1], 0.0)
    near_first, near_second = (d.argmin(1) for d in books.halves(x))
    beyond = []
    for row in range(min(asked, len(x) - 1)):
        away = ((x - x[row]) ** 2).sum(1)
        away[row] = np.inf
        best = np.argsort(away, kind="stable")[:min(k, len(x) - 1)]
        first, second = (d[0] for d in books.halves(x[row:row + 1]))
        beyond.append(first[near_first[best]] + second[near_second[best]] - away[best])
    slack = float(np.quantile(np.concatenate(beyond), confidence)) if beyond else np.inf
    return books._replace(slack=max(slack, 0.0))


def cells_in_order(first, second):
    """(sum, number of the first, number of the second centroid) by growing sum of two lists of distances."""
    order_first, order_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[order_first].tolist(), second[order_second].tolist()
    order_first, order_second = order_first.tolist(), order_second.tolist()
    heap = [(a[0] + b[0], 0, 0)]
    while heap:
        total, i, j = heappop(heap)
        yield total, order_first[i], order_second[j]
        if j + 1 < len(b):
            heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if not j and i + 1 < len(a):
            heappush(heap, (a[i + 1] + b[0], i + 1, 0))


def _quantised(books):
    def run(batches):
        for batch in batches:
            x = units(matrix(batch.column(2), books.width))
            first, second = books.halves(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first.argmin(1), pa.int32()), pa.array(second.argmin(1), pa.int32())],
                names=["row", "vec_id", "x", "first", "second"])
    return run


def _probes(books, counts, least):
    """(row, first centroid, second centroids, cells taken) of the cells that each query takes.

    A query without ``limit`` takes cells until they hold ``least`` entries. One with a limit goes on from where it was
    (``taken``) to the last cell whose summed distance is within the limit.
    """
    def cells(first, second, limit, taken):
        entries, number, lists = 0, 0, {}
        for total, i, j in cells_in_order(first, second):
            if (total > limit) if limit is not None else (entries >= least):
                break
            number += 1
            if number > taken and counts[i, j]:
                entries += counts[i, j]
                lists.setdefault(i, []).append(j)
        return number, lists

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                halves = books.halves(units(matrix(part.column(1), books.width)))
                found = []
                for row, first, second, limit, taken in zip(
                        part.column(0).to_pylist(), *halves, part.column(2).to_pylist(), part.column(3).to_pylist()):
                    number, lists = cells(first, second, limit, taken)
                    found += [(row, i, seconds, number) for i, seconds in lists.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*found) if found else ((),) * 4, (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int64()))],
                    names=["row", "first", "seconds", "taken"])
    return run


def _ranked(books, k):
    """The ``k`` nearest entries of a part of a region for each query that takes cells of it."""
    def run(batches):
        last = None
        for held, asked in meetings(batches, "unit", "part"):
            if held is not last:
                last, raw = held, matrix(held.column("x"), books.width)
                x, second = units(raw), held.column("seconds").combine_chunks().flatten().to_numpy()
                numbers, ids = held.column("row").to_numpy(), held.column("vec_id").to_numpy()
            taken = np.zeros(len(books.second), bool)
            own = matrix(asked.column("x"), books.width)
            found = []
            for query, vector, unit, seconds in zip(
                    asked.column("row").to_pylist(), own, units(own), asked.column("seconds").to_pylist()):
                taken[:] = False
                taken[seconds] = True
                rows = np.flatnonzero(taken[second] & (numbers != query))
                if not len(rows):
                    continue
                near = x[rows] @ unit
                # Entries that can be among the k nearest, whatever the rounding; then the measure itself.
                rows = rows[near >= np.partition(near, -min(k, len(near)))[-min(k, len(near))] - 1e-9]
                best = sorted(zip((-cosines(raw[rows], vector)).tolist(), ids[rows].tolist(), numbers[rows].tolist()))
                found += [(query, number, vec_id, -score) for score, vec_id, number in best[:k]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*found) if found else ((),) * 4, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                names=["query", "row", "vec_id", "score"])
    return run


def _best(found: DataFrame, k) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def fitted(vectors: DataFrame, k, confidence=CONFIDENCE, cell_rows=CELL_ROWS) -> Codebooks | None:
    """``fit`` on a sample of stored ``row, x``: rows drawn by a hash of their number. None without vectors."""
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    if not size.n:
        return None
    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // size.width))
    bound = min(1 << 30, (wanted << 30) // size.n + 1)
    drawn = vectors.filter(F.pmod(F.xxhash64("row", F.lit(9)), F.lit(1 << 30)) < bound).orderBy("row").limit(wanted)
    sample = matrix(drawn.select("x").toArrow().column(0), size.width)
    if not len(sample):  # a hash may leave out all of a few rows
        sample = matrix(vectors.select("x").limit(1).toArrow().column(0), size.width)
    centroids = int(min(MOST_CENTROIDS, max(1, (size.n / cell_rows) ** 0.5)))
    return fit(sample, k, centroids, confidence)


def search(table: DataFrame, every=50, k=5, confidence=CONFIDENCE, cell_rows=CELL_ROWS, first_rows=FIRST_ROWS,
           region_rows=None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found of each row whose id is divisible by ``every``, by cosine.

    All rows are indexed and a query meets every row but itself; ``score`` is the cosine of the original vectors in doubles. Ties
    go to the smaller id, then row. ``confidence`` sets the recall that is aimed at (0.98 for 0.98 of the neighbours, as the sample has them).

    Rows without an id, and vectors that are NULL, empty, zero or hold NULL or a non-finite component, take no part. Rows that
    repeat an id are queries and candidates of their own. Shorter vectors are filled up with zeros. Fewer than ``k`` other rows are
    all returned; no usable row, or no query, gives no rows. Other columns are ignored.

    The index is dealt to regions by the first centroid, large regions to parts; queries go only to regions of which they take cells, with the
    list of these cells, and stream past the entries. The driver holds the sample and the counts of the cells.
    """
    spark = table.sparkSession
    vectors = store(usable(table.filter(F.col("vec_id").isNotNull())).filter(F.exists("x", lambda c: c != 0)))
    books = fitted(vectors, k, confidence, cell_rows)
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = store(vectors.mapInArrow(
        _quantised(books), "row long, vec_id long, x array<double>, first int, second int"))
    counts = np.zeros((len(books.first), len(books.second)), np.int64)
    for cell in index.groupBy("first", "second").agg(F.count("*").alias("n")).collect():  # MOST_CENTROIDS squared at most
        counts[cell.first, cell.second] = cell.n
    region_rows = region_rows or max(1, REGION_VALUES // books.width)
    parts = np.maximum(1, -(-counts.sum(1) // region_rows))
    starts = (np.cumsum(parts) - parts).tolist()
    regions = F.broadcast(spark.createDataFrame(
        list(zip(range(len(parts)), starts, parts.tolist())), "first int, start long, parts long"))
    columns = ["unit", "part", "row", "vec_id", "seconds", "x"]
    held = index.join(regions, "first").select(
        (F.col("start") + F.pmod(F.xxhash64("row"), "parts")).alias("unit"), F.lit(0).alias("part"), "row", "vec_id",
        F.array("second").alias("seconds"), "x")
    queries = store(index.filter(F.col("vec_id") % every == 0).select("row", "vec_id", "x"))

    def found(asked):
        """(best entries of the cells that queries take, cells taken): ``asked`` has ``row, x, limit, taken``."""
        probes = store(asked.select("row", "x", "limit", "taken").mapInArrow(
            _probes(books, counts, max(first_rows, 4 * (k + 1))), "row long, first int, seconds array<int>, taken long"))
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
        sent = probes.join(queries, "row").join(regions, "first").withColumn("number", part).select(
            (F.col("start") + F.col("number")).alias("unit"), F.lit(0).alias("part"), "row", "vec_id", "seconds", "x")
        met = meet(held.select(columns), sent.select(columns), "unit", "part", int(parts.sum()))
        best = store(_best(met.mapInArrow(_ranked(books, k), "query long, row long, vec_id long, score double"), k))
        return best, probes.groupBy(F.col("row").alias("query")).agg(F.max("taken").alias("taken"))

    nearby, taken = found(queries.select(
        "*", F.lit(None).cast("double").alias("limit"), F.lit(0).cast("long").alias("taken")))
    # Of vectors of length one the squared distance is 2 - 2 * cosine. With fewer than k found, all cells are taken.
    reached = nearby.groupBy("query").agg(F.min("score").alias("score"), F.count("*").alias("n"))
    limit = F.when(F.col("n") < k, float("inf")).otherwise(2 - 2 * F.col("score") + books.slack)
    asked = queries.join(taken, queries["row"] == taken["query"], "left").drop("query").join(
        reached, queries["row"] == reached["query"], "left").select(
        "row", "x", F.coalesce(limit, F.lit(float("inf"))).alias("limit"), F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    farther, _ = found(asked)
    nearest = _best(nearby.drop("rank").unionByName(farther.drop("rank")), k)
    named = queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return nearest.join(named, "query").select("query_id", "rank", "vec_id", "score")
