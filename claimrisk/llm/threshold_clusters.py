"""Centroid clustering whose nearest centroids are found by the threshold algorithm.

Each dimension has its centroids in a list sorted by value. A vector walks every list outward from its own
value; a centroid that turns up in any list gets its exact distance. No centroid that has not turned up yet can be
nearer than the sum of the squared distances at the frontiers of all lists, so the walk ends when that sum
strictly exceeds the best exact distance. All arithmetic is on integers.
"""

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.llm.vectors import clipped, floors, largest, matrix, usable
from claimrisk.session import store

# Vectors that walk the lists together; bounds the memory of a task.
WALK_ROWS = 1024
# Sums travel in pieces of this many bits, so that sums of any size add up as longs.
PIECE_BITS = 40


def nearest(x, centroids):
    """(number of the nearest centroid, squared distance) of each row of ``x``, ties to the smaller number.

    Both are matrices of integers, with at least one centroid.
    """
    width, reach = x.shape[1], largest(x) + largest(centroids)
    # A sum of squares that may not fit 64 bits is taken in Python's integers.
    kind = np.int64 if width * reach * reach < 2 ** 62 else object
    x, centroids = x.astype(kind), centroids.astype(kind)
    best, distance = np.empty(len(x), np.int64), np.empty(len(x), kind)
    for first in range(0, len(x), WALK_ROWS):
        part = slice(first, first + WALK_ROWS)
        best[part], distance[part] = _walk(x[part], centroids, reach + 1)
    return best, distance


def _walk(x, centroids, beyond):
    """``nearest`` for a few rows; ``beyond`` is farther than any centroid in any dimension."""
    (k, width), dims = centroids.shape, np.arange(x.shape[1])
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    left = np.empty(x.shape, np.int64)
    for d in range(width):
        left[:, d] = np.searchsorted(lists[:, d], x[:, d]) - 1
    right = left + 1
    best, distance = np.full(len(x), -1), np.zeros(len(x), x.dtype)
    seen = np.zeros((len(x), k), bool)
    walking = np.arange(len(x))
    while len(walking):
        at, down, up = x[walking], left[walking], right[walking]
        below = np.where(down >= 0, at - lists[np.maximum(down, 0), dims], beyond)
        above = np.where(up < k, lists[np.minimum(up, k - 1), dims] - at, beyond)
        lower = below <= above
        frontier = np.where(lower, below, above)
        turned_up = order[np.clip(np.where(lower, down, up), 0, k - 1), dims]
        left[walking] -= lower
        right[walking] += ~lower
        now = np.zeros((len(walking), k), bool)
        now[np.arange(len(walking))[:, None], turned_up] = True
        now &= ~seen[walking]
        seen[walking] |= now
        for number in np.flatnonzero(now.any(0)):
            rows = walking[now[:, number]]
            away = x[rows] - centroids[number]
            exact = (away * away).sum(1)
            better = (best[rows] < 0) | (exact < distance[rows]) | ((exact == distance[rows]) & (number < best[rows]))
            best[rows[better]], distance[rows[better]] = number, exact[better]
        done = ((frontier * frontier).sum(1) > distance[walking]) | seen[walking].all(1)
        walking = walking[~done.astype(bool)]
    return best, distance


def _pieces(number):
    """(place, piece) pairs of an integer: it is the sum of piece * 2^(PIECE_BITS * place)."""
    sign, rest, place = (-1 if number < 0 else 1), abs(int(number)), 0
    while rest:
        yield place, sign * (rest & ((1 << PIECE_BITS) - 1))
        rest >>= PIECE_BITS
        place += 1


def _totals(centroids, scale):
    """A task's number of vectors and sums of components per cluster; dimension -1 holds the numbers."""
    def run(batches):
        k, width = centroids.shape
        sums, counts = np.zeros((k, width), object), [0] * k
        for batch in batches:
            x = floors(matrix(batch.column(0), width), scale)
            number, _ = nearest(x, centroids)
            for cluster in np.unique(number).tolist():
                mine = x[number == cluster]
                # Halves of the bits, so that the sum of a batch can't leave 64 bits.
                high = mine >> 26
                sums[cluster] += high.sum(0).astype(object) * (1 << 26) + (mine - (high << 26)).sum(0).astype(object)
                counts[cluster] += len(mine)
        found = [(c, d, place, piece) for c in range(k) if counts[c]
                 for d, total in [(-1, counts[c]), *enumerate(sums[c])] for place, piece in _pieces(total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in
             zip(zip(*found) if found else ((),) * 4, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            names=["cluster", "dim", "place", "piece"])
    return run


def starting_vectors(vectors: DataFrame, k: int, salt: str) -> list:
    """The ``x`` of the ``k`` rows with the smallest SHA-256 of ``salt:vec_id``; rows without an id don't start.

    Only rows under a bound on the hash are sorted, about 8 k of them; the bound rises until there are enough.
    """
    named = vectors.filter("vec_id is not null")
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows, share = named.count(), 8 * k
    while True:
        bound = 0x100000000 * share // max(rows, 1)
        low = named.withColumn("digest", digest)
        if bound < 0x100000000:
            low = low.filter(F.col("digest") < F.lit(f"{bound:08x}"))
        found = low.orderBy("digest", "x").select("x").limit(k).collect()
        if len(found) == k or bound >= 0x100000000:
            return [row.x for row in found]
        share *= 8


def _moved(vectors: DataFrame, centroids, scale):
    """The centroids after one round: componentwise floors of the means, empty clusters as they were."""
    parts = vectors.select("x").mapInArrow(_totals(centroids, scale), "cluster int, dim int, place int, piece long")
    # k * (dimensions + 1) sums, whatever the number of vectors.
    totals = {}
    for row in parts.groupBy("cluster", "dim", "place").agg(F.sum("piece").alias("piece")).collect():
        key = row.cluster, row.dim
        totals[key] = totals.get(key, 0) + (row.piece << (PIECE_BITS * row.place))
    moved = centroids.astype(object)
    for cluster in range(len(moved)):
        n = totals.get((cluster, -1), 0)
        if n:
            moved[cluster] = [totals.get((cluster, d), 0) // n for d in range(moved.shape[1])]
    return moved


def _assigned(centroids, scale):
    def run(batches):
        for batch in batches:
            number, distance = nearest(floors(matrix(batch.column(1), centroids.shape[1]), scale), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number, pa.int32()), pa.array(clipped(distance), pa.int64())],
                names=["vec_id", "cluster", "distance"])
    return run


def cluster(table: DataFrame, width=64, k=8, rounds=10, scale=1024, salt="3") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every vector of ``width`` finite
    components, quantised to floor(scale * x).

    The ``k`` starting centroids are the vectors with the smallest SHA-256 of ``salt:vec_id`` (of rows that repeat an
    id, those with the smaller vectors first); there are fewer if the table has fewer such rows. Each of ``rounds``
    rounds assigns all vectors and moves the centroids; then vectors are assigned once more. Each round reads
    the stored vectors once and brings k * (width + 1) sums to the driver; the centroids go to the tasks.

    NULL vectors, vectors of another length (empty ones too) and those with a NULL or non-finite component are left
    out. Rows that repeat an id, or have none, are vectors like any other; those without can't start a cluster.
    Ties go to the smaller cluster number. Distances and sums beyond a long are cut to its range. No usable vector,
    or none with an id, gives no rows. Other columns are ignored.
    """
    spark = table.sparkSession
    vectors = store(usable(table, width=width).select("vec_id", "x"))
    started = starting_vectors(vectors, k, salt)
    schema = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
              "centroid_sha256 string")
    if not started:
        return spark.createDataFrame([], schema)
    centroids = floors(np.array(started, np.float64).reshape(len(started), width), scale)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids, scale)
    found = store(vectors.select("vec_id", "x").mapInArrow(
        _assigned(centroids, scale), "vec_id long, cluster int, distance long"))
    sums = {row.cluster: int(row.total) for row in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    everything = clipped([sum(sums.values())])[0]
    lines = [(number, *clipped([total]), everything,
              sha256(",".join(str(int(c)) for c in centroids[number]).encode()).hexdigest())
             for number, total in sums.items()]
    about = spark.createDataFrame(
        lines, "number int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), found["cluster"] == about["number"]).drop("number")


def oracle_sql(width=64, k=8, rounds=10, scale=1024, salt="3") -> str:
    """The same clusters in plain SQL: all distances of all vectors, one step per round."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::HUGEINT) AS v FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, unnest(range({width})) AS d, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT number, unnest(range({width})) AS d, unnest(v) AS c FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('{salt}:' || vec_id), v) - 1 AS number FROM kept
    WHERE vec_id IS NOT NULL) WHERE number < {k})"""]
    for step in range(rounds + 1):
        steps.append(f"""
a{step} AS MATERIALIZED (
  SELECT r, min({{'distance': distance, 'number': number}}) AS best FROM (
    SELECT r, number, sum((x - c) * (x - c))::HUGEINT AS distance FROM parts JOIN c{step} USING (d) GROUP BY r, number)
  GROUP BY r)""")
        if step < rounds:
            steps.append(f"""
c{step + 1} AS MATERIALIZED (
  SELECT number, d, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM c{step} LEFT JOIN (
    SELECT best.number AS number, d, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
    FROM a{step} JOIN parts USING (r) GROUP BY ALL) USING (number, d))""")
    return ",".join(steps) + f"""
SELECT vec_id, best.number::INTEGER AS cluster, best.distance::BIGINT AS distance,
       (sum(best.distance) OVER (PARTITION BY best.number))::BIGINT AS cluster_inertia,
       (sum(best.distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN (
  SELECT number, sha256(string_agg(c::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY number) h
ON h.number = best.number"""
