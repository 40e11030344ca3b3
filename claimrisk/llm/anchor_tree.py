"""Hard negatives by bounds along a spanning tree of the anchors.

Anchors that are alike make groups with a minimum spanning tree each. Against a block of candidates only the root
of a tree is scored in full. From a parent to its child a candidate's score moves by no more than the length of
the tree's edge times the candidate's norm, so scores (or bounds) at the parent bound the scores at the child.
Only candidates whose bounds overlap the window of scores that is searched are scored again.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimrisk.llm.vectors import clipped, floors, largest, matrix, meet, meetings, usable
from claimrisk.session import store

SCALE = 256
# Components of the candidates that a task holds, and rows that a block has at least (but for small tables).
BLOCK_VALUES = 2 ** 21
LEAST_ROWS = 1024
# Anchors of a tree, about, and anchors that are drawn as middles of the groups, at most.
TREE_ROWS = 128
PIVOTS = 256
LABEL_SLOTS = 64


def spanning_tree(points):
    """(order, parent, edge): Prim's minimum spanning tree from row 0; a parent comes before its children. ``edge`` is
    the distance to the parent, rounded up; the root has none."""
    n = len(points)
    parent, near = np.zeros(n, np.int64), np.full(n, np.inf)
    open_, order, at = np.ones(n, bool), [], 0
    for _ in range(n):
        order.append(at)
        open_[at] = False
        away = ((points - points[at]) ** 2).sum(1)
        closer = open_ & (away < near)
        near[closer], parent[closer] = away[closer], at
        at = int(np.where(open_, near, np.inf).argmin())
    edge = np.sqrt(np.where(np.isfinite(near), near, 0.0)) * (1 + 1e-9)
    return order, parent, edge


def _least_of_best(values, k):
    """The ``k``-th largest, or the smallest if there are fewer; None without any."""
    if not len(values):
        return None
    k = min(k, len(values))
    return sorted(values, reverse=True)[k - 1] if values.dtype == object else np.partition(values, -k)[-k]


def tree_scores(anchors, candidates, wanted):
    """Walk the spanning tree of ``anchors`` (matrix of integers) and score ``candidates`` (likewise).

    ``wanted(anchor, low, high)`` says which candidates must be scored for an anchor, given bounds of all
    scores. Yields (anchor, numbers of the scored candidates, their scores, all bounds); a root is scored in full.
    """
    top = max(largest(anchors), largest(candidates))
    if 4 * candidates.shape[1] * top * top >= 2 ** 53:  # not exact in doubles: all are scored in Python's integers
        candidates, everything = candidates.astype(object), np.arange(len(candidates))
        for anchor in range(len(anchors)):
            yield anchor, everything, np.array(clipped(candidates @ anchors[anchor].astype(object)), object)
        return
    anchors, candidates = anchors.astype(np.float64), candidates.astype(np.float64)
    norms = np.sqrt((candidates * candidates).sum(1)) * (1 + 1e-9)
    order, parent, edge = spanning_tree(anchors)
    waiting = np.bincount(parent[order[1:]], minlength=len(anchors))
    bounds = {}
    for anchor in order:
        if anchor == order[0]:
            scores = candidates @ anchors[anchor]
            low, high, rows = scores, scores, np.arange(len(candidates))
        else:
            above = int(parent[anchor])
            low, high = bounds[above]
            waiting[above] -= 1
            if not waiting[above]:
                del bounds[above]
            slack = edge[anchor] * norms
            low, high = low - slack, high + slack
            rows = np.flatnonzero(wanted(anchor, low, high))
            # Scoring most rows is cheaper without picking them.
            few = len(rows) * 2 < len(candidates)
            scores = candidates[rows] @ anchors[anchor] if few else (candidates @ anchors[anchor])[rows]
            low[rows] = high[rows] = scores
        if waiting[anchor]:
            bounds[anchor] = low, high
        yield anchor, rows, scores


def _best(rows, scores, ids, numbers, k):
    """The ``k`` of ``rows`` with the highest scores, ties by id, then by number of the row."""
    edge = _least_of_best(scores, k)
    if edge is None:
        return []
    high = scores >= edge
    found = zip((-s for s in scores[high].tolist()), ids[rows[high]].tolist(), numbers[rows[high]].tolist())
    return [(number, vec_id, int(-score)) for score, vec_id, number in sorted(found)[:k]]


class Block:
    """Candidates of a block as arrays; ``table`` has ``row, vec_id, label, x``."""

    def __init__(self, table, width, scale):
        self.numbers, self.ids, self.labels = (table.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.vectors = floors(matrix(table.column("x"), width), scale)


def positives_in_block(block, anchors, k):
    """(anchor's row, row, vec_id, score): the ``k`` best other rows of each anchor's label in a block."""
    own = [(block.labels == label) & (block.numbers != number) for label, number in zip(anchors.labels, anchors.numbers)]

    def wanted(anchor, low, high):
        # The k-th largest lower bound is surely reached by k candidates.
        least = _least_of_best(low[own[anchor]], k)
        return own[anchor] & (high >= least) if least is not None else own[anchor]

    for anchor, rows, scores in tree_scores(anchors.vectors, block.vectors, wanted):
        mine = own[anchor][rows]
        for found in _best(rows[mine], scores[mine], block.ids, block.numbers, k):
            yield int(anchors.numbers[anchor]), *found


def negatives_in_block(block, anchors, positives, k, low_percent, high_percent):
    """(anchor's row, number of the positive, row, vec_id, score): for each of an anchor's ``positives`` (lists of
    scores) the ``k`` best rows of other labels in its window, in a block."""
    windows = [[(-(-low_percent * s // 100), high_percent * s // 100) for s in scores] for scores in positives]
    other = [block.labels != label for label in anchors.labels]

    def wanted(anchor, low, high):
        out = np.zeros(len(low), bool)
        for least, most in windows[anchor]:
            meets = other[anchor] & (high >= least) & (low <= most)
            inside = low[meets & (low >= least) & (high <= most)]
            if len(inside) >= k:  # k candidates surely reach this
                meets &= high >= _least_of_best(inside, k)
            out |= meets
        return out

    for anchor, rows, scores in tree_scores(anchors.vectors, block.vectors, wanted):
        mine = other[anchor][rows]
        rows, scores = rows[mine], scores[mine]
        for number, (least, most) in enumerate(windows[anchor]):
            fit = (scores >= least) & (scores <= most)
            for found in _best(rows[fit], scores[fit], block.ids, block.numbers, k):
                yield int(anchors.numbers[anchor]), number, *found


def _in_blocks(work, width, scale, names):
    """A ``mapInArrow`` function: ``work(block, anchors, asked rows)`` for each meeting of a block and a group."""
    def run(batches):
        last, block = None, None
        for held, asked in meetings(batches, "block", "tree", asked_rows=4 * TREE_ROWS):
            if held is not last:
                last, block = held, Block(held, width, scale)
            found = list(work(block, Block(asked, width, scale), asked))
            columns = list(zip(*found)) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
    return run


def _trees(anchors: DataFrame, width, scale) -> DataFrame:
    """``anchors`` with ``tree``: anchors of like labels and the same nearest pivot, dealt to trees of about TREE_ROWS.

    The pivots are no more than PIVOTS anchors, drawn by a hash of their row. How anchors are grouped changes the work, not the result.
    """
    count = anchors.count()
    share = min(1.0, 2 * PIVOTS / max(count, 1))
    drawn = anchors.filter(F.pmod(F.xxhash64("row", F.lit(5)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))
    pivots = matrix(drawn.select("x").limit(max(1, min(PIVOTS, -(-count // TREE_ROWS)))).toArrow().column(0), width)

    def nearest(batches):
        for batch in batches:
            x = matrix(batch.column(1), width)
            with np.errstate(over="ignore", invalid="ignore"):
                score = (pivots * pivots).sum(1) - 2 * x @ pivots.T if len(pivots) else np.zeros((len(x), 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.nan_to_num(score).argmin(1), pa.int64())], names=["row", "pivot"])

    near = anchors.select("row", "x").mapInArrow(nearest, "row long, pivot long")
    key = F.pmod(F.xxhash64("label"), F.lit(LABEL_SLOTS)) * PIVOTS + F.col("pivot")
    keyed = store(anchors.join(near, "row").withColumn("key", key))
    # PIVOTS * LABEL_SLOTS keys at most.
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("row", F.lit(6)), F.ceil(F.col("n") / TREE_ROWS))
    return keyed.join(F.broadcast(sizes), "key").withColumn("tree", F.col("key") * (1 << 32) + part).drop("key", "n", "pivot")


def mine(rows: DataFrame, every=50, positives=5, k=3, low_percent=50, high_percent=95, scale=SCALE,
         block_rows=None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of ``vec_id, embedding,
    label`` whose id is divisible by ``every`` as anchors.

    A row's score is its inner product with the anchor, both quantised to floor(scale * x); higher scores come first, ties by id,
    then by row. An anchor's positives are the first ``positives`` other rows of its label. Negatives of a positive with
    score s are the first ``k`` rows of other labels with scores from low_percent to high_percent per cent of s; s below zero has none.

    Rows without an id or a label, and vectors that are NULL or hold NULL or a non-finite component, take no part. Rows that
    repeat an id are anchors and candidates of their own. Shorter vectors (empty ones too) are filled up with zeros. Scores beyond a
    long are cut to its range before they are compared. An empty table, or one without anchors, gives no rows. Other columns are ignored.

    Candidates are dealt evenly to blocks; all anchors stream past each block in trees, whose best ``positives`` (then ``k``) rows of the
    block are all that leaves a task. Rows shuffled: candidates and, per block, anchors, twice.
    """
    table = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    vectors = store(usable(table, F.col("label").cast("long").alias("label")))
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    width, n = size.width or 0, size.n
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_rows = block_rows or max(1, min(BLOCK_VALUES // max(width, 1), max(LEAST_ROWS, -(-n // tasks))))
    blocks = max(1, -(-n // block_rows))
    nothing = F.array().cast("array<long>")
    candidates = vectors.select(
        F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.lit(0).cast("long").alias("tree"),
        "row", "vec_id", "label", "x", nothing.alias("scores"))
    anchors = store(_trees(vectors.filter(F.col("vec_id") % every == 0), width, scale))

    def meeting(asked):
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block")
        return meet(candidates, asked.select(everywhere, "tree", "row", "vec_id", "label", "x", "scores"),
                    "block", "tree", blocks)

    found = meeting(anchors.withColumn("scores", nothing)).mapInArrow(
        _in_blocks(lambda block, group, asked: positives_in_block(block, group, positives), width, scale,
                   ["anchor", "row", "vec_id", "score"]), "anchor long, row long, vec_id long, score long")
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row")
    best = found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
    best = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best"))
    asked = store(anchors.join(best, anchors["row"] == best["anchor"]).drop("anchor").withColumn(
        "scores", F.col("best.score")))

    def negatives(block, group, table):
        return negatives_in_block(block, group, table.column("scores").to_pylist(), k, low_percent, high_percent)

    met = meeting(asked).mapInArrow(
        _in_blocks(negatives, width, scale, ["anchor", "place", "row", "vec_id", "score"]),
        "anchor long, place long, row long, vec_id long, score long")
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "row")
    chosen = met.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    named = asked.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"), "best")
    positive = F.get("best", F.col("place").cast("int"))
    return chosen.join(named, chosen["anchor"] == named["anchor_row"]).select(
        "anchor_id", positive["vec_id"].alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))


ORACLE_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.r AS a_r, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same,
         coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])), 0)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.r <> c.r),
p AS (
  SELECT *, row_number() OVER (PARTITION BY a_r ORDER BY score DESC, vec_id, r) AS place FROM s WHERE same
  QUALIFY place <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY p.a_r, p.place ORDER BY n.score DESC, n.vec_id, n.r))::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a_r = p.a_r AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""
