"""Second-order boosted trees (Chen and Guestrin, 2016) grown from histograms, one aggregate per tree level.

Inputs are replaced by numbers of quantile bins once. Rows that fit one task are grown there, whole trees at a time: the wait for
thousands of short jobs would take longer than the sums. Of more rows, a level of a tree needs the sums of gradients and curvatures per
(node, input, bin), which tasks add up over their rows and a shuffle by input over tasks. What finds the best cut of an input sees the sums of
all its bins; the driver gets three sums per node and input, picks among the inputs and never sees rows. Rows carry their bins, label, weight, and margin, gradient and
curvature from before the tree that grows.
"""

import pickle
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.session import store

# Training rows that a single task may hold, some 100 bytes each: up to so many, tasks grow whole trees. Above it a tenth of it is what a
# partition has, about, as long as there are no more partitions than cores: each one sends its sums at every level.
PARTITION_ROWS = 1_000_000
# Rows of a block at most, about: a task that adds up a level holds one block at a time.
BLOCK_ROWS = 50_000
# Trees after which the margins of all rows are checkpointed.
ADD_EVERY = 25
# As many where a task grows them in one go, which is when it hands over its rows.
TASK_TREES = 100
# The bin of a missing value.
MISSING = -1


class Tree(NamedTuple):
    """A tree as a heap: the children of node i are 2 i + 1 and 2 i + 2. A leaf has input -1. ``value`` is the leaf's
    margin, ``cover`` the curvature in the node, ``gain`` that of its split. ``cut`` is a bin: lower ones and itself go left."""

    input: np.ndarray
    cut: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray


def walk(tree, columns, limits, missing, depth):
    """The node that each row reaches within ``depth`` steps; ``columns`` is a matrix of bins or of values, ``limits`` the
    tree's cuts or thresholds, ``missing`` a matrix that marks missing values."""
    rows, at = np.arange(len(columns)), np.zeros(len(columns), np.int64)
    for _ in range(depth):
        number = tree.input[at]
        inner = number >= 0
        if not inner.any():
            break
        number = np.maximum(number, 0)
        right = np.where(missing[rows, number], ~tree.missing_left[at], columns[rows, number] > limits[at])
        at = np.where(inner, 2 * at + 1 + right, at)
    return at


class NewtonModel(NamedTuple):
    inputs: list
    trees: list
    depth: int

    def margins(self, values):
        """The log-odds of rows of input values; NaN is missing."""
        missing, out = np.isnan(values), np.zeros(len(values))
        for tree in self.trees:
            out += tree.value[walk(tree, values, tree.threshold, missing, self.depth)]
        return out

    def rows(self):
        """The nodes as rows (tree, id, input or NULL, threshold, missing_left, value, cover, gain)."""
        for number, tree in enumerate(self.trees):
            for node in np.flatnonzero(tree.cover > 0).tolist():
                leaf = tree.input[node] < 0
                yield (number, node, None if leaf else self.inputs[tree.input[node]], float(tree.threshold[node]),
                       bool(tree.missing_left[node]), float(tree.value[node]), float(tree.cover[node]), float(tree.gain[node]))

    def importance(self):
        """{input: mean gain of its splits}, as shares."""
        number = np.concatenate([t.input for t in self.trees]) if self.trees else np.zeros(0, np.int64)
        gain = np.concatenate([t.gain for t in self.trees]) if self.trees else np.zeros(0)
        mean = {name: float(gain[number == i].mean()) if (number == i).any() else 0.0 for i, name in enumerate(self.inputs)}
        total = sum(mean.values())
        return {name: share / total if total else 0.0 for name, share in mean.items()}


SAVED = ("tree int, id int, input string, threshold double, missing_left boolean, value double, cover double, gain double")


def save(spark: SparkSession, model: NewtonModel, path: str) -> None:
    head = [(-1, i, name, 0.0, False, 0.0, float(model.depth), 0.0) for i, name in enumerate(model.inputs)]
    spark.createDataFrame([*head, *model.rows()], SAVED).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> NewtonModel:
    rows = spark.read.schema(SAVED).parquet(path).orderBy("tree", "id").collect()
    head = [r for r in rows if r.tree < 0]
    inputs, depth = [r.input for r in head], int(head[0].cover)
    trees = []
    for row in rows[len(head):]:
        if row.tree == len(trees):
            trees.append(_empty(depth))
        tree = trees[row.tree]
        tree.input[row.id] = -1 if row.input is None else inputs.index(row.input)
        for name in ("threshold", "missing_left", "value", "cover", "gain"):
            getattr(tree, name)[row.id] = row[name]
    return NewtonModel(inputs, trees, depth)


def _empty(depth):
    size = 2 ** (depth + 1) - 1
    return Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size, bool), np.zeros(size),
                np.zeros(size), np.zeros(size))


def quantile_cuts(rows: DataFrame, inputs, max_bins=256, accuracy=10_000) -> list:
    """Ascending cut values of each input: the quantiles of a sketch, all values of an input with few."""
    shares = [(i + 1) / max_bins for i in range(max_bins)]
    found = rows.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), shares, accuracy).alias(f"c{i}")
                       for i, c in enumerate(inputs)]).first()
    return [np.unique(np.array(found[i] or [], float)) for i in range(len(inputs))]


def _binned(cuts):
    """``label, weight, margin`` and the inputs of a batch to those and bins: bin b holds values up to cut b, the last one those above."""
    def run(batches):
        for batch in batches:
            bins = []
            for i, cut in enumerate(cuts):
                values = batch.column(3 + i).to_numpy(zero_copy_only=False).astype(float)
                bins.append(np.where(np.isnan(values), MISSING, np.searchsorted(cut, values, side="left")).astype(np.int16))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *map(pa.array, bins)], names=["label", "weight", "margin", *[f"b{i}" for i in range(len(cuts))]])
    return run


def _packed(batches):
    """The batches of a partition as blocks, a row each: label, weight, margin, bins (inputs by rows) and whether any is missing, pickled."""
    def row(held):
        label, weight, margin, *bins = [np.concatenate(c) for c in zip(*held)]
        bins = np.stack(bins)
        block = label, weight, margin, bins, bool((bins == MISSING).any())
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], names=["block"])

    held, size = [], 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += batch.num_rows
        if size >= BLOCK_ROWS:
            yield row(held)
            held, size = [], 0
    if size:
        yield row(held)


def _reached(tree, bins, missing, depth):
    """As ``walk`` over bins, inputs by rows; ``missing`` tells whether any bin is."""
    count = bins.shape[1]
    rows, flat, at = np.arange(count), bins.ravel(), np.zeros(count, np.int64)
    inner, start = tree.input >= 0, np.maximum(tree.input, 0) * count
    for _ in range(depth):
        here = inner.take(at)
        if not here.any():
            break
        value = flat.take(start.take(at) + rows)
        right = value > tree.cut.take(at)
        if missing:
            right = np.where(value == MISSING, ~tree.missing_left.take(at), right)
        below = 2 * at + 1 + right
        at = below if here.all() else np.where(here, below, at)
    return at


def _advanced(tree, depth):
    """A block with the margins of ``tree`` added, if there is one, and the gradients and curvatures that the next one needs."""
    def run(block):
        label, weight, margin, bins, missing = *block[:3], *block[-2:]
        if tree is not None:
            margin = margin + tree.value[_reached(tree, bins, missing, depth)]
        chance = 1 / (1 + np.exp(-margin))
        return label, weight, margin, weight * (chance - label), weight * chance * (1 - chance), bins, missing
    return run


def _sums(tree, level, widths):
    """For each input of the blocks of a task, sums of gradients and curvatures per (node of the level, bin), missing values in the last bin."""
    def run(blocks):
        first = 2 ** level - 1
        nodes, totals = first + 1, [np.zeros((2, (first + 1) * w)) for w in widths]
        for _, _, _, gradient, curvature, bins, missing in blocks:
            at = _reached(tree, bins, missing, level) - first
            here = at >= 0
            if not here.all():
                at, gradient, curvature, bins = at[here], gradient[here], curvature[here], bins[:, here]
            for own, width, total in zip(bins, widths, totals):
                slot = at * width + (np.where(own == MISSING, width - 1, own) if missing else own)
                total[0] += np.bincount(slot, gradient, nodes * width)
                total[1] += np.bincount(slot, curvature, nodes * width)
        yield from ((i, total.reshape(2, nodes, -1)) for i, total in enumerate(totals))
    return run


def _best_cut(l2, least_curvature, least_gain):
    """(input, its best cut of each node, sums up to that cut, above it and of missing values), from the sums of all its bins."""
    def run(summed):
        number, (gradient, curvature) = summed
        usable = np.arange(gradient.shape[1] - 1) < gradient.shape[1] - 2
        cut = best_splits(gradient[:, None], curvature[:, None], usable[None], l2, least_curvature, least_gain)[2]
        low = np.arange(gradient.shape[1] - 1) <= cut[:, None]
        three = [np.stack([np.where(low, a[:, :-1], 0).sum(1), np.where(low, 0, a[:, :-1]).sum(1), a[:, -1]], 1) for a in (gradient, curvature)]
        return number, cut, three
    return run


def best_splits(gradient, curvature, usable, l2, least_curvature, least_gain):
    """The best split of each node from sums of shape (nodes, inputs, bins + 1), missing values last.

    Returns (gain, input, cut, missing_left, left gradient, left curvature), arrays by node; the gain is 0 without a split. ``usable``
    marks the cuts of each input. Of equal gains the first input and cut stand, and missing values go left.
    """
    g, h = gradient.sum(2)[:, :1, None, None], curvature.sum(2)[:, :1, None, None]
    # Last axis: missing values left, or right.
    left_g = np.stack([gradient[..., :-1].cumsum(2) + gradient[..., -1:], gradient[..., :-1].cumsum(2)], 3)
    left_h = np.stack([curvature[..., :-1].cumsum(2) + curvature[..., -1:], curvature[..., :-1].cumsum(2)], 3)
    score = lambda a, b: a * a / (b + l2)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (score(left_g, left_h) + score(g - left_g, h - left_h) - score(g, h)) / 2 - least_gain
    fits = (left_h >= least_curvature) & (h - left_h >= least_curvature) & usable[None, :, :, None]
    gain = np.where(fits, np.nan_to_num(gain), 0.0).reshape(len(gradient), -1)
    # Sums may differ in their last digits with the order of rows: what is that close counts as equal.
    top = gain.max(1, keepdims=True)
    pick = (gain >= top - 1e-9 * np.abs(top)).argmax(1)
    nodes = np.arange(len(pick))
    number, cut, side = np.unravel_index(pick, left_g.shape[1:])
    return (np.where(gain[nodes, pick] > 1e-9, gain[nodes, pick], 0.0), number, cut, side == 0,
            left_g[nodes, number, cut, side], left_h[nodes, number, cut, side])


def _extended(tree, level, found, cuts, step, l2, least_curvature, least_gain):
    """Splits the nodes of a level of ``tree`` by what ``_best_cut`` found in each input; the numbers in the level of those split."""
    # What is left of an input's bins: up to its best cut, above it, missing.
    usable = np.array([[len(c) > 0, False] for c in cuts])
    cut = np.stack([c for _, c, _ in found], 1)
    gradient, curvature = (np.stack([three[i] for *_, three in found], 1) for i in range(2))
    first = 2 ** level - 1
    if not level:
        g, h = gradient[0, 0].sum(), curvature[0, 0].sum()
        tree.cover[0], tree.value[0] = h, -step * g / (h + l2)
    gain, number, _, missing_left, left_g, left_h = best_splits(
        gradient, curvature, usable, l2, least_curvature, least_gain)
    split = np.flatnonzero(gain > 0).tolist()
    for node in split:
        at = first + node
        g, h = gradient[node, 0].sum(), curvature[node, 0].sum()
        tree.input[at], tree.cut[at], tree.gain[at] = number[node], cut[node, number[node]], gain[node]
        tree.threshold[at], tree.missing_left[at] = cuts[number[node]][tree.cut[at]], missing_left[node]
        for child, (cg, ch) in ((2 * at + 1, (left_g[node], left_h[node])),
                                (2 * at + 2, (g - left_g[node], h - left_h[node]))):
            tree.cover[child], tree.value[child] = ch, -step * cg / (ch + l2)
    return split


def _grow(blocks, depth, cuts, step, l2, least_curvature, least_gain):
    """The next tree: one shuffle of sums per level, as long as some node can be split."""
    widths = [len(c) + 2 for c in cuts]
    best_cut, partitions = _best_cut(l2, least_curvature, least_gain), blocks.getNumPartitions()
    tree = _empty(depth)
    for level in range(depth):
        sums = blocks.mapPartitions(_sums(tree, level, widths))
        if partitions > 1:
            sums = sums.reduceByKey(np.add, min(partitions, len(cuts)))
        found = sorted(sums.map(best_cut).collect(), key=lambda f: f[0])
        if not _extended(tree, level, found, cuts, step, l2, least_curvature, least_gain):
            break
    return tree


def grow_here(gradient, curvature, slots, depth, cuts, step, l2, least_curvature, least_gain):
    """The next tree from arrays of all rows, and the rows of each of its leaves; ``slots`` has the bins of each input, missing
    values in the last one. Of two children the one with fewer rows is added up, the other one has the rest of their parent's sums."""
    best_cut, widths = _best_cut(l2, least_curvature, least_gain), [len(c) + 2 for c in cuts]

    def added(rows):
        g, h = (a if rows is None else a.take(rows) for a in (gradient, curvature))
        for own, width in zip(slots, widths):
            own = (own if rows is None else own.take(rows)).astype(np.intp)
            yield np.stack([np.bincount(own, g, width), np.bincount(own, h, width)])

    tree, leaves = _empty(depth), []
    nodes, sums = {0: None}, [total[:, None] for total in added(None)]
    for level in range(depth):
        found = [best_cut(summed) for summed in enumerate(sums)]
        split = set(_extended(tree, level, found, cuts, step, l2, least_curvature, least_gain))
        below, last = {}, level + 1 == depth
        totals = [] if last else [np.zeros((2, 2 * s.shape[1], s.shape[2])) for s in sums]
        for node, rows in nodes.items():
            at = 2 ** level - 1 + node
            if node not in split:
                leaves.append((at, rows))
                continue
            number = tree.input[at]
            own = slots[number] if rows is None else slots[number].take(rows)
            left = own <= tree.cut[at]
            if tree.missing_left[at]:
                left |= own == widths[number] - 1
            sides = [np.flatnonzero(side) if rows is None else rows.compress(side) for side in (left, ~left)]
            below[2 * node], below[2 * node + 1] = sides
            if last:
                continue
            fewer = int(len(sides[1]) < len(sides[0]))
            for total, whole, part in zip(totals, sums, added(sides[fewer])):
                total[:, 2 * node + fewer], total[:, 2 * node + 1 - fewer] = part, whole[:, node] - part
        nodes, sums = below, totals
        if not nodes:
            break
    return tree, [*leaves, *((2 ** depth - 1 + node, rows) for node, rows in nodes.items())]


def joined(blocks):
    """label, weight, margin and bins (inputs by rows) of all blocks of a task."""
    label, weight, margin, bins = zip(*((*block[:3], block[-2]) for block in blocks))
    return *map(np.concatenate, (label, weight, margin)), np.concatenate(bins, 1)


def _boosted(rounds, depth, cuts, step, *limits):
    """The only partition's blocks to a list of the next trees and, after it, the blocks with their margins added."""
    def run(blocks):
        label, weight, margin, bins = joined(blocks)
        slots = [np.where(own == MISSING, len(cut) + 1, own).astype(np.int16) for own, cut in zip(bins, cuts)]
        trees = []
        for _ in range(rounds):
            chance = 1 / (1 + np.exp(-margin))
            tree, leaves = grow_here(weight * (chance - label), weight * chance * (1 - chance), slots, depth, cuts, step, *limits)
            if _ends(tree):
                break
            trees.append(tree)
            for at, rows in leaves:
                margin[slice(None) if rows is None else rows] += tree.value[at]
        yield trees
        for part in (slice(i, i + BLOCK_ROWS) for i in range(0, len(label), BLOCK_ROWS)):
            yield label[part], weight[part], margin[part], bins[:, part], bool((bins[:, part] == MISSING).any())
    return run


def _ends(tree):
    """Whether nothing is left to learn."""
    return tree.input[0] < 0 and abs(tree.value[0]) < 1e-12


def task_trees(blocks, rounds, boosted):
    """The trees of a single partition of blocks: a job, and what a lost executor costs, is some trees. ``boosted`` takes the number
    of the first one and how many there should be; fewer end the model."""
    trees, held, wanted = [], blocks, 0
    while len(trees) == wanted < rounds:
        number = min(TASK_TREES, rounds - wanted)
        state = blocks.mapPartitions(boosted(wanted, number)).persist(StorageLevel.MEMORY_AND_DISK)
        state.checkpoint()
        trees += state.filter(lambda part: isinstance(part, list)).first()
        wanted += number
        held.unpersist()
        held, blocks = state, state.filter(lambda part: not isinstance(part, list))
    held.unpersist()
    return trees


def training_values(rows: DataFrame, inputs, label: str, weight: str) -> DataFrame:
    """``label, weight, margin`` and the inputs, as numbers."""
    return rows.select(
        F.col(label).cast("double").alias("label"), F.col(weight).cast("double").alias("weight"), F.lit(0.0).alias("margin"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)])


def _bins(values, cuts):
    schema = "label double, weight double, margin double, " + ", ".join(f"b{i} short" for i in range(len(cuts)))
    return values.mapInArrow(_binned(cuts), schema)


def task_blocks(values, cuts):
    """The rows as blocks of one partition."""
    return _blocks(_bins(values, cuts).repartition(1))


def fit(rows: DataFrame, inputs, label: str, weight: str, rounds=300, depth=6, step=0.05, l2=1.0, least_curvature=1.0,
        least_gain=0.0, max_bins=256) -> NewtonModel:
    """Boosted trees for the logistic loss of ``label`` (0 or 1) on ``rows`` with a ``weight``; NULL and NaN inputs are missing.

    Leaves are Newton steps shrunk by ``l2`` and ``step``; a split must leave ``least_curvature`` on both sides and gain more than
    ``least_gain``; missing values go to the side where they gain more. The driver holds the trees and, of one level, three
    pairs of sums per node and input.
    """
    inputs = list(inputs)
    cuts = quantile_cuts(rows, inputs, max_bins)
    values, count = training_values(rows, inputs, label, weight), rows.count()
    limits = step, l2, least_curvature, least_gain
    # A lone tree is grown by levels.
    if rounds > 1 and 0 < count <= PARTITION_ROWS:
        trees = task_trees(task_blocks(values, cuts), rounds, lambda _, number: _boosted(number, depth, cuts, *limits))
        return NewtonModel(inputs, trees, depth)
    partitions = max(1, min(-(-count // max(1, PARTITION_ROWS // 10)), rows.sparkSession.sparkContext.defaultParallelism))
    blocks = _blocks(store(_bins(values, cuts).repartition(partitions)))
    trees = []
    for number in range(rounds):
        # Computed with the first level; lost blocks follow from the last checkpoint and the trees since.
        state = blocks.map(_advanced(trees[-1] if trees else None, depth)).persist(StorageLevel.MEMORY_AND_DISK)
        if number and number % ADD_EVERY == 0:
            state.checkpoint()
        tree = _grow(state, depth, cuts, *limits)
        blocks.unpersist()
        blocks = state
        if _ends(tree):
            break
        trees.append(tree)
    blocks.unpersist()
    return NewtonModel(inputs, trees, depth)


def _blocks(binned: DataFrame):
    """The binned rows as an RDD of blocks: a model may take a job per level of each tree, and those jobs have nothing to
    plan. Blocks that are lost with an executor are made from the rows again."""
    packed = binned.mapInArrow(_packed, "block binary")
    return packed.rdd.map(lambda row: pickle.loads(row.block)).persist(StorageLevel.MEMORY_AND_DISK)


def margin_column(spark: SparkSession, model: NewtonModel):
    """The log-odds as a column expression of the model's inputs, for batches and streams."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def margin(inputs):
        import pandas as pd

        return pd.Series(shared.value.margins(inputs.to_numpy(dtype=float)))

    return margin(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(model.inputs)]))
