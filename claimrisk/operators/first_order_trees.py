"""MLlib's first-order boosted trees (logistic loss, variance) of training rows that fit a task, grown there.

MLlib takes a job with a shuffle per level of each tree; of few rows their sums take less time than the wait for these jobs. The
trees are those that MLlib grows if it finds its splits in all rows, and the result is a model of MLlib's, made by way of its saved form.
"""

import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.operators import newton_trees
from claimrisk.operators.newton_trees import BLOCK_ROWS, grow_here, joined, task_blocks, task_trees
from claimrisk.session import file_system, scratch_dir, store

NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
         "gain: double, leftChild: int, rightChild: int, "
         "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def split_values(values, weight, max_bins):
    """Where MLlib may split an input: between all of its values, or if they are too many, nearest to equal shares of the weight."""
    distinct, place = np.unique(values, return_inverse=True)
    between = (distinct[:-1] + distinct[1:]) / 2
    splits = min(max_bins, len(values)) - 1
    if len(between) <= splits:
        return between
    below = np.bincount(place, weight).cumsum()
    middle, stride = (below[:-1] + below[1:]) / 2, below[-1] / (splits + 1)
    found, target, at = [], stride, 0
    while True:
        at = max(at, int(np.searchsorted(middle, target, side="right")))
        if at >= len(middle):
            return between[found]
        found.append(at)
        target, at = target + stride, at + 1


def _cuts(max_bins):
    """The rows of a partition to the splits of each input, a row each."""
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        weight = table.column(1).to_numpy()
        for column in table.columns[3:]:
            values = column.to_numpy()
            if np.isnan(values).any():
                raise ValueError("first-order trees need an input without missing values")
            yield pa.RecordBatch.from_arrays([pa.array([split_values(values, weight, max_bins)], pa.list_(pa.float64()))], names=["cuts"])
    return run


def saved_nodes(tree, leaves, sums):
    """A tree as MLlib saves it: nodes in preorder; ``sums`` has count, weight, sum and sum of squares of each leaf's targets."""
    total = np.zeros((len(tree.input), 4))
    for (at, _), own in zip(leaves, sums):
        total[at] = own
    for at in range(len(tree.input) // 2 - 1, -1, -1):
        if tree.input[at] >= 0:
            total[at] = total[2 * at + 1] + total[2 * at + 2]
    _, weight, target, square = total.T
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = target / weight
        impurity = (square - target * target / weight) / weight
    nodes = []

    def add(at):
        number, leaf = len(nodes), tree.input[at] < 0
        nodes.append(None)
        gain, left, right, split = -1.0, -1, -1, (-1, [], -1)
        if not leaf:
            left, right = add(2 * at + 1), add(2 * at + 2)
            sides = [2 * at + 1, 2 * at + 2]
            gain = float(impurity[at] - (weight[sides] * impurity[sides]).sum() / weight[at])
            split = int(tree.input[at]), [float(tree.threshold[at])], -1
        nodes[number] = (number, float(mean[at]), float(impurity[at]), total[at, 1:].tolist(), int(total[at, 0]), gain, left, right, split)
        return number

    add(0)
    return nodes, mean


def _boosted(first, rounds, depth, cuts, step):
    """The only partition's blocks to a list of the next trees and, after it, the blocks with their margins added."""
    def run(blocks):
        label, weight, margin, bins = joined(blocks)
        sign, trees = 2 * label - 1, []
        for number in range(first, first + rounds):
            # The first tree fits the labels, as MLlib has it; further ones fit what is left of the loss.
            target = 4 * sign / (1 + np.exp(2 * sign * margin)) if number else sign
            size = np.sqrt((weight * target * target).sum() / weight.sum()) or 1.0
            # With the weight for a curvature, the gain is that of the variance; a side needs a row.
            tree, leaves = grow_here(-weight * target / size, weight, bins, depth, cuts, 1.0, 0.0, weight.min() / 2, 0.0)
            sums = []
            for _, rows in leaves:
                w, t = (a if rows is None else a.take(rows) for a in (weight, target))
                sums.append((len(w), w.sum(), (w * t).sum(), (w * t * t).sum()))
            nodes, mean = saved_nodes(tree, leaves, sums)
            trees.append(nodes)
            for at, rows in leaves:
                margin[slice(None) if rows is None else rows] += mean[at] * (step if number else 1.0)
        yield trees
        for part in (slice(i, i + BLOCK_ROWS) for i in range(0, len(label), BLOCK_ROWS)):
            yield label[part], weight[part], margin[part], bins[:, part], False
    return run


def fit(rows: DataFrame, inputs, label: str, weight: str, learner: GBTClassifier) -> GBTClassificationModel:
    """The model that ``learner`` fits, with splits found in all rows. They go through one task, at most ``newton_trees.PARTITION_ROWS``."""
    inputs, rounds, step = list(inputs), learner.getMaxIter(), learner.getStepSize()
    values = store(newton_trees.training_values(rows, inputs, label, weight))
    cuts = [np.array(r.cuts) for r in values.coalesce(1).mapInArrow(_cuts(learner.getMaxBins()), "cuts array<double>").collect()]
    blocks = task_blocks(values, cuts)
    trees = task_trees(blocks, rounds, lambda first, number: _boosted(first, number, learner.getMaxDepth(), cuts, step))
    return _model(rows.sparkSession, learner, len(inputs), trees, [1.0] + [step] * (len(trees) - 1))


def _model(spark, learner, inputs, trees, weights):
    """The model of saved nodes: a model of one small tree is saved, its trees are replaced, and it is loaded."""
    pattern = learner.copy({learner.maxIter: 1, learner.maxDepth: 1}).fit(spark.createDataFrame(
        [(Vectors.dense([float(i)] * inputs), float(i), 1.0) for i in (0, 1)],
        [learner.getFeaturesCol(), learner.getLabelCol(), learner.getWeightCol()]))
    path = f"{scratch_dir(spark)}/model-{uuid.uuid4()}"
    pattern.write().save(f"{path}/pattern")
    head = json.loads(spark.read.text(f"{path}/pattern/metadata").first().value)
    head["numTrees"] = len(trees)
    head["paramMap"] |= {"maxIter": learner.getMaxIter(), "maxDepth": learner.getMaxDepth()}
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    each = spark.read.parquet(f"{path}/pattern/treesMetadata")
    of_tree = each.first()[1]
    spark.createDataFrame([(i, of_tree, w) for i, w in enumerate(weights)], each.schema).coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    spark.createDataFrame([(i, node) for i, nodes in enumerate(trees) for node in nodes], NODES, verifySchema=False).coalesce(1).write.parquet(f"{path}/model/data")
    model = GBTClassificationModel.load(f"{path}/model")
    system, place = file_system(spark, path)
    system.delete(place, True)
    return model
