"""Path-dependent Shapley values of regression trees (Lundberg et al., 2018), one batch at a time.

A leaf's prediction depends on x only through which features satisfy all their splits on the way to
it. Over coalitions of the features on the path its expectation is a product, so the sums over all coalitions of a
size are the coefficients of a polynomial: it is extended by one feature after another, and a feature is unwound from it to get
the sums of the others, in time quadratic in the path. That is done once for each pattern of satisfied
features that a batch shows.
"""

from math import factorial
from typing import NamedTuple

import numpy as np
import pandas as pd

# Leaves that go to the tasks at once, in bytes.
SLICE_BYTES = 64 * 1024 * 1024
# Up to this many features on a path the patterns of a batch are counted, beyond they are sorted.
COUNTED = 12
# Tables of leaves that a task keeps from batch to batch, in bytes.
TABLE_BYTES = 64 * 1024 * 1024


class Leaves(NamedTuple):
    """Leaves with their paths one after another: features ``start[i]`` to ``start[i + 1]`` are those of leaf i.

    A value satisfies a feature of a path within ``low < x <= high``, a missing one where ``missing`` says so; ``share`` is the
    part of the training weight that does.
    """

    start: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    missing: np.ndarray
    share: np.ndarray
    value: np.ndarray

    def bytes(self):
        return sum(a.nbytes for a in self)

    def part(self, first, stop):
        inner = slice(self.start[first], self.start[stop])
        return Leaves(self.start[first:stop + 1] - self.start[first], *[a[inner] for a in self[1:6]], self.value[first:stop])

    def slices(self, limit=SLICE_BYTES):
        """The leaves in parts of no more than about ``limit`` bytes."""
        count = max(1, -(-self.bytes() // limit))
        cuts = np.linspace(0, len(self.value), count + 1).astype(int).tolist()
        return [self.part(a, b) for a, b in zip(cuts, cuts[1:]) if b > a] or [self]


def compile_trees(nodes, tree_weights) -> tuple[Leaves, float]:
    """Leaves and base value of a weighted sum of trees.

    ``nodes``: rows (treeID, id, prediction, leftChild, rightChild, feature, threshold, cover, missing_left).
    """
    trees = {}
    for node in nodes:
        trees.setdefault(node.treeID, {})[node.id] = node
    paths, values, base = [], [], 0.0
    for tree_id, tree in trees.items():
        for leaf, path in _leaf_paths(tree):
            value = leaf.prediction * tree_weights[tree_id]
            base += value * float(np.prod([share for *_, share in path.values()]))
            if path:
                paths.append(path)
                values.append(value)
    steps = [(feature, *step) for path in paths for feature, step in path.items()]
    columns = list(zip(*steps)) if steps else [()] * 5
    kinds = (np.int32, float, float, bool, float)
    return Leaves(np.cumsum([0, *map(len, paths)]), *[np.array(c, k) for c, k in zip(columns, kinds)], np.array(values, float)), base


def _leaf_paths(tree):
    """Each leaf with {feature: (low, high, whether missing values satisfy it, share of the training weight that does)}."""
    todo = [(tree[0], {})]
    while todo:
        node, path = todo.pop()
        if node.leftChild < 0:
            yield node, path
            continue
        low, high, missing, share = path.get(node.feature, (-np.inf, np.inf, True, 1.0))
        left, right = tree[node.leftChild], tree[node.rightChild]
        for child, bounds in ((left, (low, min(high, node.threshold), missing and node.missing_left)),
                              (right, (max(low, node.threshold), high, missing and not node.missing_left))):
            todo.append((child, {**path, node.feature: (*bounds, share * child.cover / node.cover)}))


def unit_contributions(shares, satisfied):
    """Shapley values of a leaf of value one, a row per pattern of satisfied features: shape (patterns, d)."""
    d, ones = len(shares), satisfied.astype(float)
    # Coefficient s: sum over coalitions of s features of the product of their factors.
    by_size = np.zeros((len(ones), d + 1))
    by_size[:, 0] = 1.0
    for i in range(d):  # extend by feature i
        longer = by_size * shares[i]
        longer[:, 1:] += by_size[:, :-1] * ones[:, [i]]
        by_size = longer
    weights = [factorial(s) * factorial(d - 1 - s) / factorial(d) for s in range(d)]
    out = np.zeros((len(ones), d))
    for j in range(d):  # unwind feature j
        inside, share = ones[:, j] > 0, shares[j]
        total, rest = np.zeros(len(ones)), np.zeros(len(ones))
        for s in range(d - 1, -1, -1):
            rest = np.where(inside, by_size[:, s + 1] - share * rest, by_size[:, s] / (share if share else 1.0))
            total += rest * weights[s]
        out[:, j] = total * (ones[:, j] - share)
    return out


def _table(leaves, i, patterns):
    """Contributions of leaf i to each input of its path (a row each), by pattern of satisfied inputs."""
    path = slice(leaves.start[i], leaves.start[i + 1])
    satisfied = (patterns[:, None] >> np.arange(path.stop - path.start)) & 1
    return np.ascontiguousarray(leaves.value[i] * unit_contributions(leaves.share[path], satisfied).T)


def add_contributions(leaves, columns, missing, values, tables=None):
    """Add the contributions of ``leaves`` for a batch to ``values`` (inputs by rows), like ``columns`` and ``missing``.

    ``tables`` keeps what does not depend on the batch, for paths of few inputs and up to TABLE_BYTES.
    """
    tables, some = {} if tables is None else tables, missing.any(1)
    room = TABLE_BYTES - sum(t.nbytes for t in tables.values())
    for i in range(len(leaves.value)):
        path = range(leaves.start[i], leaves.start[i + 1])
        pattern = np.zeros(columns.shape[1], np.uint8 if len(path) <= 8 else np.int64)
        for place, step in enumerate(path):
            feature = leaves.feature[step]
            inside = columns[feature] > leaves.low[step]
            inside &= columns[feature] <= leaves.high[step]
            if some[feature] and leaves.missing[step]:
                inside |= missing[feature]
            pattern |= inside.astype(pattern.dtype) << place
        if len(path) <= min(8, COUNTED):
            table, number = tables.get(i), pattern.astype(np.intp)
            if table is None:
                table = _table(leaves, i, np.arange(1 << len(path)))
                if table.nbytes <= room:
                    tables[i] = table
                    room -= table.nbytes
        elif len(path) <= COUNTED:
            seen = np.flatnonzero(np.bincount(pattern, minlength=1 << len(path)))
            number = np.zeros(1 << len(path), np.int64)
            number[seen] = np.arange(len(seen))
            table, number = _table(leaves, i, seen), number[pattern]
        else:
            seen, number = np.unique(pattern, return_inverse=True)
            table = _table(leaves, i, seen.astype(np.int64))
        for place, step in enumerate(path):
            values[leaves.feature[step]] += table[place].take(number)


def batch_explainer(shared, names, base, before=None):
    """A ``mapInPandas`` function that adds ``base_value`` and ``shap``; ``shared`` is a broadcast of leaves. With ``before``, the name of
    the ``shap`` column of other leaves, their contributions are added up."""
    def explain(batches):
        leaves, tables = shared.value, {}
        for batch in batches:
            columns = np.ascontiguousarray(batch[names].to_numpy(dtype=float).T)
            values = np.zeros(columns.shape)
            if before and len(batch):
                values += np.array(batch[before].tolist(), float).T
            add_contributions(leaves, columns, np.isnan(columns), values, tables)
            added = pd.DataFrame({"base_value": base, "shap": list(values.T)}, index=batch.index)
            yield pd.concat([batch.drop(columns=["base_value", "shap"]) if before else batch, added], axis=1)

    return explain
