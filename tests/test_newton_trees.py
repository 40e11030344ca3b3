"""Second-order boosted trees against a plain search over all splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimrisk.operators import newton_trees as nt
from claimrisk.operators.newton_trees import MISSING


def slow_trees(x, y, w, rounds, depth, step, l2, least_curvature):
    """Trees as nested tuples (input, threshold, missing left, left, right) or leaf values, and the margins."""
    margin, trees = np.zeros(len(y)), []

    def grow(rows, level, g, h):
        value = -step * g[rows].sum() / (h[rows].sum() + l2)
        score = lambda part: g[part].sum() ** 2 / (h[part].sum() + l2)
        best = (1e-9, None)
        for i in range(x.shape[1] if level < depth else 0):
            missing = np.isnan(x[rows, i])
            for cut in np.unique(x[:, i][~np.isnan(x[:, i])]):
                for missing_left in (True, False):
                    left = rows[np.where(missing, missing_left, x[rows, i] <= cut)]
                    right = np.setdiff1d(rows, left)
                    if h[left].sum() < least_curvature or h[right].sum() < least_curvature:
                        continue
                    gain = (score(left) + score(right) - score(rows)) / 2
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (i, cut, missing_left, left, right))
        if best[1] is None:
            return value
        i, cut, missing_left, left, right = best[1]
        return i, cut, missing_left, grow(left, level + 1, g, h), grow(right, level + 1, g, h)

    def predict(tree, row):
        while isinstance(tree, tuple):
            i, cut, missing_left, left, right = tree
            tree = left if (missing_left if np.isnan(row[i]) else row[i] <= cut) else right
        return tree

    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-margin))
        tree = grow(np.arange(len(y)), 0, w * (chance - y), w * chance * (1 - chance))
        trees.append(tree)
        margin = margin + np.array([predict(tree, row) for row in x])
    return trees, margin


def nested(tree, node=0):
    if tree.input[node] < 0:
        return float(tree.value[node])
    return (int(tree.input[node]), float(tree.threshold[node]), bool(tree.missing_left[node]),
            nested(tree, 2 * node + 1), nested(tree, 2 * node + 2))


def same(a, b):
    if not isinstance(a, tuple) or not isinstance(b, tuple):
        return a == pytest.approx(b, abs=1e-9)
    return a[:2] == b[:2] and a[2] == b[2] and same(a[3], b[3]) and same(a[4], b[4])


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(0, 1, 200).round(2), rng.integers(0, 5, 200), rng.normal(0, 1, 200).round(1)]).astype(float)
    y = ((x[:, 0] + 0.5 * x[:, 1] - 1 + rng.normal(0, 0.7, 200)) > 0).astype(float)
    x[rng.random(200) < 0.15, 0] = np.nan
    x[(rng.random(200) < 0.3) & (y == 1), 2] = np.nan
    return x, y, np.where(y == 1, 1.5, 1.0)


def frame(spark, rows):
    x, y, w = rows
    table = [(int(a), float(b), *[None if i == 1 and np.isnan(v) else float(v) for i, v in enumerate(r)])
             for r, a, b in zip(x, y, w)]
    return spark.createDataFrame(table, "label int, weight double, a double, b double, c double")


@pytest.mark.parametrize("partition_rows", [100_000, 60])
def test_splits_and_leaves(spark, rows, monkeypatch, partition_rows):
    monkeypatch.setattr(nt, "PARTITION_ROWS", partition_rows)
    monkeypatch.setattr(nt, "ADD_EVERY", 2)
    model = nt.fit(frame(spark, rows), ["a", "b", "c"], "label", "weight", rounds=5, depth=3, step=0.3)
    trees, margin = slow_trees(*rows, rounds=5, depth=3, step=0.3, l2=1.0, least_curvature=1.0)
    assert len(model.trees) == 5
    assert all(same(nested(a), b) for a, b in zip(model.trees, trees))
    assert model.margins(rows[0]) == pytest.approx(margin)
    assert any(tree.missing_left[tree.input >= 0].any() for tree in model.trees)


def test_column_save_and_load(spark, rows, tmp_path):
    table = frame(spark, rows)
    model = nt.fit(table, ["a", "b", "c"], "label", "weight", rounds=3, depth=4)
    nt.save(spark, model, str(tmp_path / "m"))
    again = nt.load(spark, str(tmp_path / "m"))
    assert (again.inputs, again.depth, len(again.trees)) == (model.inputs, 4, 3)
    assert all(np.array_equal(a, b) for s, t in zip(model.trees, again.trees) for a, b in zip(
        (s.input, s.threshold, s.missing_left, s.value, s.cover, s.gain), (t.input, t.threshold, t.missing_left, t.value, t.cover, t.gain)))
    found = table.coalesce(1).select(nt.margin_column(spark, again).alias("m")).collect()
    assert [r.m for r in found] == pytest.approx(model.margins(rows[0]).tolist())
    assert sum(model.importance().values()) == pytest.approx(1.0)


def test_driver_gets_only_sums(spark, rows, monkeypatch):
    """What a level brings to the driver depends on nodes, inputs and bins, not on rows."""
    sizes = []
    real = nt.best_splits
    monkeypatch.setattr(nt, "best_splits", lambda g, h, *rest: sizes.append(g.shape) or real(g, h, *rest))
    many = frame(spark, rows).crossJoin(spark.range(20)).drop("id")
    nt.fit(many, ["a", "b", "c"], "label", "weight", rounds=1, depth=3, max_bins=16)
    assert sizes[0][:2] == (1, 3) and sizes[-1][0] <= 4 and all(s[2] <= 18 for s in sizes)


def test_driver_gets_no_bins(spark, rows, monkeypatch):
    """Of each node and input the driver gets three sums, however many bins there are and partitions that add them up."""
    sizes = []
    real = nt.best_splits
    monkeypatch.setattr(nt, "best_splits", lambda g, h, *rest: sizes.append(g.shape) or real(g, h, *rest))
    monkeypatch.setattr(nt, "PARTITION_ROWS", 60)
    monkeypatch.setattr(nt, "BLOCK_ROWS", 7)
    model = nt.fit(frame(spark, rows), ["a", "b", "c"], "label", "weight", rounds=2, depth=3, step=0.3)
    assert sizes and all(s[1:] == (3, 3) for s in sizes)
    trees, _ = slow_trees(*rows, rounds=2, depth=3, step=0.3, l2=1.0, least_curvature=1.0)
    assert all(same(nested(a), b) for a, b in zip(model.trees, trees))


def test_few_values_missing_inputs_and_one_leaf(spark):
    table = spark.createDataFrame([(i % 2, 1.0, None, 3.0) for i in range(20)], "label int, weight double, a double, b double")
    model = nt.fit(table, ["a", "b"], "label", "weight", rounds=3)
    assert model.trees == [] and model.margins(np.array([[np.nan, 1.0]])).tolist() == [0.0]
    table = table.withColumn("label", F.lit(1))
    model = nt.fit(table, ["a", "b"], "label", "weight", rounds=2)
    assert [t.input[0] for t in model.trees] == [-1, -1] and model.margins(np.zeros((1, 2)))[0] > 0
    assert MISSING < 0


@pytest.mark.parametrize("every", [100, 2])
def test_rows_of_one_task_are_not_added_up_by_levels(spark, rows, monkeypatch, every):
    """Thousands of jobs, one per level, take longer than the trees: rows that fit a task meet a job for some trees at a time."""
    monkeypatch.setattr(nt, "_grow", lambda *a: pytest.fail("a job per level"))
    monkeypatch.setattr(nt, "TASK_TREES", every)
    model = nt.fit(frame(spark, rows), ["a", "b", "c"], "label", "weight", rounds=7, depth=4, step=0.3)
    trees, margin = slow_trees(*rows, rounds=7, depth=4, step=0.3, l2=1.0, least_curvature=1.0)
    assert len(model.trees) == 7
    assert all(same(nested(a), b) for a, b in zip(model.trees, trees))
    assert model.margins(rows[0]) == pytest.approx(margin)


def test_whole_trees_and_trees_by_levels_are_the_same(spark, rows, monkeypatch):
    many = frame(spark, rows).crossJoin(spark.range(5)).withColumn("a", F.col("a") + F.col("id")).drop("id")
    fit = lambda: nt.fit(many, ["a", "b", "c"], "label", "weight", rounds=4, depth=5, max_bins=32)
    whole = fit()
    monkeypatch.setattr(nt, "PARTITION_ROWS", 300)
    assert all(same(nested(a), nested(b)) for a, b in zip(whole.trees, fit().trees))
    assert len(whole.trees) == 4
