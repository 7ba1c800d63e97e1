"""Forests of all targets against plain recursion, on both paths of growth."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pytest

from basinspark.catalog import QUERIES, load_all
from basinspark.operators import forest, models
from basinspark.session import persisted


def brute_tree(x, y, weights, depth, least=1):
    """Nested tuples of a tree grown by trying every value of every feature at every node."""
    mean = (weights[:, None] * y).sum(axis=0) / weights.sum()
    centred = y - mean
    error = (weights * (centred**2).sum(axis=1)).sum()
    if depth == 0 or weights.sum() < max(2, 2 * least) or error <= forest.PURE * (weights * (y**2).sum(axis=1)).sum():
        return mean
    best, chosen, tolerance = -1.0, None, forest.EQUAL_GAIN * error
    for f in range(x.shape[1]):
        gains = {}
        for value in np.unique(x[:, f]):
            low = x[:, f] <= value
            if weights[low].sum() >= least and weights[~low].sum() >= least:
                side = (weights[low, None] * centred[low]).sum(axis=0)
                gains[value] = (side**2).sum() * (1 / weights[low].sum() + 1 / weights[~low].sum())
        if gains:
            most = max(gains.values())
            if chosen is None or most > best + tolerance:
                best, chosen = most, (f, next(v for v, g in gains.items() if g >= most - tolerance))
    if chosen is None:
        return mean
    f, value = chosen
    low = x[:, f] <= value
    return f, value, brute_tree(x[low], y[low], weights[low], depth - 1, least), brute_tree(x[~low], y[~low], weights[~low], depth - 1, least)


def brute_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def data(spark, n, seed, coarse):
    source = np.random.default_rng(seed)
    x = source.normal(size=(n, 3))
    if coarse:
        x = np.round(x)
    y = np.column_stack([np.sin(x[:, 0]) * 3 + x[:, 1], x[:, 2] ** 2 + source.normal(0, 0.1, n), source.normal(size=n)]) + [10, -5, 0]
    frame = pd.DataFrame(np.column_stack([x, y]), columns=["a", "b", "c", "u", "v 1", "w"])
    df = spark.createDataFrame(frame).repartition(4)
    return persisted(models.assemble(df, ["a", "b", "c"]))


TARGETS = ["u", "v 1", "w"]


@pytest.mark.parametrize(
    ("coarse", "local_rows", "depth", "least", "pass_bytes"),
    [(False, 100_000, 30, 1, 1 << 30), (True, 100_000, 30, 1, 1 << 30), (False, 40, 30, 1, 1 << 30), (True, 25, 5, 4, 1), (False, 0, 6, 1, 1 << 20)],
)
def test_forest_equals_plain_recursion(spark, coarse, local_rows, depth, least, pass_bytes):
    df = data(spark, 200, 7, coarse)
    params = forest.ForestParameters(trees=4, depth=depth, least_rows=least, local_rows=local_rows, pass_bytes=pass_bytes)
    trees = forest.fit_trees(df, "_features", TARGETS, params)
    rows = df.withColumn("id", forest.F.monotonically_increasing_id()).toPandas()
    x, y, ids = np.stack(rows["_features"].map(lambda v: v.toArray())), rows[TARGETS].to_numpy(), rows["id"].to_numpy()
    centred = y - y.mean(axis=0)
    expected = np.zeros_like(y)
    for tree in range(4):
        weights = forest.poisson_weights(ids, tree, params.seed).astype(float)
        drawn = weights > 0
        grown = brute_tree(x[drawn], centred[drawn], weights[drawn], depth, least)
        # a value between two drawn ones may fall on either side of a threshold, so rows of the tree are compared
        expected[drawn] += np.array([brute_value(grown, r) for r in x[drawn]]) + y.mean(axis=0)
        one = forest.scored(df, "_features", trees.where(f"tree = {tree}"), ["p1", "p2", "p3"]).select("p1", "p2", "p3").toPandas().to_numpy()
        alone = np.array([brute_value(grown, r) for r in x[drawn]]) + y.mean(axis=0)
        assert np.allclose(one[drawn], alone, atol=1e-8)
    assert trees.count() == 4


def test_blocks_of_trees_give_the_same_scores(spark, monkeypatch):
    df = data(spark, 120, 3, True)
    trees = forest.fit_trees(df, "_features", TARGETS, forest.ForestParameters(trees=5))
    whole = forest.scored(df, "_features", trees, ["p", "q", "r"]).select("p", "q", "r").toPandas()
    monkeypatch.setattr(forest, "BLOCK_BYTES", 1)
    split = forest.scored(df, "_features", trees, ["p", "q", "r"]).select("p", "q", "r").toPandas()
    assert np.allclose(whole, split)


def test_one_split_serves_all_targets(spark):
    """The first target alone would be split on a, the sum of all errors on b."""
    rows = [(float(i % 2), float(i // 2 % 2), float(i % 2), 10.0 * (i // 2 % 2)) for i in range(64)]
    df = models.assemble(spark.createDataFrame(rows, "a double, b double, y double, z double"), ["a", "b"])
    trees = forest.fit_trees(df, "_features", ["y", "z"], forest.ForestParameters(trees=3, depth=1)).collect()
    assert [t["feature"][0] for t in trees] == [1, 1, 1] and [t["threshold"][0] for t in trees] == [0.5] * 3


def test_rows_without_targets_and_constant_tables(spark):
    df = models.assemble(spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, None)], "a double, y double"), ["a"])
    trees = forest.fit_trees(df, "_features", ["y"], forest.ForestParameters(trees=2))
    assert {r["p"] for r in forest.scored(df, "_features", trees, ["p"]).collect()} == {2.0}
    with pytest.raises(ValueError, match="no rows"):
        forest.fit_trees(df.where("a > 2"), "_features", ["y"])


def test_weights_are_poisson():
    weights = forest.poisson_weights(np.arange(200_000), 5, 42)
    assert abs(weights.mean() - 1) < 0.01 and abs(weights.var() - 1) < 0.02
    assert (weights == forest.poisson_weights(np.arange(200_000), 5, 42)).all() and (weights != forest.poisson_weights(np.arange(200_000), 6, 42)).any()


def counted(monkeypatch, name):
    """Make a step of the forest report what it gave."""
    given, real = [], getattr(forest, name)
    monkeypatch.setattr(forest, name, lambda *args: given.append(real(*args)) or given[-1])
    return given


@pytest.mark.parametrize(
    ("local_rows", "depth", "least", "pass_bytes"),
    [(100_000, 30, 1, 1 << 30), (100_000, 30, 1, 20_000), (20, 4, 4, 1 << 30)],
)
def test_cells_of_equal_bins_grow_the_same_trees(spark, monkeypatch, local_rows, depth, least, pass_bytes):
    """Rows added up by cell, in one and in several passes, against plain recursion over the rows."""
    monkeypatch.setattr(forest, "PART_BYTES", 20_000)
    df, given = data(spark, 1500, 11, True), counted(monkeypatch, "_cells")
    params = forest.ForestParameters(trees=3, depth=depth, least_rows=least, local_rows=local_rows, pass_bytes=pass_bytes)
    trees = forest.fit_trees(df, "_features", TARGETS, params)
    stored = given[0].groupBy("tree").agg(forest.F.sum("n").alias("n")).collect()
    assert len(stored) == 3 and max(r["n"] for r in stored) < 200
    rows = df.withColumn("id", forest.F.monotonically_increasing_id()).toPandas()
    x, y, ids = np.stack(rows["_features"].map(lambda v: v.toArray())), rows[TARGETS].to_numpy(), rows["id"].to_numpy()
    for tree in range(3):
        weights = forest.poisson_weights(ids, tree, params.seed).astype(float)
        drawn = weights > 0
        grown = brute_tree(x[drawn], y[drawn] - y.mean(axis=0), weights[drawn], depth, least)
        one = forest.scored(df, "_features", trees.where(f"tree = {tree}"), ["p1", "p2", "p3"]).select("p1", "p2", "p3").toPandas().to_numpy()
        assert np.allclose(one[drawn], np.array([brute_value(grown, r) for r in x[drawn]]) + y.mean(axis=0), atol=1e-8)


def test_weights_by_slices_equal_those_by_steps():
    """The drawn weights are those of the steps of the distribution, bit by bit."""
    ids = np.arange(300_000) * 8_589_934_592 + 17
    state = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(((42 << 20) + 4) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        state = (state ^ (state >> np.uint64(shift))) * np.uint64(factor)
    uniform = ((state ^ (state >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    assert (forest.poisson_weights(ids, 3, 42) == np.searchsorted(np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 18)])), uniform, side="right")).all()


@pytest.mark.parametrize("query", ["ensemble_linear_mean", "forest_joint_targets"])
def test_queries_grow_their_forests_from_cells(spark, monkeypatch, query):
    """The trees of few different inputs come from cells, whose number does not grow with the rows."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not there")
    load_all()
    given = counted(monkeypatch, "_cells")
    assert QUERIES[query](spark, folder).count() > 0
    assert len(given) == 1 and max(r["n"] for r in given[0].groupBy("tree").agg(forest.F.sum("n").alias("n")).collect()) <= 63
