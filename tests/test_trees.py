"""Attribution and permutation importance of tree ensembles against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from loadlab.config import DEFAULT
from loadlab.operators import explain as EX
from loadlab.operators import models as MO
from loadlab.operators import trees as TR
from loadlab.sources import tables


def _plain(tree, x, known, node=0):
    """Output of a tree when only the features in ``known`` are known."""
    f = tree.feature[node]
    if f < 0:
        return tree.weight * tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        return _plain(tree, x, known, left if x[f] <= tree.threshold[node] else right)
    return sum(tree.cover[c] / tree.cover[node] * _plain(tree, x, known, c) for c in (left, right))


def _brute(trees, x):
    n, out = len(x), np.zeros(len(x))
    game = {s: sum(_plain(t, x, s) for t in trees) for k in range(n + 1) for s in map(frozenset, itertools.combinations(range(n), k))}
    for i in range(n):
        for s in game:
            if i not in s:
                out[i] += math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (game[s | {i}] - game[s])
    return out, game[frozenset()]


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_attributions_equal_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.random((400, 5)).round(2)
    y = x[:, 0] * 3 + (x[:, 1] > 0.5) * x[:, 2] + rng.random(400) * 0.1
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, d double, e double, y double")
    f = VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df)
    fit = GBTRegressor(labelCol="y", maxIter=4, maxDepth=5, seed=1) if kind == "gbt" else RandomForestRegressor(labelCol="y", numTrees=3, maxDepth=7, seed=1)
    model = fit.fit(f)
    trees = TR.ensemble(TR.node_table(spark, model))
    phi = TR.attributions(trees, x)
    raw = np.array([r.prediction for r in model.transform(f).collect()])
    assert np.allclose(phi.sum(1) + sum(t.base for t in trees), raw, rtol=0, atol=1e-9)
    assert np.allclose(sum(t.output(x) for t in trees), raw, rtol=0, atol=1e-12)
    for k in range(0, 400, 40):
        want, base = _brute(trees, x[k])
        assert np.allclose(phi[k], want, rtol=0, atol=1e-10) and abs(base - sum(t.base for t in trees)) < 1e-10


def test_a_tree_of_one_leaf():
    tree = TR.Tree(2.0, np.array([3.0]), np.array([-1]), np.array([0.0]), np.array([0]), np.array([0]), np.array([5.0]))
    x = np.ones((3, 2))
    assert tree.base == 6.0 and (tree.output(x) == 6.0).all() and not TR.attributions([tree], x).any()


@pytest.fixture(scope="module")
def gbt(spark, sf001):
    spec = MO.ModelSpec("GBT (log target)", "gbt", "log", params={"maxIter": 6, "maxDepth": 4, "seed": 42})
    return MO.fit(spec, tables.train(spark, sf001))


def test_attributions_of_a_fitted_model(spark, sf001, gbt, monkeypatch):
    holdout = tables.holdout(spark, sf001)
    rows = TR.tree_attribution(gbt, holdout, DEFAULT).collect()
    dollars = {r.load_id: r.predicted for r in gbt.predict(holdout).collect()}
    assert len(rows) == len(dollars)
    for r in rows:
        assert abs(sum(r.attributions) + r.base_value - r.raw_output) < 1e-9
        assert abs(max(math.exp(r.raw_output), gbt.floor) - dollars[r.load_id]) < 1e-6
    # In chunks of trees: the same sums.
    monkeypatch.setattr(TR, "CHUNK", 2)
    again = {r.load_id: r for r in TR.tree_attribution(gbt, holdout, DEFAULT).collect()}
    for r in rows:
        assert np.allclose(again[r.load_id].attributions, r.attributions, rtol=0, atol=1e-12)
    long = TR.named_attributions(TR.tree_attribution(gbt, holdout.limit(3), DEFAULT), gbt.feature_names, "load_id", gbt.constant_features)
    assert long.count() == 3 * len(gbt.pipeline.stages[0].feature_names())


def test_permutation_importance_of_trees_equals_scoring_copies(spark, sf001, gbt):
    holdout = tables.holdout(spark, sf001)
    touched = {r.feature: r for r in TR.permutation_importance_trees(gbt, holdout, DEFAULT, repeats=2).collect()}
    copies = {r.feature: r for r in EX.permutation_importance(gbt, holdout, DEFAULT, repeats=2).collect()}
    assert touched.keys() == copies.keys()
    for name, r in copies.items():
        assert abs(touched[name].permutation_importance - r.permutation_importance) < 1e-12, name
        assert abs(touched[name].permutation_std - r.permutation_std) < 1e-12, name
    assert sum(r.permutation_importance != 0 for r in copies.values()) > 3


def test_tabled_attributions_equal_computed_ones(monkeypatch):
    rng = np.random.default_rng(11)
    inner, n = 31, 63
    feature = np.where(np.arange(n) < inner, rng.integers(0, 7, n), -1)
    left, right = (np.where(feature >= 0, 2 * np.arange(n) + k, 0) for k in (1, 2))
    cover = np.where(feature < 0, rng.integers(1, 50, n), 0).astype(float)
    for k in range(inner - 1, -1, -1):
        cover[k] = cover[left[k]] + cover[right[k]]
    tree = TR.Tree(0.5, rng.normal(size=n), feature, rng.normal(size=n), left, right, cover)
    x = rng.normal(size=(600, 7))
    computed, calls = TR.Tree._leaf_attributions, []
    monkeypatch.setattr(TR.Tree, "_leaf_attributions", lambda self, inside: calls.append(len(inside)) or computed(self, inside))
    tabled = TR.attributions([tree], x)
    assert calls == [2 ** tree.slot.shape[1]]  # once, whatever the number of rows
    monkeypatch.setattr(TR, "SHORT", 0)
    assert np.array_equal(tabled, TR.attributions([tree], x))
