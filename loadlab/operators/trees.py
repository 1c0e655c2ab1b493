"""Tree ensembles as tables of nodes: attribution of predictions (M20, A47) and permutation importance.

A fitted Spark ensemble is written and its nodes are read back as a table; the trees' arrays go to the tasks with the
job, as the model itself does when it predicts (a large forest goes in ``CHUNK`` trees at a time).

Attribution is the Shapley value of the game "know the features in S, follow both branches of every other
split in proportion to the training rows that took them".  A leaf with value v is reached in that game with the
product over its path's features of ``o`` (known: 1 where the row's value lies in the leaf's interval, else 0) or ``z``
(unknown: share of rows that stayed on the path), so feature i gets
``v (o_i - z_i) sum_k k! (d-1-k)! / d! e_k``, where ``e_k`` sums the products with k of the other d - 1 features
known.  With ``k! (d-1-k)! / d!`` written as the integral of ``u^k (1-u)^(d-1-k)`` over [0, 1], the sum over subset
sizes is the integral of the product of ``z_j (1-u) + o_j u`` over the other features, a polynomial of
degree d - 1: Gauss-Legendre with ceil(d / 2) points is exact, and each factor is positive, so leaving a
feature out is a division.  A row meets a leaf with one of 2^d patterns of ``o``, so a task computes these once for each
leaf of a tree with short paths and looks them up.  Attributions of a row and the base value sum to the model's raw output.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlab.config import PERMUTATION_REPEATS, JobConfig
from loadlab.operators.models import FittedModel
from loadlab.operators.permute import columns_of, held_features, importance_of, matrix, permuted_pairs
from loadlab.session import checkpoint_dir

CHUNK = 200
ROWS = 256
SHORT = 8  # longest paths (in distinct features) whose leaves' attributions are tabled by pattern


def node_table(spark: SparkSession, regressor) -> DataFrame:
    """The nodes of a fitted tree ensemble: ``tree, id, value, cover, feature, threshold, left, right``, ``weight``.

    Leaves have a null ``feature``; ``cover`` counts the (weighted) training rows, ``value`` is the node's prediction.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/loadlab-ensemble-{uuid.uuid4().hex}"
    regressor.write().save(path)
    n = F.col("nodeData")
    weights = [float(w) for w in regressor.treeWeights]
    if type(regressor).__name__.startswith("RandomForest"):  # a forest averages its trees
        weights = [w / sum(weights) for w in weights]
    inner = n["leftChild"] >= 0
    split = F.when(n["split"]["numCategories"] < 0, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).otherwise(
        F.raise_error(F.lit("splits on categories are not supported")).cast("double"))
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("value"), F.get(n["impurityStats"], F.lit(0)).alias("cover"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"), F.when(inner, split).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("treeID") + 1).alias("weight"))


@dataclass
class Tree:
    """One tree's nodes (``feature`` -1 at leaves) and its leaves' paths, one slot for each distinct feature on a path."""

    weight: float
    value: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cover: np.ndarray

    def __post_init__(self):
        leaves = []
        todo = [(0, {})]
        while todo:
            node, path = todo.pop()
            f = int(self.feature[node])
            if f < 0:
                leaves.append((node, path))
                continue
            lo, hi, z = path.get(f, (-np.inf, np.inf, 1.0))
            t = self.threshold[node]
            for child, low, high in ((self.left[node], lo, min(hi, t)), (self.right[node], max(lo, t), hi)):
                todo.append((int(child), path | {f: (low, high, z * self.cover[child] / self.cover[node])}))
        d = max(1, max(len(p) for _, p in leaves))
        shape = (len(leaves), d)
        # Unused slots take feature 0 with every value inside and nothing unknown: they add nothing.
        self.slot, self.low, self.high = np.zeros(shape, np.int64), np.full(shape, -np.inf), np.full(shape, np.inf)
        self.share = np.ones(shape)
        for k, (_, path) in enumerate(leaves):
            for j, (f, (lo, hi, z)) in enumerate(path.items()):
                self.slot[k, j], self.low[k, j], self.high[k, j], self.share[k, j] = f, lo, hi, z
        self.leaf_value = self.weight * self.value[[node for node, _ in leaves]]
        self.base = float((self.share.prod(1) * self.leaf_value).sum())
        x, w = np.polynomial.legendre.leggauss((d + 1) // 2)
        self.points, self.point_weights = (x + 1) / 2, w / 2
        # Slots ordered by feature, and where each feature begins.
        flat = self.slot.ravel()
        self.order = np.argsort(flat, kind="stable")
        self.used, self.starts = np.unique(flat[self.order], return_index=True)

    @property
    def features(self) -> set[int]:
        return set(self.feature[self.feature >= 0].tolist())

    def output(self, x: np.ndarray) -> np.ndarray:
        """Weighted prediction of each row."""
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.weight * self.value[at]
            goes_left = x[rows, np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)

    def _leaf_attributions(self, inside: np.ndarray) -> np.ndarray:
        """Attributions of each leaf's slots (... x leaves x slots) where ``inside`` says which of its intervals hold the values."""
        total = np.zeros(inside.shape)
        for u, w in zip(self.points, self.point_weights, strict=True):
            factor = self.share * (1 - u) + inside * u
            total += w * factor.prod(-1)[..., None] / factor
        return total * ((inside - self.share) * self.leaf_value[:, None])

    @cached_property
    def _by_pattern(self) -> np.ndarray:
        """``_leaf_attributions`` of every pattern of held intervals (bit j: slot j), for short paths."""
        d = self.slot.shape[1]
        bits = (np.arange(2 ** d)[:, None] >> np.arange(d)) & 1
        return self._leaf_attributions(np.repeat(bits[:, None, :].astype(float), len(self.slot), axis=1)).reshape(-1, d)

    def add_attributions(self, x: np.ndarray, out: np.ndarray) -> None:
        """Add each row's attributions (rows x features) to ``out``."""
        n, d = self.slot.shape
        own = x[:, self.slot]
        inside = (own > self.low) & (own <= self.high)
        if d <= SHORT:
            total = self._by_pattern[(inside @ (1 << np.arange(d))) * n + np.arange(n)]
        else:
            total = self._leaf_attributions(inside.astype(float))
        out[:, self.used] += np.add.reduceat(total.reshape(len(x), -1)[:, self.order], self.starts, axis=1)


def ensemble(nodes: DataFrame) -> list[Tree]:
    """The trees of a ``node_table``, as arrays (the size of the model, which its driver holds anyway)."""
    rows = nodes.orderBy("tree", "id").toPandas()
    trees = []
    for _, t in rows.groupby("tree", sort=True):
        at = np.full(int(t["id"].max()) + 1, -1)
        at[t["id"].to_numpy()] = np.arange(len(t))
        child = lambda c, t=t, at=at: np.where(t[c].isna(), 0, at[t[c].fillna(0).astype(int).to_numpy()])
        trees.append(Tree(float(t["weight"].iloc[0]), t["value"].to_numpy(float), t["feature"].fillna(-1).astype(int).to_numpy(),
                          t["threshold"].to_numpy(float), child("left"), child("right"), t["cover"].to_numpy(float)))
    return trees


def attributions(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    out = np.zeros(x.shape)
    for tree in trees:
        for at in range(0, len(x), ROWS):
            tree.add_attributions(x[at:at + ROWS], out[at:at + ROWS])
    return out


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names]).astype(float)


def _model_trees(model: FittedModel) -> list[Tree]:
    regressor = model.pipeline.stages[-1]
    if not hasattr(regressor, "treeWeights"):
        raise TypeError("the model is not a tree ensemble")
    return ensemble(node_table(SparkSession.getActiveSession(), regressor))


def attributed(rows: DataFrame, trees: list[Tree], names: list[str], id_col: str) -> DataFrame:
    """Per row of ``rows`` (``id_col`` and the features ``names``): ``base_value``, ``raw_output`` and ``attributions``."""
    base = sum(t.base for t in trees)
    schema = f"{id_col} {rows.schema[id_col].dataType.simpleString()}, raw_output double, attributions array<double>"

    def explain(batches: Iterator[pa.RecordBatch], part: list[Tree]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b, names)
            phi = attributions(part, x)
            ends = np.arange(0, phi.size + 1, len(names), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(sum(t.output(x) for t in part), pa.float64()),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(phi.ravel()))], [id_col, "raw_output", "attributions"])

    needed = rows.select(id_col, *names)
    parts = [needed.mapInArrow(lambda batches, part=trees[at:at + CHUNK]: explain(batches, part), schema) for at in range(0, len(trees), CHUNK)]
    out = parts[0]
    for p in parts[1:]:  # a chunk of trees adds its outputs and attributions
        out = out.unionByName(p)
    if len(parts) > 1:
        one = out.groupBy(id_col).agg(F.sum("raw_output").alias("raw_output"), F.collect_list("attributions").alias("a"))
        out = one.withColumn("attributions", F.aggregate("a", F.array_repeat(F.lit(0.0), len(names)), lambda s, a: F.zip_with(s, a, lambda p, q: p + q)))
    return out.select(id_col, F.lit(base).alias("base_value"), "raw_output", "attributions")


def tree_attribution(model: FittedModel, df: DataFrame, cfg: JobConfig) -> DataFrame:
    """M20 for a tree ensemble, every row: the id, ``base_value``, ``raw_output`` (on the model's own scale) and
    ``attributions``, one for each of ``model.feature_names``; the attributions and the base sum to the output."""
    encoded = model.pipeline.stages[0].transform(df)
    return attributed(encoded, _model_trees(model), model.feature_names, cfg.id_column)


def tree_of_splits(rows: DataFrame, splits: tuple | None, names: list[str], target: str) -> Tree:
    """A regression tree with given splits, ``(feature, threshold, left, right)`` or None for a leaf: covers and means of
    the leaves from one aggregate over ``rows`` without nulls in ``names``."""
    nodes, where = [], []

    def grow(split, path):
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0])
        if split is None:
            where.append((at, path))
            return at
        f, t, left, right = split
        inside = F.col(f) <= F.lit(float(t))
        nodes[at] = [names.index(f), float(t), grow(left, path & inside), grow(right, path & ~inside)]
        return at

    grow(splits, F.lit(True))
    one = rows.agg(*[a for k, (_, path) in enumerate(where) for a in (F.count_if(path).alias(f"n{k}"), F.avg(F.when(path, F.col(target))).alias(f"v{k}"))]).first()
    cover, value = np.zeros(len(nodes)), np.zeros(len(nodes))
    for k, (at, _) in enumerate(where):
        cover[at], value[at] = one[f"n{k}"], one[f"v{k}"] or 0.0
    for at in range(len(nodes) - 1, -1, -1):  # children come after their parent
        if nodes[at][0] >= 0:
            cover[at] = cover[nodes[at][2]] + cover[nodes[at][3]]
    feature, threshold, left, right = (np.array(c) for c in zip(*nodes, strict=True))
    return Tree(1.0, value, feature.astype(int), threshold.astype(float), left.astype(int), right.astype(int), cover)


def named_attributions(attributed_rows: DataFrame, names: list[str], id_col: str, unused: list[str] | tuple = ()) -> DataFrame:
    """Long form of ``attributed``: id, ``feature``, ``attribution``; ``unused`` features get 0."""
    named = F.zip_with(F.lit(names), "attributions", lambda n, a: F.struct(n.alias("feature"), a.alias("attribution")))
    none = [F.struct(F.lit(n).alias("feature"), F.lit(0.0).alias("attribution")) for n in unused]
    return attributed_rows.select(id_col, F.inline(F.concat(named, F.array(*none)) if none else named))


def permutation_importance_trees(model: FittedModel, df: DataFrame, cfg: JobConfig, repeats: int = PERMUTATION_REPEATS,
                                 seed: int = 42) -> DataFrame:
    """M18 for a tree ensemble: increase in MAE on the model's scale when a feature is permuted, mean and population
    std over repeats.

    Each row meets, on position, the row whose values it borrows.  A permuted feature changes only the trees that
    split on it, so just those are walked again and their difference is added; no row is copied, and
    a task hands on one sum for each feature.
    """
    trees, names = _model_trees(model), model.feature_names
    splitting = {i: [k for k, t in enumerate(trees) if i in t.features] for i in range(len(names))}
    touched = sorted(i for i, ks in splitting.items() if ks)
    used = [names[i] for i in touched]
    held = held_features(model)

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, plain, changed = 0, 0.0, np.zeros(len(touched))
        for b in batches:
            y = b.column("__y").to_numpy(zero_copy_only=False)
            x, donor = (matrix(columns_of(b, p, held), held, len(names)) for p in "od")
            own = [t.output(x) for t in trees]
            raw = np.sum(own, axis=0)
            n, plain = n + len(y), plain + np.abs(y - raw).sum()
            for j, i in enumerate(touched):
                kept = x[:, i].copy()
                x[:, i] = donor[:, i]
                at = np.nonzero(x[:, i] != kept)[0]  # rows that borrow the value they have keep their error
                again = raw[at] + sum(trees[k].output(x[at]) - own[k][at] for k in splitting[i])
                x[:, i] = kept
                changed[j] += (np.abs(y[at] - again) - np.abs(y[at] - raw[at])).sum()
        if n:
            if np.isnan(plain):  # no increase without the errors of all rows
                changed[:] = np.nan
            yield pa.RecordBatch.from_pydict({"feature": used, "n": [n] * len(used), "gain": changed.tolist()},
                                             pa.schema([("feature", pa.string()), ("n", pa.int64()), ("gain", pa.float64())]))

    increases = []
    for r, rows in enumerate(permuted_pairs(model, df, cfg, repeats, seed) if touched else ()):
        sums = rows.mapInArrow(errors, "feature string, n long, gain double").groupBy("feature").agg(F.sum("gain").alias("gain"), F.sum("n").alias("n"))
        increases += [(r, f["feature"], f["gain"] / f["n"]) for f in sums.collect()]
    # Features that no tree splits on change no prediction.
    increases += [(0, n, 0.0) for n in [*names, *model.constant_features] if n not in set(used)]
    return importance_of(increases, df.sparkSession)
