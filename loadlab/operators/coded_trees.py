"""Boosted regression trees on coded rows, for fits of many rows (M11 and what is made from its model).

The method and the resulting model are those of Spark's ``GBTRegressor``: candidate thresholds from a sample of rows, trees
grown level by level by the reduction of variance, each further tree fitted to twice the residuals.  Spark keeps a row as one
number per feature in the storage memory and adds to every feature's bin in every pass, three sums each; many rows fall out of memory
and are read from disk hundreds of times.  Here a row is one byte for each numeric feature (the number of thresholds
below its value) and one for each *categorical* (the value's place: all its one-hot features are read off it), and its
residual.  These lie in blocks in the shared folder, a pass reads them batch by batch, and a task hands on sums only.  After a
tree the blocks are written again with the new residuals and the old ones are removed.

With all rows as the sample, the model equals Spark's (pytest holds training predictions to 1e-9); of features that divide a node's rows
alike the first is named, while Spark's choice hangs on rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlab.operators.encode import FeatureEncoderModel, onehot_name, scaled_numerics
from loadlab.operators.lookup import discard, written

ROWS = 8192  # of a block
BATCH = 32  # blocks
SAMPLE = 10_000  # rows that thresholds are taken from, at least (as Spark takes)
DEEPEST = 10
EPSILON = 2.0 ** -52
BLOCKS = "n int, codes binary, residual binary"


def suits(reg) -> bool:
    """Whether a regressor's settings are those that ``fit`` knows."""
    if not isinstance(reg, GBTRegressor) or reg.isDefined(reg.weightCol) or reg.isDefined(reg.validationIndicatorCol):
        return False
    get = lambda name: reg.getOrDefault(name)
    return (get("subsamplingRate") == 1.0 and get("featureSubsetStrategy") == "all" and get("lossType") == "squared"
            and get("minWeightFractionPerNode") == 0.0 and get("maxDepth") <= DEEPEST)


@dataclass
class Coded:
    """A column of codes: the thresholds of a numeric ``feature``, or a categorical's features by code."""

    values: Column
    feature: int | None = None
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    indicators: dict[int, int] = field(default_factory=dict)  # feature by code

    @property
    def width(self) -> int:
        return max([len(self.thresholds), *self.indicators]) + 1


def coded_columns(encoder: FeatureEncoderModel, names: list[str]) -> list[Coded]:
    """Columns over built features that the features ``names`` of ``encoder`` are read off."""
    s, at = encoder.fitted, {n: i for i, n in enumerate(names)}
    plain = dict(zip(s["weight"] + s["other"], scaled_numerics(s), strict=True)) | {c: F.col(c) for c in s["binary"]}
    out = [Coded(column.cast("double"), at[n]) for n, column in plain.items() if n in at]
    for c in encoder.job_config().categorical:
        known, rare = s["vocab"][c], s["infrequent"].get(c)
        code = F.coalesce(F.array_position(F.lit(known), F.col(c)), F.lit(0)).cast("int") if known else F.lit(0)
        if rare:
            code = F.when(F.col(c).isin(rare), len(known) + 1).otherwise(code)
        own = {k + 1: onehot_name(c, v) for k, v in enumerate(known)} | {0: f"{c}_is_unknown"}
        if rare:
            own[len(known) + 1] = onehot_name(c, "infrequent_sklearn")
        if held := {k: at[n] for k, n in own.items() if n in at}:
            out.append(Coded(code, indicators=held))
    return out


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """Candidate thresholds of a numeric feature: half-way between neighbours of the sorted distinct ``values``, all of them or
    about ``most``, with equal numbers of values between (as Spark places them)."""
    found, times = np.unique(values, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) <= most:
        return middles
    stride = len(values) / (most + 1)
    chosen, target, count = [], stride, int(times[0])
    for k in range(1, len(found)):
        before, count = count, count + int(times[k])
        if abs(before - target) < abs(count - target):
            chosen.append(middles[k - 1])
            target += stride
    return np.array(chosen)


@dataclass
class Grown:
    """A tree being grown.  ``column`` and ``to`` (node x code) lead a row from node to node; a leaf leads to itself."""

    column: list[int] = field(default_factory=list)
    to: list[np.ndarray] = field(default_factory=list)
    stats: list[tuple] = field(default_factory=list)  # rows, sum, sum of squares
    split: list[tuple | None] = field(default_factory=list)  # feature, threshold, gain, left, right

    def add(self, width: int, stats: tuple = (0, 0.0, 0.0)) -> int:
        node = len(self.column)
        self.column.append(0)
        self.to.append(np.full(width, node, np.int32))
        self.stats.append(stats)
        self.split.append(None)
        return node

    def value(self, node: int) -> float:
        n, total, _ = self.stats[node]
        return total / n

    def impurity(self, node: int) -> float:
        n, total, squares = self.stats[node]
        return (squares - total * total / n) / n


def _place(codes: np.ndarray, column: np.ndarray, to: np.ndarray, steps: int) -> np.ndarray:
    """The node that each row (a column of ``codes``) has come to after ``steps`` steps."""
    at = np.zeros(codes.shape[1], np.int32)
    rows = np.arange(codes.shape[1])
    for k in range(steps):
        own = codes[column[0]] if k == 0 else codes[column[at], rows]
        at = to[at, own]
    return at


def _blocks(batches: Iterator[pa.RecordBatch], columns: int, dtype: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in batches:
        for n, codes, residual in zip(*(b.column(k) for k in range(3)), strict=True):
            yield np.frombuffer(codes.as_buffer(), dtype).reshape(columns, n.as_py()), np.frombuffer(residual.as_buffer(), np.float64)


class _Fit:
    def __init__(self, reg: GBTRegressor, columns: list[Coded], built: DataFrame, label: str, n_rows: int):
        self.reg, self.columns, self.n_rows = reg, columns, n_rows
        self.least, self.least_gain = reg.getOrDefault("minInstancesPerNode"), reg.getOrDefault("minInfoGain")
        values = built.select(F.col(label).cast("double"), *[c.values.alias(f"c{j}") for j, c in enumerate(columns)])
        self._choose_thresholds(values)
        self.width = max((c.width for c in columns), default=1)
        self.dtype = np.dtype(np.uint8 if self.width <= 256 else np.uint16 if self.width <= 65536 else np.uint32)
        # Candidate splits in the order of features, then thresholds: column, code (the left side is up to it, or all but it), feature, threshold.
        one = [(c.feature, k, j, float(t), True) for j, c in enumerate(columns) for k, t in enumerate(c.thresholds)]
        one += [(f, code, j, 0.5, False) for j, c in enumerate(columns) for code, f in c.indicators.items()]
        self.candidates = sorted(one)
        self.blocks = self._coded(values)

    def _choose_thresholds(self, values: DataFrame) -> None:
        bins = min(self.reg.getOrDefault("maxBins"), self.n_rows)
        wanted = max(bins * bins, SAMPLE)
        few = values if wanted >= self.n_rows else values.sample(wanted / self.n_rows, seed=self.reg.getOrDefault("seed"))
        sample = few.select(*[f"c{j}" for j, c in enumerate(self.columns) if c.feature is not None]).toArrow()  # some 10,000 rows
        for c, x in zip([c for c in self.columns if c.feature is not None], sample.columns, strict=True):
            c.thresholds = thresholds(_numbers(x), bins - 1)

    def _coded(self, values: DataFrame) -> DataFrame:
        cuts, dtype = [None if c.feature is None else c.thresholds for c in self.columns], self.dtype

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                y = _numbers(b.column(0))
                codes = np.empty((len(cuts), len(y)), dtype)
                for j, cut in enumerate(cuts):
                    x = _numbers(b.column(j + 1))
                    codes[j] = x if cut is None else np.searchsorted(cut, x)
                yield _block(codes, y)

        return self._kept(values.mapInArrow(code, BLOCKS))

    @staticmethod
    def _kept(blocks: DataFrame) -> DataFrame:
        return written(blocks, "blocks", options={"compression": "zstd", "parquet.block.size": 32 << 20, "parquet.block.size.row.check.min": 10})

    def sums(self, tree: Grown, nodes: list[int], depth: int, scale: float, squares: bool) -> list[np.ndarray]:
        """By node of ``nodes``, column and code: number of rows, sum of the residuals (times ``scale``) and of their squares;
        without ``squares``, these by node only."""
        n_columns, dtype, width = len(self.columns), self.dtype, self.width
        column, to = np.array(tree.column), np.array(tree.to)
        slot = np.full(len(column), len(nodes))  # rows at leaves go to the last slot
        slot[nodes] = np.arange(len(nodes))
        size = (len(nodes) + 1) * width
        parts = 3 if squares else 2

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, plain = np.zeros((parts, n_columns, size)), np.zeros(len(nodes) + 1)
            for codes, residual in _blocks(batches, n_columns, dtype):
                own, y = slot[_place(codes, column, to, depth)], residual * scale
                plain += np.bincount(own, y * y, len(plain))
                first = own * width
                for j in range(n_columns):
                    key = first + codes[j]
                    total[0, j] += np.bincount(key, minlength=size)
                    total[1, j] += np.bincount(key, y, size)
                    if squares:
                        total[2, j] += np.bincount(key, y * y, size)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([plain.tobytes()], pa.binary())], ["total", "plain"])

        total, plain = np.zeros((parts, n_columns, len(nodes) + 1, width)), np.zeros(len(nodes) + 1)
        for r in self.blocks.mapInArrow(add, "total binary, plain binary").collect():  # nodes x columns x codes numbers a task
            total += np.frombuffer(r["total"]).reshape(total.shape)
            plain += np.frombuffer(r["plain"])
        return [*total[:, :, :-1], plain[:-1]]

    def tree(self, scale: float) -> Grown:
        tree, deepest = Grown(), self.reg.getOrDefault("maxDepth")
        active = [tree.add(self.width)]
        for depth in range(deepest + 1):
            if not active or depth == deepest and depth:
                break
            last = depth == deepest - 1
            found = self.sums(tree, active, depth, scale, last)
            count, total, plain = found[0], found[1], found[-1]
            best = self._best(count, total)
            following = []
            for k, node in enumerate(active):
                tree.stats[node] = (count[0, k].sum(), total[0, k].sum(), plain[k])
                if best is None or depth == deepest or not best[1][k] > 0 or depth and abs(tree.impurity(node)) < EPSILON:
                    continue
                feature, code, j, threshold, ordered = self.candidates[best[0][k]]
                left = np.arange(self.width) <= code if ordered else np.arange(self.width) != code
                side = lambda s, k=k, j=j: tuple(a[j, k][s].sum() for a in found[:3 if last else 2])
                children = [tree.add(self.width, side(s)) for s in (left, ~left)]
                tree.column[node], tree.to[node] = j, np.where(left, *children).astype(np.int32)
                tree.split[node] = (feature, threshold, float(best[1][k]), *children)
                following += children
            active = following
        return tree

    def _best(self, count: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Per node the first candidate of the largest gain, and the gain."""
        if not self.candidates:
            return None
        ends = [np.cumsum(a, axis=2) for a in (count, total)]
        n, s = (a[0, :, -1:] for a in ends)
        left = [np.stack([e[j][:, k] if ordered else e[j][:, -1] - a[j][:, k] for _, k, j, _, ordered in self.candidates], axis=1)
                for a, e in zip((count, total), ends, strict=True)]
        right = [n - left[0], s - left[1]]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[0] * right[0] / (n * n) * (left[1] / left[0] - right[1] / right[0]) ** 2
        held = (left[0] >= self.least) & (right[0] >= self.least) & (left[0] > 0) & (right[0] > 0) & (gain >= self.least_gain)
        gain = np.where(held, gain, -np.inf)
        at = gain.argmax(axis=1)
        return at, gain[np.arange(len(at)), at]

    def take(self, tree: Grown, weight: float) -> None:
        """Write the blocks again, less ``weight`` times the tree's values."""
        n_columns, dtype, steps = len(self.columns), self.dtype, self.reg.getOrDefault("maxDepth")
        column, to = np.array(tree.column), np.array(tree.to)
        value = weight * np.array([tree.value(k) for k in range(len(column))])

        def less(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for codes, residual in _blocks(batches, n_columns, dtype):
                yield _block(codes, residual - value[_place(codes, column, to, steps)])

        before, self.blocks = self.blocks, self._kept(self.blocks.mapInArrow(less, BLOCKS))
        discard(before)


def _numbers(x: pa.Array | pa.ChunkedArray) -> np.ndarray:
    out = np.asarray(x.to_numpy() if isinstance(x, pa.ChunkedArray) else x.to_numpy(zero_copy_only=False), float)
    if not np.isfinite(out).all():
        raise ValueError("labels and features of a fit must be finite numbers")
    return out


def _block(codes: np.ndarray, residual: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([len(residual)], pa.int32()), pa.array([codes.tobytes()], pa.binary()),
                                       pa.array([residual.tobytes()], pa.binary())], ["n", "codes", "residual"])


@contextmanager
def _settings(spark: SparkSession, values: dict[str, int]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _spark_tree(spark: SparkSession, tree: Grown, n_features: int):
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml

    def made(node: int):
        n, total, squares = (float(x) for x in tree.stats[node])
        stats = gateway.new_array(gateway.jvm.double, 3)
        stats[0], stats[1], stats[2] = n, total, squares
        known = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(n))
        value, impurity = tree.value(node), max(tree.impurity(node), 0.0)
        if tree.split[node] is None:
            return None, value, ml.tree.LeafNode(value, impurity, known)
        feature, threshold, gain, *children = tree.split[node]
        left, right = (made(c) for c in children)
        if left[0] is None and right[0] is None and left[1] == right[1]:  # leaves of one value are one leaf
            return None, value, ml.tree.LeafNode(value, impurity, known)
        split = ml.tree.ContinuousSplit(feature, threshold)
        return node, value, ml.tree.InternalNode(value, impurity, gain, left[2], right[2], split, known)

    return ml.regression.DecisionTreeRegressionModel(f"dtr_{id(tree)}", made(0)[2], n_features)


def fit(reg: GBTRegressor, encoder: FeatureEncoderModel, names: list[str], built: DataFrame, label: str, n_rows: int) -> GBTRegressionModel:
    """``reg`` fitted on the features ``names`` that ``encoder`` makes of ``built`` rows."""
    spark = built.sparkSession
    waves = 2 * spark.sparkContext.defaultParallelism
    with _settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": ROWS, "spark.sql.files.minPartitionNum": waves}):
        own = _Fit(reg, coded_columns(encoder, names), built, label, n_rows)
    rounds, step = reg.getOrDefault("maxIter"), reg.getOrDefault("stepSize")
    trees = []
    with _settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH, "spark.sql.parquet.columnarReaderBatchSize": BATCH,
                           "spark.sql.files.minPartitionNum": waves}):
        for k in range(rounds):
            trees.append(own.tree(2.0 if k else 1.0))
            if k < rounds - 1:
                own.take(trees[-1], step if k else 1.0)
    discard(own.blocks)
    gateway = spark.sparkContext._gateway
    made = gateway.new_array(spark.sparkContext._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for k, tree in enumerate(trees):
        made[k], weights[k] = _spark_tree(spark, tree, len(names)), step if k else 1.0
    model = GBTRegressionModel(spark.sparkContext._jvm.org.apache.spark.ml.regression.GBTRegressionModel(reg.uid, made, weights, len(names)))
    model._resetUid(reg.uid)
    return reg._copyValues(model)
