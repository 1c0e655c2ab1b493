"""Pairwise-complete correlations of any number of columns in one scan.

Every task keeps, for each pair of columns, the number of rows that have both, the two means, variances (sums of squares about
the mean) and the covariance over just those rows.  A batch gives them as products of masked matrices; two sets
are merged by the parallel formula for co-moments, so nothing is summed about a distant origin.  A task hands on blocks of
``BLOCK`` left columns; blocks are merged in two steps (``FAN`` groups of tasks, then those), whatever the number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, FAN = 64, 32
_STATE = "block int, fan int, state binary"


def _batch_state(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For columns of ``x`` (left) and ``y`` (right): n, mean of x, of y, squares of x, of y, and the products, over complete pairs."""
    mx, my = ~np.isnan(x), ~np.isnan(y)
    about = lambda v, m: np.where(m, v, 0.0).sum(0) / np.maximum(m.sum(0), 1)
    ax, ay = about(x, mx), about(y, my)
    xs, ys = np.where(mx, x - ax, 0.0), np.where(my, y - ay, 0.0)
    fx, fy = mx.astype(float), my.astype(float)
    n = fx.T @ fy
    sx, sy = xs.T @ fy, fx.T @ ys
    d = np.maximum(n, 1)
    return np.stack([n, sx / d + ax[:, None], sy / d + ay[None, :], (xs * xs).T @ fy - sx * sx / d, fx.T @ (ys * ys) - sy * sy / d, xs.T @ ys - sx * sy / d])


def _merged(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    if a is None:
        return b
    n = a[0] + b[0]
    d = np.maximum(n, 1)
    dx, dy, w = b[1] - a[1], b[2] - a[2], a[0] * b[0] / d
    # A side without rows has no mean of its own.
    dx, dy = np.where(w > 0, dx, 0.0), np.where(w > 0, dy, 0.0)
    take = a[0] == 0
    return np.stack([n, np.where(take, b[1], a[1] + dx * b[0] / d), np.where(take, b[2], a[2] + dy * b[0] / d),
                     a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w, a[5] + b[5] + dx * dy * w])


def pair_correlations(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """``feature_a`` (of ``left``), ``feature_b`` (of ``right``), ``n`` (rows that have both) and ``corr``: Pearson's, null where a side is
    constant or ``n`` is under 2.  NULL and NaN are missing."""
    names = list(dict.fromkeys([*left, *right]))
    at_left, at_right = [names.index(c) for c in left], [names.index(c) for c in right]
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(names))])
            total = _merged(total, _batch_state(x[:, at_left], x[:, at_right]))
        if total is not None:
            fan = TaskContext.get().partitionId() % FAN
            for k in range(0, len(left), BLOCK):
                yield pa.RecordBatch.from_pydict({"block": pa.array([k // BLOCK], pa.int32()), "fan": pa.array([fan], pa.int32()),
                                                  "state": pa.array([total[:, k:k + BLOCK].tobytes()], pa.binary())})

    def state(raw: bytes) -> np.ndarray:
        return np.frombuffer(raw).reshape(6, -1, len(right))

    def merge(table: pa.Table) -> pa.Table:
        total = None
        for raw in table.column("state"):
            total = _merged(total, state(raw.as_py()))
        return pa.table({"block": table.column("block")[:1], "fan": table.column("fan")[:1], "state": pa.array([total.tobytes()], pa.binary())})

    def finish(table: pa.Table) -> pa.Table:
        s = state(merge(table).column("state")[0].as_py())
        first = table.column("block")[0].as_py() * BLOCK
        i, j = np.indices(s.shape[1:])
        scale = np.sqrt(np.maximum(s[3], 0) * np.maximum(s[4], 0))
        good = (s[0] > 1) & (scale > 0)
        corr = np.where(good, s[5] / np.where(good, scale, 1.0), np.nan).ravel()
        return pa.table({"feature_a": pa.array([left[first + k] for k in i.ravel()]), "feature_b": pa.array([right[k] for k in j.ravel()]),
                         "n": pa.array(s[0].ravel().astype(np.int64)), "corr": pa.array(corr, mask=~good.ravel())})

    parts = rows.mapInArrow(gather, _STATE)
    some = parts.groupBy("block", "fan").applyInArrow(merge, _STATE)
    return some.groupBy("block").applyInArrow(finish, "feature_a string, feature_b string, n long, corr double")
