"""Exact, interpolated quantiles without gathering or sorting a group's values.

One method at every size:

1. a sketch (``percentile_approx``) per group brackets every target rank.  Its rank error is
   at most ``n / ACCURACY``, and the bracket reaches three times that to each side, so the
   target lies inside; a group of at most ``ACCURACY`` values is its own bracket;
2. one map-side combined aggregate counts, per target, the values below the bracket (one
   row) and each distinct value inside it (a few in ten thousand of the values);
3. a running count over those rows finds the two values around ``h = (n - 1) q``, and
   ``v[lo] + (h - lo) (v[hi] - v[lo])`` equals linear-interpolation quantiles (numpy's
   default, DuckDB's ``quantile_cont``).

No step depends on row order, on one plan node being shared by several branches, or on a session
setting.  A group's values meet in one task only inside the bracket: about
``8 / ACCURACY`` of them (8 million numbers for 10^10 rows in one group, in a spilling sort).
(whole columns: a few thousandths, see ``column_quantiles``).  The sketch table is written first, so the planner broadcasts it by its real size, and a hot
group is split by AQE otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlab.operators.lookup import written

ACCURACY = 10_000
REACH = 3.0
# Values of a column sorted at once, sorted blocks a task holds, and intervals kept of a block and of a task.
BLOCK = 1 << 17
BLOCKS = 64
INTERVALS = 2_000


def _value(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def _valid(v: Column) -> Column:
    """NULL and NaN are no values."""
    return F.when(v.isNotNull() & ~F.isnan(v), v)


def _ends(probs: list[float]) -> tuple[list[float], list[float]]:
    reach = REACH / ACCURACY
    return [max(p - reach, 0.0) for p in probs], [min(p + reach, 1.0) for p in probs]


def _bracket(v: Column, probs: list[float]) -> list[Column]:
    lows, highs = _ends(probs)
    return [F.count(v).alias("__n"), F.percentile_approx(v, [*lows, *highs], ACCURACY).alias("__ends")]


def interpolated_counts(counts: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """``counts``: per (keys, __i) rows ``__x`` (NULL: all values below the bracket), ``__c`` of them,
    ``__n`` values in the group.  Returns ``keys, __i, __q``."""
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__i") + 1)
    seen = F.sum("__c").over(Window.partitionBy(*keys, "__i").orderBy(F.col("__x").asc_nulls_first())
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumn("__to", seen).withColumn("__h", (F.col("__n") - 1) * prob)
    lo, hi = F.floor("__h"), F.ceil("__h")
    at = lambda rank: F.max(F.when((rank >= F.col("__to") - F.col("__c")) & (rank < F.col("__to")), F.col("__x")))
    pair = ranked.groupBy(*keys, "__i").agg(at(lo).alias("__a"), at(hi).alias("__b"), F.max(F.col("__h") - lo).alias("__w"))
    outside = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    value = F.col("__a") + F.col("__w") * (F.col("__b") - F.col("__a"))
    return pair.select(*keys, "__i", F.when(F.col("__a").isNull() | F.col("__b").isNull(), outside)
                       .when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise(value).alias("__q"))


def exact_quantiles(df: DataFrame, value: str | Column, probs: list[float], keys: list[str] | tuple = (),
                    names: list[str] | None = None) -> DataFrame:
    """One row per group (``keys``; none for a global result) with one column per probability.

    NULL / NaN values are ignored, and so are rows whose group key is NULL
    (like pandas' ``groupby``); a group without values is absent.
    """
    names = names or [f"q{i}" for i in range(len(probs))]
    by = list(keys) or ["__all"]
    base = df if keys else df.withColumn("__all", F.lit(0))
    base = base.select(*by, _valid(_value(value)).alias("__v")).filter(F.col("__v").isNotNull())
    for k in by:
        base = base.filter(F.col(k).isNotNull())
    sketch = written(base.groupBy(*by).agg(*_bracket(F.col("__v"), probs)))
    own = base.join(sketch, by)
    lows, highs = _ends(probs)
    whole, v = F.col("__n") <= ACCURACY, F.col("__v")
    entries = []
    for i, (low, high) in enumerate(zip(lows, highs, strict=True)):
        below = F.lit(False) if low == 0.0 else ~whole & (v < F.col("__ends")[i])
        above = F.lit(False) if high == 1.0 else ~whole & (v > F.col("__ends")[len(probs) + i])
        entries.append(F.when(~above, F.struct(F.lit(i).alias("__i"), F.when(~below, v).alias("__x"))))
    rows = own.select(*by, "__n", F.explode(F.array_compact(F.array(*entries))).alias("__e"))
    counts = rows.groupBy(*by, F.col("__e.__i").alias("__i"), F.col("__e.__x").alias("__x")).agg(
        F.count(F.lit(1)).alias("__c"), F.max("__n").alias("__n"))
    found = interpolated_counts(counts, by, probs)
    wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(n) for i, n in enumerate(names)])
    return wide.select(*keys, *names)


def exact_median(df: DataFrame, value: str | Column, keys: list[str] | tuple = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], keys, [name])


def quantile_values(df: DataFrame, value: str | Column, probs: list[float]) -> list[float | None]:
    """Global quantiles as Python floats (one small result row)."""
    found = column_quantiles(df.select(_value(value).alias("__x")), ["__x"], probs)["__x"]
    return found if found is not None else [None] * len(probs)


def group_medians(df: DataFrame, keys: list[str], values: dict[str, str | Column], probs: float = 0.5) -> DataFrame:
    """Exact quantile of several value columns per group at once: the columns are
    stacked into ``(keys, metric, value)`` rows and ``metric`` becomes part of the group key.
    Returns ``keys + list(values)`` columns (NULL groups dropped)."""
    if len(values) == 1:
        (name, v), = values.items()
        return exact_quantiles(df, v, [probs], keys, [name])
    stacked = df.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(name).alias("__metric"), _value(v).alias("__val")) for name, v in values.items()])))
    q = exact_quantiles(stacked, "__val", [probs], [*keys, "__metric"], ["__q"])
    return q.groupBy(*keys).pivot("__metric", list(values)).agg(F.first("__q"))


def with_medians(agg: DataFrame, df: DataFrame, keys: list[str], values: dict[str, str | Column]) -> DataFrame:
    """Attach exact per-group medians (``values``: output name -> column) to an aggregate on ``keys``."""
    if not keys:
        raise ValueError("with_medians needs group keys; use quantile_values for global medians")
    return agg.join(group_medians(df, keys, values), keys, "left")


def _bracket_counts(values: DataFrame, targets: list[tuple[int, int, float, float]]) -> DataFrame:
    """Per target (``__f``: place of its column in ``values``, ``__i``): distinct values ``__x`` from its low to its high end
    with their counts ``__c``, and one row with ``__x`` NULL for the values below, if any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("__f", pa.int32()), ("__i", pa.int32()), ("__x", pa.float64()), ("__c", pa.int64())])
        under = np.zeros(len(targets), np.int64)
        for b in batches:
            out = []
            for k, (c, i, low, high) in enumerate(targets):
                x = b.column(c).to_numpy(zero_copy_only=False).astype(float)
                under[k] += np.count_nonzero(x < low)
                found, times = np.unique(x[(x >= low) & (x <= high)], return_counts=True)  # NaN (no value) is in no bracket
                out.append((np.full(len(found), c), np.full(len(found), i), found, times))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), f.type) for a, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        at = np.nonzero(under)[0].tolist()
        yield pa.RecordBatch.from_arrays([pa.array([targets[k][0] for k in at], pa.int32()), pa.array([targets[k][1] for k in at], pa.int32()),
                                          pa.nulls(len(at), pa.float64()), pa.array(under[at], pa.int64())], schema=schema)

    found = values.mapInArrow(count, "__f int, __i int, __x double, __c long")
    return found.groupBy("__f", "__i", "__x").agg(F.sum("__c").alias("__c"))


def _condensed(low: np.ndarray, high: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals (``times`` values from ``low`` to ``high``) in the order of their low ends, neighbours joined until about
    ``INTERVALS`` are left; one that holds that share by itself stays alone."""
    order = np.lexsort((high, low))
    low, high, times = low[order], high[order], times[order]
    size = max(times.sum() / INTERVALS, 1.0)
    place = (np.cumsum(times) - times) // size
    full = times >= size
    starts = np.nonzero(np.concatenate([[True], (place[1:] != place[:-1]) | full[1:] | full[:-1]]))[0]
    return low[starts], np.maximum.reduceat(high, starts), np.add.reduceat(times, starts)


class _Summary:
    """Intervals of one column's values in a task, sorted ``BLOCK`` values at a time."""

    def __init__(self):
        self.waiting, self.n_waiting, self.parts = [], 0, []

    def add(self, x: np.ndarray) -> None:
        self.waiting.append(x)
        self.n_waiting += len(x)
        if self.n_waiting >= BLOCK:
            self.sort()

    def sort(self) -> None:
        if self.n_waiting:
            found, times = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.parts.append(_condensed(found, found, times))
            self.waiting, self.n_waiting = [], 0
        if len(self.parts) == BLOCKS:
            self.parts = [self.joined()]

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _condensed(*[np.concatenate(a) for a in zip(*self.parts, strict=True)])


def _sure_ends(low: np.ndarray, high: np.ndarray, times: np.ndarray, probs: list[float]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of values in intervals, and per probability two ends that hold the two values around its rank: at most the
    values of intervals with a low end under x are less than x, at least those of intervals with a high end up to x are not above x."""
    n = int(times.sum())
    up, down = np.argsort(low, kind="stable"), np.argsort(high, kind="stable")
    below, reached = np.cumsum(times[up]) - times[up], np.cumsum(times[down])
    rank = (n - 1) * np.array(probs, float)
    first = low[up][np.searchsorted(below, np.floor(rank), side="right") - 1]
    last = high[down][np.searchsorted(reached, np.ceil(rank) + 1, side="left")]
    return n, first, last


def _brackets(values: DataFrame, probs: list[float]) -> list[tuple[int, int, float, float, int]]:
    """Per column (its place in ``values``) and probability: ends between which the two values around its rank lie, and the
    column's number of values.  Columns without values are absent.  A task hands on some ``INTERVALS`` intervals a column, and
    a column's intervals meet in one task.
    """
    columns = range(len(values.columns))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_Summary() for _ in columns]
        for b in batches:
            for c in columns:
                x = b.column(c).to_numpy(zero_copy_only=False).astype(float)
                found[c].add(x[~np.isnan(x)])
        for c in columns:
            found[c].sort()
            if found[c].parts:
                low, high, times = found[c].joined()
                yield pa.RecordBatch.from_pydict({"__f": pa.array(np.full(len(low), c), pa.int32()), "__low": pa.array(low),
                                                  "__high": pa.array(high), "__c": pa.array(times, pa.int64())})

    def bracket(t: pa.Table) -> pa.Table:
        n, first, last = _sure_ends(*[t.column(c).to_numpy() for c in ("__low", "__high", "__c")], probs)
        k = len(probs)
        return pa.table({"__f": pa.array(np.full(k, t.column("__f")[0].as_py()), pa.int32()), "__i": pa.array(np.arange(k), pa.int32()),
                         "__low": pa.array(first), "__high": pa.array(last), "__n": pa.array(np.full(k, n), pa.int64())})

    intervals = values.mapInArrow(summarise, "__f int, __low double, __high double, __c long")
    found = intervals.groupBy("__f").applyInArrow(bracket, "__f int, __i int, __low double, __high double, __n long")
    return sorted(tuple(r) for r in found.collect())  # columns x probabilities rows


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns (no groups), as a dict; None for a column without values.

    The same three steps, but the brackets come from interval counts (``_brackets``): merging sketches of all columns and
    tasks would be one task's work.  Then one pass counts the values below each bracket and the distinct values
    inside, batch by batch (``_bracket_counts``).
    """
    if not cols:
        return {}
    values = df.select(*[_valid(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    found = _brackets(values, probs)
    out: dict[str, list[float | None]] = dict.fromkeys(cols)
    if not found:
        return out
    n_values = {c: n for c, _, _, _, n in found}
    sizes = F.array(*[F.lit(n_values.get(k, 0)).cast("long") for k in range(len(cols))])
    counts = _bracket_counts(values, [r[:4] for r in found]).withColumn("__n", F.get(sizes, F.col("__f")))
    out |= {cols[c]: [None] * len(probs) for c in n_values}
    for r in interpolated_counts(counts, ["__f"], probs).collect():  # columns x probabilities rows
        out[cols[r["__f"]]][r["__i"]] = r["__q"]
    return out
