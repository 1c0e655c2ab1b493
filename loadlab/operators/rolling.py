"""Exact rolling medians over windows of any width (W4), without a frame of the window's rows anywhere.

Rows have a position (their order) and their values a rank.  The k-th smallest value of a window is found in two steps:

1. ranks are cut into buckets of ``BUCKET`` and positions into blocks of ``BLOCK``; counts per (block, bucket), summed over
   the blocks before, give the histogram of any whole-block range as a difference of two rows of sums.  A task
   takes one block of windows: the histogram between the blocks where its first window begins and ends, and the rows of the
   few blocks in which its windows begin and end.  It finds each window's bucket, and the rank wanted inside it;
2. a task takes the part of one bucket that a block of windows can reach, and the windows that ask it.

Both steps descend bit by bit through a wavelet matrix, for all windows of a task at once.  A task holds a few
blocks or one bucket, and one number for each bucket; rows are copied at most four times in step 1, and in step 2
only to blocks of windows that ask their bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlab.config import JobConfig
from loadlab.operators.lookup import written
from loadlab.operators.splits import with_position

BLOCK, BUCKET = 50_000, 500_000


class Wavelet:
    """Counts and order statistics of prefixes of a sequence of integers below ``2 ** bits``."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.zeros, self.ahead = bits, [], []
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit) & 1
            self.ahead.append(np.concatenate([[0], np.cumsum(one == 0)]))
            self.zeros.append(int((one == 0).sum()))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def zeros_before(self, level: int, at: np.ndarray) -> np.ndarray:
        return self.ahead[level][at]

    def step(self, level: int, at: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Where the boundary ``at`` lies one level down, on the side of the chosen bit."""
        z = self.ahead[level][at]
        return np.where(one, self.zeros[level] + at - z, z)


def kth_bucket(histogram: np.ndarray, enter: np.ndarray, entered: np.ndarray, leave: np.ndarray, left: np.ndarray, k: np.ndarray):
    """For each window (``histogram`` plus the first ``entered`` of ``enter`` less the first ``left`` of ``leave``):
    the bucket of its ``k``-th smallest member, and how many of the window's members in that bucket come before it."""
    bits = max(1, int(len(histogram) - 1).bit_length())
    upto = np.concatenate([[0], np.cumsum(histogram), np.full((1 << bits) - len(histogram), histogram.sum())])
    trees = [(Wavelet(enter, bits), 1), (Wavelet(leave, bits), -1)]
    ends = [(np.zeros(len(k), np.int64), entered), (np.zeros(len(k), np.int64), left)]
    prefix, k = np.zeros(len(k), np.int64), k.copy()
    for level in range(bits):
        half = 1 << (bits - 1 - level)
        zeros = upto[prefix + half] - upto[prefix]
        for (tree, sign), (a, b) in zip(trees, ends, strict=True):
            zeros = zeros + sign * (tree.zeros_before(level, b) - tree.zeros_before(level, a))
        one = k >= zeros
        k = np.where(one, k - zeros, k)
        prefix = np.where(one, prefix + half, prefix)
        ends = [(tree.step(level, a, one), tree.step(level, b, one)) for (tree, _), (a, b) in zip(trees, ends, strict=True)]
    return prefix, k


def kth_member(ranks: np.ndarray, start: np.ndarray, stop: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The ``k``-th smallest of ``ranks[start:stop]`` for each window."""
    bits = max(1, int(ranks.max()).bit_length())
    tree, out, k = Wavelet(ranks, bits), np.zeros(len(k), np.int64), k.copy()
    for level in range(bits):
        zeros = tree.zeros_before(level, stop) - tree.zeros_before(level, start)
        one = k >= zeros
        k = np.where(one, k - zeros, k)
        out = out * 2 + one
        start, stop = tree.step(level, start, one), tree.step(level, stop, one)
    return out


def _long(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def rolling_median_rows(positioned: DataFrame, value: str, before: int, after: int, least: int, block: int | None = None,
                          bucket: int | None = None) -> DataFrame:
    """``position, rolling_median`` of ``positioned`` (``position`` 0 to n - 1, ``value``): the median over the rows from
    ``before`` behind to ``after`` ahead, null where fewer than ``least`` of them have a value."""
    block, bucket = block or BLOCK, bucket or BUCKET
    rows = written(positioned.select("position", F.col(value).cast("double").alias("v")), "rolling")
    n = rows.count()
    held = rows.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    ranked = with_position(held.select(F.col("position").alias("p"), "v"), JobConfig(date_column="v", id_column="p"))
    members = written(ranked.select("p", "v", F.col("position").alias("rank"), F.floor(F.col("position") / bucket).alias("bucket"),
                                    F.floor(F.col("p") / block).alias("block")), "rolling-ranks")
    total = members.count()
    if not total:
        return rows.select("position", F.lit(None).cast("double").alias("rolling_median"))
    spark, n_blocks, n_buckets = rows.sparkSession, -(-n // block), -(-total // bucket)
    first = lambda q: (max(0, q * block - before) // block, min(n, q * block + after + 1) // block)

    # Members before each block, by bucket: a running sum over a full grid.
    counts = members.groupBy("block", "bucket").agg(F.count(F.lit(1)).alias("c"))
    grid = spark.range(n_blocks + 1).select(F.col("id").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1)).cast("array<long>")).alias("bucket"))
    earlier = Window.partitionBy("bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summed = written(grid.join(counts, ["block", "bucket"], "left").select(
        "block", "bucket", F.coalesce(F.sum(F.coalesce("c", F.lit(0))).over(earlier), F.lit(0)).alias("upto")), "rolling-sums")
    windows = lambda: spark.range(n_blocks).select(F.col("id").alias("q"))
    low = F.floor(F.greatest(F.lit(0), F.col("q") * block - before) / block)
    high = F.floor(F.least(F.lit(n), F.col("q") * block + after + 1) / block)
    at = lambda b, sign: windows().withColumn("block", b).join(summed, "block").select("q", "bucket", (F.col("upto") * sign).alias("h"))
    histograms = at(high, 1).unionByName(at(low, -1)).groupBy("q", "bucket").agg(F.sum("h").alias("h")).filter("h <> 0")
    # The blocks in which a block of windows begins (0) and ends (1).
    reached = windows().select("q", F.explode(F.array(*[F.struct((b + i).alias("block"), F.lit(side).alias("side")) for side, b in ((0, low), (1, high)) for i in (0, 1)])).alias("t"))
    border = reached.select("q", "t.*").join(members, "block").select("q", "side", "p", "bucket")

    def locate(key, borders: pa.Table, hist: pa.Table) -> pa.Table:
        q = key[0].as_py()
        p = np.arange(q * block, min(n, (q + 1) * block), dtype=np.int64)
        lo, hi = np.maximum(0, p - before), np.minimum(n, p + after + 1)
        h = np.zeros(n_buckets, np.int64)
        h[_long(hist, "bucket")] = _long(hist, "h")
        side, pos, buckets = _long(borders, "side"), _long(borders, "p"), _long(borders, "bucket")
        found = []
        for s, bound, start in ((1, hi, first(q)[1]), (0, lo, first(q)[0])):
            own = (side == s) & (pos >= start * block)
            order = np.argsort(pos[own], kind="stable")
            found += [buckets[own][order], np.searchsorted(pos[own][order], bound)]
        size = h.sum() + found[1] - found[3]
        enough = np.nonzero(size >= max(1, least))[0]
        out = []
        for k in ((size - 1) // 2, size // 2):
            b, inside = kth_bucket(h, found[0], found[1][enough], found[2], found[3][enough], k[enough])
            out.append((p[enough], b, inside))
        p, b, inside = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"q": np.full(len(p), q), "p": p, "bucket": b, "k": inside})

    asked = windows().join(border, "q", "left").groupBy("q").cogroup(histograms.groupBy("q"))
    asked = written(asked.applyInArrow(locate, "q long, p long, bucket long, k long"), "rolling-asked")

    def resolve(asks: pa.Table, own: pa.Table) -> pa.Table:
        p, v, rank = _long(own, "p"), own.column("v").to_numpy(), _long(own, "rank")
        order = np.argsort(p)
        p, v, rank = p[order], v[order], rank[order]
        by_rank = np.argsort(rank)
        local = np.empty(len(rank), np.int64)
        local[by_rank] = np.arange(len(rank))
        at = _long(asks, "p")
        start, stop = np.searchsorted(p, at - before), np.searchsorted(p, np.minimum(n, at + after + 1))
        return pa.table({"p": at, "x": v[by_rank][kth_member(local, start, stop, _long(asks, "k"))]})

    # Only the part of a bucket that the windows of block q can reach.
    pairs = asked.select(F.col("q").alias("q"), F.col("bucket").alias("bucket")).distinct()
    near = (F.col("p") >= F.col("q") * block - before) & (F.col("p") <= (F.col("q") + 1) * block + after)
    parts = members.join(pairs, "bucket").filter(near).select("q", "bucket", "p", "v", "rank")
    values = asked.groupBy("q", "bucket").cogroup(parts.groupBy("q", "bucket")).applyInArrow(resolve, "p long, x double")
    medians = values.groupBy("p").agg(F.avg("x").alias("rolling_median"))
    return rows.join(medians, F.col("position") == F.col("p"), "left").select("position", "rolling_median")
