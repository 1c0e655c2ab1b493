"""Exact quantiles of many columns over many expanding windows, without a copy of a row for each window.

Rows carry a segment number, a window is all segments before a border.  Sketches of each column give ``BUCKETS``
cut points; one pass counts values by (column, segment, bucket), and sums over the first segments are any
window's counts, so the bucket of any rank in any window is known on the driver (columns x segments x buckets
numbers, whatever the number of rows).  A second pass hands on only values in those buckets, and a running
count over a bucket's distinct values finds the two values around each rank, interpolated as in ``quantiles``.
Cut points decide only how much the second pass hands on, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlab.operators.quantiles import interpolated_counts

BUCKETS = 256


def _values(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(float)


class PrefixQuantiles:
    """Quantiles of ``columns`` (doubles; null and NaN are no values) of ``rows`` by segment borders."""

    def __init__(self, rows: DataFrame, columns: list[str], segment: str):
        self.columns, self.segment = columns, segment
        self.rows = rows.select(F.col(segment).cast("int").alias("s"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
        shares = ", ".join(f"{k / BUCKETS}D" for k in range(1, BUCKETS))
        sketch = "percentile_approx(CASE WHEN NOT isnan({0}) THEN {0} END, array({1}), {2})"  # one text: quick to plan
        row = self.rows.agg(*[F.expr(sketch.format(f"c{i}", shares, 4 * BUCKETS)).alias(f"c{i}") for i in range(len(columns))]).first()
        # Bucket k holds the values above cut k - 1, up to cut k.
        self.cuts = [np.unique(row[f"c{i}"] or []) for i in range(len(columns))]
        cuts, n_columns = self.cuts, len(columns)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for b in batches:
                segments = np.asarray(b.column("s"))
                for s in np.unique(segments):
                    own = segments == s
                    total[int(s), -1] = total.get((int(s), -1), 0) + np.array([own.sum()])
                    for i in range(n_columns):
                        x = _values(b, f"c{i}")[own]
                        found = np.bincount(np.searchsorted(cuts[i], x[~np.isnan(x)]), minlength=len(cuts[i]) + 1)
                        total[int(s), i] = total.get((int(s), i), 0) + found
            for (s, i), n in total.items():
                at = np.nonzero(n)[0]
                yield pa.RecordBatch.from_pydict({"s": pa.array(np.full(len(at), s), pa.int32()), "i": pa.array(np.full(len(at), i), pa.int32()),
                                                  "k": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})

        counts = self.rows.mapInArrow(count, "s int, i int, k int, n long").groupBy("s", "i", "k").agg(F.sum("n").alias("n")).toArrow()
        s, i, k, n = (np.asarray(counts.column(c)) for c in ("s", "i", "k", "n"))
        self.n_segments = int(s.max()) + 1 if len(s) else 0
        self.sizes = np.zeros(self.n_segments, np.int64)
        self.counts = [np.zeros((self.n_segments, len(c) + 1), np.int64) for c in cuts]
        self.sizes[s[i < 0]] = n[i < 0]
        for j in range(n_columns):
            own = i == j
            self.counts[j][s[own], k[own]] = n[own]

    def n_rows(self, until: int) -> int:
        return int(self.sizes[:until].sum())

    def n_values(self, column: str, until: int) -> int:
        return int(self.counts[self.columns.index(column)][:until].sum())

    def quantiles(self, wanted: dict[tuple[str, int], list[float]], extra: dict[tuple[str, int], tuple[float, int]] | None = None) -> dict:
        """(column, until) -> quantiles at the given probabilities over the segments before ``until``, None without values;
        ``extra`` adds a value so many times to a window."""
        extra = extra or {}
        probs = sorted({p for ps in wanted.values() for p in ps})
        targets, inside = [], {}
        for w, ((column, until), ps) in enumerate(wanted.items()):
            i = self.columns.index(column)
            held = self.counts[i][:until].sum(0)
            value, times = extra.get((column, until), (0.0, 0))
            if times:
                held[np.searchsorted(self.cuts[i], value)] += times
            total = int(held.sum())
            upto = np.cumsum(held)
            for p in ps if total else []:
                h = (total - 1) * p
                low, high = (int(np.searchsorted(upto, np.floor(h) + 1)), int(np.searchsorted(upto, np.ceil(h) + 1)))
                targets.append((w, probs.index(p), i, until, low, high, int(upto[low] - held[low]), total))
                inside.setdefault(i, set()).update(range(low, high + 1))
                if times and low <= np.searchsorted(self.cuts[i], value) <= high:
                    targets[-1] += (float(value), times)
        if not targets:
            return dict.fromkeys(wanted)
        cuts, chosen = self.cuts, {i: np.array(sorted(ks)) for i, ks in inside.items()}

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                segments = np.asarray(b.column("s"))
                for i, ks in chosen.items():
                    x = _values(b, f"c{i}")
                    k = np.where(np.isnan(x), -1, np.searchsorted(cuts[i], x))
                    at = np.nonzero(np.isin(k, ks))[0]
                    yield pa.RecordBatch.from_pydict({"i": pa.array(np.full(len(at), i), pa.int32()), "k": pa.array(k[at], pa.int32()),
                                                      "s": pa.array(segments[at], pa.int32()), "x": pa.array(x[at])})

        spark = self.rows.sparkSession
        known = spark.createDataFrame([t[:8] for t in targets], "w int, __i int, i int, until int, low int, high int, below long, __n long")
        held = self.rows.mapInArrow(pick, "i int, k int, s int, x double").groupBy("i", "k", "s", "x").agg(F.count(F.lit(1)).alias("c"))
        # A row for each target: windows x probabilities.
        met = held.join(F.broadcast(known), "i").filter("k >= low AND k <= high AND s < until")
        rows = met.select("w", "__i", F.col("x").alias("__x"), F.col("c").alias("__c"), "__n")
        first = known.filter("below > 0").select("w", "__i", F.lit(None).cast("double").alias("__x"), F.col("below").alias("__c"), "__n")
        rows = rows.unionByName(first)
        added = [(t[0], t[1], t[8], t[9], t[7]) for t in targets if len(t) > 8]
        if added:
            rows = rows.unionByName(spark.createDataFrame(added, "w int, __i int, __x double, __c long, __n long"))
        rows = rows.groupBy("w", "__i", "__x", "__n").agg(F.sum("__c").alias("__c"))
        found = {(r["w"], r["__i"]): r["__q"] for r in interpolated_counts(rows, ["w"], probs).collect()}
        return {key: [found[w, probs.index(p)] for p in ps] if (w, probs.index(ps[0])) in found else None for w, (key, ps) in enumerate(wanted.items())}
