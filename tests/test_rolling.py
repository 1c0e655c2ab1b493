"""Rolling medians against a plain sliding window."""

import numpy as np
import pytest

from loadlab.operators import rolling as RO


def _plain(v, before, after, least):
    out = []
    for p in range(len(v)):
        own = [x for x in v[max(0, p - before):p + after + 1] if x is not None and x == x]
        out.append(float(np.median(own)) if len(own) >= max(1, least) else None)
    return out


@pytest.mark.parametrize("n,before,after,block,bucket,kind", [
    (700, 25, 24, 50, 40, "plain"), (700, 25, 24, 64, 33, "gaps"), (300, 40, 39, 1000, 1000, "gaps"), (500, 3, 3, 7, 11, "ties"),
    (400, 90, 120, 30, 25, "sorted"), (40, 25, 24, 16, 9, "none"), (1, 25, 24, 16, 9, "plain")])
def test_rolling_median_equals_sliding(spark, n, before, after, block, bucket, kind):
    rng = np.random.default_rng(n)
    v = [float(x) for x in rng.normal(size=n)]
    if kind == "gaps":
        v = [None if rng.random() < 0.6 else x for x in v]
        v[100:180] = [float("nan")] * 80
    elif kind == "ties":
        v = [float(int(x)) for x in v]
    elif kind == "sorted":
        v.sort()
    elif kind == "none":
        v = [None] * n
    df = spark.createDataFrame(list(enumerate(v)), "position long, v double")
    got = {r.position: r.rolling_median for r in RO.rolling_median_rows(df, "v", before, after, 10, block, bucket).collect()}
    assert [got[p] for p in range(n)] == pytest.approx(_plain(v, before, after, 10), nan_ok=True)


def test_wavelet_counts_and_orders():
    rng = np.random.default_rng(1)
    ranks = rng.permutation(1000)
    start = rng.integers(0, 900, 200)
    stop = start + rng.integers(1, 100, 200)
    k = (rng.random(200) * (stop - start)).astype(int)
    want = [sorted(ranks[a:b])[i] for a, b, i in zip(start, stop, k)]
    assert RO.kth_member(ranks, start, stop, k).tolist() == want
