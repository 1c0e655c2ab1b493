"""Masked correlations against plain ones, and of many columns."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadlab.operators import correlations as CO
from loadlab.operators.stats import correlation_matrix


def test_pairs_equal_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(CO, "BLOCK", 2)
    monkeypatch.setattr(CO, "FAN", 2)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 5)) + [0, 1e6, -3, 0, 0]
    rows = [[None if rng.random() < 0.3 else float(v) for v in r] for r in x]
    for r in rows:
        r[3] = 7.0  # constant
        r[4] = None if r[0] is not None else r[4]  # never beside the first
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(7)
    table = pd.DataFrame(rows, columns=list("abcde"), dtype=float)
    plain = table.corr()
    got = {(r.feature_a, r.feature_b): (r.n, r.corr) for r in CO.pair_correlations(df, list("abcde"), list("abcde")).collect()}
    assert len(got) == 25
    for p in "abcde":
        for q in "abcde":
            have, want = got[p, q], plain.loc[p, q]
            assert have[0] == (table[p].notna() & table[q].notna()).sum()
            assert have[1] == (None if want != want else pytest.approx(want, abs=1e-10)), (p, q)


def test_five_hundred_columns(spark):
    base = spark.range(2000).select("id", *[F.rand(k).alias(f"r{k}") for k in range(5)])
    df = base.select(*[(F.col(f"r{k % 5}") * (k + 1) + F.sin(F.col("id") * (k + 1))).alias(f"x{k}") for k in range(500)])
    df = df.select(*[F.when(F.col(c) > 0.1, F.col(c)).alias(c) if k % 50 == 0 else F.col(c) for k, c in enumerate(df.columns)])
    m = correlation_matrix(df, df.columns)
    assert m.count() == 250_000
    pick = {(r.feature_a, r.feature_b): r.corr for r in m.filter("feature_a IN ('x0', 'x7') AND feature_b IN ('x12', 'x450')").collect()}
    one = df.agg(*[F.corr(a, b).alias(f"{a}_{b}") for a, b in pick]).first()
    assert all(pick[k] == pytest.approx(one[f"{k[0]}_{k[1]}"], abs=1e-9) for k in pick)


def test_no_rows(spark):
    assert CO.pair_correlations(spark.createDataFrame([], "a double, b double"), ["a"], ["b"]).count() == 0
