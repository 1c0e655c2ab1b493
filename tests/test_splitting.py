import pytest
from pyspark.sql import functions as F

from loadlab.config import DEFAULT
from loadlab.operators import splits as SP
from loadlab.sources import tables


def test_positions_are_a_permutation_in_date_order(spark, sf001):
    dev = tables.development(spark, sf001)
    pos = SP.with_position(dev, n_partitions=5).select("load_id", "date", "position").toPandas()
    n = len(pos)
    assert sorted(pos["position"]) == list(range(n))
    ordered = pos.sort_values("position")
    expected = pos.sort_values(["date", "load_id"])
    assert list(ordered["load_id"]) == list(expected["load_id"])


def test_fold_bounds_match_expanding_window_rule():
    # n = 100, k = 5 -> test size 16; folds test [20,36), [36,52), ..., [84,100).
    b = SP.fold_bounds(100, 5)
    assert [s for _, s, _ in b] == [20, 36, 52, 68, 84]
    assert all(t == 16 for _, _, t in b)
    with pytest.raises(ValueError):
        SP.fold_bounds(3, 5)


def test_folds_are_forward_and_disjoint(spark, sf001):
    rows = SP.fold_rows(tables.development(spark, sf001), DEFAULT.n_cv_splits)
    rep = SP.leakage_report(rows).collect()
    assert len(rep) == 5 and all(r["ok"] for r in rep)


def test_temporal_split_boundary_in_holdout(spark, sf001):
    s = SP.temporal_split(tables.development(spark, sf001))
    info = SP.assert_split_valid(s)
    assert str(info["holdout_min"]) >= "2000-07-01" > str(info["train_max"])
    counts = {r["split"]: r["rows"] for r in SP.split_summary(s).collect()}
    assert counts == {"train": 5074, "holdout": 434}


def test_empty_side_raises(spark, sf001):
    s = SP.temporal_split(tables.development(spark, sf001), boundary=__import__("datetime").date(1900, 1, 1))
    with pytest.raises(ValueError):
        SP.assert_split_valid(s)


def test_train_holdout_disjoint(spark, sf001):
    n = SP.overlap_count(tables.train(spark, sf001), tables.holdout(spark, sf001)).first()[0]
    assert n == 0


def test_stride_sample(spark, sf001):
    s = SP.stride_sample(tables.development(spark, sf001), 10).select("position").collect()
    assert all(r[0] % 10 == 0 for r in s) and len(s) == (5508 + 9) // 10
