import pytest
from pyspark.sql import functions as F

from loadlab.operators.baselines import fit_rate_per_mile
from loadlab.operators.metrics import regression_metrics


def test_perfect_predictions(spark):
    df = spark.createDataFrame([(100.0, 100.0), (200.0, 200.0), (300.0, 300.0)], "posted_rate double, predicted double")
    m = regression_metrics(df).first()
    assert m["mae"] == 0 and m["rmse"] == 0 and m["r2"] == 1.0 and m["mape"] == 0 and m["n"] == 3


def test_constant_truth_gives_null_r2(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "posted_rate double, predicted double")
    assert regression_metrics(df).first()["r2"] is None


def test_mape_zero_truth_raises(spark):
    df = spark.createDataFrame([(0.0, 4.0), (5.0, 6.0)], "posted_rate double, predicted double")
    with pytest.raises(Exception):
        regression_metrics(df).collect()


def test_constant_rate_per_mile_recovered(spark):
    df = spark.createDataFrame([(100.0, "Dry Van", 200.0), (200.0, "Dry Van", 400.0), (400.0, "Dry Van", 800.0)],
                               "distance double, equipment string, posted_rate double")
    model = fit_rate_per_mile(df, "equipment")
    assert model.global_rate == 2.0
    out = model.transform(df).select("predicted").collect()
    assert [r[0] for r in out] == [200.0, 400.0, 800.0]


def test_unknown_group_falls_back_to_global(spark):
    train = spark.createDataFrame([(100.0, "A", 300.0), (100.0, "B", 100.0)], "distance double, equipment string, posted_rate double")
    test = spark.createDataFrame([(10.0, "C"), (None, "A")], "distance double, equipment string")
    out = [r[0] for r in fit_rate_per_mile(train, "equipment").transform(test).select("predicted").collect()]
    assert out == [20.0, 0.0]


def test_flagship_matches_fixture(spark):
    import __spark_entry__ as E
    row = E.entry(spark).first()
    assert (row["n"], row["mae"], row["rmse"], row["r2"], row["mape"]) == (434, 187.687351, 250.392413, 0.982818, 6.927536)
