import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlab.operators import encode as EN
from loadlab.operators import models as MO
from loadlab.operators.contracts import assert_same_rows
from loadlab.sources import tables


@pytest.fixture(scope="module")
def fitted(spark, sf001):
    return EN.FeatureEncoder().fit(tables.train(spark, sf001))


def test_encoder_names_and_guards(spark, sf001, fitted):
    out = EN.transform_guarded(fitted, tables.holdout(spark, sf001))
    names = fitted.feature_names()
    assert names[0] == "weight" and "is_weekend" in names  # is_weekend is scaled, not binary
    first_hot = EN.onehot_name("pickup", fitted.fitted["vocab"]["pickup"][0])
    assert names.index("market_index_is_missing") < names.index(first_hot) < names.index("pickup_is_unknown")
    assert out.count() == 434


def test_median_is_interpolated(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (10.0,), (20.0,)], "x double")
    assert df.agg(F.percentile("x", 0.5)).first()[0] == 6.5


def test_unseen_category_gives_zero_one_hot_and_flag(spark, sf001, fitted):
    row = tables.holdout(spark, sf001).limit(1).withColumn("pickup", F.lit("Atlantis")).withColumn("delivery", F.lit("El Dorado"))
    out = fitted.transform(row).first().asDict()
    vocab = fitted.fitted["vocab"]
    assert all(out[EN.onehot_name("pickup", v)] == 0.0 for v in vocab["pickup"])
    assert out["pickup_is_unknown"] == 1.0 and out["delivery_is_unknown"] == 1.0 and out["equipment_is_unknown"] == 0.0


def test_refit_is_deterministic(spark, sf001, fitted):
    again = EN.FeatureEncoder().fit(tables.train(spark, sf001))
    h = tables.holdout(spark, sf001)
    assert_same_rows(fitted.transform(h), again.transform(h))


def test_subset_equals_whole(spark, sf001, fitted):
    h = tables.holdout(spark, sf001)
    whole = fitted.transform(h).filter("load_id < '2'")
    part = fitted.transform(h.filter("load_id < '2'"))
    assert_same_rows(whole, part)


def test_ridge_matches_closed_form(spark, sf001):
    spec = MO.ModelSpec("ridge", "ridge", params={"alpha": 1.0})
    train = tables.train(spark, sf001)
    model = MO.fit(spec, train)
    names = model.feature_names
    pdf = model.pipeline.stages[0].transform(train).select(*names, "posted_rate").toPandas()
    X = pdf[names].to_numpy(float)
    y = pdf["posted_rate"].to_numpy(float)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(X.shape[1]), Xc.T @ yc)
    b = y.mean() - X.mean(0) @ w
    reg = model.pipeline.stages[-1]
    got = X @ np.array(reg.coefficients.toArray()) + reg.intercept
    # Fitted values are the well-determined part (near-collinear features can trade weight).
    assert np.max(np.abs(got - (X @ w + b))) / np.std(y) < 1e-8


def test_log_model_predictions_positive(spark, sf001):
    spec = MO.ModelSpec("ridge log", "ridge", "log", params={"alpha": 1.0})
    model = MO.fit(spec, tables.train(spark, sf001))
    pred = model.predict(tables.holdout(spark, sf001))
    assert pred.filter(F.col("predicted") <= 0).count() == 0


def test_save_and_load_pipeline(spark, sf001, tmp_path):
    spec = MO.ModelSpec("ridge", "ridge", params={"alpha": 1.0})
    model = MO.fit(spec, tables.train(spark, sf001))
    path = str(tmp_path / "model")
    model.factor, model.floor = 1.5, 700.0
    model.save(path)
    again = MO.load(path)
    assert (again.spec, again.factor, again.floor) == (spec, 1.5, 700.0)
    h = tables.holdout(spark, sf001)
    assert_same_rows(model.predict(h).select("load_id", "predicted"), again.predict(h).select("load_id", "predicted"))


def test_search_refits_the_best_candidate(spark, sf001):
    from loadlab.operators.metrics import regression_metrics
    from loadlab.operators.splits import with_position

    # A penalty this large predicts the mean: it must lose in every fold.
    spec = MO.ModelSpec("ridge", "ridge", "log", search_space={"alpha": [1.0, 1e9]}, n_iter=2)
    dev = with_position(tables.train(spark, sf001))
    found = MO.search(spec, dev, dev.count(), n_folds=2)
    rows = {r["params"]: r for r in found.table.collect()}
    good, bad = rows["[('alpha', 1.0)]"], rows["[('alpha', 1000000000.0)]"]
    assert good["best"] and not bad["best"] and good["cv_mae"] < bad["cv_mae"] and found.params == {"alpha": 1.0}
    holdout = tables.holdout(spark, sf001)
    refit, plain = (regression_metrics(m.predict(holdout)).first() for m in (found.model, MO.fit(spec, dev, params={"alpha": 1.0})))
    assert refit["n"] == plain["n"] == 434 and abs(refit["mae"] - plain["mae"]) < 1e-6
