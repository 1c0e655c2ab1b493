"""Window fits from one pass of sums, and sparse vocabularies."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from loadlab.config import DEFAULT, JobConfig
from loadlab.operators import gram as GR
from loadlab.operators import models as MO
from loadlab.operators import vocabulary as VO
from loadlab.operators.encode import FeatureEncoder
from loadlab.operators.metrics import metrics_by, regression_metrics
from loadlab.operators.splits import fold_bounds, with_position
from loadlab.sources import tables


def _separate(spec, dev, train, holdout, folds):
    """Errors of a fresh pipeline for the holdout and the given folds."""
    dev = with_position(dev).persist()
    out = {"holdout": regression_metrics(MO.fit_predict(spec, train, holdout)).first()}
    for fold, start, size in [b for b in fold_bounds(dev.count(), DEFAULT.n_cv_splits) if b[0] in folds]:
        test = dev.filter((F.col("position") >= start) & (F.col("position") < start + size))
        out[f"fold {fold}"] = regression_metrics(MO.fit_predict(spec, dev.filter(F.col("position") < start), test)).first()
    dev.unpersist()
    return out


@pytest.mark.parametrize("kind,folds", [("log", (0, 3)), ("identity", ())])
def test_window_fits_equal_separate_fits(spark, sf001, kind, folds):
    # Some categories appear late, some values are missing, one column is constant in the first windows.
    dev = tables.development(spark, sf001).withColumn("pickup", F.when(F.col("load_id").endswith("3"), F.lit(None)).otherwise(F.col("pickup")))
    dev = dev.withColumn("quote_signal", F.when(F.col("date") < "2000-03-01", F.lit(2.5)).otherwise(F.col("quote_signal"))).persist()
    split = F.col("date") < F.lit(DEFAULT.holdout_start)
    spec = MO.ModelSpec("ridge", "ridge", kind, params={"alpha": 1.0})
    rows, parts = GR.expanding_parts(dev)
    base, fits = GR.fit_windows(rows, parts, 1.0, log=kind == "log")
    got = {r["part"]: r for r in metrics_by(GR.predict_windows(rows, base, fits), ["part"]).collect()}
    want = _separate(spec, dev, dev.filter(split), dev.filter(~split), folds)
    assert len(got) == DEFAULT.n_cv_splits + 1
    for name, w in want.items():
        assert got[name]["n"] == w["n"]
        for m in ("mae", "rmse"):
            assert abs(got[name][m] - w[m]) < 1e-8 * max(1.0, w[m]), (name, m)
    one, part = GR.holdout_part(dev)
    base, fits = GR.fit_windows(one, part, 1.0, log=kind == "log")
    alone = regression_metrics(GR.predict_windows(one, base, fits)).first()
    assert abs(alone["mae"] - want["holdout"]["mae"]) < 1e-8 * want["holdout"]["mae"]
    dev.unpersist()


def test_rare_values_share_a_coefficient(spark, sf001):
    train = tables.train(spark, sf001)
    cfg = JobConfig(min_frequency=train.count() // 25)
    dev = tables.development(spark, sf001)
    rows, parts = GR.holdout_part(dev, cfg)
    _, (fit,) = GR.fit_windows(rows, parts, 1.0, cfg=cfg)
    names = FeatureEncoder(minFrequency=cfg.min_frequency).fit(train).feature_names()
    assert list(fit.coefficients) == names and any(n.endswith("_infrequent_sklearn") for n in names)


def test_development_rows_are_read_once(spark, sf001):
    rows, parts = GR.expanding_parts(tables.development(spark, sf001))
    base, fits = GR.fit_windows(rows, parts, 1.0, log=True)
    plan = GR.predict_windows(rows, base, fits)._jdf.queryExecution().optimizedPlan().toString()
    # Everything after the positions reads the checkpointed rows, not the tables.
    assert "parquet" not in plan.lower().replace("lookup", "") or "lineitem" not in plan
    assert plan.count("LogicalRDD") <= 2


def test_sparse_vectors_equal_named_columns(spark, sf001):
    train, holdout = tables.train(spark, sf001), tables.scoring(spark, sf001)
    model, named = VO.SparseEncoder().fit(train), FeatureEncoder(keepColumns=["load_id"]).fit(train)
    dense = {r["load_id"]: r for r in named.transform(holdout).collect()}
    stats, vocab = named.fitted, named.fitted["vocab"]
    rows = model.transform(holdout).collect()
    assert len(rows) == len(dense)
    for r in rows:
        d = dense[r["load_id"]]
        want = [d[c] for c in stats["weight"] + stats["other"] + stats["binary"]]
        for c in DEFAULT.categorical:
            want += [*[d[f"{c}_{v}"] for v in vocab[c]], d[f"{c}_is_unknown"]]
        assert r["features"].size == model.size == len(want)
        assert np.allclose(r["features"].toArray(), want, rtol=0, atol=1e-12)


def test_rare_and_missing_values_take_shared_slots(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] + [("c",)] * 4 + [("d",)] + [(None,)] * 3, "x string")
    v = VO.fit_vocabulary(df, ["x"], 2)
    assert (v.frequent, v.rare, v.slots("x")) == ({"x": 2}, {"x": 2}, 4)
    got = {r["x"]: r["x_slot"] for r in VO.with_slots(spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("z",), (None,)], "x string"), v, ["x"]).collect()}
    assert got == {"a": 0, "c": 1, "b": 2, "d": 2, "z": 3, None: 3}
    empty = VO.fit_vocabulary(df.filter("false"), ["x"])
    assert empty.slots("x") == 1 and {r["x_slot"] for r in VO.with_slots(df, empty, ["x"]).collect()} == {0}


def test_a_million_values(spark):
    df = spark.range(1_500_000).select(F.concat(F.lit("v"), F.pmod(F.col("id"), F.lit(1_000_000)).cast("string")).alias("x"))
    v = VO.fit_vocabulary(df, ["x"])
    assert v.frequent == {"x": 1_000_000}
    coded = VO.with_slots(df.unionByName(spark.createDataFrame([("new",)], "x string")), v, ["x"])
    n, low, high, distinct, unknown = coded.agg(F.count(F.lit(1)), F.min("x_slot"), F.max("x_slot"), F.count_distinct("x_slot"),
                                                F.count_if(VO.is_unknown(v, "x") == 1)).first()
    assert (n, low, high, distinct, unknown) == (1_500_001, 0, 1_000_000, 1_000_001, 1)


def test_fit_and_score_with_many_values(spark, sf001):
    """A column with a value for nearly every row goes through encoder and solver as a sparse vector."""
    many = lambda d: d.withColumn("pickup", F.concat("pickup", F.lit(" "), F.pmod(F.xxhash64("load_id"), F.lit(3000)).cast("string")))
    train, holdout = many(tables.train(spark, sf001)), many(tables.holdout(spark, sf001))
    model = VO.SparseEncoder().fit(train)
    assert model.size > 2000
    rows = model.transform(train).withColumn("label", F.ln("posted_rate"))
    fit = LinearRegression(solver="l-bfgs", regParam=0.01, maxIter=30).fit(rows)
    scored = fit.transform(model.transform(holdout)).withColumn("predicted", F.exp("prediction"))
    m = regression_metrics(scored).first()
    mean = train.agg(F.avg("posted_rate")).first()[0]
    assert m["n"] == 434 and m["mae"] < 0.6 * regression_metrics(holdout.withColumn("predicted", F.lit(mean))).first()["mae"]


def test_sparse_encoder_roundtrip(spark, sf001, tmp_path):
    model = VO.SparseEncoder(min_frequency=30).fit(tables.train(spark, sf001))
    model.save(str(tmp_path / "encoder"))
    again = VO.SparseEncoderModel.load(str(tmp_path / "encoder"))
    holdout = tables.holdout(spark, sf001)
    text = lambda m: sorted(str(r) for r in m.transform(holdout).collect())
    assert text(model) == text(again) and again.size == model.size
