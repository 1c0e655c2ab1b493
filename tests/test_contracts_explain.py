import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadlab.config import DEFAULT
from loadlab.functions import cleaning as C
from loadlab.operators import contracts as CT
from loadlab.operators import explain as EX
from loadlab.operators import models as MO
from loadlab.operators import schema as SC
from loadlab.sources import tables


def _sub(spark, rows):
    return spark.createDataFrame(rows, "load_id string, predicted_rate double, position long")


def test_submission_contract_passes_and_fails(spark):
    template = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "load_id string, position long")
    ok = CT.submission_report(_sub(spark, [("a", 10.0, 0), ("b", 20.0, 1), ("c", 5.0, 2)]), template)
    assert len(CT.assert_submission(ok)) == 7
    bad_order = CT.submission_report(_sub(spark, [("b", 10.0, 0), ("a", 20.0, 1), ("c", 5.0, 2)]), template)
    with pytest.raises(ValueError, match="order"):
        CT.assert_submission(bad_order)
    bad_rate = CT.submission_report(_sub(spark, [("a", 0.0, 0), ("b", 20.0, 1), ("c", 5.0, 2)]), template)
    with pytest.raises(ValueError, match="not positive"):
        CT.assert_submission(bad_rate)
    extra = CT.submission_report(_sub(spark, [("a", 1.0, 0), ("b", 2.0, 1), ("z", 5.0, 2)]), template)
    r = extra.first()
    assert (r["missing_ids"], r["extra_ids"]) == (1, 1)


def test_scenario_contract_counts(spark):
    from loadlab.operators.inference import scenario
    s = scenario(spark).withColumn("predicted_rate", F.lit(100.0))
    r = CT.scenario_report(s).first().asDict()
    assert r["rows"] == 31 and all(v == 0 for k, v in r.items() if k != "rows")
    r2 = CT.scenario_report(s.filter(F.col("date") != dt.date(2001, 5, 7)).withColumn(
        "weight", F.lit(31000.0))).first()
    assert r2["missing_dates"] == 1 and r2["bad_weight"] == 30


def test_required_columns_and_strict_numeric(spark, sf001):
    df = tables.loads(spark, sf001)
    SC.ensure_required_columns(df, DEFAULT.raw_feature_columns)
    with pytest.raises(KeyError):
        SC.ensure_required_columns(df.drop("weight"), DEFAULT.raw_feature_columns)
    C.assert_strict_numeric(df, "distance")
    with pytest.raises(ValueError):
        C.assert_strict_numeric(df, "weight")  # has NULLs
    num, other = SC.split_by_type(df)
    assert "distance" in num and "pickup" in other
    assert SC.inferred_roles(df)["target"] == "posted_rate"


def test_date_guard(spark):
    df = spark.createDataFrame([("2001-02-28",), ("2001-02-30",)], "d string")
    with pytest.raises(ValueError):
        C.assert_dates_parsed(df, "d")
    C.assert_dates_parsed(df.limit(1), "d")


def test_generic_permutation_equals_linear_shortcut(spark, sf001):
    spec = MO.ModelSpec("ridge log", "ridge", "log", params={"alpha": 1.0})
    model = MO.fit(spec, tables.train(spark, sf001))
    h = tables.holdout(spark, sf001)
    feats = model.feature_names[:6]
    fast = {r["feature"]: r["permutation_importance"]
            for r in EX.permutation_importance_linear(model, h, DEFAULT, repeats=2).collect()}
    slow = {r["feature"]: r["permutation_importance"]
            for r in EX.permutation_importance(model, h, DEFAULT, features=feats, repeats=2).collect()}
    for f in feats:
        assert slow[f] == pytest.approx(fast[f], rel=1e-6, abs=1e-9)


def test_linear_attribution_long_and_wide_agree(spark, sf001):
    spec = MO.ModelSpec("ridge log", "ridge", "log", params={"alpha": 1.0})
    model = MO.fit(spec, tables.train(spark, sf001))
    h = tables.holdout(spark, sf001)
    wide = {r["feature"]: r["mean_abs_attribution"] for r in EX.mean_abs_attribution_linear(model, h).collect()}
    long = {r["feature"]: r["mean_abs_attribution"]
            for r in EX.mean_abs_attribution(EX.linear_attribution(model, h, DEFAULT)).collect()}
    assert wide.keys() == long.keys()
    for k in wide:
        assert wide[k] == pytest.approx(long[k], rel=1e-9, abs=1e-12)


def test_average_rank_equals_the_window_form(spark):
    from loadlab.operators.errors import average_rank, average_rank_desc
    df = spark.range(500).select("id", F.when(F.col("id") % 50 != 7, F.col("id") % 23).alias("v"))
    rows = [sorted(map(tuple, f(df, "v", "rank").select("id", "v", "rank").collect())) for f in (average_rank, average_rank_desc)]
    assert rows[0] == rows[1] and len(rows[0]) == 500
    assert average_rank(df.limit(0), "v", "rank").count() == 0


def test_top_views_are_the_first_of_each_ranking(spark):
    table = spark.createDataFrame([(f"f{i}", float(i), float(-i), 20 - i, i) for i in range(1, 20)],
                                  "feature string, native_importance double, permutation_importance double, native_rank int, permutation_rank int")
    views = {v: [r["feature"] for r in EX.top_views(table, 3).filter(F.col("view") == v).orderBy("rank").collect()]
             for v in ("native", "permutation")}
    assert views == {"native": ["f19", "f18", "f17"], "permutation": ["f1", "f2", "f3"]}
