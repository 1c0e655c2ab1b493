"""What jobs leave on disk: shuffles and written copies that the result does not need."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from loadlab.config import DEFAULT
from loadlab.operators import explain as EX
from loadlab.operators import gram as GR
from loadlab.operators import models as MO
from loadlab.operators import permute as PE
from loadlab.operators import quality as Q
from loadlab.operators import splits as SP
from loadlab.sources import tables

ROWS = [("A1", "x", 1.0), ("a1", "X", 1.0), ("A1", "x", 1.0), (None, "Y", 2.0), (None, "y", None), ("b2", None, 3.0), ("İ", "Y", 3.0)]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(ROWS, "load_id string, city string, amount double").repartition(3)


def test_distinct_values_and_repeated_ids_come_from_one_count(frame):
    found = Q._distinct_counts(frame, ["load_id", "city"])
    for i, c in enumerate(("load_id", "city")):
        values = [r[i] for r in ROWS if r[i] is not None]
        one = frame.select(F.count_distinct(c), F.count_distinct(F.lower(c))).first()
        assert (found[c].n, found[c].lower) == tuple(one)
        assert found[c].repeated == sum(values.count(v) for v in {*values} if values.count(v) > 1)
    issues = {r.issue_type: r for r in Q.validate(frame, "own").collect() if r.issue_type.startswith("duplicate")}
    plain = Q.duplicate_ids(frame).first()
    assert issues["duplicate_ids"].n_bad == plain.missing_ids + plain.dup_id_rows and issues["duplicate_ids"].n_total == len(ROWS)
    assert issues["duplicate_rows"].n_bad == 2 and issues["duplicate_rows"].n_total == len(ROWS)


def test_hashes_of_single_rows_are_not_written(frame, monkeypatch):
    kept = []
    monkeypatch.setattr(Q, "written", lambda *a, own=Q.written: kept.append(own(*a)) or kept[-1])
    assert Q.duplicate_rows(frame).first() == (2, len(ROWS))
    assert [k.count() for k in kept] == [1]


def test_positions_are_not_checkpointed(spark, monkeypatch):
    df = spark.range(500).selectExpr("cast(500 - id as string) as load_id", "date_add(date'2000-01-01', cast(id % 7 as int)) as date")
    monkeypatch.setattr(type(df), "checkpoint", lambda *a, **k: pytest.fail("rows were checkpointed"))
    found = [tuple(r) for r in SP.with_position(df, n_partitions=4).orderBy("position").collect()]
    assert [r[2] for r in found] == list(range(500)) and [r[:2] for r in found] == sorted((r[:2] for r in found), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("name", ["s6_processed_matrices", "t4_j12_baseline_ranking"])
def test_star_join_runs_once(spark, sf001, monkeypatch, name):
    asked = []
    monkeypatch.setattr(tables, "_star_join", lambda *a, own=tables._star_join: asked.append(a) or own(*a))
    sf = sf001.replace("0.001", "0.01")  # the scenario's dates need a market row
    out = E.queries()[name](spark, sf)
    assert len(asked) == 1 and not [f for f in out.inputFiles() if sf in f]
    assert out.collect()


def _names(kept):
    return [k.written_path.rsplit("/", 1)[1].split("-")[1] for k in kept]


def test_linear_fits_write_no_vectors_and_searches_keep_no_fold(spark, sf001, monkeypatch):
    kept, removed = [], []
    monkeypatch.setattr(MO, "written", lambda *a, own=MO.written, **k: kept.append(own(*a, **k)) or kept[-1])
    monkeypatch.setattr(MO, "discard", lambda df, own=MO.discard: removed.append(df) or own(df))
    train = tables.train(spark, sf001)
    model = MO.fit(MO.default_specs()[2], train)
    assert _names(kept) == ["built"] and model.predict_training("posted_rate").count() == train.count()
    kept.clear()
    spec = MO.ModelSpec("Ridge (log target)", "ridge", "log", params={"alpha": 1.0}, search_space={"alpha": [0.1, 10.0]}, n_iter=2)
    pos = SP.with_position(train)
    MO.search(spec, pos, pos.count(), n_folds=2)
    assert sorted(_names(removed)) == sorted(["built", "vectors", "encoded"] * 2)
    assert _names([k for k in kept if k not in removed]) == ["built"]


def test_permutations_shuffle_raw_columns_and_are_removed(spark, sf001, monkeypatch):
    wide, removed = [], []
    monkeypatch.setattr(PE, "with_position", lambda df, *a, own=PE.with_position: wide.append(df.columns) or own(df, *a))
    monkeypatch.setattr(PE, "discard", lambda df, own=PE.discard: removed.append(df) or own(df))
    model = MO.fit(MO.default_specs()[2], tables.train(spark, sf001))
    found = EX.permutation_importance_linear(model, tables.holdout(spark, sf001), DEFAULT, repeats=2)
    assert wide == [["load_id", "__y", "__raw"]] + [["load_id", "__raw", "__h"]] * 2 and len(removed) == 3
    assert {r.feature for r in found.collect()} == {*model.pipeline.stages[0].feature_names()}


def test_importance_without_labels_is_null(spark, sf001):
    model = MO.fit(MO.default_specs()[2], tables.train(spark, sf001))
    rows = tables.holdout(spark, sf001).withColumn("posted_rate", F.lit(None).cast("double"))
    found = {r.feature: r.permutation_importance for r in EX.permutation_importance_linear(model, rows, DEFAULT, repeats=1).collect()}
    assert {found[n] for n in model.feature_names} == {None} and {found[n] for n in model.constant_features} <= {0.0}


def test_raw_rows_are_put_in_order_for_window_fits(spark, sf001, monkeypatch):
    asked = []
    monkeypatch.setattr(GR, "with_position", lambda df, *a, own=GR.with_position: asked.append(df.columns) or own(df, *a))
    rows, _ = GR.expanding_parts(tables.development(spark, sf001))
    assert asked == [list(tables.LOADS_COLUMNS)] and "haversine_miles" in rows.columns and rows.count() == tables.development(spark, sf001).count()
