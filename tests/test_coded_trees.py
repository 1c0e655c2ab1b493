"""Boosted trees fitted on coded rows equal Spark's."""

import datetime as dt

import numpy as np
import pytest

from loadlab.config import JobConfig
from loadlab.operators import coded_trees as CT
from loadlab.operators import models as MO
from loadlab.operators import trees as TR

COLUMNS = ("load_id string, pickup string, delivery string, pickup_lat double, pickup_lon double, delivery_lat double, delivery_lon double, "
           "distance double, equipment string, weight double, date date, market_index double, quote_signal double, posted_rate double")


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    made = []
    for i in range(900):
        a, b, kind = (int(rng.integers(0, k)) for k in (4, 5, 3))
        miles, load = float(rng.uniform(50, 2500)), float(rng.uniform(6000, 45000))
        made.append((f"L{i:04d}", None if i % 90 == 0 else f"CITY {a}", f"CITY {b}", 30.0 + a, -100.0 + 3 * a, 31.0 + b, -90.0 - b, miles, ["Van", "Flatbed", "Reefer"][kind],
                     None if i % 40 == 0 else load, dt.date(1999, 1, 1) + dt.timedelta(days=int(rng.integers(0, 500))), float(rng.uniform(1, 1.2)), float(rng.uniform(2, 2.1)),
                     miles * (2 + kind + 0.3 * b) + load / 50 + float(rng.uniform(1, 300))))
    path = str(tmp_path_factory.mktemp("rows") / "loads")
    spark.createDataFrame(made, COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def _both(rows, spec, monkeypatch, cfg=JobConfig()):
    plain = MO.fit(spec, rows, cfg)
    monkeypatch.setattr(MO, "FILE_ROWS", 2)
    monkeypatch.setattr(CT, "ROWS", 100)
    fitted = []
    monkeypatch.setattr(CT, "fit", lambda *a, own=CT.fit: fitted.append(a) or own(*a))
    return plain, MO.fit(spec, rows, cfg), fitted


@pytest.mark.parametrize("params, cfg", [({"maxIter": 5, "maxDepth": 4}, JobConfig()), ({"maxIter": 3, "maxDepth": 3, "minInstancesPerNode": 30, "stepSize": 0.3}, JobConfig(min_frequency=200)),
                                         ({"maxIter": 2, "maxDepth": 0}, JobConfig())])
def test_boosted_trees_on_coded_rows_equal_sparks(spark, rows, monkeypatch, params, cfg):
    spec = MO.ModelSpec("GBT", "gbt", "log", params={"seed": 42, **params})
    plain, own, fitted = _both(rows, spec, monkeypatch, cfg)
    assert len(fitted) == 1
    a, b = (m.pipeline.stages[-1] for m in (plain, own))
    assert list(a.treeWeights) == list(b.treeWeights) and a.numFeatures == b.numFeatures
    wanted, found = ({r.load_id: r.p for r in m.predict(rows, "p").collect()} for m in (plain, own))
    assert wanted.keys() == found.keys()
    assert np.allclose([found[k] for k in wanted], [*wanted.values()], rtol=1e-9)
    wanted, found = (TR.node_table(spark, m).orderBy("tree", "id").toPandas() for m in (a, b))
    for c in ("tree", "id", "cover", "left", "right"):  # a node is cut alike, by whichever of equal features
        assert len(wanted) == len(found)
        if c in ("tree", "id"):
            assert (wanted[c] == found[c]).all()
    assert sorted(wanted["cover"]) == sorted(found["cover"])
    assert np.allclose(b.featureImportances.toArray().sum(), a.featureImportances.toArray().sum())
    assert own.predict_training("posted_rate").count() == rows.count()


def test_settings_that_coded_rows_do_not_know_are_sparks(spark, rows, monkeypatch):
    spec = MO.ModelSpec("GBT", "gbt", "log", params={"maxIter": 2, "maxDepth": 2, "subsamplingRate": 0.8, "seed": 42})
    _, own, fitted = _both(rows, spec, monkeypatch)
    assert not fitted and own.predict(rows).count() == rows.count()


def test_fits_leave_no_blocks_and_settings_as_they_were(spark, rows, monkeypatch, tmp_path):
    spec = MO.ModelSpec("GBT", "gbt", "log", params={"maxIter": 3, "maxDepth": 2, "seed": 42})
    removed, kept = [], []
    monkeypatch.setattr(CT, "written", lambda *a, own=CT.written, **k: kept.append(own(*a, **k)) or kept[-1])
    monkeypatch.setattr(CT, "discard", lambda df, own=CT.discard: removed.append(df.written_path) or own(df))
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(k, None) for k in names]
    _both(rows, spec, monkeypatch)
    assert len(kept) == 3 and removed == [k.written_path for k in kept]
    assert [spark.conf.get(k, None) for k in names] == before


def test_thresholds():
    assert CT.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 5).tolist() == [1.5, 2.5]
    assert CT.thresholds(np.array([7.0, 7.0]), 5).tolist() == []
    many = CT.thresholds(np.arange(1000.0), 31)
    assert len(many) == 31 and np.ptp(np.diff(many)) <= 1


def test_missing_labels_raise(spark, rows, monkeypatch):
    from pyspark.sql import functions as F
    spec = MO.ModelSpec("GBT", "gbt", "identity", params={"maxIter": 2, "maxDepth": 2, "seed": 42})
    monkeypatch.setattr(MO, "FILE_ROWS", 2)
    with pytest.raises(Exception, match="finite"):
        MO.fit(spec, rows.withColumn("posted_rate", F.when(F.col("load_id") != "L0007", F.col("posted_rate"))))
