"""Jobs that read the loads more than once join them once; what the encoder knows of constant columns; bracket counts."""

import datetime as dt
import itertools

import numpy as np
import pytest

import __spark_entry__ as E
from loadlab.operators import encode as EN
from loadlab.operators import errors as ER
from loadlab.operators import models as MO
from loadlab.operators import quantiles
from loadlab.operators.lookup import written
from loadlab.sources import tables

COLUMNS = ("load_id string, pickup string, delivery string, pickup_lat double, pickup_lon double, delivery_lat double, delivery_lon double, "
           "distance double, equipment string, weight double, date date, market_index double, quote_signal double, posted_rate double")


def _rows():
    rng = np.random.default_rng(7)
    day = dt.date(1999, 9, 1)
    for i in range(600):
        date = day + dt.timedelta(days=i + 10)
        miles = float(rng.integers(1, 40) * 70)
        place = lambda k: f"CITY {k}"
        a, b = int(rng.integers(0, 3)), int(rng.integers(0, 3))
        # Flatbeds all over; one equipment only, so its column is constant.
        yield (f"L{i:04d}", place(a), place(b), 30.0 + a, -100.0 + a, 31.0 + b, -90.0 - b, miles, "Flatbed", None if i % 50 == 0 else float(rng.integers(6, 40) * 1000),
               date, 1.0 + i % 10 / 100, 2.05, miles * 2 + float(rng.integers(1, 500)))


@pytest.fixture
def joined(spark, tmp_path, monkeypatch):
    """A written star join of own rows, and how often it was asked for."""
    path = str(tmp_path / "star")
    spark.createDataFrame(list(_rows()), COLUMNS).write.parquet(path)
    asked = []

    def star(spark, sf_dir):
        asked.append(sf_dir)
        return spark.read.parquet(path)

    monkeypatch.setattr(tables, "_star_join", star)
    return path, asked


@pytest.mark.parametrize("name", ["w5_worst_share", "m9_baseline_holdout_table", "g8_planted_change", "a50_risk_flags", "m4_sparse_vectors",
                                  "m21_final_predictions", "t7_top_continuous_features", "u2_s8_model_comparison"])
def test_star_join_runs_once(spark, joined, name):
    path, asked = joined
    out = E.queries()[name](spark, "own rows")
    assert len(asked) == 1
    assert not [f for f in out.inputFiles() if path in f]
    assert out.collect()


def test_windows_are_the_date_filters(spark, joined):
    kept = tables.kept_windows(spark, "own rows", scoring=True)
    for name in ("train", "holdout", "development", "scoring"):
        plain, own = getattr(tables, name)(spark, "own rows"), getattr(kept, name)
        assert own.columns == plain.columns
        assert own.exceptAll(plain).isEmpty() and plain.exceptAll(own).isEmpty()


def test_encoder_knows_constant_columns(spark, joined):
    train = tables.train(spark, "own rows")
    model = EN.FeatureEncoder().fit(train)
    encoded = model.transform(train).toPandas()
    plain = [c for c in model.feature_names() if encoded[c].min() == encoded[c].max()]
    assert sorted(model.fitted["constant"]) == sorted(plain)
    assert {"quote_signal", "equipment_Flatbed", "pickup_is_unknown"} <= set(plain)
    fit = MO.fit(MO.default_specs()[1], train)
    assert sorted(fit.constant_features) == sorted(plain)


def test_constant_columns_are_not_cached(spark, joined):
    with MO.prepared(MO.default_specs()[1], tables.train(spark, "own rows")) as p:
        assert not p.rows.storageLevel.useMemory
        assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_training_rows_are_predicted_from_written_vectors(spark, joined, monkeypatch):
    spec = MO.default_specs()[2]
    windows = tables.kept_windows(spark, "own rows")
    model = MO.fit(spec, windows.train)
    plain = sorted(tuple(r) for r in model.predict(windows.train, "p").select("posted_rate", "p").collect())
    choice = MO.smearing_decision(model, windows.train, windows.holdout).first()
    built = tables.Windows(MO.built_rows(spec, windows.development))
    again = MO.fit(spec, None, built=built.train)
    assert again.feature_names == model.feature_names
    monkeypatch.setattr(EN.FeatureEncoderModel, "encode", lambda *a: pytest.fail("training rows were encoded again"))
    for m in (model, again):
        assert np.allclose(sorted(tuple(r) for r in m.predict_training("posted_rate", "p").collect()), plain, rtol=1e-10)
    monkeypatch.undo()
    assert np.allclose(MO.smearing_decision(again, None, windows.holdout).first(), choice, rtol=1e-9)


def test_rows_of_tree_fits_make_full_waves(spark):
    df = spark.range(4000).selectExpr("id", f"cast(hash(id) % 1000 as double) as {MO.LABEL}").repartition(3)
    rows = written(df, "rows", 50)
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    with MO.spread(rows, 2) as passes:
        assert passes.exceptAll(rows).isEmpty() and rows.exceptAll(passes).isEmpty()
        parts = passes.select(MO.LABEL).rdd.glom().map(lambda p: [r[0] for r in p]).collect()
    assert spark.conf.get(key, None) == before
    assert len(parts) == 2 * MO.WAVES and max(map(len, parts)) <= 1.5 * min(map(len, parts))
    falls = sum(b < a for p in parts for a, b in itertools.pairwise(p))
    assert falls <= 4 * MO.SPLITS * MO.WAVES  # a few sorted runs a partition
    few = rows.coalesce(2)
    with MO.spread(few, 2) as passes:
        assert passes is few


def test_large_tree_fits_read_short_files_and_small_ones_do_not(spark, joined, monkeypatch):
    train = tables.train(spark, "own rows")
    spec = MO.default_specs()[3]
    with MO.prepared(spec, train) as p:
        assert p.passes is p.rows
        small = len(p.rows.inputFiles())
    monkeypatch.setattr(MO, "FILE_ROWS", 2)
    with MO.prepared(spec, train) as p:
        assert p.passes is not p.rows and len(p.rows.inputFiles()) > small
        model = p.fit(spec, {"numTrees": 2, "maxDepth": 2})
    assert model.predict_training("posted_rate").count() == train.count()


def test_bracket_counts_of_repeated_and_missing_values(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", 100)
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 5, 3000).astype(float), rng.normal(size=3000)
    rows = [(float(a), None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(b), None) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "x double, y double, z double").repartition(5)
    kept = [b for _, b, _ in rows if b is not None and b == b]
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    found = quantiles.column_quantiles(df, ["x", "y", "z"], probs)
    assert found["x"] == pytest.approx(np.quantile(x, probs)) and found["y"] == pytest.approx(np.quantile(kept, probs))
    assert found["z"] is None
    counts = {(r["__i"], r["__x"]): r["__c"] for r in quantiles._bracket_counts(df.select("x"), [(0, 0, -np.inf, 1.0), (0, 1, 2.0, 3.0)]).collect()}
    assert counts == {(0, 0.0): (x == 0).sum(), (0, 1.0): (x == 1).sum(), (1, None): (x < 2).sum(), (1, 2.0): (x == 2).sum(), (1, 3.0): (x == 3).sum()}


def test_ends_of_summaries_hold_the_ranks(monkeypatch):
    for name, value in (("BLOCK", 300), ("BLOCKS", 3), ("INTERVALS", 20)):
        monkeypatch.setattr(quantiles, name, value)
    rng = np.random.default_rng(5)
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    for x in (rng.normal(size=5000), rng.integers(0, 4, 5000).astype(float), np.where(rng.random(5000) < 0.4, 5.0, rng.random(5000) * 10), np.ones(1)):
        tasks = [quantiles._Summary() for _ in range(3)]
        for k, part in enumerate(np.array_split(x, 40)):
            tasks[k % 3].add(part)
        for t in tasks:
            t.sort()
        n, first, last = quantiles._sure_ends(*[np.concatenate(a) for a in zip(*[t.joined() for t in tasks if t.parts], strict=True)], probs)
        ordered, rank = np.sort(x), (len(x) - 1) * np.array(probs)
        assert n == len(x)
        assert (first <= ordered[np.floor(rank).astype(int)]).all() and (last >= ordered[np.ceil(rank).astype(int)]).all()
        if len(np.unique(x)) > 100:
            assert ((x[:, None] >= first) & (x[:, None] <= last)).mean(0).max() < 0.9


def test_no_task_merges_the_sketches_of_all_columns(spark):
    """Brackets of several columns: the interval counts are dealt by column, no aggregate without keys holds a sketch of each."""
    df = spark.range(0, 4000, 1, 8).selectExpr("cast(id AS double) AS x", "cast(id % 10 AS double) AS y")
    seen = []
    agg = type(df).agg
    patch = pytest.MonkeyPatch()
    patch.setattr(type(df), "agg", lambda self, *a: seen.append(a) or agg(self, *a))
    try:
        found = quantiles.column_quantiles(df, ["x", "y"], [0.5])
    finally:
        patch.undo()
    assert found == {"x": [1999.5], "y": [4.5]}
    assert not [a for call in seen for a in call if "percentile_approx" in str(a)]


def test_columns_of_training_rows(spark, joined):
    """The columns that only the holdout needs are null where training rows are written, and both windows hold their rows."""
    own = ("equipment", "distance", "posted_rate")
    kept = tables.kept_columns(spark, "own rows", own, (*own, "load_id", "weight"))
    for name, columns in (("train", ("distance", "equipment", "date", "posted_rate")), ("holdout", (*own, "load_id", "weight"))):
        plain, rows = getattr(tables, name)(spark, "own rows").select(*columns), getattr(kept, name).select(*columns)
        assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    assert set(kept.train.columns) == {*own, "date"}
    assert kept.rows.filter("date < '2000-07-01' AND (load_id IS NOT NULL OR weight IS NOT NULL)").isEmpty()
    with pytest.raises(ValueError, match="some columns"):
        kept.development
    with pytest.raises(KeyError, match="nothing"):
        tables.kept_columns(spark, "own rows", own, (*own, "nothing"))


def test_lines_are_not_shuffled_by_customer(spark, tmp_path):
    """The star join joins customers to orders, and gives the rows of the fixed text, null and repeated keys too."""
    day = dt.datetime(2000, 3, 1)
    frames = {
        "nation": ("n_nationkey int, n_name string", [(0, "A"), (5, "F"), (5, "G")]),
        "customer": ("c_custkey long, c_nationkey int, c_acctbal double", [(1, 0, 10.0), (2, 5, -20.0), (2, 5, 7.0), (None, 0, 1.0), (3, 9, 1.0)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(13, 0), (7, 5), (None, 0)]),
        "part": ("p_partkey long, p_retailprice double", [(160, 900.0), (2, 950.0), (2, 960.0), (None, 1.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp", [(1, 1, day), (2, 2, day), (2, 1, day), (None, 1, day), (3, None, day), (128, 3, day), (256, 2, None)]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, l_quantity double, l_returnflag string, l_discount double, l_tax double",
                     [(k, 7 if k == 2 else 1, p, s, day, 5.0, flag, 0.05, 0.01) for k in (1, 2, 3, 128, 256, None) for p in (160, 2, None) for s in (13, 7) for flag in ("A", "N")]),
    }
    for name, (schema, rows) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    plain = spark.sql(tables.LOADS_TEMPLATE, **tables.driver_tables(spark, str(tmp_path), tuple(frames)))
    own = tables.loads(spark, str(tmp_path))
    assert own.columns == plain.columns == list(tables.LOADS_COLUMNS)
    assert plain.count() > 20 and own.exceptAll(plain).isEmpty() and plain.exceptAll(own).isEmpty()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tables.loads(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if "hashpartitioning(o_custkey" in line)
    under = itertools.takewhile(lambda line: depth(line) > depth(lines[at]), lines[at + 1:])
    assert not [line for line in under if "l_orderkey" in line]


@pytest.fixture(params=["odd", "plain"])
def driver_rows(request, spark, tmp_path):
    """Driver tables with orders of all windows; ``odd``: keys that are null, repeated or without a match."""
    odd = request.param == "odd"
    days = [dt.datetime(2000, 3, 1), dt.datetime(2000, 9, 1), dt.datetime(2001, 2, 1)] + [None] * odd
    keys = lambda *k: [*k, *[None] * odd]
    frames = {
        "nation": ("n_nationkey int, n_name string", [(0, "A"), (5, "F")] + [(5, "G")] * odd),
        "customer": ("c_custkey long, c_nationkey int, c_acctbal double", [(1, 0, 10.0), (2, 5, -20.0)] + [(2, 0, 7.0), (None, 0, 1.0), (3, 9, 1.0)] * odd),
        "supplier": ("s_suppkey long, s_nationkey int", [(13, 0), (7, 5)] + [(7, 0), (None, 0), (8, 9)] * odd),
        "part": ("p_partkey long, p_retailprice double", [(160, 900.0), (2, 950.0)] + [(2, 960.0), (None, 1.0)] * odd),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp", [(100 * i + 10 * j + k, c, d) for i, d in enumerate(days) for j, c in enumerate(keys(1, 2, *[3, 4] * odd)) for k in (1, 2)]),
    }
    frames["orders"][1].extend([(1, 1, days[1]), (None, 1, days[0])] * odd)
    orders = [r[0] for r in frames["orders"][1]]
    frames["lineitem"] = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, l_quantity double, l_returnflag string, l_discount double, l_tax double",
                          [(o, n, p, s, days[0], 5.0, flag, 0.05, 0.01) for o in orders for n, flag in ((1, "A"), (7, "N"), (keys(7)[-1], keys("R")[-1]))
                           for p in keys(160, 2) for s in keys(13, 7, *[8, 9] * odd)])
    for name, (schema, rows) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path), odd


@pytest.mark.parametrize("late", [(), ("weight",), ("pickup", "weight", "delivery"), ("load_id", "pickup", "pickup_lat", "delivery_lon", "market_index", "quote_signal")])
def test_kept_columns_shuffle_lines_by_order_and_part_only(spark, driver_rows, monkeypatch, late):
    """The rows of both windows are those of the star join, and training rows meet neither customers nor suppliers."""
    own = ("equipment", "distance", "posted_rate")
    path, odd = driver_rows
    plans = {}

    def kept(df, name="lookup", *a):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name, *a)

    monkeypatch.setattr(tables, "written", kept)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        windows = tables.kept_columns(spark, path, own, (*own, *late))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name, columns in (("train", (*own, "date")), ("holdout", (*own, "date", *late))):
        plain, rows = getattr(tables, name)(spark, path).select(*columns), getattr(windows, name).select(*columns)
        assert plain.count() > 20 and rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    assert set(windows.train.columns) == {*own, "date"} and set(windows.holdout.columns) >= {*own, "date", *late}
    if not odd:
        assert "hashpartitioning(l_orderkey" in plans["windows"] and "hashpartitioning(l_partkey" in plans["windows"]
        assert "hashpartitioning(l_suppkey" not in plans["windows"]
    assert "load_id" in late or "l_shipdate" not in plans["windows"]


@pytest.mark.parametrize("kind", ["apart", "ties", "one value", "few", "none", "nan", "null", "infinite"])
def test_worst_share_needs_no_order(spark, kind):
    rng = np.random.default_rng(2)
    x = {"apart": rng.random(700), "ties": rng.integers(1, 6, 700).astype(float), "one value": np.full(300, 2.5), "few": np.array([3.0, 1.0]),
         "none": np.array([]), "nan": np.append(rng.random(500), np.nan), "null": rng.random(400), "infinite": np.append(rng.random(300), [np.inf] * 9)}[kind].tolist()
    x += [None] * {"null": 3}.get(kind, 0)
    found = ER.worst_share(spark.createDataFrame([(v,) for v in x], "absolute_error double").repartition(3)).first()
    k = max(1, round(0.01 * len(x)))
    values = sorted((v for v in x if v is not None), key=lambda v: -np.inf if v != v else v, reverse=True)
    worst = values[:max(k - x.count(None), 0)]
    expected = 100 * sum(worst) / sum(values) if worst else None
    assert found["k"] == k
    assert found["worst_share_pct"] == (pytest.approx(expected, nan_ok=True) if expected is not None else None)
