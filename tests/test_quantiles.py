import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlab.operators import quantiles
from loadlab.operators.quantiles import exact_quantiles, quantile_values


@pytest.fixture(params=["true", "false"])
def reuse(request, spark):
    """With and without shared exchanges; brackets of a few values, so that the sketch matters."""
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield request.param
    spark.conf.set("spark.sql.exchange.reuse", before)


@pytest.mark.parametrize("accuracy", [50, 100_000])
def test_exact_quantiles_match_numpy_with_hot_group_and_ties(spark, accuracy, reuse, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    conf = dict(spark.sparkContext.getConf().getAll())
    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{i % 7}"  # one group holds a third of the rows
        v = float(rng.integers(0, 40)) if i % 2 else float(rng.normal(100, 20))  # many ties
        rows.append((g, v))
    rows.append(("hot", None))
    rows.append((None, 5.0))  # NULL group is dropped
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))]
           for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert None not in got
    for g in {r[0] for r in rows if r[0] is not None}:
        vals = np.array([r[1] for r in rows if r[0] == g and r[1] is not None])
        assert got[g] == pytest.approx(list(np.quantile(vals, probs)), rel=1e-12, abs=1e-12)
    allv = np.array([r[1] for r in rows if r[1] is not None])
    assert quantile_values(df, "v", probs) == pytest.approx(list(np.quantile(allv, probs)))
    both = df.withColumn("w", df["v"] * 2).withColumn("none", df["v"] * F.lit(None).cast("double"))
    got = quantiles.column_quantiles(both, ["v", "w", "none"], [0.25, 0.9])
    assert got["none"] is None and got["v"] == pytest.approx(list(np.quantile(allv, [0.25, 0.9])))
    assert got["w"] == pytest.approx(list(np.quantile(2 * allv, [0.25, 0.9])))
    assert dict(spark.sparkContext.getConf().getAll()) == conf


def test_single_value_group(spark, reuse):
    df = spark.createDataFrame([("a", 3.0)], "g string, v double")
    assert exact_quantiles(df, "v", [0.25, 0.5], ["g"]).first()["q1"] == 3.0


def test_prefix_quantiles_equal_plain_ones(spark, monkeypatch):
    import numpy as np

    from loadlab.operators import prefix_quantiles as PQ

    monkeypatch.setattr(PQ, "BUCKETS", 16)
    rng = np.random.default_rng(4)
    rows = []
    for k in range(3000):
        x = None if k % 7 == 0 else round(float(rng.normal()), 2)
        y = float("nan") if k % 5 == 0 else float(rng.integers(0, 4))  # ties
        rows.append((int(k * 6 // 3000), x, y, None if k < 1500 else float(k)))
    df = spark.createDataFrame(rows, "s int, x double, y double, z double")
    pq = PQ.PrefixQuantiles(df, ["x", "y", "z"], "s")
    probs = [0.25, 0.5, 0.75]
    extra = {("x", u): (0.1, 40 * u) for u in (1, 4)}
    got = pq.quantiles({(c, u): probs for c in "xyz" for u in (1, 2, 4, 6)}, extra)
    for j, c in enumerate("xyz"):
        for u in (1, 2, 4, 6):
            v = [r[j + 1] for r in rows if r[0] < u and r[j + 1] is not None and r[j + 1] == r[j + 1]]
            v += [extra[c, u][0]] * extra[c, u][1] if (c, u) in extra else []
            assert (got[c, u] is None and not v) or np.allclose(got[c, u], np.quantile(v, probs), rtol=0, atol=1e-12), (c, u)
    assert pq.n_rows(2) == 1000 and pq.n_values("z", 6) == 1500
