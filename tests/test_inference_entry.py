import os

import duckdb
import pytest

import __spark_entry__ as E
from loadlab.operators import inference as INF
from loadlab.sources import tables


def test_scenario_has_31_days(spark):
    df = INF.scenario(spark)
    assert df.count() == 31 and df.columns[-1] == "predicted_rate"


def test_uncovered_dates_raise_at_small_scale(spark, sf001):
    cities = INF.city_coordinates(tables.development(spark, sf001), tables.scoring(spark, sf001))
    market = INF.daily_market(tables.scoring(spark, sf001))
    with pytest.raises(KeyError):
        INF.enrich(INF.scenario(spark).drop("predicted_rate"), cities, market)


def test_unknown_city_raises(spark, sf001):
    from pyspark.sql import functions as F
    cities = INF.city_coordinates(tables.development(spark, sf001))
    market = INF.daily_market(tables.development(spark, sf001))
    frame = INF.scenario(spark).drop("predicted_rate").withColumn("pickup", F.lit("Atlantis"))
    with pytest.raises(KeyError):
        INF.enrich(frame, cities, market)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _tables_for(name, smallest):
    """The smallest tables lack loads on some of the scenario's dates; scenario jobs take the next size."""
    return os.path.join(os.path.dirname(smallest), "sf0.01") if name.startswith("g10") else smallest


@pytest.mark.parametrize("name", ["m9_rpm_equipment_holdout", "a14_validate_all", "a31_segment_report",
                                  "m15_baseline_cv_folds", "m1_m3_encoder_stats", "g9_faulty_submission",
                                  "g10_faulty_scenario", "a50_risk_flags", "m16_smearing_decision_rpm", "m5_rare_categories"])
def test_oracle_equality_small(spark, sf001, name):
    sf001 = _tables_for(name, sf001)
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf001, t + '.parquet')}')")
    sdf = E.queries()[name](spark, sf001)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)

    def canon(cols, rows):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        norm = lambda v: round(v, 6) if isinstance(v, float) else (v.isoformat() if hasattr(v, "isoformat") else v)
        return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=str)

    assert canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == canon(dcols, cur.fetchall())


@pytest.mark.parametrize("name", ["g9_faulty_submission", "g10_faulty_scenario"])
def test_every_planted_fault_is_counted(spark, sf001, name):
    report = E.queries()[name](spark, _tables_for(name, sf001)).first().asDict()
    assert all(n > 0 for n in report.values()), report
