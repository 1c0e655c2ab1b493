"""Registered scenario, submission and file jobs (S1, S4, S5, S7, S9, S10, J1, J2, A37,
A40, A41, W7, U1, G9, G10, J7, J9, U4, U6).

The scenario and submission are priced with the by-equipment rate-per-mile model
fitted on development rows, so every contract is checked against SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlab.functions.cleaning import floor_predictions
from loadlab.operators import contracts as CT
from loadlab.operators import inference as INF
from loadlab.operators.baselines import fit_rate_per_mile
from loadlab.operators.splits import with_position
from loadlab.plans.common import oracle, rounded
from loadlab.plans.registry import register
from loadlab.sources import files, tables

INF_CTES = """dev AS (SELECT * FROM loads WHERE date < DATE '2001-01-01'),
scoring AS (SELECT * EXCLUDE (posted_rate) FROM loads WHERE date >= DATE '2001-01-01'),
roles AS (
  SELECT 'pickup' AS role, regexp_replace(pickup, '^\\s+|\\s+$', '', 'g') AS city, pickup_lat AS lat, pickup_lon AS lon FROM loads
  UNION ALL SELECT 'delivery', regexp_replace(delivery, '^\\s+|\\s+$', '', 'g'), delivery_lat, delivery_lon FROM loads),
cities AS (SELECT role, city, count(DISTINCT lat) AS n_lat, count(DISTINCT lon) AS n_lon, min(lat) AS lat, min(lon) AS lon
           FROM roles WHERE city IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL GROUP BY role, city),
market AS (SELECT date, avg(market_index) AS market_index, avg(quote_signal) AS quote_signal FROM scoring GROUP BY date),
scen AS (SELECT 'NATION_3' AS pickup, 'NATION_7' AS delivery, 360.0 AS distance, 'Dry Van' AS equipment, 32000.0 AS weight,
           cast(d AS DATE) AS date FROM range(DATE '2001-05-01', DATE '2001-06-01', INTERVAL 1 DAY) t(d)),
enriched AS (SELECT s.*, coalesce(p1.lat, p2.lat) AS pickup_lat, coalesce(p1.lon, p2.lon) AS pickup_lon,
             coalesce(d1.lat, d2.lat) AS delivery_lat, coalesce(d1.lon, d2.lon) AS delivery_lon, m.market_index, m.quote_signal
  FROM scen s
  LEFT JOIN cities p1 ON p1.role = 'pickup' AND p1.city = s.pickup LEFT JOIN cities p2 ON p2.role = 'delivery' AND p2.city = s.pickup
  LEFT JOIN cities d1 ON d1.role = 'delivery' AND d1.city = s.delivery LEFT JOIN cities d2 ON d2.role = 'pickup' AND d2.city = s.delivery
  JOIN market m ON m.date = s.date),
rates AS (SELECT equipment, quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r
          FROM dev WHERE equipment IS NOT NULL GROUP BY equipment),
g AS (SELECT quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r FROM dev),
priced AS (SELECT e.pickup, e.delivery, e.distance, e.equipment, e.weight, e.date,
             CASE WHEN p0 IS NULL OR isnan(p0) OR isinf(p0) OR p0 < 1.0 THEN 1.0 ELSE p0 END AS predicted_rate
           FROM (SELECT e.*, coalesce(e.distance, 0) * coalesce(rates.r, g.r) AS p0 FROM enriched e
                 LEFT JOIN rates ON e.equipment = rates.equipment CROSS JOIN g) e),
sub AS (SELECT s.load_id, CASE WHEN p0 IS NULL OR isnan(p0) OR isinf(p0) OR p0 < 1.0 THEN 1.0 ELSE p0 END AS predicted_rate,
          row_number() OVER (ORDER BY s.date, s.load_id) - 1 AS position
        FROM (SELECT s.*, coalesce(s.distance, 0) * coalesce(rates.r, g.r) AS p0 FROM scoring s
              LEFT JOIN rates ON s.equipment = rates.equipment CROSS JOIN g) s)"""


def _lookups(spark, sf):
    allrows = tables.loads(spark, sf)
    cities = INF.city_coordinates(tables.development(spark, sf), tables.scoring(spark, sf))
    market = INF.daily_market(tables.scoring(spark, sf))
    return allrows, cities, market


def _priced_scenario(spark, sf):
    _, cities, market = _lookups(spark, sf)
    enriched = INF.enrich(INF.scenario(spark).drop("predicted_rate"), cities, market)
    model = fit_rate_per_mile(tables.development(spark, sf), "equipment")
    priced = model.transform(enriched, "p0").withColumn("predicted_rate", floor_predictions("p0", 1.0))
    return priced.select(*CT.SCENARIO_OUTPUT_COLUMNS)


def _submission(spark, sf):
    model = fit_rate_per_mile(tables.development(spark, sf), "equipment")
    scored = model.transform(tables.scoring(spark, sf), "p0").withColumn("predicted_rate", floor_predictions("p0", 1.0))
    return with_position(scored.select("load_id", "date", "predicted_rate")).drop("date")


@register("w7_city_lookup", oracle("SELECT role, city, round(lat, 6) AS lat, round(lon, 6) AS lon FROM cities", INF_CTES))
def w7_city_lookup(spark, sf):
    return rounded(INF.city_coordinates(tables.development(spark, sf), tables.scoring(spark, sf)))


@register("a40_city_coordinate_conflicts", oracle("SELECT role, city, n_lat, n_lon FROM cities", INF_CTES))
def a40_city_coordinate_conflicts(spark, sf):
    return INF.coordinate_conflicts(tables.development(spark, sf), tables.scoring(spark, sf))


@register("a41_daily_market_lookup", oracle(
    "SELECT date, round(market_index, 6) AS market_index, round(quote_signal, 6) AS quote_signal FROM market", INF_CTES))
def a41_daily_market_lookup(spark, sf):
    return rounded(INF.daily_market(tables.scoring(spark, sf)))


@register("s4_j1_j2_scenario_enriched", oracle("""
SELECT pickup, delivery, distance, equipment, weight, date, round(pickup_lat, 6) AS pickup_lat, round(pickup_lon, 6) AS pickup_lon,
  round(delivery_lat, 6) AS delivery_lat, round(delivery_lon, 6) AS delivery_lon, round(market_index, 6) AS market_index,
  round(quote_signal, 6) AS quote_signal FROM enriched""", INF_CTES))
def s4_j1_j2_scenario_enriched(spark, sf):
    _, cities, market = _lookups(spark, sf)
    e = INF.enrich(INF.scenario(spark).drop("predicted_rate"), cities, market)
    return rounded(e.select("pickup", "delivery", "distance", "equipment", "weight", "date", "pickup_lat", "pickup_lon",
                            "delivery_lat", "delivery_lon", "market_index", "quote_signal"))


@register("a37_scenario_stats", oracle("""
SELECT round(min(predicted_rate), 6) AS min, round(max(predicted_rate), 6) AS max, round(avg(predicted_rate), 6) AS mean,
  round(max(predicted_rate) - min(predicted_rate), 6) AS spread,
  round(100.0 * (max(predicted_rate) - min(predicted_rate)) / avg(predicted_rate), 6) AS spread_pct_of_mean FROM priced""", INF_CTES))
def a37_scenario_stats(spark, sf):
    return rounded(INF.scenario_stats(_priced_scenario(spark, sf)))


def _g10_sql(frame: str) -> str:
    """The scenario contract's counts over ``frame``, every one computed."""
    return f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE date IS NULL) AS invalid_dates,
  count(date) - count(DISTINCT date) AS duplicate_dates,
  count(*) FILTER (WHERE pickup <> 'NATION_3') AS bad_pickup, count(*) FILTER (WHERE delivery <> 'NATION_7') AS bad_delivery,
  count(*) FILTER (WHERE abs(distance - 360.0) > 1e-8 + 1e-5 * 360.0) AS bad_distance,
  count(*) FILTER (WHERE equipment <> 'Dry Van') AS bad_equipment,
  count(*) FILTER (WHERE abs(weight - 32000.0) > 1e-8 + 1e-5 * 32000.0) AS bad_weight,
  count(*) FILTER (WHERE predicted_rate IS NULL OR isnan(predicted_rate) OR isinf(predicted_rate) OR predicted_rate <= 0) AS bad_rate,
  (SELECT count(*) FROM (SELECT date FROM scen EXCEPT SELECT date FROM {frame})) AS missing_dates,
  (SELECT count(*) FROM (SELECT date FROM {frame} EXCEPT SELECT date FROM scen)) AS extra_dates FROM {frame}"""


def _g9_sql(frame: str) -> str:
    """The submission contract's counts over ``frame``, every one computed."""
    return f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE load_id IS NULL) AS missing_ids_in_submission,
  count(load_id) - count(DISTINCT load_id) AS duplicate_ids,
  count(*) FILTER (WHERE predicted_rate IS NULL OR isnan(predicted_rate) OR isinf(predicted_rate)) AS non_finite_rates,
  count(*) FILTER (WHERE NOT isnan(predicted_rate) AND NOT isinf(predicted_rate) AND predicted_rate <= 0) AS non_positive_rates,
  (SELECT count(*) FROM (SELECT load_id FROM template EXCEPT SELECT load_id FROM {frame})) AS missing_ids,
  (SELECT count(*) FROM (SELECT load_id FROM {frame} EXCEPT SELECT load_id FROM template)) AS extra_ids,
  (SELECT count(*) FROM {frame} a JOIN template b ON a.load_id = b.load_id WHERE a.position <> b.position) AS out_of_order,
  (SELECT count(*) FROM template) AS expected_rows FROM {frame}"""


TEMPLATE = """template AS (SELECT load_id, row_number() OVER (ORDER BY date, load_id) - 1 AS position
                    FROM loads WHERE date >= DATE '2001-01-01')"""

# Faults planted by position (submission) or day of the month (scenario), in both engines alike.
FAULTY_SUBMISSION = """faulty AS (
  SELECT CASE position % 100 WHEN 19 THEN load_id || '-other' WHEN 23 THEN NULL ELSE load_id END AS load_id,
    CASE position % 100 WHEN 13 THEN 0.0 WHEN 14 THEN -predicted_rate WHEN 17 THEN cast('NaN' AS double)
      WHEN 18 THEN cast('Infinity' AS double) WHEN 20 THEN NULL ELSE predicted_rate END AS predicted_rate,
    position + CASE position % 100 WHEN 29 THEN 1 WHEN 30 THEN -1 ELSE 0 END AS position
  FROM {sub} WHERE position % 100 <> 7
  UNION ALL SELECT load_id, predicted_rate, position FROM {sub} WHERE position % 100 = 11)"""
FAULTY_SCENARIO = """faulty AS (
  SELECT CASE WHEN day(date) = 3 THEN 'NATION_4' ELSE pickup END AS pickup,
    CASE WHEN day(date) IN (4, 5) THEN 'NATION_8' ELSE delivery END AS delivery,
    distance + CASE WHEN day(date) = 6 THEN 1.0 WHEN day(date) = 7 THEN 0.001 ELSE 0.0 END AS distance,
    CASE WHEN day(date) > 28 THEN 'Reefer' ELSE equipment END AS equipment,
    weight * CASE WHEN day(date) < 3 THEN 1.1 ELSE 1.0 END AS weight,
    CASE day(date) WHEN 10 THEN DATE '2001-05-11' WHEN 12 THEN DATE '2001-07-01' WHEN 13 THEN NULL ELSE date END AS date,
    CASE day(date) WHEN 15 THEN 0.0 WHEN 16 THEN cast('NaN' AS double) ELSE predicted_rate END AS predicted_rate
  FROM {priced})"""


@register("g10_scenario_contract", oracle(_g10_sql("priced"), INF_CTES))
def g10_scenario_contract(spark, sf):
    return CT.scenario_report(_priced_scenario(spark, sf))


@register("g10_faulty_scenario", oracle(_g10_sql("faulty"), INF_CTES + ",\n" + FAULTY_SCENARIO.format(priced="priced")))
def g10_faulty_scenario(spark, sf):
    """The contract's counts over a scenario with planted faults of every kind."""
    text = f"WITH {FAULTY_SCENARIO} SELECT * FROM faulty"
    return CT.scenario_report(spark.sql(text, priced=_priced_scenario(spark, sf)))


def _template(spark, sf):
    return with_position(tables.scoring(spark, sf).select("load_id", "date")).drop("date")


@register("g9_submission_contract", oracle(_g9_sql("sub"), INF_CTES + ",\n" + TEMPLATE))
def g9_submission_contract(spark, sf):
    report = CT.submission_report(_submission(spark, sf).select("load_id", "predicted_rate", "position"), _template(spark, sf))
    CT.assert_submission(report)
    return report


@register("g9_faulty_submission", oracle(_g9_sql("faulty"), INF_CTES + ",\n" + TEMPLATE + ",\n"
                                         + FAULTY_SUBMISSION.format(sub="sub")))
def g9_faulty_submission(spark, sf):
    """The contract's counts over a submission with planted faults of every kind."""
    text = f"WITH {FAULTY_SUBMISSION} SELECT * FROM faulty"
    return CT.submission_report(spark.sql(text, sub=_submission(spark, sf)), _template(spark, sf))


@register("s1_s7_submission_roundtrip", oracle(
    "SELECT load_id, round(predicted_rate, 6) AS predicted_rate FROM sub", INF_CTES))
def s1_s7_submission_roundtrip(spark, sf):
    """S7 then S1: write the ordered submission CSV to shared storage and scan it back strictly."""
    sub = rounded(_submission(spark, sf))
    path = files.write_csv(sub.select("load_id", "predicted_rate", "position"),
                           files.scratch_path(spark, "submission"), order_by=["position"])
    back = files.read_csv(spark, path, files.SUBMISSION_SCHEMA.add("position", "long"), "submission")
    return back.select("load_id", "predicted_rate")


@register("s9_s10_metadata_roundtrip", oracle("""
SELECT model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2, round(mape, 6) AS mape, n FROM (
  SELECT 'Rate-per-mile (by equipment)' AS model, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
    CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS r2,
    100 * avg(abs((y - p) / y)) AS mape, count(*) AS n
  FROM (SELECT h.posted_rate AS y, CASE WHEN p0 IS NULL OR isnan(p0) OR isinf(p0) OR p0 < 1.0 THEN 1.0 ELSE p0 END AS p
        FROM (SELECT h.*, coalesce(h.distance, 0) * coalesce(rates.r, g.r) AS p0
              FROM (SELECT * FROM loads WHERE date >= DATE '2000-07-01' AND date < DATE '2001-01-01') h
              LEFT JOIN trates rates ON h.equipment = rates.equipment CROSS JOIN tg g) h))""",
    """train AS (SELECT * FROM loads WHERE date < DATE '2000-07-01'),
trates AS (SELECT equipment, quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r
           FROM train WHERE equipment IS NOT NULL GROUP BY equipment),
tg AS (SELECT quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r FROM train)"""))
def s9_s10_metadata_roundtrip(spark, sf):
    """S9 then S10: write the flagship metrics as run metadata JSON and read the rows back."""
    from loadlab.plans.flagship import rate_per_mile_holdout
    m = rate_per_mile_holdout(spark, sf, "equipment").first().asDict()
    record = {"phase": "baselines", "results": [{"model": "Rate-per-mile (by equipment)", **m}]}
    path = files.write_metadata(spark, record, files.scratch_path(spark, "metadata"))
    back = files.read_metrics_rows(spark, path)
    return rounded(back.select("model", "mae", "rmse", "r2", "mape", F.col("n").cast("long").alias("n")))


RPM_RECORDS_CTES = """t AS (SELECT *, date < DATE '2000-07-01' AS training FROM loads WHERE date < DATE '2001-01-01'),
rate AS (SELECT training, equipment, CASE WHEN distance > 0 THEN posted_rate / distance END AS r FROM t),
rates AS (SELECT equipment, quantile_cont(r, 0.5) AS r FROM rate WHERE training AND equipment IS NOT NULL GROUP BY equipment),
g AS (SELECT quantile_cont(r, 0.5) AS r FROM rate WHERE training),
scored AS (SELECT training, y, CASE WHEN p0 IS NULL OR isnan(p0) OR isinf(p0) OR p0 < 1.0 THEN 1.0 ELSE p0 END AS p
  FROM (SELECT t.training, t.posted_rate AS y, coalesce(t.distance, 0) * coalesce(rates.r, g.r) AS p0
        FROM t LEFT JOIN rates ON t.equipment = rates.equipment CROSS JOIN g))"""
RECORD_MEASURES = ("mae", "rmse", "mape")
_MEASURES_SQL = {"mae": "avg(abs(y - p))", "rmse": "sqrt(avg((y - p) * (y - p)))", "mape": "100 * avg(abs((y - p) / y))"}


@register("s9_metadata_records", oracle("\nUNION ALL\n".join([
    "SELECT 'preprocessing' AS record, 'train_rows' AS field, cast(count(*) FILTER (WHERE training) AS double) AS value FROM t",
    "SELECT 'preprocessing', 'holdout_rows', cast(count(*) FILTER (WHERE NOT training) AS double) FROM t",
    "SELECT 'preprocessing', 'negative_weights', cast(count(*) FILTER (WHERE weight < 0) AS double) FROM t",
    *[f"SELECT '{r}', '{m}', round({_MEASURES_SQL[m]}, 6) FROM scored WHERE NOT training"
      for r in ("baselines", "best_model") for m in RECORD_MEASURES],
    "SELECT 'final_model', 'training_rows', cast(count(*) AS double) FROM t",
    "SELECT 'final_model', 'smearing_factor', round(avg(exp(ln(y) - ln(greatest(p, 1e-9)))), 6) FROM scored WHERE training"]),
    RPM_RECORDS_CTES))
def s9_metadata_records(spark, sf):
    """The records of the four phases (preprocessing, baselines, best model, final model) for the by-equipment
    rate per mile, written as JSON and read back as (record, field, value)."""
    from loadlab.operators.metrics import regression_metrics, smearing_factor
    train, holdout = tables.train(spark, sf), tables.holdout(spark, sf)
    model = fit_rate_per_mile(train, "equipment")
    scored = [model.transform(d, "p0").withColumn("p", floor_predictions("p0", 1.0)) for d in (train, holdout)]
    measures = regression_metrics(scored[1], "posted_rate", "p").select(*RECORD_MEASURES).first().asDict()
    rows = tables.development(spark, sf).agg(
        F.count_if(F.col("date") < F.lit("2000-07-01").cast("date")).alias("train_rows"), F.count(F.lit(1)).alias("all_rows"),
        F.count_if(F.col("weight") < 0).alias("negative_weights")).first()
    name = "Rate-per-mile (by equipment)"
    records = {
        "preprocessing": {"train_rows": rows["train_rows"], "holdout_rows": rows["all_rows"] - rows["train_rows"],
                          "negative_weights": rows["negative_weights"]},
        "baselines": {"best_baseline": name, "selection_metric": "holdout MAE", **measures},
        "best_model": {"best_model": name, "target_transform": "identity", **measures},
        "final_model": {"algorithm": name, "training_rows": rows["all_rows"],
                        "smearing_factor": smearing_factor(scored[0], "posted_rate", "p").first()[0]},
    }
    back = {r: files.read_metadata(spark, files.write_metadata(spark, v, files.scratch_path(spark, r))) for r, v in records.items()}
    return rounded(spark.createDataFrame(
        [(r, f, float(x)) for r, record in back.items() for f, x in record.items() if not isinstance(x, str)],
        "record string, field string, value double"))


@register("s5_scenario_csv_roundtrip", oracle("""
SELECT pickup, delivery, distance, equipment, weight, date, round(predicted_rate, 6) AS predicted_rate FROM priced""", INF_CTES))
def s5_scenario_csv_roundtrip(spark, sf):
    """S5 + G10: write the priced scenario as a date-ordered CSV, scan it back strictly, check the contract."""
    from pyspark.sql import types as T
    priced = rounded(_priced_scenario(spark, sf))
    path = files.write_csv(priced, files.scratch_path(spark, "scenario"), order_by=["date"])
    schema = T.StructType([T.StructField("pickup", T.StringType()), T.StructField("delivery", T.StringType()),
                           T.StructField("distance", T.DoubleType()), T.StructField("equipment", T.StringType()),
                           T.StructField("weight", T.DoubleType()), T.StructField("date", T.DateType()),
                           T.StructField("predicted_rate", T.DoubleType())])
    back = files.read_csv(spark, path, schema, "scenario")
    report = CT.scenario_report(back).first()
    bad = {k: v for k, v in report.asDict().items() if k != "rows" and v}
    if bad or report["rows"] != 31:
        raise ValueError(f"scenario contract failed: {bad}")
    return back
