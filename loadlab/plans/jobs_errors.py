"""Registered error-analysis jobs over the by-equipment rate-per-mile predictions on
raw holdout rows (F17, A31-A34, W4-W6, T1, T3, T5, T6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlab.functions.cleaning import floor_predictions
from loadlab.operators import errors as ER
from loadlab.operators.baselines import fit_rate_per_mile
from loadlab.operators.lookup import written
from loadlab.plans.common import oracle, rounded
from loadlab.plans.registry import register
from loadlab.sources import tables

ERR_CTES = """train AS (SELECT * FROM loads WHERE date < DATE '2000-07-01'),
holdout AS (SELECT * FROM loads WHERE date >= DATE '2000-07-01' AND date < DATE '2001-01-01'),
rates AS (SELECT equipment, quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r
          FROM train WHERE equipment IS NOT NULL GROUP BY equipment),
g AS (SELECT quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r FROM train),
raw AS (SELECT h.*, coalesce(h.distance, 0) * coalesce(rates.r, g.r) AS p0
        FROM holdout h LEFT JOIN rates ON h.equipment = rates.equipment CROSS JOIN g),
scored AS (SELECT * EXCLUDE (p0), CASE WHEN p0 IS NULL OR isnan(p0) OR isinf(p0) OR p0 < 1.0 THEN 1.0 ELSE p0 END AS predicted FROM raw),
qe AS (SELECT quantile_cont(predicted, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM scored),
errs AS (SELECT s.*, posted_rate - predicted AS residual, abs(posted_rate - predicted) AS absolute_error,
    100.0 * (posted_rate - predicted) / posted_rate AS percentage_error,
    abs(100.0 * (posted_rate - predicted) / posted_rate) AS absolute_percentage_error,
    strftime(date, '%Y-%m') AS month, dayname(date) AS day_of_week,
    CASE WHEN distance >= 0 AND distance < 250 THEN '<250mi' WHEN distance >= 250 AND distance < 500 THEN '250-500mi'
         WHEN distance >= 500 AND distance < 1000 THEN '500-1000mi' WHEN distance >= 1000 AND distance < 2000 THEN '1000-2000mi'
         WHEN distance >= 2000 THEN '>2000mi' END AS distance_band,
    CASE WHEN abs(weight) >= 0 AND abs(weight) < 15000 THEN '<15k lb' WHEN abs(weight) >= 15000 AND abs(weight) < 25000 THEN '15-25k lb'
         WHEN abs(weight) >= 25000 AND abs(weight) < 35000 THEN '25-35k lb' WHEN abs(weight) >= 35000 AND abs(weight) < 45000 THEN '35-45k lb'
         WHEN abs(weight) >= 45000 THEN '>45k lb' END AS weight_band,
    CASE WHEN predicted <= e[2] THEN 'Q1' WHEN predicted <= e[3] THEN 'Q2' WHEN predicted <= e[4] THEN 'Q3'
         WHEN predicted <= e[5] THEN 'Q4' ELSE 'Q5' END AS prediction_quintile
  FROM scored s, qe),
seg AS (SELECT segment, value, count(*) AS rows, avg(absolute_error) AS MAE, avg(absolute_percentage_error) AS MAPE,
          avg(residual) AS bias, quantile_cont(posted_rate, 0.5) AS median_rate FROM (
  SELECT 'equipment' AS segment, equipment AS value, * EXCLUDE (equipment) FROM errs
  UNION ALL BY NAME SELECT 'distance_band' AS segment, distance_band AS value, * EXCLUDE (distance_band) FROM errs
  UNION ALL BY NAME SELECT 'weight_band' AS segment, weight_band AS value, * EXCLUDE (weight_band) FROM errs
  UNION ALL BY NAME SELECT 'month' AS segment, month AS value, * EXCLUDE (month) FROM errs
  UNION ALL BY NAME SELECT 'day_of_week' AS segment, day_of_week AS value, * EXCLUDE (day_of_week) FROM errs
  UNION ALL BY NAME SELECT 'prediction_quintile' AS segment, prediction_quintile AS value, * EXCLUDE (prediction_quintile) FROM errs
  UNION ALL BY NAME SELECT 'pickup' AS segment, pickup AS value, * EXCLUDE (pickup) FROM errs
  UNION ALL BY NAME SELECT 'delivery' AS segment, delivery AS value, * EXCLUDE (delivery) FROM errs)
  WHERE value IS NOT NULL GROUP BY segment, value)"""


# What the by-equipment rates are fitted on and predict from.
RATE_COLUMNS = ("equipment", "distance", "posted_rate")


def _errors(spark, sf, *columns):
    """The error frame of the holdout; ``columns`` of the loads beside the date and those of the rates."""
    windows = tables.kept_columns(spark, sf, RATE_COLUMNS, (*RATE_COLUMNS, *columns))
    model = fit_rate_per_mile(windows.train, "equipment")
    scored = model.transform(windows.holdout, "p0")
    scored = scored.withColumn("predicted", floor_predictions("p0", 1.0)).drop("p0")
    return ER.error_frame(scored)


def _written_errors(spark, sf, *columns):
    """Columns of the error frame, written once for jobs that read them several times."""
    return written(_errors(spark, sf, *[c for c in columns if c in tables.LOADS_COLUMNS]).select(*columns), "errors")


def _segments(spark, sf):
    return ER.segment_table(_errors(spark, sf, "weight", "pickup", "delivery"))


@register("f17_error_frame", oracle("""
SELECT load_id, round(predicted, 6) AS predicted, round(residual, 6) AS residual, round(absolute_error, 6) AS absolute_error,
  round(percentage_error, 6) AS percentage_error, round(absolute_percentage_error, 6) AS absolute_percentage_error,
  month, day_of_week, distance_band, weight_band, prediction_quintile FROM errs""", ERR_CTES))
def f17_error_frame(spark, sf):
    e = _errors(spark, sf, "load_id", "weight")
    return rounded(e.select("load_id", "predicted", "residual", "absolute_error", "percentage_error",
                            "absolute_percentage_error", "month", "day_of_week", "distance_band", "weight_band",
                            "prediction_quintile"))


@register("a31_segment_report", oracle("""
SELECT segment, value, rows, round(MAE, 6) AS MAE, round(MAPE, 6) AS MAPE, round(bias, 6) AS bias,
  round(median_rate, 6) AS median_rate, rank FROM (
  SELECT *, cast(row_number() OVER (PARTITION BY segment ORDER BY MAE DESC, value) AS INTEGER) AS rank FROM seg
  WHERE segment NOT IN ('pickup', 'delivery') OR rows >= 30)
WHERE segment NOT IN ('pickup', 'delivery') OR rank <= 15""", ERR_CTES))
def a31_segment_report(spark, sf):
    return rounded(ER.segment_report(_segments(spark, sf)))


@register("t6_segment_order", oracle("""
SELECT segment, value, rows, cast(order_index AS INTEGER) AS order_index FROM seg LEFT JOIN (
  SELECT 'distance_band' AS s, unnest(['<250mi', '250-500mi', '500-1000mi', '1000-2000mi', '>2000mi']) AS v, unnest(range(0, 5)) AS order_index
  UNION ALL SELECT 'weight_band', unnest(['<15k lb', '15-25k lb', '25-35k lb', '35-45k lb', '>45k lb']), unnest(range(0, 5))
  UNION ALL SELECT 'day_of_week', unnest(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']), unnest(range(0, 7))
  UNION ALL SELECT 'prediction_quintile', unnest(['Q1','Q2','Q3','Q4','Q5']), unnest(range(0, 5))) d
ON seg.segment = d.s AND seg.value = d.v""", ERR_CTES))
def t6_segment_order(spark, sf):
    return ER.segment_order(_segments(spark, sf)).select("segment", "value", "rows", "order_index")


@register("a34_worst_best", oracle("""
SELECT segment, arg_max(value, (MAE, value)) AS worst_value, round(max(MAE), 6) AS worst_mae,
  arg_min(value, (MAE, value)) AS best_value, round(min(MAE), 6) AS best_mae, round(max(MAE) / min(MAE), 6) AS mae_ratio
FROM seg GROUP BY segment""", ERR_CTES))
def a34_worst_best(spark, sf):
    return rounded(ER.worst_best(_segments(spark, sf)))


@register("a33_error_headline", oracle("""
SELECT round(avg(absolute_error), 6) AS mae, round(quantile_cont(absolute_error, 0.5), 6) AS median_abs_error,
  round(quantile_cont(absolute_error, 0.95), 6) AS p95_abs_error, round(quantile_cont(absolute_error, 0.99), 6) AS p99_abs_error,
  round(max(absolute_error), 6) AS max_abs_error, round(avg(absolute_percentage_error), 6) AS mape,
  round(avg(residual), 6) AS bias, round(quantile_cont(residual, 0.5), 6) AS median_residual FROM errs""", ERR_CTES))
def a33_error_headline(spark, sf):
    return rounded(ER.headline(_written_errors(spark, sf, "absolute_error", "absolute_percentage_error", "residual")))


@register("a32_residual_diagnostics", oracle("""
SELECT round(m, 6) AS mean_residual, round(med, 6) AS median_residual, round(s, 6) AS residual_std,
  round(m / (s / sqrt(n)), 6) AS bias_t_statistic, abs(m / (s / sqrt(n))) > 2.0 AS bias_is_significant,
  round(qr, 6) AS quintile_std_ratio, round(c, 6) AS abs_residual_vs_prediction_corr,
  (qr > 1.5 OR abs(c) > 0.2) AS heteroscedastic, round(k, 6) AS excess_kurtosis,
  round(ws, 6) AS worst_1pct_share_of_total_error, k > 3.0 AS heavy_tailed
FROM (SELECT avg(residual) AS m, quantile_cont(residual, 0.5) AS med, stddev_samp(residual) AS s, count(*) AS n,
        corr(abs(residual), predicted) AS c, kurtosis_pop(residual) AS k FROM errs),
     (SELECT max(sd) / min(sd) AS qr FROM (SELECT stddev_samp(residual) AS sd FROM errs GROUP BY prediction_quintile)),
     (SELECT 100.0 * sum(absolute_error) FILTER (WHERE rn <= greatest(1, round_even(0.01 * cnt, 0))) / sum(absolute_error) AS ws
      FROM (SELECT absolute_error, row_number() OVER (ORDER BY absolute_error DESC) AS rn, count(*) OVER () AS cnt FROM errs))""",
                                               ERR_CTES))
def a32_residual_diagnostics(spark, sf):
    return rounded(ER.diagnose(_written_errors(spark, sf, "predicted", "residual", "absolute_error", "prediction_quintile")))


@register("w5_worst_share", oracle("""
SELECT round(100.0 * sum(absolute_error) FILTER (WHERE rn <= k) / sum(absolute_error), 6) AS worst_share_pct, any_value(k) AS k
FROM (SELECT absolute_error, row_number() OVER (ORDER BY absolute_error DESC) AS rn,
        cast(greatest(1, round_even(0.01 * count(*) OVER (), 0)) AS INTEGER) AS k FROM errs)""", ERR_CTES))
def w5_worst_share(spark, sf):
    return rounded(ER.worst_share(_written_errors(spark, sf, "absolute_error")))


@register("t1_worst_rows", oracle("""
SELECT load_id, pickup, delivery, equipment, round(distance, 6) AS distance, round(weight, 6) AS weight, date,
  round(market_index, 6) AS market_index, round(posted_rate, 6) AS posted_rate, round(predicted, 6) AS predicted,
  round(residual, 6) AS residual, round(absolute_error, 6) AS absolute_error,
  round(absolute_percentage_error, 6) AS absolute_percentage_error
FROM errs ORDER BY absolute_error DESC, load_id LIMIT 20""", ERR_CTES))
def t1_worst_rows(spark, sf):
    return rounded(ER.worst_rows(_errors(spark, sf, "load_id", "pickup", "delivery", "weight", "market_index")))


@register("t5_representative_rows", oracle("""
SELECT arg_min(load_id, (abs(residual), load_id)) AS typical, arg_min(load_id, (-residual, load_id)) AS worst_underprediction,
  arg_min(load_id, (residual, load_id)) AS worst_overprediction FROM errs""", ERR_CTES))
def t5_representative_rows(spark, sf):
    return ER.representative_rows(_errors(spark, sf, "load_id"))


@register("w4_rolling_median_distance", oracle("""
SELECT load_id, round(distance, 6) AS distance, round(residual, 6) AS residual, position,
  round(CASE WHEN c >= 10 THEN m END, 6) AS rolling_median FROM (
  SELECT load_id, distance, residual, row_number() OVER (ORDER BY distance, load_id) - 1 AS position,
    quantile_cont(residual, 0.5) OVER f AS m, count(residual) OVER f AS c
  FROM (SELECT *, greatest(50, (SELECT count(*) FROM errs) // 40) AS w FROM errs)
  WINDOW f AS (ORDER BY distance, load_id ROWS BETWEEN w // 2 PRECEDING AND (w - 1) // 2 FOLLOWING))""", ERR_CTES))
def w4_rolling_median_distance(spark, sf):
    return rounded(ER.rolling_median(_written_errors(spark, sf, "load_id", "distance", "residual"), "distance"))


@register("w6_qq_points")
def w6_qq_points(spark, sf):
    return rounded(ER.qq_points(_written_errors(spark, sf, "load_id", "residual")))
