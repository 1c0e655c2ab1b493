"""Registered descriptive-statistics jobs (A15-A29, A35, A36, A38, A39) over raw
development or train rows, as the original EDA and business-evidence steps do."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlab.operators import stats as S
from loadlab.plans.common import oracle, rounded
from loadlab.plans.registry import register
from loadlab.sources import tables

NUMERIC = ["pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon", "distance", "weight",
           "market_index", "quote_signal", "posted_rate"]
DEV_CTE = """dev AS (SELECT *, CASE WHEN distance > 0 THEN posted_rate / distance END AS rate_per_mile
        FROM loads WHERE date < DATE '2001-01-01'),
train AS (SELECT * FROM loads WHERE date < DATE '2000-07-01')"""


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _dev(spark, sf):
    return tables.development(spark, sf)


def _train(spark, sf):
    return tables.train(spark, sf)


@register("a15_iqr_outliers", oracle(_union([f"""
SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outlier_count,
  round(100.0 * count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count({c}), 6) AS outlier_pct,
  round(any_value(q1 - 1.5 * (q3 - q1)), 6) AS lo, round(any_value(q3 + 1.5 * (q3 - q1)), 6) AS hi
FROM train, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM train) q
HAVING count({c}) >= 10 AND any_value(q3 - q1) <> 0""" for c in NUMERIC]), DEV_CTE))
def a15_iqr_outliers(spark, sf):
    return rounded(S.iqr_outliers(_train(spark, sf), NUMERIC))


@register("a16_correlation_matrix", oracle(_union([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM train"
    for a in NUMERIC for b in NUMERIC]), DEV_CTE))
def a16_correlation_matrix(spark, sf):
    return rounded(S.correlation_matrix(_train(spark, sf), NUMERIC))


@register("a17_target_correlations", oracle("SELECT feature, corr FROM (" + _union([
    f"SELECT '{c}' AS feature, round(corr({c}, posted_rate), 6) AS corr FROM train" for c in NUMERIC])
    + ") WHERE corr IS NOT NULL AND NOT isnan(corr) ORDER BY corr DESC, feature LIMIT 20", DEV_CTE))
def a17_target_correlations(spark, sf):
    return rounded(S.target_correlations(_train(spark, sf), NUMERIC))


@register("a18_date_summary", oracle("""
SELECT count(*) FILTER (WHERE try_cast(date AS DATE) IS NULL) AS date_parse_missing,
  min(try_cast(date AS DATE)) AS date_min, max(try_cast(date AS DATE)) AS date_max
FROM loads_dirty""", f"loads_dirty AS ({tables.LOADS_DIRTY_SELECT})"))
def a18_date_summary(spark, sf):
    return S.date_summary(tables.loads_dirty(spark, sf))


@register("a19_mean_rate_by_date", oracle(
    "SELECT date, round(avg(posted_rate), 6) AS mean_rate FROM train GROUP BY date", DEV_CTE))
def a19_mean_rate_by_date(spark, sf):
    return rounded(S.mean_target_by_date(_train(spark, sf)))


@register("a20_group_target_stats", oracle(_union([f"""
SELECT * FROM (SELECT {k} AS value, count(*) AS count, round(avg(posted_rate), 6) AS mean,
  round(quantile_cont(posted_rate, 0.5), 6) AS median, '{k}' AS feature
  FROM train GROUP BY {k} ORDER BY avg(posted_rate) DESC, {k} LIMIT 10)""" for k in ["pickup", "delivery", "equipment"]]), DEV_CTE))
def a20_group_target_stats(spark, sf):
    return rounded(S.group_target_stats(_train(spark, sf), ["pickup", "delivery", "equipment"]))


@register("a21_equipment_effects", oracle("""
SELECT equipment, count(*) AS loads, round(quantile_cont(posted_rate, 0.5), 6) AS median_rate,
  round(quantile_cont(rate_per_mile, 0.5), 6) AS median_rate_per_mile, round(avg(distance), 6) AS mean_distance
FROM dev GROUP BY equipment""", DEV_CTE))
def a21_equipment_effects(spark, sf):
    return rounded(S.equipment_effects(_dev(spark, sf)))


@register("a22_distance_effects", oracle("""
SELECT distance_band, count(*) AS loads, round(quantile_cont(posted_rate, 0.5), 6) AS median_rate,
  round(quantile_cont(rate_per_mile, 0.5), 6) AS median_rate_per_mile
FROM (SELECT *, CASE WHEN distance >= 0 AND distance < 250 THEN '<250mi' WHEN distance >= 250 AND distance < 500 THEN '250-500mi'
       WHEN distance >= 500 AND distance < 1000 THEN '500-1000mi' WHEN distance >= 1000 AND distance < 2000 THEN '1000-2000mi'
       WHEN distance >= 2000 THEN '>2000mi' END AS distance_band FROM dev)
WHERE distance_band IS NOT NULL GROUP BY distance_band""", DEV_CTE))
def a22_distance_effects(spark, sf):
    return rounded(S.distance_effects(_dev(spark, sf)))


QCUT_SQL = """CASE WHEN {c} IS NULL THEN NULL WHEN {c} <= e[2] THEN 'Q1' WHEN {c} <= e[3] THEN 'Q2'
  WHEN {c} <= e[4] THEN 'Q3' WHEN {c} <= e[5] THEN 'Q4' ELSE 'Q5' END"""


@register("a23_market_effects", oracle(f"""
SELECT market_quintile, count(*) AS loads, round(avg(market_index), 6) AS mean_market_index,
  round(quantile_cont(rate_per_mile, 0.5), 6) AS median_rate_per_mile
FROM (SELECT dev.*, {QCUT_SQL.format(c='market_index')} AS market_quintile
      FROM dev, (SELECT quantile_cont(market_index, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM dev) q)
WHERE market_quintile IS NOT NULL GROUP BY market_quintile""", DEV_CTE))
def a23_market_effects(spark, sf):
    return rounded(S.market_effects(_dev(spark, sf)))


@register("a24_monthly_effects", oracle("""
SELECT strftime(date, '%Y-%m') AS month, count(*) AS loads, round(avg(posted_rate), 6) AS mean_rate,
  round(avg(rate_per_mile), 6) AS mean_rate_per_mile, round(avg(market_index), 6) AS mean_market_index
FROM dev GROUP BY 1""", DEV_CTE))
def a24_monthly_effects(spark, sf):
    return rounded(S.monthly_effects(_dev(spark, sf)))


@register("a25_weekday_effects", oracle("""
SELECT d.day_index, d.day_of_week, g.loads, round(g.mean_rate_per_mile, 6) AS mean_rate_per_mile
FROM (SELECT i - 1 AS day_index, ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][i] AS day_of_week
      FROM range(1, 8) t(i)) d
LEFT JOIN (SELECT dayname(date) AS day_of_week, count(*) AS loads, avg(rate_per_mile) AS mean_rate_per_mile
           FROM dev GROUP BY 1) g ON d.day_of_week = g.day_of_week""", DEV_CTE))
def a25_weekday_effects(spark, sf):
    df = S.weekday_effects(_dev(spark, sf))
    return rounded(df.withColumn("day_index", F.col("day_index").cast("long")))


@register("a26_lane_effects", oracle("""
SELECT pickup, delivery, count(*) AS loads, round(avg(distance), 6) AS mean_distance,
  round(quantile_cont(rate_per_mile, 0.5), 6) AS median_rate_per_mile
FROM dev GROUP BY pickup, delivery HAVING count(*) >= 30
ORDER BY quantile_cont(rate_per_mile, 0.5) DESC, pickup, delivery LIMIT 15""", DEV_CTE))
def a26_lane_effects(spark, sf):
    return rounded(S.lane_effects(_dev(spark, sf)))


@register("a27_daily_market", oracle("""
SELECT date, round(avg(market_index), 6) AS market_index, round(avg(rate_per_mile), 6) AS rate_per_mile
FROM dev GROUP BY date""", DEV_CTE))
def a27_daily_market(spark, sf):
    return rounded(S.daily_market(_dev(spark, sf)))


@register("a29_named_correlations", oracle("""
SELECT name, round(value, 6) AS value FROM (
  SELECT 'distance' AS name, corr(distance, posted_rate) AS value FROM dev
  UNION ALL SELECT 'market_index', corr(market_index, posted_rate) FROM dev
  UNION ALL SELECT 'quote_signal', corr(quote_signal, posted_rate) FROM dev
  UNION ALL SELECT 'weight', corr(abs(weight), posted_rate) FROM dev
  UNION ALL SELECT 'delivery_lon', corr(delivery_lon, posted_rate) FROM dev
  UNION ALL SELECT 'distance_vs_rpm', corr(distance, rate_per_mile) FROM dev
  UNION ALL SELECT 'daily_market_vs_rpm', corr(m, r) FROM daily
  UNION ALL SELECT 'market_elasticity', regr_slope(ln(r), ln(m)) FROM daily
  UNION ALL SELECT 'within_band_market_corr', corr(market_index, rate_per_mile) FROM dev WHERE distance > 340 AND distance < 380)""",
    DEV_CTE + ",\ndaily AS (SELECT date, avg(market_index) AS m, avg(rate_per_mile) AS r FROM dev GROUP BY date)"))
def a29_named_correlations(spark, sf):
    return rounded(S.named_correlations(_dev(spark, sf)))


@register("a35_equipment_premium", oracle("""
SELECT equipment, loads, round(median_rate, 6) AS median_rate, round(e.m, 6) AS median_rate_per_mile,
  round(mean_distance, 6) AS mean_distance, round(100.0 * (e.m / b.m - 1), 6) AS premium_pct
FROM (SELECT equipment, count(*) AS loads, quantile_cont(posted_rate, 0.5) AS median_rate,
        quantile_cont(rate_per_mile, 0.5) AS m, avg(distance) AS mean_distance
      FROM dev GROUP BY equipment) e,
     (SELECT quantile_cont(rate_per_mile, 0.5) AS m FROM dev WHERE equipment = 'Dry Van') b""", DEV_CTE))
def a35_equipment_premium(spark, sf):
    return rounded(S.equipment_premium(_dev(spark, sf)))


@register("a35_monthly_swing", oracle("""
SELECT round(100.0 * (max(r) / min(r) - 1), 6) AS monthly_swing_pct
FROM (SELECT strftime(date, '%Y-%m') AS month, avg(rate_per_mile) AS r FROM dev GROUP BY 1)""", DEV_CTE))
def a35_monthly_swing(spark, sf):
    return rounded(S.monthly_swing(_dev(spark, sf)))


@register("a38_rate_histogram", oracle("""
SELECT b.bin, round(b.bin_lo, 6) AS bin_lo, round(b.bin_hi, 6) AS bin_hi, coalesce(c.cnt, 0) AS count
FROM (SELECT i AS bin,
        CASE WHEN i = 1 THEN lo - (hi - lo) * 0.001 ELSE lo + (i - 1) * ((hi - lo) / 40) END AS bin_lo,
        CASE WHEN i = 40 THEN hi ELSE lo + i * ((hi - lo) / 40) END AS bin_hi
      FROM range(1, 41) t(i), (SELECT min(posted_rate) AS lo, max(posted_rate) AS hi FROM dev) m) b
LEFT JOIN (SELECT b2.bin, count(*) AS cnt FROM dev d,
             (SELECT i AS bin, CASE WHEN i = 1 THEN lo - (hi - lo) * 0.001 ELSE lo + (i - 1) * ((hi - lo) / 40) END AS bl,
                     CASE WHEN i = 40 THEN hi ELSE lo + i * ((hi - lo) / 40) END AS bh
              FROM range(1, 41) t(i), (SELECT min(posted_rate) AS lo, max(posted_rate) AS hi FROM dev) m) b2
           WHERE d.posted_rate > b2.bl AND d.posted_rate <= b2.bh GROUP BY b2.bin) c ON b.bin = c.bin""", DEV_CTE))
def a38_rate_histogram(spark, sf):
    return rounded(S.histogram(_dev(spark, sf), "posted_rate", 40).withColumn("bin", F.col("bin").cast("long")))


@register("a39_box_stats", oracle("""
SELECT round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
  round(min(posted_rate) FILTER (WHERE posted_rate >= q1 - 1.5 * (q3 - q1) AND posted_rate <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round(max(posted_rate) FILTER (WHERE posted_rate >= q1 - 1.5 * (q3 - q1) AND posted_rate <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  count(*) FILTER (WHERE posted_rate IS NOT NULL AND NOT (posted_rate >= q1 - 1.5 * (q3 - q1) AND posted_rate <= q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM train, (SELECT quantile_cont(posted_rate, 0.25) AS q1, quantile_cont(posted_rate, 0.5) AS q2,
                    quantile_cont(posted_rate, 0.75) AS q3 FROM train) q""", DEV_CTE))
def a39_box_stats(spark, sf):
    return rounded(S.box_stats(_train(spark, sf), "posted_rate"))


@register("a36_prediction_stats", oracle("""
SELECT count(p) AS count, round(min(p), 6) AS min, round(quantile_cont(p, 0.05), 6) AS p05,
  round(quantile_cont(p, 0.5), 6) AS median, round(avg(p), 6) AS mean, round(quantile_cont(p, 0.95), 6) AS p95,
  round(max(p), 6) AS max, round(stddev_samp(p), 6) AS std
FROM (SELECT CASE WHEN p0 IS NULL OR isnan(p0) OR isinf(p0) OR p0 < 1.0 THEN 1.0 ELSE p0 END AS p
      FROM (SELECT coalesce(s.distance, 0) * coalesce(r.r, g.r) AS p0 FROM scoring s
            LEFT JOIN rates r ON s.equipment = r.equipment CROSS JOIN g))""",
    DEV_CTE + """,
scoring AS (SELECT * FROM loads WHERE date >= DATE '2001-01-01'),
rates AS (SELECT equipment, quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r
          FROM dev WHERE equipment IS NOT NULL GROUP BY equipment),
g AS (SELECT quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r FROM dev)"""))
def a36_prediction_stats(spark, sf):
    from loadlab.functions.cleaning import floor_predictions
    from loadlab.operators.baselines import fit_rate_per_mile
    model = fit_rate_per_mile(_dev(spark, sf), "equipment")
    p = model.transform(tables.scoring(spark, sf), "p0").withColumn("predicted", floor_predictions("p0", 1.0))
    return rounded(S.prediction_stats(p))


@register("w3_lane_average_rank", oracle("""
SELECT pickup, delivery, loads, cast(floor(rank() OVER (ORDER BY loads DESC)
  + (count(*) OVER (PARTITION BY loads) - 1) / 2.0) AS INTEGER) AS load_rank
FROM (SELECT pickup, delivery, count(*) AS loads FROM dev GROUP BY pickup, delivery)""", DEV_CTE))
def w3_lane_average_rank(spark, sf):
    from loadlab.operators.errors import average_rank
    lanes = _dev(spark, sf).groupBy("pickup", "delivery").agg(F.count(F.lit(1)).alias("loads"))
    return average_rank(lanes, "loads", "load_rank")
