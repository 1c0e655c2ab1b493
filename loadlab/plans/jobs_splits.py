"""Registered split, position, fold and baseline-evaluation jobs (W1, W2, S13, A48,
G6, G7, J8, M9, M15, A45, T4, J12) over the development window."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlab.config import DEFAULT
from loadlab.operators import evaluation as EV
from loadlab.operators import splits as SP
from loadlab.plans.common import oracle, rounded
from loadlab.plans.registry import register
from loadlab.sources import tables

POS_CTE = """dev AS (SELECT * FROM loads WHERE date < DATE '2001-01-01'),
pos AS (SELECT *, row_number() OVER (ORDER BY date, load_id) - 1 AS position FROM dev),
nn AS (SELECT count(*) AS n, count(*) // 6 AS t FROM dev),
fr AS (SELECT * FROM (
  SELECT p.*, f.fold,
    CASE WHEN p.position < nn.n - (5 - f.fold) * nn.t THEN 'train'
         WHEN p.position < nn.n - (5 - f.fold) * nn.t + nn.t THEN 'test' END AS role
  FROM pos p, nn, (SELECT range AS fold FROM range(0, 5)) f) WHERE role IS NOT NULL)"""

FLOOR = "CASE WHEN {p} IS NULL OR isnan({p}) OR isinf({p}) OR {p} < 1.0 THEN 1.0 ELSE {p} END"

# The four raw baselines for test rows of each key, fitted on train rows of the same key.
BASELINE_PRED_SQL = """
st AS (SELECT {k}, avg(posted_rate) AS mean_rate, quantile_cont(posted_rate, 0.5) AS median_rate,
         quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS global_rpm
       FROM {train} GROUP BY {k}),
gr AS (SELECT {k}, regexp_replace(equipment, '^\\s+|\\s+$', '', 'g') AS eq,
         quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS group_rpm
       FROM {train} GROUP BY {k}, 2),
jt AS (SELECT t.{k}, t.load_id, t.posted_rate, coalesce(t.distance, 0) AS d, st.mean_rate, st.median_rate, st.global_rpm, gr.group_rpm
       FROM {test} t LEFT JOIN st ON t.{k} = st.{k}
       LEFT JOIN gr ON t.{k} = gr.{k} AND regexp_replace(t.equipment, '^\\s+|\\s+$', '', 'g') = gr.eq),
preds AS (
  SELECT {k}, 'Mean (constant)' AS model, posted_rate AS y, mean_rate AS p0 FROM jt
  UNION ALL SELECT {k}, 'Median (constant)', posted_rate, median_rate FROM jt
  UNION ALL SELECT {k}, 'Rate-per-mile (global)', posted_rate, d * global_rpm FROM jt
  UNION ALL SELECT {k}, 'Rate-per-mile (by equipment)', posted_rate, d * coalesce(group_rpm, global_rpm) FROM jt),
scored AS (SELECT {k}, model, y, """ + FLOOR.format(p="p0") + """ AS p FROM preds)"""

METRICS_COLS = """round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
  round(CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END, 6) AS r2,
  round(100 * avg(abs((y - p) / y)), 6) AS mape, count(*) AS n"""


def _dev(spark, sf):
    return tables.development(spark, sf)


@register("w1_positions", oracle("SELECT load_id, position FROM pos", POS_CTE))
def w1_positions(spark, sf):
    return SP.with_position(_dev(spark, sf)).select("load_id", "position")


@register("s13_stride_sample", oracle("SELECT load_id, position FROM pos WHERE position % 10 = 0", POS_CTE))
def s13_stride_sample(spark, sf):
    return SP.stride_sample(_dev(spark, sf), 10).select("load_id", "position")


@register("w2_fold_membership", oracle("""
SELECT cast(fold AS INTEGER) AS fold, role, count(*) AS rows, min(position) AS pos_min, max(position) AS pos_max,
  min(date) AS date_min, max(date) AS date_max FROM fr GROUP BY fold, role""", POS_CTE))
def w2_fold_membership(spark, sf):
    rows = SP.fold_rows(_dev(spark, sf), DEFAULT.n_cv_splits)
    return rows.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min("position").alias("pos_min"), F.max("position").alias("pos_max"),
        F.min("date").alias("date_min"), F.max("date").alias("date_max"))


@register("g7_leakage_report", oracle("""
SELECT cast(fold AS INTEGER) AS fold, max(date) FILTER (WHERE role = 'train') AS train_max,
  min(date) FILTER (WHERE role = 'test') AS test_min, count(*) FILTER (WHERE role = 'train') AS n_train,
  count(*) FILTER (WHERE role = 'test') AS n_test, 0 AS shared_rows,
  max(date) FILTER (WHERE role = 'train') <= min(date) FILTER (WHERE role = 'test') AS ok
FROM fr GROUP BY fold""", POS_CTE))
def g7_leakage_report(spark, sf):
    rows = SP.fold_rows(_dev(spark, sf), DEFAULT.n_cv_splits)
    return SP.leakage_report(rows).withColumn("shared_rows", F.col("shared_rows").cast("long"))


@register("a48_split_summary", oracle("""
SELECT CASE WHEN date < DATE '2000-07-01' THEN 'train' ELSE 'holdout' END AS split, count(*) AS rows,
  min(date) AS date_min, max(date) AS date_max FROM loads WHERE date < DATE '2001-01-01' GROUP BY 1"""))
def a48_split_summary(spark, sf):
    s = SP.temporal_split(_dev(spark, sf))
    SP.assert_split_valid(s)
    return SP.split_summary(s)


@register("j8_split_overlap", oracle("""
SELECT count(*) AS shared_rows FROM (SELECT load_id FROM loads WHERE date < DATE '2000-07-01') a
WHERE a.load_id IN (SELECT load_id FROM loads WHERE date >= DATE '2000-07-01' AND date < DATE '2001-01-01')"""))
def j8_split_overlap(spark, sf):
    return SP.overlap_count(tables.train(spark, sf), tables.holdout(spark, sf))


@register("m9_baseline_holdout_table", oracle(
    "SELECT model, " + METRICS_COLS + " FROM scored GROUP BY model",
    """train AS (SELECT *, 1 AS k FROM loads WHERE date < DATE '2000-07-01'),
holdout AS (SELECT *, 1 AS k FROM loads WHERE date >= DATE '2000-07-01' AND date < DATE '2001-01-01'),"""
    + BASELINE_PRED_SQL.format(k="k", train="train", test="holdout")))
def m9_baseline_holdout_table(spark, sf):
    columns = ("equipment", "distance", "posted_rate")
    windows = tables.kept_columns(spark, sf, columns, columns)
    return rounded(EV.holdout_table(windows.train, windows.holdout))


CV_CTES = POS_CTE + """,
ftrain AS (SELECT * FROM fr WHERE role = 'train'), ftest AS (SELECT * FROM fr WHERE role = 'test'),""" + \
    BASELINE_PRED_SQL.format(k="fold", train="ftrain", test="ftest")


@register("m15_baseline_cv_folds", oracle(
    "SELECT model, cast(fold AS INTEGER) AS fold, " + METRICS_COLS + " FROM scored GROUP BY model, fold", CV_CTES))
def m15_baseline_cv_folds(spark, sf):
    return rounded(EV.cv_fold_metrics(_dev(spark, sf)))


@register("a45_baseline_cv_summary", oracle("""
SELECT model, round(avg(mae), 6) AS cv_mae_mean, round(stddev_pop(mae), 6) AS cv_mae_std, count(*) AS n_folds
FROM (SELECT model, fold, avg(abs(y - p)) AS mae FROM scored GROUP BY model, fold) GROUP BY model""", CV_CTES))
def a45_baseline_cv_summary(spark, sf):
    return rounded(EV.cv_summary(EV.cv_fold_metrics(_dev(spark, sf))))


@register("t4_j12_baseline_ranking", oracle("""
SELECT h.model, h.mae, h.rmse, h.r2, h.mape, h.n, c.cv_mae_mean, c.cv_mae_std, c.n_folds,
  cast(row_number() OVER (ORDER BY h.mae, h.model) AS INTEGER) AS rank,
  round(100.0 * (max(h.mae) FILTER (WHERE h.model = 'Mean (constant)') OVER () - h.mae)
        / max(h.mae) FILTER (WHERE h.model = 'Mean (constant)') OVER (), 6) AS improvement_pct
FROM (SELECT model, """ + METRICS_COLS + """ FROM hscored GROUP BY model) h
LEFT JOIN (SELECT model, round(avg(mae), 6) AS cv_mae_mean, round(stddev_pop(mae), 6) AS cv_mae_std, count(*) AS n_folds
           FROM (SELECT model, fold, avg(abs(y - p)) AS mae FROM scored GROUP BY model, fold) GROUP BY model) c
ON h.model = c.model""", CV_CTES + """,
htrain AS (SELECT *, 1 AS k FROM loads WHERE date < DATE '2000-07-01'),
hhold AS (SELECT *, 1 AS k FROM loads WHERE date >= DATE '2000-07-01' AND date < DATE '2001-01-01'),
""" + BASELINE_PRED_SQL.format(k="k", train="htrain", test="hhold").replace("st AS", "hst AS").replace(
    "gr AS", "hgr AS").replace("jt AS", "hjt AS").replace("preds AS", "hpreds AS").replace("scored AS", "hscored AS")
    .replace("JOIN st ON", "JOIN hst st ON").replace("JOIN gr ON", "JOIN hgr gr ON").replace("FROM jt", "FROM hjt")
    .replace("FROM preds", "FROM hpreds")))
def t4_j12_baseline_ranking(spark, sf):
    windows = tables.kept_columns(spark, sf, EV.COLUMNS, EV.COLUMNS)  # one star join, for both
    hold = EV.holdout_table(windows.train, windows.holdout)
    cv = rounded(EV.cv_summary(EV.cv_fold_metrics(windows.rows)))
    table = EV.improvement_vs(rounded(hold), "Mean (constant)")
    from pyspark.sql import Window
    ranked = table.join(cv, "model", "left").withColumn("rank", F.row_number().over(Window.orderBy("mae", "model")))
    return rounded(ranked)
