"""Registered model jobs.

Model outputs are not SQL-expressible, so most of these are rows-only in the
driver and checked by pytest against closed forms and invariants; the
smearing factor (A46) of the SQL-expressible baseline is oracle-checked.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlab.config import DEFAULT
from loadlab.functions.cleaning import floor_predictions
from loadlab.operators import explain as EX
from loadlab.operators import gram as GR
from loadlab.operators import models as MO
from loadlab.operators import trees as TR
from loadlab.operators.baselines import fit_rate_per_mile
from loadlab.operators.lookup import release
from loadlab.operators.metrics import metrics_by, regression_metrics, smearing_factor
from loadlab.plans.common import oracle, rounded, split_frames
from loadlab.plans.registry import register
from loadlab.sources import tables

SPECS = {s.name: s for s in MO.default_specs()}
# Sizes of the registered tree jobs; the specs' own (200 trees to depth 16, 400 boosting rounds) take
# 12 and 8 minutes on eight threads at sf0.01.
JOB_SIZES = {"RandomForest (log target)": {"numTrees": 40, "maxDepth": 8, "minInstancesPerNode": 1},
             "GBT (log target)": {"maxIter": 40, "maxDepth": 5}}


def _holdout_metrics(spark, sf, name):
    return _model_metrics(tables.kept_windows(spark, sf), name)


def _model_metrics(windows, name):
    model = MO.fit(SPECS[name], windows.train, params=JOB_SIZES.get(name))
    return rounded(regression_metrics(model.predict(windows.holdout)).withColumn("model", F.lit(name)))


def _ridge_metrics(spark, sf, name):
    """M8 by normal equations from one pass of sums."""
    spec = SPECS[name]
    rows, parts = GR.holdout_part(tables.development(spark, sf))
    base, fits = GR.fit_windows(rows, parts, spec.params["alpha"], log=spec.target_transform == "log")
    return rounded(regression_metrics(GR.predict_windows(rows, base, fits)).withColumn("model", F.lit(name)))


register("m7_linear_holdout")(lambda spark, sf: _holdout_metrics(spark, sf, "LinearRegression"))
register("m8_ridge_holdout")(lambda spark, sf: _ridge_metrics(spark, sf, "Ridge (alpha=1.0)"))
register("m8_ridge_log_holdout")(lambda spark, sf: _ridge_metrics(spark, sf, "Ridge (alpha=1.0, log target)"))
register("m10_random_forest_log_holdout")(lambda spark, sf: _holdout_metrics(spark, sf, "RandomForest (log target)"))
register("m11_gbt_log_holdout")(lambda spark, sf: _holdout_metrics(spark, sf, "GBT (log target)"))


def _search(spark, sf, spec):
    """Seeded random search over three expanding folds of the training window; the best
    candidate is refitted on the whole window and measured on the holdout."""
    from loadlab.operators.splits import with_position
    windows = tables.kept_windows(spark, sf)
    pos = with_position(windows.train)
    release(spark)
    found = MO.search(spec, pos, pos.count(), n_folds=3)
    holdout = regression_metrics(found.model.predict(windows.holdout)).first()
    return rounded(found.table.withColumn("holdout_mae", F.when(F.col("best"), F.lit(float(holdout["mae"])))))


@register("m12_ridge_log_search")
def m12_ridge_log_search(spark, sf):
    return _search(spark, sf, MO.ModelSpec("Ridge (log target)", "ridge", "log", params={"alpha": 1.0},
                                           search_space={"alpha": [0.1, 1.0, 10.0, 100.0]}, n_iter=3))


@register("s11_model_roundtrip")
def s11_model_roundtrip(spark, sf):
    """A fitted model with its smearing factor, saved and loaded; holdout predictions of both."""
    from loadlab.sources import files
    windows = tables.kept_windows(spark, sf)
    train, holdout = windows.train, windows.holdout
    model = MO.fit(SPECS["Ridge (alpha=1.0, log target)"], train)
    model.factor = smearing_factor(model.predict_training("posted_rate", "p"), "posted_rate", "p").first()[0]
    path = files.scratch_path(spark, "model")
    model.save(path)
    both = MO.load(path).predict(model.predict(holdout, "fitted"), "loaded")
    return rounded(both.select("load_id", "fitted", "loaded"))


@register("m16_smearing_decision")
def m16_smearing_decision(spark, sf):
    windows = tables.kept_windows(spark, sf)
    model = _ridge_log(windows)
    return rounded(MO.smearing_decision(model, None, windows.holdout))


@register("m21_final_predictions")
def m21_final_predictions(spark, sf):
    """Refit the winner on all development rows, smear if adopted, score the scoring window."""
    spec = SPECS["Ridge (alpha=1.0, log target)"]
    windows = tables.kept_windows(spark, sf, scoring=True)
    built = tables.Windows(MO.built_rows(spec, windows.development))  # both fits read these
    dec = MO.smearing_decision(MO.fit(spec, None, built=built.train), None, windows.holdout).first()
    final = MO.fit(spec, None, built=built.development)
    if dec["adopted"]:
        # The factor is recomputed on the final fit's own training rows.
        final.factor = smearing_factor(final.predict_training("posted_rate", "p"), "posted_rate", "p").first()[0]
    out = final.predict(windows.scoring).select("load_id", F.col("predicted").alias("predicted_rate"))
    return rounded(out)


@register("a46_smearing_factor_rpm", oracle("""
SELECT round(avg(exp(ln(posted_rate) - ln(greatest(p, 1e-9)))), 6) AS smearing_factor
FROM (SELECT t.posted_rate,
        CASE WHEN p0 IS NULL OR isnan(p0) OR isinf(p0) OR p0 < 1.0 THEN 1.0 ELSE p0 END AS p
      FROM (SELECT t.*, coalesce(t.distance, 0) * coalesce(r.r, g.r) AS p0
            FROM train t LEFT JOIN rates r ON t.equipment = r.equipment CROSS JOIN g) t)""",
    """train AS (SELECT * FROM loads WHERE date < DATE '2000-07-01'),
rates AS (SELECT equipment, quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r
          FROM train WHERE equipment IS NOT NULL GROUP BY equipment),
g AS (SELECT quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r FROM train)"""))
def a46_smearing_factor_rpm(spark, sf):
    train = tables.train(spark, sf)
    model = fit_rate_per_mile(train, "equipment")
    p = model.transform(train, "p0").withColumn("p", floor_predictions("p0", 1.0))
    return rounded(smearing_factor(p, "posted_rate", "p"))


M16_MEASURES = ", ".join(f"""
  avg(abs(y - {k})) AS mae_{k}, sqrt(avg((y - {k}) * (y - {k}))) AS rmse_{k},
  1 - sum((y - {k}) * (y - {k})) / (var_pop(y) * count(*)) AS r2_{k},
  100 * avg(abs((y - {k}) / y)) AS mape_{k}, avg(y - {k}) AS bias_{k}""" for k in ("plain", "smeared"))
M16_ROUNDED = ", ".join(f"round({m}_{k}, 6) AS {m}_{k}" for k in ("plain", "smeared") for m in ("mae", "rmse", "r2", "mape", "bias"))


@register("m16_smearing_decision_rpm", oracle(f"""
SELECT round(f, 6) AS smearing_factor, {M16_ROUNDED}, mae_smeared <= mae_plain AS adopted
FROM (SELECT any_value(f) AS f, {M16_MEASURES}
      FROM (SELECT y, f, p AS plain, CASE WHEN p * f < 1.0 THEN 1.0 ELSE p * f END AS smeared
            FROM priced CROSS JOIN factor WHERE NOT training))""",
    """t AS (SELECT *, date < DATE '2000-07-01' AS training FROM loads WHERE date < DATE '2001-01-01'),
rates AS (SELECT equipment, quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r
          FROM t WHERE training AND equipment IS NOT NULL GROUP BY equipment),
g AS (SELECT quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r FROM t WHERE training),
priced AS (SELECT training, y, CASE WHEN p0 IS NULL OR isnan(p0) OR isinf(p0) OR p0 < 1.0 THEN 1.0 ELSE p0 END AS p
           FROM (SELECT t.training, t.posted_rate AS y, coalesce(t.distance, 0) * coalesce(rates.r, g.r) AS p0
                 FROM t LEFT JOIN rates ON t.equipment = rates.equipment CROSS JOIN g)),
factor AS (SELECT avg(exp(ln(y) - ln(greatest(p, 1e-9)))) AS f FROM priced WHERE training)"""))
def m16_smearing_decision_rpm(spark, sf):
    """M16 on the by-equipment rate-per-mile predictions, which SQL can make too."""
    train = tables.train(spark, sf)
    model = fit_rate_per_mile(train, "equipment")
    scored = [model.transform(d, "p0").withColumn("p", floor_predictions("p0", 1.0))
              for d in (train, tables.holdout(spark, sf))]
    return rounded(MO.back_transform_choice(*scored, "posted_rate", "p", 1.0))


def _ridge_log(windows):
    return MO.fit(SPECS["Ridge (alpha=1.0, log target)"], windows.train)


@register("m19_importance_table")
def m19_importance_table(spark, sf):
    windows = tables.kept_windows(spark, sf)
    model = _ridge_log(windows)
    native = EX.native_importance(model)
    perm = EX.permutation_importance_linear(model, windows.holdout, DEFAULT, repeats=5)
    return rounded(EX.importance_table(native, perm))


@register("t9_consensus_features")
def t9_consensus_features(spark, sf):
    windows = tables.kept_windows(spark, sf)
    model = _ridge_log(windows)
    native = EX.native_importance(model)
    perm = EX.permutation_importance_linear(model, windows.holdout, DEFAULT, repeats=5)
    return rounded(EX.consensus(EX.importance_table(native, perm)))


@register("t9_top_views")
def t9_top_views(spark, sf):
    """The first 15 features of each view of the merged ranking."""
    windows = tables.kept_windows(spark, sf)
    model = _ridge_log(windows)
    native = EX.native_importance(model)
    perm = EX.permutation_importance_linear(model, windows.holdout, DEFAULT, repeats=5)
    return rounded(EX.top_views(EX.importance_table(native, perm)))


@register("m17_native_importance_gbt")
def m17_native_importance_gbt(spark, sf):
    return rounded(EX.native_importance(_gbt_log(tables.Windows(tables.development(spark, sf)))))


@register("a47_mean_abs_attribution")
def a47_mean_abs_attribution(spark, sf):
    windows = tables.kept_windows(spark, sf)
    return rounded(EX.mean_abs_attribution_linear(_ridge_log(windows), windows.holdout))


@register("m20_linear_attribution")
def m20_linear_attribution(spark, sf):
    """Every holdout row's attribution to every feature, long form."""
    windows = tables.kept_windows(spark, sf)
    return rounded(EX.linear_attribution(_ridge_log(windows), windows.holdout, DEFAULT))


@register("t7_top_continuous_features")
def t7_top_continuous_features(spark, sf):
    windows = tables.kept_windows(spark, sf)
    model = _ridge_log(windows)
    ranking = EX.mean_abs_attribution_linear(model, windows.holdout)
    frame = model.pipeline.stages[0].transform(windows.holdout)
    return rounded(EX.continuous_top(ranking, frame, "mean_abs_attribution"))


@register("m15_model_cv_folds")
def m15_model_cv_folds(spark, sf):
    """M15 for an ML spec: holdout + expanding folds, all windows fitted from one pass of sums."""
    spec = SPECS["Ridge (alpha=1.0, log target)"]
    rows, parts = GR.expanding_parts(tables.development(spark, sf))
    base, fits = GR.fit_windows(rows, parts, spec.params["alpha"], log=True)
    scored = GR.predict_windows(rows, base, fits)
    return rounded(metrics_by(scored, ["part"]).withColumn("model", F.lit(spec.name)))


@register("t8_seeded_sample")
def t8_seeded_sample(spark, sf):
    """A repeatable sample of 2,000 holdout rows without replacement (the limit is the feature:
    order by a seeded hash of the id; each task keeps at most 2,000 rows)."""
    h = tables.holdout(spark, sf)
    return h.orderBy(F.xxhash64(F.col("load_id"), F.lit(42)), "load_id").limit(2000).select("load_id", "date")


@register("u2_s8_model_comparison")
def u2_s8_model_comparison(spark, sf):
    """Baseline rows and model rows in one ranked table; S8: the importance ranking as CSV."""
    from loadlab.operators import evaluation as EV
    from loadlab.sources import files
    windows = tables.kept_windows(spark, sf)
    base = EV.holdout_table(windows.train, windows.holdout)
    model = _ridge_log(windows)
    ridge = rounded(regression_metrics(model.predict(windows.holdout)).withColumn("model", F.lit(model.spec.name)))
    both = rounded(base).unionByName(ridge.select(*base.columns))
    ranking = EX.mean_abs_attribution_linear(model, windows.holdout)
    files.write_csv(rounded(ranking), files.scratch_path(spark, "importance"), order_by=["rank", "feature"])
    return EV.comparison_table(both)


def _gbt_log(windows):
    return MO.fit(SPECS["GBT (log target)"], windows.train, params=JOB_SIZES["GBT (log target)"])


@register("m18_permutation_importance_gbt")
def m18_permutation_importance_gbt(spark, sf):
    """M18 for a tree model: GBT (log target), only the trees that split on a feature walked again."""
    windows = tables.kept_windows(spark, sf)
    model = _gbt_log(windows)
    perm = TR.permutation_importance_trees(model, windows.holdout, DEFAULT, repeats=5)
    return rounded(EX.importance_table(EX.native_importance(model), perm))


@register("m20_tree_attribution")
def m20_tree_attribution(spark, sf):
    """M20 for the boosted trees: every holdout row's attribution to every feature, long form."""
    windows = tables.kept_windows(spark, sf)
    model = _gbt_log(windows)
    rows = TR.tree_attribution(model, windows.holdout, DEFAULT)
    return rounded(TR.named_attributions(rows, model.feature_names, "load_id", model.constant_features))


@register("m20_tree_attribution_sums")
def m20_tree_attribution_sums(spark, sf):
    """Base value, output of the boosted trees and sum of the attributions of every holdout row."""
    windows = tables.kept_windows(spark, sf)
    rows = TR.tree_attribution(_gbt_log(windows), windows.holdout, DEFAULT)
    total = F.aggregate("attributions", F.lit(0.0), lambda s, a: s + a)
    return rounded(rows.select("load_id", "base_value", "raw_output", total.alias("attribution_sum")))


@register("a47_tree_mean_abs_attribution")
def a47_tree_mean_abs_attribution(spark, sf):
    """A47 of the boosted trees: mean absolute attribution per feature, ranked."""
    windows = tables.kept_windows(spark, sf)
    model = _gbt_log(windows)
    rows = TR.tree_attribution(model, windows.holdout, DEFAULT)
    return rounded(EX.mean_abs_attribution(TR.named_attributions(rows, model.feature_names, "load_id", model.constant_features)))


# A tree with given splits, fitted and explained in both engines: distance, then distance again or weight, and market_index.
PLANTED_NAMES = ["distance", "weight", "market_index"]
PLANTED_SPLITS = ("distance", 900.0, ("distance", 400.0, None, ("weight", 25000.0, None, None)),
                  ("market_index", 1.0, None, ("weight", 25000.0, None, None)))
_OPEN = "'infinity'::DOUBLE"
PLANTED_CTES = f"""c AS (SELECT load_id, date, posted_rate, distance, market_index,
    CASE WHEN abs(weight) < 5000.0 THEN 5000.0 WHEN abs(weight) > 47500.0 THEN 47500.0 ELSE abs(weight) END AS weight FROM loads),
d AS (SELECT * FROM c WHERE distance IS NOT NULL AND weight IS NOT NULL AND market_index IS NOT NULL),
leaf AS (SELECT *, CASE WHEN distance <= 400 THEN 1 WHEN distance <= 900 AND weight <= 25000 THEN 2 WHEN distance <= 900 THEN 3
    WHEN market_index <= 1 THEN 4 WHEN weight <= 25000 THEN 5 ELSE 6 END AS leaf FROM d WHERE date < DATE '2000-07-01'),
n AS (SELECT count(*) AS a, count_if(leaf <= 3) AS l, count_if(leaf IN (2, 3)) AS lr, count_if(leaf >= 4) AS r, count_if(leaf >= 5) AS rr,
    count_if(leaf = 1) AS n1, count_if(leaf = 2) AS n2, count_if(leaf = 3) AS n3, count_if(leaf = 4) AS n4, count_if(leaf = 5) AS n5, count_if(leaf = 6) AS n6 FROM leaf),
v AS (SELECT leaf, avg(posted_rate) AS v FROM leaf GROUP BY leaf),
path AS (SELECT u.* FROM n, LATERAL (VALUES
  (1, 'distance', -{_OPEN}, 400.0, l / a * n1 / l), (2, 'distance', 400.0, 900.0, l / a * lr / l), (2, 'weight', -{_OPEN}, 25000.0, n2 / lr),
  (3, 'distance', 400.0, 900.0, l / a * lr / l), (3, 'weight', 25000.0, {_OPEN}, n3 / lr),
  (4, 'distance', 900.0, {_OPEN}, r / a), (4, 'market_index', -{_OPEN}, 1.0, n4 / r),
  (5, 'distance', 900.0, {_OPEN}, r / a), (5, 'market_index', 1.0, {_OPEN}, rr / r), (5, 'weight', -{_OPEN}, 25000.0, n5 / rr),
  (6, 'distance', 900.0, {_OPEN}, r / a), (6, 'market_index', 1.0, {_OPEN}, rr / r), (6, 'weight', 25000.0, {_OPEN}, n6 / rr)) u(leaf, feature, lo, hi, z)),
x AS (SELECT load_id, unnest(['distance', 'weight', 'market_index']) AS feature, unnest([distance, weight, market_index]) AS val
    FROM d WHERE date >= DATE '2000-07-01' AND date < DATE '2001-01-01'),
o AS (SELECT x.load_id, p.leaf, p.feature, p.z, CASE WHEN x.val > p.lo AND x.val <= p.hi THEN 1.0 ELSE 0.0 END AS o FROM x JOIN path p USING (feature)),
-- Sums over the subsets of the other features on the path (at most two of them), by size.
e AS (SELECT i.load_id, i.leaf, i.feature, i.o, i.z, count(j.feature) AS others, coalesce(product(j.z), 1) AS e0, coalesce(product(j.o), 1) AS e2,
    coalesce(max_by(j.o, j.feature) * min_by(j.z, j.feature) + max_by(j.z, j.feature) * min_by(j.o, j.feature), 0) AS e1
  FROM o i LEFT JOIN o j ON j.load_id = i.load_id AND j.leaf = i.leaf AND j.feature <> i.feature GROUP BY ALL)"""


@register("m20_planted_tree", oracle("""
SELECT load_id, feature, round(sum(v * (o - z) * CASE others WHEN 0 THEN 1 WHEN 1 THEN (e0 + e2) / 2 ELSE e0 / 3 + e1 / 6 + e2 / 3 END), 6) AS attribution
FROM e JOIN v USING (leaf) GROUP BY load_id, feature""", PLANTED_CTES))
def m20_planted_tree(spark, sf):
    """M20 on a tree that SQL can fit and explain too."""
    train, holdout = (d.select("load_id", "posted_rate", *PLANTED_NAMES).na.drop(subset=PLANTED_NAMES) for d in split_frames(spark, sf))
    tree = TR.tree_of_splits(train, PLANTED_SPLITS, PLANTED_NAMES, "posted_rate")
    return rounded(TR.named_attributions(TR.attributed(holdout, [tree], PLANTED_NAMES, "load_id"), PLANTED_NAMES, "load_id"))
