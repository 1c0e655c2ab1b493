"""Regression metrics as one aggregate (A30), fold summary (A45), smearing.

Each returns a one-row DataFrame (lazy). ``metrics_by`` computes the same
record per group (per fold, per model) in one shuffle of partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlab.config import PREDICTION_FLOOR, SMEARING_EPS
from loadlab.functions.cleaning import floor_predictions


def _metric_columns(y: Column, p: Column) -> list[Column]:
    r = y - p
    n = F.count(F.lit(1))
    sse = F.sum(r * r)
    sst = F.var_pop(y) * n
    return [
        F.avg(F.abs(r)).alias("mae"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        # R2 is undefined (NULL) when the truth is constant.
        F.when(sst > 0, F.lit(1.0) - sse / F.when(sst > 0, sst)).alias("r2"),
        F.when(F.count_if(y == 0) > 0,
               F.raise_error(F.lit("a true value of zero leaves no percentage error")).cast("double"))
        .otherwise(F.lit(100.0) * F.avg(F.abs(r / F.when(y != 0, y)))).alias("mape"),
        n.alias("n"),
    ]


def error_measures(y: str, p: str, suffix: str) -> list[Column]:
    """A30's measures but the count, and the bias mean(y - p), as aggregates named ``<measure>_<suffix>``."""
    names = ["mae", "rmse", "r2", "mape"]
    found = _metric_columns(F.col(y), F.col(p))[:len(names)]
    return [c.alias(f"{n}_{suffix}") for n, c in zip(names, found)] + [F.avg(F.col(y) - F.col(p)).alias(f"bias_{suffix}")]


def regression_metrics(df: DataFrame, y: str = "posted_rate", p: str = "predicted",
                       floor: float | None = PREDICTION_FLOOR) -> DataFrame:
    """MAE, RMSE, R2, MAPE %, n; predictions floored first (P10)."""
    pred = floor_predictions(p, floor) if floor is not None else F.col(p)
    return df.select(F.col(y).cast("double").alias("__y"), pred.alias("__p")).agg(
        *_metric_columns(F.col("__y"), F.col("__p")))


def metrics_by(df: DataFrame, keys: list[str], y: str = "posted_rate", p: str = "predicted",
               floor: float | None = PREDICTION_FLOOR) -> DataFrame:
    """A30 per group (fold, model, segment): partial aggregation, one shuffle."""
    pred = floor_predictions(p, floor) if floor is not None else F.col(p)
    return (df.select(*keys, F.col(y).cast("double").alias("__y"), pred.alias("__p"))
            .groupBy(*keys).agg(*_metric_columns(F.col("__y"), F.col("__p"))))


def fold_summary(fold_metrics: DataFrame, keys: list[str] | None = None, value: str = "mae") -> DataFrame:
    """Mean and population std of per-fold MAE."""
    aggs = [F.avg(value).alias("cv_mae_mean"), F.stddev_pop(value).alias("cv_mae_std"),
            F.count(F.lit(1)).alias("n_folds")]
    return fold_metrics.groupBy(*(keys or [])).agg(*aggs)


def smearing_factor(df: DataFrame, y: str = "posted_rate", p: str = "predicted") -> DataFrame:
    """Duan factor mean(exp(ln y - ln max(p, eps))); must be finite and > 0."""
    term = F.exp(F.ln(F.col(y)) - F.ln(F.greatest(F.col(p), F.lit(SMEARING_EPS))))
    f = F.avg(term)
    ok = f.isNotNull() & ~F.isnan(f) & (f > 0) & (f != F.lit(float("inf")))
    return df.agg(F.when(ok, f).otherwise(
        F.raise_error(F.lit("smearing factor is not finite and positive")).cast("double")).alias("smearing_factor"))
