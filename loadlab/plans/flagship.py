"""Flagship slice: clean -> temporal split -> by-equipment median rate per mile on
train -> applied to holdout -> floor -> metrics (S, P4-P7, A43, J3, P10, A30)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadlab.config import DEFAULT, JobConfig
from loadlab.operators.baselines import fit_rate_per_mile
from loadlab.operators.metrics import regression_metrics
from loadlab.plans.common import oracle_clean, rounded, split_frames


def rate_per_mile_holdout(spark: SparkSession, sf_dir: str, group: str | None = "equipment",
                          cfg: JobConfig = DEFAULT) -> DataFrame:
    train, hold = split_frames(spark, sf_dir, cfg)
    model = fit_rate_per_mile(train, group)
    return rounded(regression_metrics(model.transform(hold), cfg.target, "predicted", cfg.prediction_floor))


FLOOR_SQL = "CASE WHEN {p} IS NULL OR isnan({p}) OR isinf({p}) OR {p} < 1.0 THEN 1.0 ELSE {p} END"

METRICS_SQL = """
SELECT round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
  round(CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END, 6) AS r2,
  round(100 * avg(abs((y - p) / y)), 6) AS mape, count(*) AS n
FROM {src}"""

RPM_EQUIPMENT_SQL = oracle_clean(
    METRICS_SQL.format(src="scored"),
    f"""rates AS (SELECT equipment, quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r
            FROM train WHERE equipment IS NOT NULL GROUP BY equipment),
g AS (SELECT quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r FROM train),
raw AS (SELECT h.posted_rate AS y, coalesce(h.distance, 0) * coalesce(rates.r, g.r) AS p0
        FROM holdout h LEFT JOIN rates ON h.equipment = rates.equipment CROSS JOIN g),
scored AS (SELECT y, {FLOOR_SQL.format(p='p0')} AS p FROM raw)""")

RPM_GLOBAL_SQL = oracle_clean(
    METRICS_SQL.format(src="scored"),
    f"""g AS (SELECT quantile_cont(CASE WHEN distance > 0 THEN posted_rate / distance END, 0.5) AS r FROM train),
raw AS (SELECT h.posted_rate AS y, coalesce(h.distance, 0) * g.r AS p0 FROM holdout h CROSS JOIN g),
scored AS (SELECT y, {FLOOR_SQL.format(p='p0')} AS p FROM raw)""")
