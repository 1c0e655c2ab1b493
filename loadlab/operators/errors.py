"""Error analysis on scored holdout rows.

Sign convention: residual = actual - predicted (positive: under-priced).

The eight segment tables are one job: each row is stacked into one
``(segment, value)`` row per segment and a single ``groupBy(segment, value)``
aggregates them all (segments have few values, so the partial aggregate
collapses each task's rows to a few hundred before the shuffle).

Ordered statistics avoid global windows: the worst 1% are added up above their smallest value, the rolling median and the
Q-Q points use the range-partitioned numbering of ``splits.with_position`` (positions,
or windows partitioned by position blocks plus halo rows), and ranks over large tables
come from running counts of the distinct values (``average_rank``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlab.config import (
    DISTANCE_BAND_LABELS,
    PREDICTION_QUINTILE_LABELS,
    ROLLING_DIVISOR,
    ROLLING_MIN_PERIODS,
    ROLLING_MIN_WINDOW,
    SEGMENT_MIN_ROWS,
    WEEKDAYS,
    WEIGHT_BAND_LABELS,
    WORST_SHARE,
)
from loadlab.functions.features import distance_band, month_label, weekday_name, weight_band
from loadlab.operators.lookup import written
from loadlab.operators.quantiles import column_quantiles, quantile_values, with_medians
from loadlab.operators.rolling import rolling_median_rows
from loadlab.operators.stats import quantile_cut, quantile_edges

SEGMENTS = ("equipment", "distance_band", "weight_band", "month", "day_of_week", "prediction_quintile",
            "pickup", "delivery")
CITY_SEGMENTS = ("pickup", "delivery")


def error_frame(scored: DataFrame, y: str = "posted_rate", p: str = "predicted") -> DataFrame:
    """residual, absolute, percentage and absolute-percentage error, plus segment columns (no weight band without a weight)."""
    r = F.col(y) - F.col(p)
    f = scored.withColumns({
        "residual": r,
        "absolute_error": F.abs(r),
        "percentage_error": F.lit(100.0) * r / F.col(y),
        "month": month_label("date"),
        "day_of_week": weekday_name("date"),
        "distance_band": distance_band("distance"),
    } | ({"weight_band": weight_band("weight")} if "weight" in scored.columns else {})).withColumn("absolute_percentage_error", F.abs("percentage_error"))
    edges = quantile_edges(f, p, 5)
    return f.withColumn("prediction_quintile", quantile_cut(p, edges, PREDICTION_QUINTILE_LABELS))


def segment_table(errors: DataFrame, segments=SEGMENTS, y: str = "posted_rate") -> DataFrame:
    """Rows, MAE, MAPE, bias, median rate per (segment, value); all segments in one aggregate."""
    stacked = errors.select(
        F.inline(F.array(*[F.struct(F.lit(s).alias("segment"), F.col(s).cast("string").alias("value")) for s in segments])),
        "absolute_error", "absolute_percentage_error", "residual", y)
    stacked = stacked.filter(F.col("value").isNotNull())
    agg = stacked.groupBy("segment", "value").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("absolute_error").alias("MAE"),
        F.avg("absolute_percentage_error").alias("MAPE"), F.avg("residual").alias("bias"))
    return with_medians(agg, stacked, ["segment", "value"], {"median_rate": y})


def segment_report(table: DataFrame, min_rows: int = SEGMENT_MIN_ROWS, top_cities: int = 15) -> DataFrame:
    """A31 + P9 + T3: city segments keep rows >= min_rows and their 15 worst by MAE; others whole.
    ``rank`` orders each segment by MAE desc (ties on value)."""
    w = Window.partitionBy("segment").orderBy(F.col("MAE").desc(), F.col("value"))
    city = F.col("segment").isin(*CITY_SEGMENTS)
    kept = table.filter(~city | (F.col("rows") >= min_rows)).withColumn("rank", F.row_number().over(w))
    return kept.filter(~city | (F.col("rank") <= top_cities))


def segment_order(table: DataFrame) -> DataFrame:
    """Calendar / band / quintile order index for plotting-ordered segment rows (join to an order dimension)."""
    spark = table.sparkSession
    dims = ([("distance_band", v, i) for i, v in enumerate(DISTANCE_BAND_LABELS)]
            + [("weight_band", v, i) for i, v in enumerate(WEIGHT_BAND_LABELS)]
            + [("day_of_week", v, i) for i, v in enumerate(WEEKDAYS)]
            + [("prediction_quintile", v, i) for i, v in enumerate(PREDICTION_QUINTILE_LABELS)])
    dim = spark.createDataFrame(dims, "segment string, value string, order_index int")
    return table.join(F.broadcast(dim), ["segment", "value"], "left")


def worst_best(table: DataFrame) -> DataFrame:
    """Per segment the worst and best value by MAE, and the max/min MAE ratio."""
    return table.groupBy("segment").agg(
        F.max_by("value", F.struct("MAE", F.col("value"))).alias("worst_value"), F.max("MAE").alias("worst_mae"),
        F.min_by("value", F.struct("MAE", F.col("value"))).alias("best_value"), F.min("MAE").alias("best_mae"),
        (F.max("MAE") / F.min("MAE")).alias("mae_ratio"))


def headline(errors: DataFrame) -> DataFrame:
    """MAE, median / p95 / p99 / max absolute error, MAPE, bias, median residual."""
    found = column_quantiles(errors, ["absolute_error", "residual"], [0.5, 0.95, 0.99])
    q, med = found["absolute_error"] or [None] * 3, (found["residual"] or [None])[0]
    return errors.agg(F.avg("absolute_error").alias("mae"), F.max("absolute_error").alias("max_abs_error"),
                      F.avg("absolute_percentage_error").alias("mape"), F.avg("residual").alias("bias")).select(
        "mae", F.lit(q[0]).alias("median_abs_error"), F.lit(q[1]).alias("p95_abs_error"),
        F.lit(q[2]).alias("p99_abs_error"), "max_abs_error", "mape", "bias", F.lit(med).alias("median_residual"))


def worst_share(errors: DataFrame, share: float = WORST_SHARE) -> DataFrame:
    """Percent of total absolute error in the worst max(1, round(share n)) rows (half-even).

    k grows with the data (1% of rows), so the worst rows are neither gathered by a
    top-k limit nor sorted: a value between the k-th and the next error is found like a
    quantile, and the errors above it are summed. Rows without an error count among the first, NaN as the last.
    """
    e = F.col("absolute_error")
    st = errors.agg(F.count(F.lit(1)).alias("n"), F.count_if(e.isNull()).alias("none"), F.count_if(~F.isnan(e)).alias("m")).first()
    k = max(1, int(round(share * st["n"])))
    top = min(k - st["none"], st["m"])  # errors to add up
    if k <= st["none"]:
        worst = F.lit(None).cast("double")
    elif top == st["m"]:
        worst = F.sum(e)
    else:
        # Between the ranks of the last error that counts and the one below: halfway, or the value of both.
        cut = F.lit(quantile_values(errors, "absolute_error", [(st["m"] - top - 0.5) / (st["m"] - 1)])[0])
        above = ~F.isnan(e) & (e > cut)
        worst = F.coalesce(F.sum(F.when(above, e)), F.lit(0.0)) + F.when(F.count_if(above) < top, (F.lit(top) - F.count_if(above)) * cut).otherwise(F.lit(0.0))
    return errors.agg((F.lit(100.0) * worst / F.sum(e)).alias("worst_share_pct"), F.lit(k).alias("k"))


def diagnose(errors: DataFrame) -> DataFrame:
    """Eleven residual diagnostics, one row.  Their names and the limits 2.0, 1.5, 0.2 and 3.0 are fixed values."""
    base = errors.agg(
        F.avg("residual").alias("mean_residual"),
        F.stddev_samp("residual").alias("residual_std"), F.count(F.lit(1)).alias("n"),
        F.corr(F.abs("residual"), F.col("predicted")).alias("abs_residual_vs_prediction_corr"),
        F.kurtosis("residual").alias("excess_kurtosis")).first()
    median_residual = quantile_values(errors, "residual", [0.5])[0]
    q = (errors.filter(F.col("prediction_quintile").isNotNull()).groupBy("prediction_quintile")
         .agg(F.stddev_samp("residual").alias("s")).agg((F.max("s") / F.min("s")).alias("r")).first()["r"])
    ws = worst_share(errors).first()["worst_share_pct"]
    se = base["residual_std"] / math.sqrt(base["n"]) if base["n"] else 0.0
    bias_t = base["mean_residual"] / se if se else 0.0
    row = {
        "mean_residual": base["mean_residual"], "median_residual": median_residual,
        "residual_std": base["residual_std"], "bias_t_statistic": bias_t,
        "bias_is_significant": abs(bias_t) > 2.0, "quintile_std_ratio": q,
        "abs_residual_vs_prediction_corr": base["abs_residual_vs_prediction_corr"],
        "heteroscedastic": bool(q > 1.5 or abs(base["abs_residual_vs_prediction_corr"]) > 0.2),
        "excess_kurtosis": base["excess_kurtosis"], "worst_1pct_share_of_total_error": ws,
        "heavy_tailed": bool(base["excess_kurtosis"] > 3.0),
    }
    schema = ("mean_residual double, median_residual double, residual_std double, bias_t_statistic double, "
              "bias_is_significant boolean, quintile_std_ratio double, abs_residual_vs_prediction_corr double, "
              "heteroscedastic boolean, excess_kurtosis double, worst_1pct_share_of_total_error double, heavy_tailed boolean")
    return errors.sparkSession.createDataFrame([tuple(row.values())], schema)


def worst_rows(errors: DataFrame, top_n: int = 20) -> DataFrame:
    """The top_n largest absolute errors (ties on load_id) with their key columns."""
    cols = ["load_id", "pickup", "delivery", "equipment", "distance", "weight", "date", "market_index",
            "posted_rate", "predicted", "residual", "absolute_error", "absolute_percentage_error"]
    return errors.select(*[c for c in cols if c in errors.columns]).orderBy(
        F.col("absolute_error").desc(), F.col("load_id")).limit(top_n)


def representative_rows(errors: DataFrame) -> DataFrame:
    """T5: typical (min |residual|), worst under- and over-prediction ids; ties on load_id."""
    return errors.agg(
        F.min_by("load_id", F.struct(F.abs("residual"), F.col("load_id"))).alias("typical"),
        F.min_by("load_id", F.struct(-F.col("residual"), F.col("load_id"))).alias("worst_underprediction"),
        F.min_by("load_id", F.struct(F.col("residual"), F.col("load_id"))).alias("worst_overprediction"))


def average_rank_desc(df: DataFrame, value: str, out: str, partition: list[str] | None = None) -> DataFrame:
    """Descending average rank (ties share the mean of their positions), truncated to int.

    For tables with one row per feature or model; ``average_rank`` ranks tables that grow with the data.
    """
    w = Window.partitionBy(*(partition or [])).orderBy(F.col(value).desc())
    wt = Window.partitionBy(*(partition or []), value)
    return (df.withColumn("__r", F.rank().over(w)).withColumn("__t", F.count(F.lit(1)).over(wt))
            .withColumn(out, F.floor(F.col("__r") + (F.col("__t") - 1) / 2.0).cast("int")).drop("__r", "__t"))


def average_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """W3 at any size: the same ranks as ``average_rank_desc`` without a window over all rows.

    Distinct values are counted, range-partitioned downwards and written with their partition's
    number; a value's rank is the count of its predecessors in the partition plus the partition's offset
    (one row per partition). The ranks are joined back on the value, NULL last as a value of its own.
    """
    part = "__part"
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__t"))
    runs = written(counts.repartitionByRange(F.col(value).desc()).withColumn(part, F.spark_partition_id()), "rank-runs")
    sizes = runs.groupBy(part).agg(F.sum("__t").alias("__n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(part).orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = runs.withColumn("__in", F.coalesce(F.sum("__t").over(inside), F.lit(0))).join(offsets, part).select(
        F.col(value).alias("__v"),
        F.floor(F.col("__off") + F.col("__in") + 1 + (F.col("__t") - 1) / 2.0).cast("int").alias(out))
    return df.join(written(ranks, "ranks"), F.col(value).eqNullSafe(F.col("__v"))).drop("__v")


def rolling_median(errors: DataFrame, driver: str, value: str = "residual", id_col: str = "load_id",
                   block: int | None = None, bucket: int | None = None) -> DataFrame:
    """Centred rolling median of ``value`` over rows sorted by ``driver``; window
    max(50, n // 40) rows, NULL when fewer than 10 rows are in the frame (see ``rolling``)."""
    from loadlab.operators.splits import with_position
    from loadlab.config import JobConfig

    pos = written(with_position(errors.select(id_col, driver, value), JobConfig(date_column=driver, id_column=id_col)), "positions")
    w = max(ROLLING_MIN_WINDOW, pos.count() // ROLLING_DIVISOR)
    medians = rolling_median_rows(pos, value, w // 2, (w - 1) // 2, ROLLING_MIN_PERIODS, block, bucket)
    return pos.join(medians, "position").select(id_col, driver, value, "position", "rolling_median")


def _norm_ppf(p: Column) -> Column:
    """Inverse standard normal CDF (Acklam's rational approximation), as column math."""
    # --- fixed values: published coefficients of the approximation ---
    a = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02,
         -3.066479806614716e01, 2.506628277459239e00)
    b = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01,
         -1.328068155288572e01)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00,
         4.374664141464968e00, 2.938163982698783e00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
    # --- end fixed values ---
    plow = 0.02425

    def poly(coefs, x):
        out = F.lit(coefs[0])
        for k in coefs[1:]:
            out = out * x + F.lit(k)
        return out

    ql = F.sqrt(F.lit(-2.0) * F.ln(p))
    qh = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - p))
    q = p - 0.5
    r = q * q
    low = poly(c, ql) / (poly(d, ql) * ql + 1)
    high = -poly(c, qh) / (poly(d, qh) * qh + 1)
    mid = poly(a, r) * q / (poly(b, r) * r + 1)
    return F.when(p < plow, low).when(p > 1 - plow, high).otherwise(mid)


def qq_points(errors: DataFrame, value: str = "residual") -> DataFrame:
    """Standardised sorted residual vs the normal quantile at (i - 0.5) / n."""
    from loadlab.operators.splits import with_position
    from loadlab.config import JobConfig

    st = errors.agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.stddev_samp(value).alias("s")).first()
    pos = with_position(errors.filter(F.col(value).isNotNull()).select("load_id", value),
                        JobConfig(date_column=value, id_column="load_id"))
    p = (F.col("position") + 0.5) / F.lit(st["n"])
    return pos.select("load_id", "position", ((F.col(value) - F.lit(st["m"])) / F.lit(st["s"])).alias("sample_quantile"),
                      _norm_ppf(p).alias("theoretical_quantile"))
