"""Descriptive statistics and business effects.

Everything is a grouped or global aggregate; groups here are few (3 equipment
types, 5 bands, months, days, lanes), so the partial aggregate shrinks each
map task's output to a handful of rows before the shuffle. Where a statistic
needs a first pass (quantile edges, histogram range), the one-row result is
fetched to the driver and the second pass uses literals - two scans, no join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlab.config import IQR_MIN_ROWS, IQR_MULTIPLIER, MARKET_QUINTILE_LABELS, SEGMENT_MIN_ROWS, WEEKDAYS
from loadlab.functions.features import distance_band, month_label, per_mile, weekday_name
from loadlab.operators.correlations import pair_correlations
from loadlab.operators.quantiles import column_quantiles, quantile_values, with_medians


def _stack(structs: list[Column]) -> Column:
    return F.inline(F.array(*structs))


def with_rate_per_mile(df: DataFrame, y: str = "posted_rate", distance: str = "distance") -> DataFrame:
    return df.withColumn("rate_per_mile", per_mile(y, distance))


def _column_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float]]:
    """Exact quantiles of several columns (see ``quantiles.column_quantiles``)."""
    return column_quantiles(df, cols, probs)


# ---- A15 ----------------------------------------------------------------------

def iqr_outliers(df: DataFrame, cols: list[str], multiplier: float = IQR_MULTIPLIER,
                 min_rows: int = IQR_MIN_ROWS) -> DataFrame:
    """Per column, fences q1 - m*IQR / q3 + m*IQR and the share outside.

    Pass 1: all quartiles in one aggregate; pass 2: all conditional counts in
    one aggregate with the fences as literals. Columns with n < min_rows or
    IQR = 0 are skipped.
    """
    first = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    quart = _column_quantiles(df, cols, [0.25, 0.75])
    rows, aggs = [], []
    for i, c in enumerate(cols):
        n, q = first[f"n{i}"], quart.get(c)
        if n < min_rows or q is None:
            continue
        iqr = q[1] - q[0]
        if iqr == 0:
            continue
        lo, hi = q[0] - multiplier * iqr, q[1] + multiplier * iqr
        x = F.col(c)
        aggs.append(F.count_if((x < lo) | (x > hi)).alias(f"o{i}"))
        rows.append((i, c, n, lo, hi))
    if not rows:
        return df.sparkSession.createDataFrame([], "feature string, outlier_count long, outlier_pct double, lo double, hi double")
    counts = df.agg(*aggs)
    return counts.select(_stack([
        F.struct(F.lit(c).alias("feature"), F.col(f"o{i}").alias("outlier_count"),
                 (F.lit(100.0) * F.col(f"o{i}") / F.lit(n)).alias("outlier_pct"),
                 F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for i, c, n, lo, hi in rows]))


# ---- A16, A17, A29 --------------------------------------------------------------

def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, long form (a, b, corr), one scan."""
    return pair_correlations(df, cols, cols).select("feature_a", "feature_b", "corr")


def target_correlations(df: DataFrame, cols: list[str], target: str = "posted_rate", top: int = 20) -> DataFrame:
    """corr(feature, target), NaN/NULL dropped, sorted desc, top 20."""
    long = pair_correlations(df, cols, [target]).select(F.col("feature_a").alias("feature"), "corr")
    return long.filter(F.col("corr").isNotNull()).orderBy(F.col("corr").desc(), "feature").limit(top)


def daily_market(df: DataFrame, date: str = "date") -> DataFrame:
    """Daily mean market index and mean rate per mile."""
    return with_rate_per_mile(df).groupBy(date).agg(
        F.avg("market_index").alias("market_index"), F.avg("rate_per_mile").alias("rate_per_mile"))


def named_correlations(df: DataFrame) -> DataFrame:
    """A28 + A29: nine named correlations and the market elasticity as ``(name, value)`` rows.

    Three aggregates unioned: the row-level correlations, the daily table (A27)
    with its correlation and log-log slope (A28), and the 340-380 mile band.
    """
    f = with_rate_per_mile(df)
    row_level = {
        "distance": F.corr("distance", "posted_rate"),
        "market_index": F.corr("market_index", "posted_rate"),
        "quote_signal": F.corr("quote_signal", "posted_rate"),
        "weight": F.corr(F.abs("weight"), "posted_rate"),
        "delivery_lon": F.corr("delivery_lon", "posted_rate"),
        "distance_vs_rpm": F.corr("distance", "rate_per_mile"),
    }
    daily_level = {
        "daily_market_vs_rpm": F.corr("market_index", "rate_per_mile"),
        "market_elasticity": F.regr_slope(F.ln("rate_per_mile"), F.ln("market_index")),
    }

    def long(frame: DataFrame, aggs: dict[str, Column]) -> DataFrame:
        one = frame.agg(*[v.alias(k) for k, v in aggs.items()])
        return one.select(_stack([F.struct(F.lit(k).alias("name"), F.col(k).alias("value")) for k in aggs]))

    band = f.filter((F.col("distance") > 340) & (F.col("distance") < 380))
    return (long(f, row_level).unionByName(long(daily_market(df), daily_level))
            .unionByName(long(band, {"within_band_market_corr": F.corr("market_index", "rate_per_mile")})))


# ---- A18-A20 -----------------------------------------------------------------------

def date_summary(df: DataFrame, date: str = "date") -> DataFrame:
    """Unparsed count, min and max date."""
    d = F.col(date).cast("string").try_cast("date")
    return df.agg(F.count_if(d.isNull()).alias("date_parse_missing"), F.min(d).alias("date_min"), F.max(d).alias("date_max"))


def mean_target_by_date(df: DataFrame, date: str = "date", y: str = "posted_rate") -> DataFrame:
    """A19."""
    return df.groupBy(date).agg(F.avg(y).alias("mean_rate"))


def group_target_stats(df: DataFrame, keys: list[str], y: str = "posted_rate", top: int = 10) -> DataFrame:
    """Count / mean / median of the target per value of each key, top 10 by mean each."""
    out = None
    for k in keys:
        kv = df.select(F.col(k).alias("value"), F.col(y).alias("__y"))
        agg = kv.groupBy("value").agg(F.count(F.lit(1)).alias("count"), F.avg("__y").alias("mean"))
        g = (with_medians(agg, kv, ["value"], {"median": "__y"})
             .orderBy(F.col("mean").desc(), "value").limit(top).withColumn("feature", F.lit(k)))
        out = g if out is None else out.unionByName(g)
    return out


# ---- A21-A26 business effects (output names are fixed values) --------------------------------------------------------

def equipment_effects(df: DataFrame) -> DataFrame:
    """A21."""
    f = with_rate_per_mile(df)
    agg = f.groupBy("equipment").agg(F.count(F.lit(1)).alias("loads"), F.avg("distance").alias("mean_distance"))
    return with_medians(agg, f, ["equipment"], {"median_rate": "posted_rate", "median_rate_per_mile": "rate_per_mile"})


def distance_effects(df: DataFrame) -> DataFrame:
    """By left-closed distance band (F7); rows outside every band dropped."""
    f = (with_rate_per_mile(df).withColumn("distance_band", distance_band("distance"))
         .filter(F.col("distance_band").isNotNull()))
    agg = f.groupBy("distance_band").agg(F.count(F.lit(1)).alias("loads"))
    return with_medians(agg, f, ["distance_band"], {"median_rate": "posted_rate", "median_rate_per_mile": "rate_per_mile"})


def quantile_edges(df: DataFrame, c: str, q: int = 5) -> list[float]:
    """F8 pass 1: interpolated quantile edges [min, ..., max]; equal edges raise."""
    probs = [i / q for i in range(q + 1)]
    edges = quantile_values(df, c, probs)
    if edges[0] is None:
        raise ValueError(f"quantile cut of {c!r}: no values")
    if len(set(edges)) < len(edges):
        raise ValueError(f"quantile cut of {c!r}: equal edges in {edges}")
    return list(edges)


def quantile_cut(c: str | Column, edges: list[float], labels) -> Column:
    """F8 pass 2: right-closed bins on the edges, lowest edge included; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = (c >= lo) & (c <= hi) if i == 0 else (c > lo) & (c <= hi)
        expr = expr.when(cond, F.lit(label))
    return expr


def market_effects(df: DataFrame) -> DataFrame:
    """By market-index quintile (F8)."""
    edges = quantile_edges(df, "market_index", 5)
    f = with_rate_per_mile(df).withColumn("market_quintile", quantile_cut("market_index", edges, MARKET_QUINTILE_LABELS))
    f = f.filter(F.col("market_quintile").isNotNull())
    agg = f.groupBy("market_quintile").agg(F.count(F.lit(1)).alias("loads"), F.avg("market_index").alias("mean_market_index"))
    return with_medians(agg, f, ["market_quintile"], {"median_rate_per_mile": "rate_per_mile"})


def monthly_effects(df: DataFrame) -> DataFrame:
    """A24."""
    return with_rate_per_mile(df).groupBy(month_label("date").alias("month")).agg(
        F.count(F.lit(1)).alias("loads"), F.avg("posted_rate").alias("mean_rate"),
        F.avg("rate_per_mile").alias("mean_rate_per_mile"), F.avg("market_index").alias("mean_market_index"))


def weekday_effects(df: DataFrame) -> DataFrame:
    """Monday..Sunday, absent days kept with NULL stats (left join from a 7-row dimension)."""
    spark = df.sparkSession
    days = spark.createDataFrame([(i, d) for i, d in enumerate(WEEKDAYS)], "day_index int, day_of_week string")
    g = with_rate_per_mile(df).groupBy(weekday_name("date").alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("loads"), F.avg("rate_per_mile").alias("mean_rate_per_mile"))
    return days.join(F.broadcast(g), "day_of_week", "left").orderBy("day_index")


def lane_effects(df: DataFrame, min_loads: int = SEGMENT_MIN_ROWS, top: int = 15) -> DataFrame:
    """A26 + P9: pickup x delivery, loads >= 30, top 15 by median rate per mile."""
    f = with_rate_per_mile(df)
    agg = f.groupBy("pickup", "delivery").agg(F.count(F.lit(1)).alias("loads"), F.avg("distance").alias("mean_distance"))
    return (with_medians(agg, f, ["pickup", "delivery"], {"median_rate_per_mile": "rate_per_mile"})
        .filter(F.col("loads") >= min_loads)
        .orderBy(F.col("median_rate_per_mile").desc(), "pickup", "delivery").limit(top))


def equipment_premium(df: DataFrame, base: str = "Dry Van") -> DataFrame:
    """Median rate-per-mile premium of each equipment over a base value, percent.

    The effects table has one row per equipment type; the base value is read
    from it and applied as a literal.
    """
    eff = equipment_effects(df)
    row = eff.filter(F.col("equipment") == base).select("median_rate_per_mile").first()
    if row is None:
        raise ValueError(f"base equipment {base!r} not present")
    return eff.withColumn("premium_pct", F.lit(100.0) * (F.col("median_rate_per_mile") / F.lit(row[0]) - 1))


def monthly_swing(df: DataFrame) -> DataFrame:
    """(max / min - 1) percent of the monthly mean rate per mile."""
    return monthly_effects(df).agg(
        (F.lit(100.0) * (F.max("mean_rate_per_mile") / F.min("mean_rate_per_mile") - 1)).alias("monthly_swing_pct"))


# ---- A36, A38, A39 ------------------------------------------------------------------

def prediction_stats(df: DataFrame, p: str = "predicted") -> DataFrame:
    """Count, min, p05, median, mean, p95, max, sample std."""
    q = quantile_values(df, p, [0.05, 0.5, 0.95])
    return df.agg(F.count(p).alias("count"), F.min(p).alias("min"), F.avg(p).alias("mean"),
                  F.max(p).alias("max"), F.stddev_samp(p).alias("std")).select(
        "count", "min", F.lit(q[0]).alias("p05"), F.lit(q[1]).alias("median"), "mean",
        F.lit(q[2]).alias("p95"), "max", "std")


def histogram(df: DataFrame, c: str, bins: int = 40) -> DataFrame:
    """Equal-width bins, right-closed, the range widened by 0.1% on the left.

    Edges follow ``linspace(min, max, bins + 1)``; the bin of x is found from
    ``ceil((x - min) / step)`` and corrected against the exact edges. Empty bins
    are kept by a left join from the ``bins``-row dimension.
    """
    lo_hi = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    lo, hi = lo_hi["lo"], lo_hi["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, count long")
    if lo == hi:  # degenerate range: pandas widens by 0.1% each side
        adj = abs(lo) * 0.001 if lo != 0 else 0.001
        edges = list(np.linspace(lo - adj, hi + adj, bins + 1))
    else:
        edges = list(np.linspace(lo, hi, bins + 1))
        edges[0] -= (hi - lo) * 0.001
    x = F.col(c)
    # when-chain over the exact edges (bins is a small parameter).
    idx = None
    for i in range(bins):
        cond = x <= F.lit(float(edges[i + 1]))
        idx = F.when(cond, F.lit(i + 1)) if idx is None else idx.when(cond, F.lit(i + 1))
    counts = df.filter(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    dim = spark.createDataFrame([(i + 1, float(edges[i]), float(edges[i + 1])) for i in range(bins)],
                                "bin int, bin_lo double, bin_hi double")
    return (dim.join(F.broadcast(counts), "bin", "left")
            .withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("long")).orderBy("bin"))


def box_stats(df: DataFrame, c: str, whisker: float = IQR_MULTIPLIER) -> DataFrame:
    """Quartiles, whiskers (most extreme values inside the fences) and outlier count."""
    q = quantile_values(df, c, [0.25, 0.5, 0.75])
    iqr = q[2] - q[0]
    lo_f, hi_f = q[0] - whisker * iqr, q[2] + whisker * iqr
    x = F.col(c)
    inside = (x >= lo_f) & (x <= hi_f)
    return df.agg(
        F.lit(q[0]).alias("q1"), F.lit(q[1]).alias("median"), F.lit(q[2]).alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
        F.count_if(x.isNotNull() & ~inside).alias("n_outliers"))
