"""Constant and rate-per-mile baselines.

Fitting computes exact medians by sorting (see ``quantiles``); the fitted
statistics are a handful of numbers, so applying a baseline is a projection
plus (for the grouped rate) one size-checked broadcast join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlab.functions.cleaning import strip_text
from loadlab.functions.features import per_mile
from loadlab.operators.lookup import Lookup, bounded
from loadlab.operators.quantiles import exact_quantiles, quantile_values


def rate_per_mile(y: str = "posted_rate", distance: str = "distance"):
    """Rate per mile, NULL when distance <= 0 (ignored by the median)."""
    return per_mile(F.col(y).cast("double"), F.col(distance).cast("double"))


def rate_table(df: DataFrame, group: str | None = "equipment", y: str = "posted_rate",
               distance: str = "distance") -> DataFrame:
    """Median rate per mile per group plus the global one.

    Exact medians (``exact_quantiles``): no group's values are gathered in one
    task, even a group holding a third of all rows. NULL
    groups are dropped like pandas' groupby.
    """
    rpm = rate_per_mile(y, distance).alias("rpm")
    if group is None:
        return exact_quantiles(df.select(rpm), "rpm", [0.5], [], ["rate_per_mile"]).select(
            F.lit(None).cast("string").alias("group"), F.lit(True).alias("is_global"), "rate_per_mile")
    # Grouped and global medians in one pass: each row once under its group and
    # once under the global key (is_global separates them; NULL groups only count globally).
    g = strip_text(group)
    both = df.select(F.inline(F.array(
        F.struct(g.alias("group"), F.lit(False).alias("is_global"), rpm),
        F.struct(F.lit("").alias("group"), F.lit(True).alias("is_global"), rpm))))
    both = both.filter(F.col("is_global") | F.col("group").isNotNull())
    med = exact_quantiles(both, "rpm", [0.5], ["is_global", "group"], ["rate_per_mile"])
    return med.select(F.when(~F.col("is_global"), F.col("group")).alias("group"), "is_global", "rate_per_mile")


@dataclass
class RatePerMileModel:
    group: str | None
    global_rate: float
    rates: Lookup | None
    distance: str = "distance"

    def transform(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        """J3 + P11: distance x (group rate, else global rate); missing distance gives 0."""
        dist = F.coalesce(F.col(self.distance).cast("double"), F.lit(0.0))
        if self.group is None or self.rates is None:
            return df.withColumn(out, dist * F.lit(self.global_rate))
        keyed = df.withColumn("__grp", strip_text(self.group))
        rates = self.rates.df.select(F.col("group").alias("__grp"), F.col("rate_per_mile").alias("__rpm"))
        joined = Lookup(rates).join(keyed, on="__grp", how="left")
        return joined.withColumn(out, dist * F.coalesce(F.col("__rpm"), F.lit(self.global_rate))).drop("__grp", "__rpm")


def fit_rate_per_mile(df: DataFrame, group: str | None = "equipment", y: str = "posted_rate",
                      distance: str = "distance") -> RatePerMileModel:
    table = rate_table(df, group, y, distance)
    lookup = bounded(table)
    glob = [r["rate_per_mile"] for r in lookup.df.filter("is_global").collect()]  # one row
    g = glob[0] if glob else None
    if g is None:
        raise ValueError("rate-per-mile baseline: no row with distance > 0")
    groups = Lookup(lookup.df.filter(~F.col("is_global"))) if group else None
    return RatePerMileModel(group, float(g), groups, distance)


@dataclass
class ConstantModel:
    kind: str
    value: float

    def transform(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        return df.withColumn(out, F.lit(self.value))


def constant_stats(df: DataFrame, y: str = "posted_rate") -> dict:
    """Mean (one aggregate) and exact median of the target."""
    mean = df.agg(F.avg(y)).first()[0]
    return {"mean_rate": mean, "median_rate": quantile_values(df, y, [0.5])[0]}


def fit_constant(df: DataFrame, kind: str = "mean", y: str = "posted_rate") -> ConstantModel:
    row = constant_stats(df, y)
    value = row["mean_rate"] if kind == "mean" else row["median_rate"]
    if value is None:
        raise ValueError("constant baseline fitted on an empty frame")
    return ConstantModel(kind, float(value))
