"""Output contracts as jobs.

Each check is an aggregate or an anti-join producing counts; a ``*_report``
function returns them as rows, an ``assert_*`` function raises on the first
violation. Nothing is collected but the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlab.config import (
    SCENARIO_DELIVERY,
    SCENARIO_DISTANCE,
    SCENARIO_END,
    SCENARIO_EQUIPMENT,
    SCENARIO_PICKUP,
    SCENARIO_START,
    SCENARIO_WEIGHT,
)
from loadlab.functions.cleaning import coerce_number, is_finite

SUBMISSION_COLUMNS = ["load_id", "predicted_rate"]
SCENARIO_OUTPUT_COLUMNS = ["pickup", "delivery", "distance", "equipment", "weight", "date", "predicted_rate"]


def id_differences(submitted: DataFrame, expected: DataFrame, key: str = "load_id") -> DataFrame:
    """J7 + U4: ids missing from and extra in the submission (two anti-joins), one row."""
    a = submitted.select(key).distinct()
    b = expected.select(key).distinct()
    missing = b.join(a, key, "left_anti").agg(F.count(F.lit(1)).alias("missing_ids"))
    extra = a.join(b, key, "left_anti").agg(F.count(F.lit(1)).alias("extra_ids"))
    return missing.unionByName(extra, allowMissingColumns=True).agg(
        F.max("missing_ids").alias("missing_ids"), F.max("extra_ids").alias("extra_ids"))


def submission_report(submission: DataFrame, template: DataFrame, key: str = "load_id") -> DataFrame:
    """The seven scorer checks as counts (schema checked on the driver).

    ``template`` carries ``position`` (template order); order equality (J9) is a
    join on id comparing the submission's ``position`` with the template's.
    """
    if submission.columns[:2] != SUBMISSION_COLUMNS:
        raise ValueError(f"a submission starts with {SUBMISSION_COLUMNS}; this one has {submission.columns}")
    rate = coerce_number("predicted_rate")
    stats = submission.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("missing_ids_in_submission"),
        (F.count(F.col(key)) - F.count_distinct(key)).alias("duplicate_ids"),
        F.count_if(~is_finite(rate)).alias("non_finite_rates"),
        F.count_if(is_finite(rate) & (rate <= 0)).alias("non_positive_rates"))
    diff = id_differences(submission, template, key)
    order = (submission.select(key, F.col("position").alias("__sp"))
             .join(template.select(key, F.col("position").alias("__tp")), key)
             .agg(F.count_if(F.col("__sp") != F.col("__tp")).alias("out_of_order")))
    n_template = template.agg(F.count(F.lit(1)).alias("expected_rows"))
    return (stats.withColumn("__k", F.lit(0)).join(diff.withColumn("__k", F.lit(0)), "__k")
            .join(order.withColumn("__k", F.lit(0)), "__k").join(n_template.withColumn("__k", F.lit(0)), "__k").drop("__k"))


def assert_submission(report: DataFrame) -> list[str]:
    r = report.first().asDict()
    checks = {
        "row count differs from the template": r["rows"] != r["expected_rows"],
        "load_id null or repeated": r["missing_ids_in_submission"] + r["duplicate_ids"],
        "load_id set differs from the template": r["missing_ids"] + r["extra_ids"],
        "rows out of the template's order": r["out_of_order"],
        "rates not finite": r["non_finite_rates"],
        "rates not positive": r["non_positive_rates"],
    }
    for what, found in checks.items():  # the first fault decides
        if found:
            raise ValueError(f"submission: {what} ({int(found)})")
    return ["schema", "rows", "ids unique", "ids match", "order", "finite", "positive"]


def calendar_differences(frame: DataFrame, start=SCENARIO_START, end=SCENARIO_END, date: str = "date") -> DataFrame:
    """Dates missing from / extra to the calendar (both directions of ``subtract``)."""
    spark = frame.sparkSession
    cal = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias(date))
    got = frame.select(F.col(date).cast("string").try_cast("date").alias(date))
    missing = cal.subtract(got).agg(F.count(F.lit(1)).alias("missing_dates"))
    extra = got.subtract(cal).agg(F.count(F.lit(1)).alias("extra_dates"))
    return missing.withColumn("__k", F.lit(0)).join(extra.withColumn("__k", F.lit(0)), "__k").drop("__k")


def scenario_report(frame: DataFrame) -> DataFrame:
    """Scenario contract counts (constants with isclose tolerance, dates, positivity)."""
    if frame.columns != SCENARIO_OUTPUT_COLUMNS:
        raise ValueError(f"scenario columns must be {SCENARIO_OUTPUT_COLUMNS}")

    def not_close(c, v):
        x = coerce_number(c)
        return x.isNull() | (F.abs(x - F.lit(v)) > F.lit(1e-8) + F.lit(1e-5) * F.lit(abs(v)))

    d = F.col("date").cast("string").try_cast("date")
    stats = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(d.isNull()).alias("invalid_dates"),
        (F.count(d) - F.count_distinct(d)).alias("duplicate_dates"),
        F.count_if(F.col("pickup") != F.lit(SCENARIO_PICKUP)).alias("bad_pickup"),
        F.count_if(F.col("delivery") != F.lit(SCENARIO_DELIVERY)).alias("bad_delivery"),
        F.count_if(not_close("distance", SCENARIO_DISTANCE)).alias("bad_distance"),
        F.count_if(F.col("equipment") != F.lit(SCENARIO_EQUIPMENT)).alias("bad_equipment"),
        F.count_if(not_close("weight", SCENARIO_WEIGHT)).alias("bad_weight"),
        F.count_if(~is_finite(coerce_number("predicted_rate")) | (coerce_number("predicted_rate") <= 0)).alias("bad_rate"))
    cal = calendar_differences(frame)
    return stats.withColumn("__k", F.lit(0)).join(cal.withColumn("__k", F.lit(0)), "__k").drop("__k")


def _fingerprint(df: DataFrame, side: int) -> DataFrame:
    """Two hashes of each row, in which a null is told from every value and from a null elsewhere."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    every = [nulls, *[F.col(f"`{c}`") for c in df.columns]]
    exact = lambda h: h.cast("decimal(20,0)")
    return df.select(F.lit(side).alias("side"), exact(F.xxhash64(*every)).alias("h1"), exact(F.xxhash64(F.lit("second"), *every)).alias("h2"))


def compare_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Whether two frames hold the same multiset of rows, as one row ``rows_a, rows_b, same``.

    Compared by an order-free fingerprint: the number of rows and the sums of two 64-bit row hashes, combined on the
    map side, so no row is shuffled.  Columns must agree in name, order and type.
    """
    if a.dtypes != b.dtypes:
        raise ValueError(f"columns differ: {a.dtypes} and {b.dtypes}")
    of = lambda agg, col, side: agg(F.when(F.col("side") == side, F.col(col)))
    one = _fingerprint(a, 0).unionByName(_fingerprint(b, 1)).agg(*[
        of(agg, col, side).alias(f"{name}{side}") for side in (0, 1) for name, agg, col in (("n", F.count, "side"), ("x", F.sum, "h1"), ("y", F.sum, "h2"))])
    same = F.col("n0").eqNullSafe(F.col("n1")) & F.col("x0").eqNullSafe(F.col("x1")) & F.col("y0").eqNullSafe(F.col("y1"))
    return one.select(F.col("n0").alias("rows_a"), F.col("n1").alias("rows_b"), same.alias("same"))


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one frame holds more often than the other, with ``side`` (a or b); for frames that ``compare_rows`` tells apart."""
    return a.exceptAll(b).select(F.lit("a").alias("side"), "*").unionByName(b.exceptAll(a).select(F.lit("b").alias("side"), "*"))


def assert_same_rows(a: DataFrame, b: DataFrame) -> None:
    """Raises unless two frames hold the same multiset of rows, showing a few that differ."""
    found = compare_rows(a, b).first()
    if not found["same"]:
        shown = [tuple(r) for r in row_differences(a, b).limit(4).collect()]
        raise ValueError(f"frames differ ({found['rows_a']} and {found['rows_b']} rows): refit is not deterministic; e.g. {shown}")
