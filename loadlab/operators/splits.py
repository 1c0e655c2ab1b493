"""Temporal split, stable positions and expanding-window folds (P7, W1, W2, S13,
A48, G6, G7, J8).

Global order without a global window: rows are range-partitioned on
``(date, load_id)`` - the id splits even a date that holds a third of all rows
across many tasks - sorted within partitions, and numbered by
``partition offset + index in partition``. The offsets come from a table with
one row per partition (bounded by the partition count, so broadcast). The
numbered frame is written to the shared folder so a lost executor cannot
renumber rows between the offset job and its users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlab.config import DEFAULT, JobConfig
from loadlab.operators.lookup import written


def temporal_split(df: DataFrame, cfg: JobConfig = DEFAULT, boundary=None) -> DataFrame:
    """One frame with a ``split`` column (train / holdout), dates strictly before the boundary train."""
    b = F.lit(boundary or cfg.holdout_start)
    return df.withColumn("split", F.when(F.col(cfg.date_column) < b, "train").otherwise("holdout"))


def split_summary(split_df: DataFrame, cfg: JobConfig = DEFAULT) -> DataFrame:
    """Rows and date range per side."""
    d = F.col(cfg.date_column)
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min(d).alias("date_min"),
                                         F.max(d).alias("date_max"))


def assert_split_valid(split_df: DataFrame, cfg: JobConfig = DEFAULT) -> dict:
    """Unparsed dates, empty sides and overlap raise; returns the summary as a dict (one job)."""
    d = F.col(cfg.date_column)
    row = split_df.agg(
        F.count_if(d.isNull()).alias("unparsed"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "holdout").alias("n_holdout"),
        F.min(F.when(F.col("split") == "train", d)).alias("train_min"),
        F.max(F.when(F.col("split") == "train", d)).alias("train_max"),
        F.min(F.when(F.col("split") == "holdout", d)).alias("holdout_min"),
        F.max(F.when(F.col("split") == "holdout", d)).alias("holdout_max")).first().asDict()
    if row["unparsed"]:
        raise ValueError(f"{cfg.date_column!r} has {row['unparsed']} value(s) that are no dates")
    if row["n_train"] == 0:
        raise ValueError("no rows before the split date")
    if row["n_holdout"] == 0:
        raise ValueError("no rows from the split date on")
    if row["train_max"] >= row["holdout_min"]:
        raise ValueError(f"train reaches {row['train_max']}, past the holdout's start {row['holdout_min']}")
    return row


def with_position(df: DataFrame, cfg: JobConfig = DEFAULT, n_partitions: int | None = None) -> DataFrame:
    """0-based position in (date, id) order, computed without a global window."""
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(n, cfg.date_column, cfg.id_column)
               .sortWithinPartitions(cfg.date_column, cfg.id_column)
               .withColumn("__pid", F.spark_partition_id())
               .withColumn("__mid", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("__idx", F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)).drop("__mid")
    # Parquet: a checkpoint of the same rows is several times as large (rows as they lie in memory, not compressed).
    ordered = written(ordered, "ordered")
    sizes = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: a window over it is a small, single-task job by design.
    offsets = sizes.withColumn("__off", F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = F.broadcast(offsets.select("__pid", F.coalesce("__off", F.lit(0)).alias("__off")))
    out = (ordered.join(offsets, "__pid").withColumn("position", F.col("__off") + F.col("__idx"))
           .drop("__pid", "__idx", "__off"))
    out.ordered = ordered  # for callers that ``discard`` it after use
    return out


def fold_bounds(n: int, k: int) -> list[tuple[int, int, int]]:
    """W2 (TimeSeriesSplit): fold i trains on [0, s_i) and tests on [s_i, s_i + t), t = n // (k + 1)."""
    t = n // (k + 1)
    if t < 1:
        raise ValueError(f"{n} rows are too few for {k} expanding folds")
    return [(i, n - (k - i) * t, t) for i in range(k)]


def with_folds(positioned: DataFrame, n: int, k: int) -> DataFrame:
    """``test_fold`` (fold tested on, or NULL) and ``train_folds`` (folds trained on) per row."""
    bounds = fold_bounds(n, k)
    pos = F.col("position")
    test = None
    for i, s, t in bounds:
        cond = (pos >= s) & (pos < s + t)
        test = F.when(cond, F.lit(i)) if test is None else test.when(cond, F.lit(i))
    train = F.array_compact(F.array(*[F.when(pos < s, F.lit(i)) for i, s, _ in bounds]))
    return positioned.withColumn("test_fold", test).withColumn("train_folds", train)


def fold_rows(df: DataFrame, k: int, cfg: JobConfig = DEFAULT) -> DataFrame:
    """Rows tagged with ``fold`` and ``role`` (train / test): each row appears once per
    fold it belongs to (at most k + 1 copies, k is a small parameter)."""
    positioned = with_position(df, cfg)
    n = positioned.count()
    tagged = with_folds(positioned, n, k)
    train = tagged.select("*", F.explode("train_folds").alias("fold")).withColumn("role", F.lit("train"))
    test = tagged.filter(F.col("test_fold").isNotNull()).withColumn("fold", F.col("test_fold")).withColumn("role", F.lit("test"))
    return train.drop("train_folds", "test_fold").unionByName(test.drop("train_folds", "test_fold"))


def stride_sample(df: DataFrame, step: int, cfg: JobConfig = DEFAULT) -> DataFrame:
    """Every ``step``-th row in (date, id) order (``iloc[::step]``)."""
    return with_position(df, cfg).filter(F.pmod(F.col("position"), F.lit(step)) == 0)


def leakage_report(folds: DataFrame, cfg: JobConfig = DEFAULT) -> DataFrame:
    """Per fold, train max date vs test min date and shared rows; ``ok`` when
    train max <= test min (a fold border may cut inside a date) and no row is shared."""
    d = F.col(cfg.date_column)
    dates = folds.groupBy("fold").agg(
        F.max(F.when(F.col("role") == "train", d)).alias("train_max"),
        F.min(F.when(F.col("role") == "test", d)).alias("test_min"),
        F.count_if(F.col("role") == "train").alias("n_train"),
        F.count_if(F.col("role") == "test").alias("n_test"))
    shared = (folds.groupBy("fold", cfg.id_column).agg(F.count_distinct("role").alias("__r"))
              .groupBy("fold").agg(F.count_if(F.col("__r") > 1).alias("shared_rows")))
    return (dates.join(shared, "fold", "left").withColumn("shared_rows", F.coalesce("shared_rows", F.lit(0)))
            .withColumn("ok", (F.col("train_max") <= F.col("test_min")) & (F.col("shared_rows") == 0)))


def overlap_count(a: DataFrame, b: DataFrame, key: str = "load_id") -> DataFrame:
    """Rows of ``a`` whose id is also in ``b`` (must be 0 for a valid split)."""
    return a.select(key).join(b.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("shared_rows"))
