"""Rows beside the rows whose values they borrow, for permutation importance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlab.config import JobConfig
from loadlab.functions.cleaning import clean_loads
from loadlab.functions.features import build_features
from loadlab.operators.coded_trees import coded_columns
from loadlab.operators.lookup import discard, release
from loadlab.operators.models import FittedModel
from loadlab.operators.splits import with_position


@dataclass
class Held:
    """What a column of codes holds: a numeric ``feature``, or a categorical's features by code (the number of features: none)."""

    feature: int | None
    by_code: np.ndarray


def held_features(model: FittedModel) -> list[Held]:
    n = len(model.feature_names)
    out = []
    for c in coded_columns(model.pipeline.stages[0], model.feature_names):
        known = model.pipeline.stages[0].fitted
        by_code = np.full(max(len(v) for v in known["vocab"].values()) + 2 if known["vocab"] else 0, n)
        for code, feature in c.indicators.items():
            by_code[code] = feature
        out.append(Held(c.feature, by_code))
    return out


def columns_of(batch: pa.RecordBatch, prefix: str, held: list[Held]) -> list[np.ndarray]:
    return [batch.column(f"{prefix}{j}").to_numpy(zero_copy_only=False) for j in range(len(held))]


def matrix(columns: list[np.ndarray], held: list[Held], n_features: int) -> np.ndarray:
    """Rows x features of a batch's columns of codes."""
    out = np.zeros((len(columns[0]) if columns else 0, n_features + 1))
    for h, x in zip(held, columns, strict=True):
        if h.feature is not None:
            out[:, h.feature] = x
        else:
            out[np.arange(len(x)), h.by_code[x]] = 1.0
    return out[:, :-1]


def permuted_pairs(model: FittedModel, df: DataFrame, cfg: JobConfig, repeats: int, seed: int) -> Iterator[DataFrame]:
    """For each repeat the rows of ``df`` beside the rows that they borrow from (on position, in the order of a seeded hash of the
    id): label ``__y`` and the columns of ``held_features``, own (``o0``, ``o1``..) and borrowed (``d0``, ``d1``..).

    Raw columns go through the shuffles, a fraction of the encoded features' size, and are encoded where rows have met.  Taking
    the next repeat removes what the last one has shuffled and written.
    """
    encoder = model.pipeline.stages[0]
    own = encoder.job_config()
    raw = [c for c in df.columns if c in own.raw_feature_columns]
    y = F.col(cfg.target).cast("double")
    label = F.ln(y) if model.spec.target_transform == "log" else y
    base = df.select(cfg.id_column, label.alias("__y"), F.struct(*raw).alias("__raw"))
    pos = with_position(base, JobConfig(date_column=cfg.id_column, id_column=cfg.id_column))
    columns = coded_columns(encoder, model.feature_names)

    def coded(rows: DataFrame, source: str, prefix: str, keep: list[str]) -> DataFrame:
        built = build_features(clean_loads(rows.select(*keep, f"{source}.*"), own), own, keep=tuple(keep))
        return built.select(*keep, *[c.values.alias(f"{prefix}{j}") for j, c in enumerate(columns)])

    for r in range(repeats):
        key = F.xxhash64(F.col(cfg.id_column), F.lit(seed), F.lit(r))
        perm = with_position(pos.select(cfg.id_column, "__raw").withColumn("__h", key), JobConfig(date_column="__h", id_column=cfg.id_column))
        met = pos.select("position", "__y", "__raw").join(perm.select("position", F.col("__raw").alias("__donor")), "position")
        half = coded(met, "__raw", "o", ["__y", "__donor"])
        yield coded(half, "__donor", "d", ["__y", *[f"o{j}" for j in range(len(columns))]])
        discard(perm.ordered)
        del perm, met, half
        release(df.sparkSession)
    discard(pos.ordered)


def importance_of(increases: list[tuple[int, str, float | None]], spark: SparkSession) -> DataFrame:
    """Mean and population std over repeats of ``(repeat, feature, increase)``."""
    every = spark.createDataFrame(increases, "repeat int, feature string, increase double")
    return every.groupBy("feature").agg(F.avg("increase").alias("permutation_importance"), F.stddev_pop("increase").alias("permutation_std"))
