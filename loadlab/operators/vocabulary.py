"""Categories of any number as a written vocabulary and sparse vectors.

A vocabulary is a table (``feature, value, n, slot, rare``): values in use get slots in value order, numbered by a range
partitioning and per-partition offsets; values under the frequency limit share one slot after them, and
missing or unknown values take the last.  Encoding joins a column to its part of the table, so no value passes
through the driver and there is no column per value: the table is written, and the planner
broadcasts it only under its size limit.  Only one number of slots for each feature is collected.

``FeatureEncoder`` names a column for every value and is for small vocabularies; a caller who has more
asks for ``SparseEncoder``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlab.config import DEFAULT, JobConfig, from_json, to_json
from loadlab.functions.cleaning import clean_loads
from loadlab.functions.features import build_features
from loadlab.operators.encode import classify_built, numeric_statistics, scaled_numerics
from loadlab.operators.lookup import written
from loadlab.operators.splits import with_position


@dataclass
class Vocabulary:
    """``table`` (see above) and, per feature, the number of values with a slot of their own and of rare values."""

    table: DataFrame
    frequent: dict[str, int]
    rare: dict[str, int]

    def slots(self, feature: str) -> int:
        """Slots of a feature: own, shared by rare values (if any), unknown."""
        return self.frequent[feature] + (self.rare[feature] > 0) + 1

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: list[str]) -> Vocabulary:
        return cls.of(spark.read.parquet(path), features)

    @classmethod
    def of(cls, table: DataFrame, features: list[str]) -> Vocabulary:
        sizes = {r["feature"]: r for r in table.groupBy("feature").agg(F.count_if(~F.col("rare")).alias("f"), F.count_if("rare").alias("r")).collect()}
        number = lambda k: {c: sizes[c][k] if c in sizes else 0 for c in features}
        return cls(table, number("f"), number("r"))


def fit_vocabulary(rows: DataFrame, features: list[str], min_frequency: int | None = None) -> Vocabulary:
    """The values of ``features`` in ``rows`` (null is no value)."""
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in features]))
    counts = rows.select(pairs).filter("value IS NOT NULL").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    rare = F.col("n") < min_frequency if min_frequency is not None else F.lit(False)
    counts = written(counts.withColumn("rare", rare), "value-counts")
    placed = with_position(counts.filter(~F.col("rare")), JobConfig(date_column="feature", id_column="value"))
    first = {r["feature"]: r["p"] for r in placed.groupBy("feature").agg(F.min("position").alias("p")).collect()}
    starts = F.element_at(F.create_map(*[F.lit(x) for c in features for x in (c, first.get(c, 0))]), F.col("feature"))
    own = placed.select("feature", "value", "n", (F.col("position") - starts).cast("int").alias("slot"), "rare")
    found = Vocabulary.of(own, features)
    shared = F.element_at(F.create_map(*[F.lit(x) for c in features for x in (c, found.frequent[c])]), F.col("feature"))
    table = own.unionByName(counts.filter("rare").withColumn("slot", shared.cast("int")))
    return Vocabulary.of(written(table, "vocabulary"), features)


def with_slots(rows: DataFrame, vocabulary: Vocabulary, features: list[str], suffix: str = "_slot") -> DataFrame:
    """``rows`` with ``<feature>_slot``: the value's slot, the last one for missing and unknown values."""
    out = rows
    for c in features:
        known = vocabulary.table.filter(F.col("feature") == c).select(F.col("value").alias(f"__{c}"), F.col("slot").alias(f"{c}{suffix}"))
        out = out.join(known, F.col(c).cast("string") == F.col(f"__{c}"), "left").drop(f"__{c}")
        out = out.withColumn(f"{c}{suffix}", F.coalesce(f"{c}{suffix}", F.lit(vocabulary.slots(c) - 1)))
    return out


def is_unknown(vocabulary: Vocabulary, feature: str, suffix: str = "_slot"):
    """1.0 where ``with_slots`` met a missing or unknown value."""
    return (F.col(f"{feature}{suffix}") == vocabulary.slots(feature) - 1).cast("double")


@dataclass
class SparseEncoder:
    """M6 with sparse categories: cleaned and built features, numerics imputed and scaled as ``FeatureEncoder`` does, flags,
    and a block of slots for each categorical, in one vector."""

    cfg: JobConfig = DEFAULT
    min_frequency: int | None = None

    def fit(self, train: DataFrame) -> SparseEncoderModel:
        cfg = self.cfg
        built = written(build_features(clean_loads(train, cfg), cfg), "built")
        weight, other, binary = classify_built(built.columns, cfg)
        stats = numeric_statistics(built, weight, other) | {"weight": weight, "other": other, "binary": binary}
        limit = self.min_frequency if self.min_frequency is not None else cfg.min_frequency
        return SparseEncoderModel(cfg, stats, fit_vocabulary(built, list(cfg.categorical), limit))


@dataclass
class SparseEncoderModel:
    cfg: JobConfig
    stats: dict
    vocabulary: Vocabulary

    def transform(self, rows: DataFrame, keep: tuple[str, ...] = ("load_id", "posted_rate"), output: str = "features") -> DataFrame:
        """``keep`` columns and the vector ``output``."""
        cats, s = list(self.cfg.categorical), self.stats
        built = build_features(clean_loads(rows, self.cfg), self.cfg, keep=tuple(c for c in keep if c in rows.columns))
        carried = [c for c in keep if c in rows.columns]
        coded = with_slots(built, self.vocabulary, cats)
        numeric = [*s["weight"], *s["other"], *s["binary"]]
        coded = coded.select(*carried, *scaled_numerics(s), *[F.col(c) for c in s["binary"]], *[f"{c}_slot" for c in cats])
        spark = rows.sparkSession
        # The encoder learns the number of slots from a row with each feature's last one.
        last = spark.createDataFrame([tuple(float(self.vocabulary.slots(c) - 1) for c in cats)], [f"{c}_slot" for c in cats])
        hot = OneHotEncoder(inputCols=[f"{c}_slot" for c in cats], outputCols=[f"{c}_hot" for c in cats], dropLast=False).fit(last)
        vector = VectorAssembler(inputCols=[*numeric, *[f"{c}_hot" for c in cats]], outputCol=output)
        return PipelineModel(stages=[hot, vector]).transform(coded).select(*carried, output)

    @property
    def size(self) -> int:
        """Length of the vectors."""
        return sum(len(self.stats[k]) for k in ("weight", "other", "binary")) + sum(self.vocabulary.slots(c) for c in self.cfg.categorical)

    def save(self, path: str) -> None:
        self.vocabulary.save(f"{path}/vocabulary")
        state = json.dumps({"config": to_json(self.cfg), "stats": self.stats})
        SparkSession.getActiveSession().createDataFrame([(state,)], "state string").coalesce(1).write.mode("overwrite").json(f"{path}/state")

    @classmethod
    def load(cls, path: str) -> SparseEncoderModel:
        spark = SparkSession.getActiveSession()
        state = json.loads(spark.read.schema("state string").json(f"{path}/state").first()["state"])
        cfg = from_json(state["config"])
        return cls(cfg, state["stats"], Vocabulary.load(spark, f"{path}/vocabulary", list(cfg.categorical)))
