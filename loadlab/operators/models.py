"""Model specs, fitting and scoring with pyspark.ml.

A model is a ``Pipeline``: ``FeatureEncoder`` (fitted on the training split
only) -> ``VectorAssembler`` -> regressor, with the label optionally on log
scale. Training data is never collected; fold fits are independent Spark
jobs driven from a short driver loop over (candidate, fold).
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import asdict, dataclass, field
from functools import cached_property
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlab.config import DEFAULT, JobConfig, to_json
from loadlab.functions.cleaning import clean_loads, exp_target, floor_predictions, log_target
from loadlab.functions.features import build_features
from loadlab.operators import coded_trees
from loadlab.operators.encode import FeatureEncoder
from loadlab.operators.lookup import discard, written
from loadlab.operators.metrics import error_measures, regression_metrics, smearing_factor
from loadlab.session import small_methods

LABEL = "__label"
# Rows of a tree fit, if there is a file for each core: partitions a core, splits a partition, and rows a written file (a
# split holds whole files).
WAVES, SPLITS, FILE_ROWS = 2, 8, 50_000


@dataclass
class ModelSpec:
    """A named regressor, its target transform and its search space."""

    name: str
    kind: str  # linear | ridge | rf | gbt
    target_transform: str = "identity"  # identity | log
    params: dict = field(default_factory=dict)
    search_space: dict = field(default_factory=dict)
    n_iter: int = 0


# --- fixed values: published search grids of the two tree families (Spark's name and spelling of each
# setting; a tree without depth limit is Spark's limit of 30) and candidates tried of each ---
FOREST_GRID = {"numTrees": [200, 300, 400], "maxDepth": [30, 16, 24], "minInstancesPerNode": [1, 2, 4],
               "featureSubsetStrategy": ["sqrt", "0.3", "0.5"]}
FOREST_CANDIDATES = 6
BOOSTED_GRID = {"maxIter": [400, 700, 1000], "stepSize": [0.03, 0.05, 0.1], "maxDepth": [6, 8, 10],
                "subsamplingRate": [0.8, 1.0], "featureSubsetStrategy": ["0.6", "0.8", "all"], "minInstancesPerNode": [1, 5]}
BOOSTED_CANDIDATES = 8
# --- end fixed values ---


def default_specs(seed: int = 42) -> list[ModelSpec]:
    """Baseline linear models (M7, M8) and the two tree families."""
    return [
        ModelSpec("LinearRegression", "linear"),
        ModelSpec("Ridge (alpha=1.0)", "ridge", params={"alpha": 1.0}),
        ModelSpec("Ridge (alpha=1.0, log target)", "ridge", "log", params={"alpha": 1.0}),
        ModelSpec("RandomForest (log target)", "rf", "log", params={"numTrees": 200, "maxDepth": 16, "minInstancesPerNode": 4, "seed": seed},
                  search_space=FOREST_GRID, n_iter=FOREST_CANDIDATES),
        ModelSpec("GBT (log target)", "gbt", "log", params={"maxIter": 400, "maxDepth": 6, "stepSize": 0.1, "seed": seed},
                  search_space=BOOSTED_GRID, n_iter=BOOSTED_CANDIDATES),
    ]


def _regressor(spec: ModelSpec, params: dict, n_train: int | None, label_std: float | None):
    common = {"featuresCol": "features", "labelCol": LABEL, "predictionCol": "__raw"}
    if spec.kind == "linear":
        return LinearRegression(solver="normal", regParam=0.0, **common)
    if spec.kind == "ridge":
        # sklearn Ridge: ||y - Xw - b||^2 + alpha ||w||^2. Spark's objective is scaled by 1/(2n)
        # and its penalty by the label's std, so regParam = alpha / n * std_pop(y).
        alpha = params.get("alpha", 1.0)
        reg = alpha / n_train * label_std if n_train and label_std else alpha
        return LinearRegression(solver="normal", elasticNetParam=0.0, standardization=False, regParam=reg, **common)
    if spec.kind == "rf":
        return RandomForestRegressor(**{k: v for k, v in params.items()}, **common)
    if spec.kind == "gbt":
        return GBTRegressor(**{k: v for k, v in params.items()}, **common)
    raise ValueError(f"unknown model kind {spec.kind!r}")


def _labelled(df: DataFrame, spec: ModelSpec, cfg: JobConfig) -> DataFrame:
    y = F.col(cfg.target).cast("double")
    return df.withColumn(LABEL, log_target(y) if spec.target_transform == "log" else y)


@dataclass
class FittedModel:
    spec: ModelSpec
    pipeline: PipelineModel
    floor: float = 1.0
    factor: float = 1.0
    training: DataFrame | None = None  # feature vectors and labels of the rows it was fitted on, as a plan (not saved)

    @property
    def constant_features(self) -> list[str]:
        """Encoder features that were constant in training and so carry no weight."""
        used = set(self.feature_names)
        return [n for n in self.pipeline.stages[0].feature_names() if n not in used]

    @property
    def feature_names(self) -> list[str]:
        """Names of the model's input features (the assembler's columns), in order."""
        return list(self.pipeline.stages[1].getInputCols())

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        """The input rows with ``out``: raw model output back in dollars (exp for a log
        target), times the smearing factor, floored (P10, F16, F18)."""
        return self.score(carried_features(self.pipeline.stages[0], df), out)

    def score(self, encoded: DataFrame, out: str = "predicted") -> DataFrame:
        """``predict`` for rows that ``carried_features`` has encoded already."""
        scored = encoded
        for stage in self.pipeline.stages[1:]:
            scored = stage.transform(scored)
        return scored.select("__row.*", self._dollars().alias(out))

    def predict_training(self, target: str, out: str = "predicted") -> DataFrame:
        """``target`` (in dollars, from the label) and ``out`` of the rows the model was fitted on, from the built features
        (or vectors) that the fit has written."""
        if self.training is None:
            raise ValueError("a loaded model has no training rows")
        scored = self.pipeline.stages[-1].transform(self.training)
        y = F.exp(LABEL) if self.spec.target_transform == "log" else F.col(LABEL)
        return scored.select(y.alias(target), self._dollars().alias(out))

    def _dollars(self):
        raw = F.col("__raw")
        dollars = exp_target(raw) if self.spec.target_transform == "log" else raw
        return floor_predictions(dollars * F.lit(self.factor), self.floor)

    def save(self, path: str) -> None:
        """Persist the fitted pipeline and what prediction needs besides it
        (target transform, smearing factor, floor)."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        state = json.dumps({"spec": asdict(self.spec), "floor": self.floor, "factor": self.factor})
        spark.createDataFrame([(state,)], "state string").coalesce(1).write.mode("overwrite").json(f"{path}/state")


def carried_features(encoder, df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Features of ``df`` with the input row (or ``columns`` of it) beside them in one struct column, so no join is
    needed to re-attach it (processed features reuse raw column names)."""
    carried = df.withColumn("__row", F.struct(*[F.col(c) for c in columns or df.columns]))
    return encoder.copy({encoder.keepColumns: ["__row"]}).transform(carried)


@dataclass
class Prepared:
    """Encoded training rows that any number of candidates can be fitted on."""

    encoder: object
    assembler: VectorAssembler
    built: DataFrame
    many: bool
    n_rows: int
    label_std: float | None
    stack: ExitStack

    @cached_property
    def vectors(self) -> DataFrame:
        """Feature vectors and labels, as a plan over the built features."""
        return self.assembler.transform(self.encoder.encode(self.built, [LABEL])).select("features", LABEL)

    @cached_property
    def rows(self) -> DataFrame:
        """``vectors``, written once for solvers that pass over them often (several times the size of the built features)."""
        with small_methods(self.built.sparkSession):
            return written(self.vectors, "vectors", FILE_ROWS if self.many else 0)

    @cached_property
    def passes(self) -> DataFrame:
        """The same rows, as Spark's solvers pass over them."""
        return self.stack.enter_context(spread(self.rows)) if self.many else self.rows

    def fit(self, spec: ModelSpec, params: dict | None = None) -> FittedModel:
        reg = _regressor(spec, {**spec.params, **(params or {})}, self.n_rows, self.label_std)
        if self.many and coded_trees.suits(reg):
            found = coded_trees.fit(reg, self.encoder, self.assembler.getInputCols(), self.built, LABEL, self.n_rows)
            return FittedModel(spec, PipelineModel(stages=[self.encoder, self.assembler, found]), training=self.vectors)
        if spec.kind in ("linear", "ridge") and "rows" not in self.__dict__:  # normal equations: one pass
            with small_methods(self.built.sparkSession):
                found = reg.fit(self.vectors)
            return FittedModel(spec, PipelineModel(stages=[self.encoder, self.assembler, found]), training=self.vectors)
        return FittedModel(spec, PipelineModel(stages=[self.encoder, self.assembler, reg.fit(self.passes)]), training=self.rows)


@contextmanager
def spread(rows: DataFrame, cores: int | None = None) -> Iterator[DataFrame]:
    """Written rows for a solver that passes over them hundreds of times, without a shuffle.  Some more partitions than
    cores would leave most cores idle in the last wave of every pass, so short splits, each in the order of its labels
    (neighbours then meet the same nodes of a tree, whose sums stay in the cache), make ``WAVES`` full waves.  A frame of
    no more partitions than cores stays as it is."""
    spark = rows.sparkSession
    cores = cores or spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() <= cores:
        yield rows
        return
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(WAVES * SPLITS * cores))
    try:
        yield rows.sortWithinPartitions(LABEL).coalesce(WAVES * cores)
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def built_rows(spec: ModelSpec, rows: DataFrame, cfg: JobConfig = DEFAULT, dated: bool = True) -> DataFrame:
    """Cleaned and built features of ``rows`` with label (and date) in front, written once: any number of windows of them
    can be ``prepared`` and fitted."""
    front = (cfg.date_column, LABEL) if dated else (LABEL,)
    return written(build_features(clean_loads(_labelled(rows, spec, cfg), cfg), cfg, keep=front), "built")


@contextmanager
def prepared(spec: ModelSpec, train: DataFrame | None, cfg: JobConfig = DEFAULT, built: DataFrame | None = None) -> Iterator[Prepared]:
    """Encoder and assembler fitted on ``train`` (or on its ``built_rows``); its feature vectors are written once, if read."""
    # Features are built once, for the encoder's passes and for the vectors that the solvers read. Cached columns would
    # take 8 bytes a value (a flag too) and leave the tree fits no memory for their own rows.
    built = built_rows(spec, train, cfg, dated=False) if built is None else built
    features = built.drop(cfg.date_column, LABEL)
    enc_model = FeatureEncoder(keepColumns=[cfg.id_column, cfg.target, LABEL], config=to_json(cfg)).fit_built(features)
    # Columns constant on the training rows (e.g. unknown-category flags) carry no
    # information and make the normal equations singular; they get no coefficient.
    constant = set(enc_model.fitted["constant"])
    assembler = VectorAssembler(inputCols=[c for c in enc_model.feature_names() if c not in constant], outputCol="features", handleInvalid="error")
    st = built.agg(F.count(LABEL).alias("__n"), F.stddev_pop(LABEL).alias("__s")).first()
    many = spec.kind in ("rf", "gbt") and st["__n"] >= FILE_ROWS * built.sparkSession.sparkContext.defaultParallelism
    with ExitStack() as stack:
        yield Prepared(enc_model, assembler, built, many, st["__n"], st["__s"], stack)


def fit(spec: ModelSpec, train: DataFrame | None, cfg: JobConfig = DEFAULT, params: dict | None = None,
        built: DataFrame | None = None) -> FittedModel:
    """Fit encoder + assembler + regressor on ``train`` (or on its ``built_rows``) only."""
    with prepared(spec, train, cfg, built) as p:
        return p.fit(spec, params)


def load(path: str) -> FittedModel:
    """Reload a saved model; it predicts as the one that was saved."""
    state = json.loads(SparkSession.getActiveSession().read.schema("state string").json(f"{path}/state").first()["state"])
    return FittedModel(ModelSpec(**state["spec"]), PipelineModel.load(f"{path}/pipeline"), state["floor"], state["factor"])


def fit_predict(spec: ModelSpec, train: DataFrame, evaluate: DataFrame, cfg: JobConfig = DEFAULT,
                params: dict | None = None) -> DataFrame:
    """Fit on one split, predict the other."""
    return fit(spec, train, cfg, params).predict(evaluate)


def sample_candidates(space: dict, n_iter: int, seed: int) -> list[dict]:
    """n_iter distinct grid points sampled without replacement (seeded)."""
    keys = sorted(space)
    grid = [{}]
    for k in keys:
        grid = [{**g, k: v} for g in grid for v in space[k]]
    rng = random.Random(seed)
    return rng.sample(grid, min(n_iter, len(grid)))


@dataclass
class SearchResult:
    """One row per candidate (mean MAE over the folds, the best marked), the best
    candidate's settings, and the model refitted with them on all rows searched."""

    table: DataFrame
    params: dict
    model: FittedModel


def search(spec: ModelSpec, dev_positioned: DataFrame, n: int, n_folds: int = 3, cfg: JobConfig = DEFAULT,
           seed: int = 42, parallelism: int = 4) -> SearchResult:
    """Random search over expanding folds by MAE, then a refit of the best candidate.

    ``CrossValidator`` is not used: with a fold column it trains on all other
    folds, i.e. on the future. ``dev_positioned`` carries ``position`` (W1). A fold is encoded
    once; its candidates are independent fits, ``parallelism`` at a time. Ties go to the candidate
    drawn first.
    """
    from loadlab.operators.splits import fold_bounds

    spark = dev_positioned.sparkSession
    candidates = sample_candidates(spec.search_space, spec.n_iter, seed)
    rows = []
    for fold, start, size in fold_bounds(n, n_folds):
        tr = dev_positioned.filter(F.col("position") < start)
        te = dev_positioned.filter((F.col("position") >= start) & (F.col("position") < start + size))
        with prepared(spec, tr, cfg) as p:
            test = written(carried_features(p.encoder, te, [cfg.target]), "encoded")
            kept = [p.built, p.rows, test]  # vectors are written for the candidates to share

            def mae(cand: dict, p: Prepared = p, test: DataFrame = test) -> float:
                return float(regression_metrics(p.fit(spec, cand).score(test), cfg.target, "predicted").first()["mae"])

            with ThreadPool(min(parallelism, len(candidates))) as pool:
                found = pool.map(inheritable_thread_target(spark)(mae), candidates)
        for df in kept:
            discard(df)
        rows += [(ci, fold, m) for ci, m in enumerate(found)]
    means = [sum(m for ci, _, m in rows if ci == i) / n_folds for i in range(len(candidates))]
    best = min(range(len(candidates)), key=means.__getitem__)
    table = spark.createDataFrame(
        [(spec.name, i, str(sorted(c.items())), means[i], n_folds, i == best) for i, c in enumerate(candidates)],
        "model string, candidate int, params string, cv_mae double, n_folds long, best boolean")
    return SearchResult(table, candidates[best], fit(spec, dev_positioned, cfg, candidates[best]))


def back_transform_choice(train: DataFrame, holdout: DataFrame, y: str, p: str, floor: float) -> DataFrame:
    """M16 on scored rows: Duan factor of ``train`` (A46), then MAE, RMSE, R2, MAPE and bias of the plain and the
    smeared holdout predictions from one aggregate; adopted only if MAE does not rise. One row."""
    factor = smearing_factor(train, y, p).first()[0]
    truth = F.col(y).cast("double")
    kinds = {"plain": F.col(p), "smeared": floor_predictions(F.col(p) * F.lit(factor), floor)}
    one = holdout.select(truth.alias("__y"), *[c.alias(f"__{k}") for k, c in kinds.items()]).agg(*[
        m for k in kinds for m in error_measures("__y", f"__{k}", k)])
    return one.select(F.lit(factor).alias("smearing_factor"), *one.columns,
                      (F.col("mae_smeared") <= F.col("mae_plain")).alias("adopted"))


def smearing_decision(model: FittedModel, train: DataFrame | None, holdout: DataFrame, cfg: JobConfig = DEFAULT) -> DataFrame:
    """M16 for a fitted model: ``back_transform_choice`` on its predictions; without ``train``, of the rows it was fitted on."""
    own = model.predict_training(cfg.target, "p") if train is None else model.predict(train, "p")
    return back_transform_choice(own, model.predict(holdout, "p"), cfg.target, "p", model.floor)
