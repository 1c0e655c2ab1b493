"""Linear and ridge fits of many expanding training windows from one pass over the rows.

Every encoded feature of every window is a linear map of one base vector that does not depend on the window: a
constant, the numerics with 0 for missing, their missing masks, the flags, one entry for each category value and one
for a missing category, and the label.  So the rows are read once, for the Gram matrix (sums of products) of the
base vector in each segment between two window borders; sums over the first segments give any
window's matrix.  A window's medians, scales and vocabulary are then put in as a small matrix, its normal equations
are solved on the driver (features x features numbers) and the coefficients are mapped back to the base
vector, so that predicting is one projection.  Numerics are shifted near their middle first, which keeps the sums exact enough.

The result equals a fresh ``FeatureEncoder`` and ridge regression for each window (pytest holds fold errors to 1e-8).
Category values become entries of the base vector, so this is for the named-column vocabularies of
``FeatureEncoder``; ``loadlab.operators.vocabulary`` encodes columns with any number of values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlab.config import DEFAULT, JobConfig
from loadlab.functions.cleaning import clean_loads, exp_target, floor_predictions, log_target
from loadlab.functions.features import build_features
from loadlab.operators.encode import classify_built, onehot_name
from loadlab.operators.lookup import discard, release, written
from loadlab.operators.prefix_quantiles import PrefixQuantiles
from loadlab.operators.splits import fold_bounds, with_position

SEGMENT, TARGET = "__segment", "__y"


@dataclass(frozen=True)
class Part:
    """A window: trained on the segments before ``until``, tested on segments ``start`` to ``stop`` (exclusive)."""

    name: str
    until: int
    start: int
    stop: int


@dataclass
class Base:
    """What the base vector is made of."""

    numeric: list[str]
    binary: list[str]
    values: dict[str, list[str]]
    shift: dict[str, float]
    log: bool

    @property
    def names(self) -> list[str]:
        return ["1", *self.numeric, *[f"{c}?" for c in self.numeric], *self.binary,
                *[onehot_name(c, v) for c, vs in self.values.items() for v in vs], *[f"{c}?" for c in self.values], TARGET]


@dataclass
class WindowFit:
    """Coefficients of one window: by encoded feature, and mapped to the base vector."""

    part: Part
    n: int
    coefficients: dict[str, float]
    intercept: float
    base_weights: np.ndarray


def prepared_rows(rows: DataFrame, keep: tuple[str, ...], cfg: JobConfig = DEFAULT) -> DataFrame:
    """Cleaned rows with built features, ``keep`` in front."""
    return build_features(clean_loads(rows, cfg), cfg, keep=keep)


def expanding_parts(dev: DataFrame, cfg: JobConfig = DEFAULT) -> tuple[DataFrame, list[Part]]:
    """Development rows, written with their segment, and the windows: the holdout (rows from its start date on) and each
    expanding fold (M15)."""
    keep = (cfg.id_column, cfg.target, cfg.date_column)
    # Raw rows are put in order: their features are twice the columns.
    pos = with_position(dev, cfg)
    before = F.col(cfg.date_column) < F.lit(cfg.holdout_start)
    n, n_train = pos.agg(F.count(F.lit(1)), F.count_if(before)).first()
    windows = [("holdout", n_train, n_train, n)] + [(f"fold {i}", s, s, s + t) for i, s, t in fold_bounds(n, cfg.n_cv_splits)]
    cuts = sorted({c for _, *bounds in windows for c in bounds} - {0})
    at = {0: 0} | {c: i + 1 for i, c in enumerate(cuts)}
    segment = sum((F.col("position") >= c).cast("int") for c in cuts)
    rows = written(prepared_rows(pos, (*keep, "position"), cfg).withColumn(SEGMENT, segment), "windows")
    discard(pos.ordered)
    release(dev.sparkSession)
    return rows, [Part(name, *(at[b] for b in bounds)) for name, *bounds in windows]


def holdout_part(dev: DataFrame, cfg: JobConfig = DEFAULT) -> tuple[DataFrame, list[Part]]:
    """Development rows, written with segment 0 (train) or 1 (holdout), and that one window."""
    rows = prepared_rows(dev, (cfg.id_column, cfg.target, cfg.date_column), cfg)
    segment = (F.col(cfg.date_column) >= F.lit(cfg.holdout_start)).cast("int")
    return written(rows.withColumn(SEGMENT, segment), "windows"), [Part("holdout", 1, 1, 2)]


def _categories(rows: DataFrame, parts: list[Part], cfg: JobConfig) -> tuple[dict[str, list[str]], dict[tuple[str, str], list[int]]]:
    """Values of each categorical in any training window, and how often each occurs there, by the window's end."""
    until = sorted({p.until for p in parts})
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in cfg.categorical]))
    long = rows.select(SEGMENT, pairs).filter(F.col("v").isNotNull() & (F.col(SEGMENT) < max(until)))
    found = long.groupBy("c", "v").agg(*[F.count_if(F.col(SEGMENT) < u).alias(f"n{u}") for u in until]).collect()
    counts = {(r["c"], r["v"]): {u: r[f"n{u}"] for u in until} for r in found}
    return {c: sorted(v for k, v in counts if k == c) for c in cfg.categorical}, counts


def _base_columns(rows: DataFrame, base: Base, carried: list[Column]) -> DataFrame:
    """``carried`` and the columns that ``_base_matrix`` reads: shifted numerics, flags, positions of the category values."""
    code = [F.coalesce(F.array_position(F.lit(vs), F.col(c)), F.lit(0)).cast("int").alias(f"__v{i}") if vs else F.lit(0).alias(f"__v{i}")
            for i, (c, vs) in enumerate(base.values.items())]
    missing = [F.col(c).isNull().cast("double").alias(f"__n{i}") for i, c in enumerate(base.values)]
    return rows.select(*carried, *[(F.col(c).cast("double") - base.shift[c]).alias(c) for c in base.numeric],
                       *[F.col(c).cast("double").alias(c) for c in base.binary], *code, *missing)


def _base_matrix(b: pa.RecordBatch, base: Base, label: np.ndarray | float) -> np.ndarray:
    """Base vectors of a batch, one in a row."""
    col = lambda name: b.column(name).to_numpy(zero_copy_only=False).astype(float)
    out = np.zeros((b.num_rows, len(base.names)))
    out[:, 0], out[:, -1] = 1.0, label
    k, d = 1, len(base.numeric)
    for j, name in enumerate(base.numeric):
        x = col(name)
        gone = np.isnan(x)
        out[:, k + j], out[:, k + d + j] = np.where(gone, 0.0, x), gone
    k += 2 * d
    for name in base.binary:
        out[:, k] = col(name)
        k += 1
    for i, vs in enumerate(base.values.values()):
        at = np.asarray(b.column(f"__v{i}"))
        hit = np.nonzero(at)[0]
        out[hit, k + at[hit] - 1] = 1.0
        k += len(vs)
    for i in range(len(base.values)):
        out[:, k] = col(f"__n{i}")
        k += 1
    return out


def _gram(rows: DataFrame, base: Base, cfg: JobConfig) -> dict[int, np.ndarray]:
    """The Gram matrix of the base vector in each segment."""
    y = F.col(cfg.target).cast("double")
    wanted = _base_columns(rows, base, [F.col(SEGMENT), (log_target(y) if base.log else y).alias(TARGET)])
    p = len(base.names)
    upper = np.triu_indices(p)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            out = _base_matrix(b, base, b.column(TARGET).to_numpy(zero_copy_only=False))
            segment = np.asarray(b.column(SEGMENT))
            for s in np.unique(segment):
                own = out[segment == s]
                total[int(s)] = total.get(int(s), 0.0) + own.T @ own
        for s, g in total.items():
            yield pa.RecordBatch.from_pydict({"s": pa.array([s], pa.int32()), "g": pa.array([g[upper].tolist()], pa.list_(pa.float64()))})

    parts = wanted.mapInArrow(sums, "s int, g array<double>").select("s", F.posexplode("g").alias("k", "x"))
    # (segments x features^2 / 2) numbers, whatever the number of rows.
    added = parts.groupBy("s", "k").agg(F.sum("x").alias("x")).toArrow()
    out = {}
    s, k, x = (np.asarray(added.column(c)) for c in ("s", "k", "x"))
    for one in np.unique(s):
        flat = np.zeros(len(upper[0]))
        flat[k[s == one]] = x[s == one]
        g = np.zeros((p, p))
        g[upper] = flat
        out[int(one)] = g + np.triu(g, 1).T
    return out


def fit_windows(rows: DataFrame, parts: list[Part], alpha: float = 1.0, log: bool = False, cfg: JobConfig = DEFAULT) -> tuple[Base, list[WindowFit]]:
    """Ridge (``alpha`` 0: least squares) on each window's training rows.  ``rows``: built features, target and segment."""
    built = [c for c in rows.columns if c not in (cfg.id_column, cfg.target, cfg.date_column, SEGMENT, "position")]
    weight, other, binary = classify_built(built, cfg)
    numeric = weight + other
    until = sorted({p.until for p in parts})
    found = PrefixQuantiles(rows, numeric, SEGMENT)
    median = {k: (q or [None])[0] or 0.0 for k, q in found.quantiles({(c, u): [0.5] for c in numeric for u in until}).items()}
    # The weight's quartiles are those of the imputed values: the median stands for every missing one.
    filled = {(c, u): (median[c, u], found.n_rows(u) - found.n_values(c, u)) for c in weight for u in until}
    quarters = found.quantiles({k: [0.25, 0.5, 0.75] for k in filled}, filled)
    values, counts = _categories(rows, parts, cfg)
    base = Base(numeric, binary, values, {c: median[c, until[-1]] for c in numeric}, log)
    grams = _gram(rows, base, cfg)
    fits = [_window(p, base, sum(g for s, g in grams.items() if s < p.until), median, quarters, counts, weight, alpha, cfg) for p in parts]
    return base, fits


def _window(part: Part, base: Base, g: np.ndarray, median: dict, quarters: dict, counts: dict, weight: list[str], alpha: float, cfg: JobConfig) -> WindowFit:
    names = base.names
    at = {name: i for i, name in enumerate(names)}
    one = np.eye(len(names))
    n, u = g[0, 0], part.until
    encoded: list[tuple[str, np.ndarray]] = []
    for c in base.numeric:
        # Imputed value less the shift, as a function of the base vector.
        x = one[at[c]] + (median[c, u] - base.shift[c]) * one[at[f"{c}?"]]
        if c in weight:
            q = quarters[c, u]
            centre, scale = q[1] - base.shift[c], (q[2] - q[0]) or 1.0
        else:
            centre = x @ g[0] / n
            scale = np.sqrt(max(x @ g @ x / n - centre * centre, 0.0)) or 1.0
        encoded.append((c, (x - centre * one[0]) / scale))
    encoded += [(c, one[at[c]]) for c in base.binary]
    unknown = []
    for c, vs in base.values.items():
        seen = [v for v in vs if counts[c, v][u] > 0]
        rare = [v for v in seen if cfg.min_frequency is not None and counts[c, v][u] < cfg.min_frequency]
        common = set(seen) - set(rare)
        encoded += [(onehot_name(c, v), one[at[onehot_name(c, v)]]) for v in seen if v in common]
        if rare:
            encoded.append((onehot_name(c, "infrequent_sklearn"), sum(one[at[onehot_name(c, v)]] for v in rare)))
        unknown.append((f"{c}_is_unknown", one[at[f"{c}?"]] + sum((one[at[onehot_name(c, v)]] for v in vs if v not in set(seen)), np.zeros(len(names)))))
    if cfg.unknown_category_indicator:
        encoded += unknown
    t = np.array([e for _, e in encoded])
    mean = t @ g[0] / n
    cross = t @ g
    centred = cross @ t.T - n * np.outer(mean, mean)
    # Constant on the training rows: no coefficient (as in ``models.prepared``).
    used = np.diag(centred) > 1e-9 * np.maximum(np.einsum("ij,ij->i", cross, t), 1e-300)
    y_mean = g[0, -1] / n
    right = cross[:, -1] - n * mean * y_mean
    a = centred[np.ix_(used, used)] + alpha * np.eye(int(used.sum()))
    beta = np.zeros(len(encoded))
    beta[used] = np.linalg.solve(a, right[used])
    intercept = y_mean - mean @ beta
    weights = t.T @ beta + intercept * one[0]
    return WindowFit(part, int(round(n)), dict(zip([c for c, _ in encoded], beta.tolist(), strict=True)), float(intercept), weights)


def predict_windows(rows: DataFrame, base: Base, fits: list[WindowFit], cfg: JobConfig = DEFAULT) -> DataFrame:
    """Each window's test rows: id, target, ``part``, ``predicted`` (in dollars, floored); one scan."""
    weights = np.column_stack([f.base_weights for f in fits])
    bounds = [(f.part.start, f.part.stop) for f in fits]
    id_type = rows.schema[cfg.id_column].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = _base_matrix(b, base, 0.0) @ weights
            segment = np.asarray(b.column(SEGMENT))
            for k, (start, stop) in enumerate(bounds):
                at = np.nonzero((segment >= start) & (segment < stop))[0]
                if len(at):
                    own = b.select([cfg.id_column, cfg.target]).take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.full(len(at), k), pa.int32()), pa.array(raw[at, k])],
                                                     [cfg.id_column, cfg.target, "k", "raw"])

    wanted = _base_columns(rows, base, [F.col(cfg.id_column), F.col(cfg.target).cast("double").alias(cfg.target), F.col(SEGMENT)])
    scored = wanted.mapInArrow(predict, f"{cfg.id_column} {id_type}, {cfg.target} double, k int, raw double")
    dollars = exp_target("raw") if base.log else F.col("raw")
    return scored.select(cfg.id_column, cfg.target, F.get(F.lit([f.part.name for f in fits]), F.col("k")).alias("part"),
                         floor_predictions(dollars, cfg.prediction_floor).alias("predicted"))
