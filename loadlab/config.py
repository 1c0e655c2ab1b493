"""Job parameters as one frozen dataclass.

Replaces the YAML loader: every job takes a ``JobConfig`` (or the default one).
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field, fields

# --- fixed values (must equal the original pipeline's for equal results) ---
# Column roles.
ID_COLUMN = "load_id"
TARGET_COLUMN = "posted_rate"
DATE_COLUMN = "date"
CATEGORICAL_COLUMNS = ("pickup", "delivery", "equipment")
NUMERIC_COLUMNS = (
    "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon",
    "distance", "weight", "market_index", "quote_signal",
)
# Columns the reduced scenario table lacks and lookups must restore.
SCENARIO_ABSENT = ("pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon",
                   "market_index", "quote_signal")
MISSING_INDICATOR_COLUMNS = ("weight", "market_index")
# Cleaning envelope for weight.
WEIGHT_MIN = 5000.0
WEIGHT_MAX = 47500.0
# Earth radius for great-circle miles.
EARTH_RADIUS_MILES = 3958.7613
# Positive prediction floor.
PREDICTION_FLOOR = 1.0
# Log-target inverse clip.
LOG_CLIP = 50.0
# Smearing guard on predictions.
SMEARING_EPS = 1e-9
# Error-analysis bands: left-closed edges (last edge open to +inf).
DISTANCE_BAND_EDGES = (0.0, 250.0, 500.0, 1000.0, 2000.0, float("inf"))
DISTANCE_BAND_LABELS = ("<250mi", "250-500mi", "500-1000mi", "1000-2000mi", ">2000mi")
WEIGHT_BAND_EDGES = (0.0, 15000.0, 25000.0, 35000.0, 45000.0, float("inf"))
WEIGHT_BAND_LABELS = ("<15k lb", "15-25k lb", "25-35k lb", "35-45k lb", ">45k lb")
PREDICTION_QUINTILE_LABELS = ("Q1", "Q2", "Q3", "Q4", "Q5")
MARKET_QUINTILE_LABELS = ("Q1", "Q2", "Q3", "Q4", "Q5")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# Minimum rows for a segment to be reported.
SEGMENT_MIN_ROWS = 30
# Outlier rule.
IQR_MULTIPLIER = 1.5
IQR_MIN_ROWS = 10
# Audit rules.
CASEFOLD_RATIO_MAX = 0.7
TEXT_NUMERIC_MIN_DISTINCT = 5
AUDIT_MAX_VALUES = 50
AUDIT_HIGH_CARDINALITY = 1000
# Scenario (reduced inference table).
SCENARIO_PICKUP = "NATION_3"
SCENARIO_DELIVERY = "NATION_7"
SCENARIO_DISTANCE = 360.0
SCENARIO_EQUIPMENT = "Dry Van"
SCENARIO_WEIGHT = 32000.0
SCENARIO_START = dt.date(2001, 5, 1)
SCENARIO_END = dt.date(2001, 5, 31)
# Temporal windows on the driver tables (see FIXTURES.md).
HOLDOUT_START = dt.date(2000, 7, 1)
SCORING_START = dt.date(2001, 1, 1)
N_CV_SPLITS = 5
# Rolling residual window.
ROLLING_MIN_WINDOW = 50
ROLLING_DIVISOR = 40
ROLLING_MIN_PERIODS = 10
# Worst-share fraction.
WORST_SHARE = 0.01
# Permutation importance repeats.
PERMUTATION_REPEATS = 5
# --- end fixed values ---


@dataclass(frozen=True)
class JobConfig:
    """Parameters shared by the jobs; defaults are the fixed values above."""

    id_column: str = ID_COLUMN
    target: str = TARGET_COLUMN
    date_column: str = DATE_COLUMN
    categorical: tuple[str, ...] = CATEGORICAL_COLUMNS
    numeric: tuple[str, ...] = NUMERIC_COLUMNS
    missing_indicators: tuple[str, ...] = MISSING_INDICATOR_COLUMNS
    weight_column: str = "weight"
    weight_sign_repair: str = "abs"
    weight_min: float = WEIGHT_MIN
    weight_max: float = WEIGHT_MAX
    holdout_start: dt.date = HOLDOUT_START
    scoring_start: dt.date = SCORING_START
    n_cv_splits: int = N_CV_SPLITS
    prediction_floor: float = PREDICTION_FLOOR
    reference_date: dt.date = dt.date(2000, 1, 1)
    # Names in ``features.BLOCKS``, in output order.
    feature_blocks: tuple[str, ...] = ("year angle", "week angle", "weekend", "great circle", "bearing", "steps", "log distance",
                                       "weight per mile", "missing")
    unknown_category_indicator: bool = True
    min_frequency: int | None = None
    seed: int = 42
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def raw_feature_columns(self) -> list[str]:
        """Categorical + date + numeric, in that order."""
        return [*self.categorical, self.date_column, *self.numeric]


DEFAULT = JobConfig()


def to_json(cfg: JobConfig) -> str:
    """A config as text, for fitted state that is saved with a model."""
    return json.dumps({f.name: getattr(cfg, f.name) for f in fields(cfg) if f.name != "extra"},
                      default=lambda d: d.isoformat())


def from_json(text: str) -> JobConfig:
    values = json.loads(text)
    for f in fields(JobConfig):
        if isinstance(getattr(DEFAULT, f.name), dt.date):
            values[f.name] = dt.date.fromisoformat(values[f.name])
        elif isinstance(getattr(DEFAULT, f.name), tuple):
            values[f.name] = tuple(values[f.name])
    return JobConfig(**values)
