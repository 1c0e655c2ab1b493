"""Schema-level helpers.

They read column names and types only (``df.schema`` on the driver), so they
cost no Spark job; the jobs call them as guards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from loadlab.operators.encode import (  # noqa: F401  (re-exported guards)
    assert_aligned,
    assert_feature_names,
    assert_no_target_or_id,
    classify_built,
)
from loadlab.operators.quality import (  # noqa: F401
    _coordinate_columns,
    compare_schemas,
    infer_identifiers,
    infer_target,
    numeric_columns,
    text_columns,
)


def ensure_required_columns(df: DataFrame, required, label: str = "frame") -> None:
    """Raise with the sorted list of missing columns."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise KeyError(f"{label} is missing required columns: {missing}")


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric columns, other columns) in schema order."""
    num = numeric_columns(df)
    return num, [c for c in df.columns if c not in num]


def coordinate_pairs(columns: list[str]) -> list[tuple[str, str]]:
    """Every latitude-like x longitude-like column pair."""
    lats, lons = _coordinate_columns(columns)
    return [(a, b) for a in lats for b in lons]


def inferred_roles(df: DataFrame) -> dict:
    """Identifier, target, datetime, numeric and categorical columns by name and type."""
    cols = df.columns
    dtypes = dict(df.dtypes)
    num, _ = split_by_type(df)
    dt = [c for c in cols if any(k in c.lower() for k in ("date", "time")) or dtypes[c] in ("date", "timestamp", "timestamp_ntz")]
    return {"identifiers": infer_identifiers(cols), "target": infer_target(cols), "datetime": dt,
            "numeric": num, "categorical": [c for c in cols if dtypes[c] == "string"]}
