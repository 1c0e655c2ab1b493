"""Shared pieces for registered jobs: cleaned windows, rounding, oracle SQL prelude."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlab.config import DEFAULT, JobConfig
from loadlab.functions.cleaning import clean_loads
from loadlab.sources import tables

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (results are compared to 6 places)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def clean(spark: SparkSession, sf_dir: str, cfg: JobConfig = DEFAULT) -> DataFrame:
    """``loads`` after the row-local cleaner."""
    return clean_loads(tables.loads(spark, sf_dir), cfg)


def split_frames(spark: SparkSession, sf_dir: str, cfg: JobConfig = DEFAULT, cleaned: bool = True):
    df = clean(spark, sf_dir, cfg) if cleaned else tables.loads(spark, sf_dir)
    d = F.col(cfg.date_column)
    train = df.filter(d < F.lit(cfg.holdout_start))
    hold = df.filter((d >= F.lit(cfg.holdout_start)) & (d < F.lit(cfg.scoring_start)))
    return train, hold


def dev_frame(spark: SparkSession, sf_dir: str, cfg: JobConfig = DEFAULT, cleaned: bool = True) -> DataFrame:
    df = clean(spark, sf_dir, cfg) if cleaned else tables.loads(spark, sf_dir)
    return df.filter(F.col(cfg.date_column) < F.lit(cfg.scoring_start))


# ---- oracle SQL (DuckDB) -----------------------------------------------------

def oracle(body: str, ctes: str = "") -> str:
    """``WITH loads AS (<fixed view>) [, ctes] <body>`` for DuckDB."""
    head = f"WITH loads AS ({tables.LOADS_SELECT})"
    if ctes.strip():
        head += ",\n" + ctes
    return head + "\n" + body


# Cleaned view in SQL, mirroring ``clean_loads`` (regexp with the global flag in DuckDB).
CLEAN_CTE = r"""
clean AS (
  SELECT load_id,
    regexp_replace(pickup, '^\s+|\s+$', '', 'g') AS pickup,
    regexp_replace(delivery, '^\s+|\s+$', '', 'g') AS delivery,
    pickup_lat, pickup_lon, delivery_lat, delivery_lon, distance,
    regexp_replace(equipment, '^\s+|\s+$', '', 'g') AS equipment,
    CASE WHEN abs(weight) < 5000.0 THEN 5000.0 WHEN abs(weight) > 47500.0 THEN 47500.0 ELSE abs(weight) END AS weight,
    date, market_index, quote_signal, posted_rate
  FROM loads),
train AS (SELECT * FROM clean WHERE date < DATE '2000-07-01'),
holdout AS (SELECT * FROM clean WHERE date >= DATE '2000-07-01' AND date < DATE '2001-01-01'),
dev AS (SELECT * FROM clean WHERE date < DATE '2001-01-01'),
scoring AS (SELECT * EXCLUDE (posted_rate) FROM clean WHERE date >= DATE '2001-01-01')"""


def oracle_clean(body: str, ctes: str = "") -> str:
    return oracle(body, CLEAN_CTE + ((",\n" + ctes) if ctes.strip() else ""))


# Built feature columns (P13) in SQL over a cleaned relation, rounded to 6 places.
FEATURES_SQL = """pickup, delivery, equipment, round(pickup_lat, 6) AS pickup_lat, round(pickup_lon, 6) AS pickup_lon,
  round(delivery_lat, 6) AS delivery_lat, round(delivery_lon, 6) AS delivery_lon, round(distance, 6) AS distance,
  round(weight, 6) AS weight, round(market_index, 6) AS market_index, round(quote_signal, 6) AS quote_signal,
  round(sin(2 * pi() * (dayofyear(date) - 1) / dayofyear(make_date(year(date), 12, 31))), 6) AS doy_sin,
  round(cos(2 * pi() * (dayofyear(date) - 1) / dayofyear(make_date(year(date), 12, 31))), 6) AS doy_cos,
  round(sin(2 * pi() * (isodow(date) - 1) / 7.0), 6) AS dow_sin,
  round(cos(2 * pi() * (isodow(date) - 1) / 7.0), 6) AS dow_cos,
  CASE WHEN isodow(date) - 1 >= 5 THEN 1.0 ELSE 0.0 END AS is_weekend,
  round(2 * 3958.7613 * asin(sqrt(least(greatest(
     pow(sin((radians(delivery_lat) - radians(pickup_lat)) / 2), 2)
     + cos(radians(pickup_lat)) * cos(radians(delivery_lat)) * pow(sin((radians(delivery_lon) - radians(pickup_lon)) / 2), 2),
     0.0), 1.0))), 6) AS haversine_miles,
  round(sin(atan2(sin(radians(delivery_lon) - radians(pickup_lon)) * cos(radians(delivery_lat)),
     cos(radians(pickup_lat)) * sin(radians(delivery_lat)) - sin(radians(pickup_lat)) * cos(radians(delivery_lat)) * cos(radians(delivery_lon) - radians(pickup_lon)))), 6) AS bearing_sin,
  round(cos(atan2(sin(radians(delivery_lon) - radians(pickup_lon)) * cos(radians(delivery_lat)),
     cos(radians(pickup_lat)) * sin(radians(delivery_lat)) - sin(radians(pickup_lat)) * cos(radians(delivery_lat)) * cos(radians(delivery_lon) - radians(pickup_lon)))), 6) AS bearing_cos,
  round(delivery_lon - pickup_lon, 6) AS lon_delta, round(delivery_lat - pickup_lat, 6) AS lat_delta,
  round(CASE WHEN distance IS NOT NULL THEN ln(1 + greatest(distance, 0)) END, 6) AS log_distance,
  round(CASE WHEN distance > 0 THEN weight / distance END, 6) AS weight_per_mile,
  CASE WHEN weight IS NULL THEN 1.0 ELSE 0.0 END AS weight_is_missing,
  CASE WHEN market_index IS NULL THEN 1.0 ELSE 0.0 END AS market_index_is_missing
"""


def _unround(sql: str) -> str:
    """Drop ``round(<expr>, 6)`` wrappers (for statistics computed on exact values)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 0, j + len("round")
        last_comma = None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                last_comma = k
            k += 1
        out.append(_unround(sql[j + len("round("):last_comma]))
        i = k + 1


FEATURES_RAW_SQL = _unround(FEATURES_SQL)
