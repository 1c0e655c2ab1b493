"""Registered jobs: flagship, sources, cleaning and scalar features.

Each job reads the driver tables (through ``loads``) and returns a lazy
DataFrame; doubles are rounded to 6 places for the oracle comparison.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlab.config import DEFAULT
from loadlab.functions import cleaning as C
from loadlab.functions import features as FE
from loadlab.plans import flagship
from loadlab.plans.common import FEATURES_SQL, clean, oracle, oracle_clean, rounded
from loadlab.plans.registry import register
from loadlab.sources import files, tables

# ---- flagship + baselines on holdout ----------------------------------------------

register("m9_rpm_equipment_holdout", flagship.RPM_EQUIPMENT_SQL)(
    lambda spark, sf: flagship.rate_per_mile_holdout(spark, sf, "equipment"))
register("m9_rpm_global_holdout", flagship.RPM_GLOBAL_SQL)(
    lambda spark, sf: flagship.rate_per_mile_holdout(spark, sf, None))


# ---- sources -------------------------------------------------------------------------

@register("s2_loads_windows", oracle("""
SELECT CASE WHEN date < DATE '2000-07-01' THEN 'train' WHEN date < DATE '2001-01-01' THEN 'holdout'
            ELSE 'scoring' END AS window,
  count(*) AS n_rows, count(DISTINCT load_id) AS n_ids, min(date) AS min_date, max(date) AS max_date,
  round(sum(posted_rate), 4) AS sum_rate
FROM loads GROUP BY 1"""))
def s2_loads_windows(spark, sf):
    df = tables.with_window(tables.loads(spark, sf))
    return rounded(df.groupBy("window").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("load_id").alias("n_ids"),
        F.min("date").alias("min_date"), F.max("date").alias("max_date"),
        F.round(F.sum("posted_rate"), 4).alias("sum_rate")))


@register("s2_csv_pair", oracle("""
SELECT CASE WHEN date < DATE '2001-01-01' THEN 'train' ELSE 'scoring' END AS dataset, count(*) AS n_rows,
  count(DISTINCT load_id) AS n_ids, count(weight) AS n_weights, cast(sum(length(pickup)) AS bigint) AS pickup_chars,
  round(sum(distance), 4) AS sum_distance, max(date) AS max_date,
  round(sum(CASE WHEN date < DATE '2001-01-01' THEN posted_rate END), 4) AS sum_rate
FROM loads GROUP BY 1"""))
def s2_csv_pair(spark, sf):
    """The labelled and the scoring table as CSV files, scanned back strictly."""
    paths = [files.write_csv(d, files.scratch_path(spark, name)) for name, d in (
        ("train", tables.development(spark, sf).select(*files.LOADS_SCHEMA.names)),
        ("scoring", tables.scoring(spark, sf).select(*[c for c in files.LOADS_SCHEMA.names if c != "posted_rate"])))]
    train, scoring = files.load_datasets(spark, *paths)
    both = train.withColumn("dataset", F.lit("train")).unionByName(
        scoring.withColumn("dataset", F.lit("scoring")), allowMissingColumns=True)
    return both.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("load_id").alias("n_ids"), F.count("weight").alias("n_weights"),
        F.sum(F.length("pickup")).alias("pickup_chars"), F.round(F.sum("distance"), 4).alias("sum_distance"),
        F.max("date").alias("max_date"), F.round(F.sum("posted_rate"), 4).alias("sum_rate"))


# ---- cleaning (P4-P6) and projections (P1) -------------------------------------------

@register("p4_p6_clean_rows", oracle_clean("""
SELECT load_id, pickup, delivery, equipment, round(weight, 6) AS weight FROM clean"""))
def p4_p6_clean_rows(spark, sf):
    return rounded(clean(spark, sf).select("load_id", "pickup", "delivery", "equipment", "weight"))


@register("p4_sign_repair_nan", oracle("""
SELECT load_id, round(CASE WHEN weight < 5000.0 THEN 5000.0 WHEN weight > 47500.0 THEN 47500.0 ELSE weight END, 6) AS weight
FROM (SELECT load_id, CASE WHEN weight >= 0 THEN weight END AS weight FROM loads)"""))
def p4_sign_repair_nan(spark, sf):
    df = tables.loads(spark, sf)
    w = C.clip_range(C.repair_sign("weight", "nan"), DEFAULT.weight_min, DEFAULT.weight_max)
    return rounded(df.select("load_id", w.alias("weight")))


@register("p1_raw_feature_projection", oracle("""
SELECT pickup, delivery, equipment, date, round(pickup_lat, 6) AS pickup_lat, round(pickup_lon, 6) AS pickup_lon,
  round(delivery_lat, 6) AS delivery_lat, round(delivery_lon, 6) AS delivery_lon, round(distance, 6) AS distance,
  round(weight, 6) AS weight, round(market_index, 6) AS market_index, round(quote_signal, 6) AS quote_signal
FROM loads"""))
def p1_raw_feature_projection(spark, sf):
    return rounded(tables.loads(spark, sf).select(*DEFAULT.raw_feature_columns))


@register("p7_temporal_filter", oracle("""
SELECT load_id, date FROM loads WHERE date < DATE '2000-07-01'"""))
def p7_temporal_filter(spark, sf):
    return tables.train(spark, sf).select("load_id", "date")


@register("p8_distance_band_filter", oracle("""
SELECT load_id, round(distance, 6) AS distance, round(market_index, 6) AS market_index
FROM loads WHERE date < DATE '2001-01-01' AND distance > 340 AND distance < 380"""))
def p8_distance_band_filter(spark, sf):
    df = tables.development(spark, sf)
    return rounded(df.filter((F.col("distance") > 340) & (F.col("distance") < 380))
                   .select("load_id", "distance", "market_index"))


@register("p10_prediction_floor", oracle("""
SELECT load_id, round(CASE WHEN p IS NULL OR isnan(p) OR isinf(p) OR p < 1.0 THEN 1.0 ELSE p END, 6) AS floored
FROM (SELECT load_id, CASE WHEN weight IS NULL THEN NULL ELSE (weight / 5000.0) - 2 END AS p FROM loads)"""))
def p10_prediction_floor(spark, sf):
    df = tables.loads(spark, sf).select("load_id", (F.col("weight") / 5000.0 - 2).alias("p"))
    return rounded(df.select("load_id", C.floor_predictions("p", 1.0).alias("floored")))


# ---- scalar features (F1-F13) ------------------------------------------------------

@register("f1_f3_calendar", oracle("""
SELECT load_id,
  round(sin(2 * pi() * (dayofyear(date) - 1) / dayofyear(make_date(year(date), 12, 31))), 6) AS doy_sin,
  round(cos(2 * pi() * (dayofyear(date) - 1) / dayofyear(make_date(year(date), 12, 31))), 6) AS doy_cos,
  round(sin(2 * pi() * (isodow(date) - 1) / 7.0), 6) AS dow_sin,
  round(cos(2 * pi() * (isodow(date) - 1) / 7.0), 6) AS dow_cos,
  CASE WHEN isodow(date) - 1 >= 5 THEN 1.0 ELSE 0.0 END AS is_weekend,
  cast(date_diff('day', DATE '2000-01-01', date) AS DOUBLE) AS days_since_reference
FROM loads"""))
def f1_f3_calendar(spark, sf):
    df = tables.loads(spark, sf)
    cols = FE.block_features(["year angle", "week angle", "weekend", "days since"])
    return rounded(df.select("load_id", *[v.alias(k) for k, v in cols.items()]))


@register("f4_f6_geo", oracle("""
SELECT load_id,
  round(2 * 3958.7613 * asin(sqrt(least(greatest(
     pow(sin((radians(delivery_lat) - radians(pickup_lat)) / 2), 2)
     + cos(radians(pickup_lat)) * cos(radians(delivery_lat)) * pow(sin((radians(delivery_lon) - radians(pickup_lon)) / 2), 2),
     0.0), 1.0))), 6) AS haversine_miles,
  round(sin(atan2(sin(radians(delivery_lon) - radians(pickup_lon)) * cos(radians(delivery_lat)),
     cos(radians(pickup_lat)) * sin(radians(delivery_lat)) - sin(radians(pickup_lat)) * cos(radians(delivery_lat)) * cos(radians(delivery_lon) - radians(pickup_lon)))), 6) AS bearing_sin,
  round(cos(atan2(sin(radians(delivery_lon) - radians(pickup_lon)) * cos(radians(delivery_lat)),
     cos(radians(pickup_lat)) * sin(radians(delivery_lat)) - sin(radians(pickup_lat)) * cos(radians(delivery_lat)) * cos(radians(delivery_lon) - radians(pickup_lon)))), 6) AS bearing_cos,
  round(delivery_lon - pickup_lon, 6) AS lon_delta, round(delivery_lat - pickup_lat, 6) AS lat_delta
FROM loads"""))
def f4_f6_geo(spark, sf):
    df = tables.loads(spark, sf)
    return rounded(df.select("load_id", *[v.alias(k) for k, v in FE.block_features(["great circle", "bearing", "steps"]).items()]))


@register("f7_bands", oracle("""
SELECT load_id,
  CASE WHEN distance >= 0 AND distance < 250 THEN '<250mi' WHEN distance >= 250 AND distance < 500 THEN '250-500mi'
       WHEN distance >= 500 AND distance < 1000 THEN '500-1000mi' WHEN distance >= 1000 AND distance < 2000 THEN '1000-2000mi'
       WHEN distance >= 2000 THEN '>2000mi' END AS distance_band,
  CASE WHEN abs(weight) >= 0 AND abs(weight) < 15000 THEN '<15k lb' WHEN abs(weight) >= 15000 AND abs(weight) < 25000 THEN '15-25k lb'
       WHEN abs(weight) >= 25000 AND abs(weight) < 35000 THEN '25-35k lb' WHEN abs(weight) >= 35000 AND abs(weight) < 45000 THEN '35-45k lb'
       WHEN abs(weight) >= 45000 THEN '>45k lb' END AS weight_band
FROM loads"""))
def f7_bands(spark, sf):
    df = tables.loads(spark, sf)
    return df.select("load_id", FE.distance_band("distance").alias("distance_band"),
                     FE.weight_band("weight").alias("weight_band"))


@register("f9_f12_interactions", oracle("""
SELECT load_id,
  round(CASE WHEN distance IS NOT NULL THEN ln(1 + greatest(distance, 0)) END, 6) AS log_distance,
  round(CASE WHEN distance > 0 THEN weight / distance END, 6) AS weight_per_mile,
  round(CASE WHEN distance > 0 THEN posted_rate / distance END, 6) AS rate_per_mile,
  CASE WHEN weight IS NULL THEN 1.0 ELSE 0.0 END AS weight_is_missing,
  CASE WHEN market_index IS NULL THEN 1.0 ELSE 0.0 END AS market_index_is_missing
FROM loads"""))
def f9_f12_interactions(spark, sf):
    df = tables.loads(spark, sf)
    cols = {**FE.block_features(["log distance", "weight per mile"]), "rate_per_mile": FE.per_mile("posted_rate", "distance"),
            **FE.missing_flags(DEFAULT.missing_indicators)}
    return rounded(df.select("load_id", *[v.alias(k) for k, v in cols.items()]))


@register("f13_calendar_labels", oracle("""
SELECT load_id, strftime(date, '%Y-%m') AS month, dayname(date) AS day_of_week FROM loads"""))
def f13_calendar_labels(spark, sf):
    df = tables.loads(spark, sf)
    return df.select("load_id", FE.month_label("date").alias("month"), FE.weekday_name("date").alias("day_of_week"))


@register("f16_log_target_roundtrip", oracle("""
SELECT load_id, round(ln(posted_rate), 6) AS log_rate,
  round(exp(CASE WHEN ln(posted_rate) < -50 THEN -50 WHEN ln(posted_rate) > 50 THEN 50 ELSE ln(posted_rate) END), 6) AS back
FROM loads WHERE date < DATE '2001-01-01'"""))
def f16_log_target_roundtrip(spark, sf):
    df = tables.development(spark, sf)
    z = C.log_target("posted_rate")
    return rounded(df.select("load_id", z.alias("log_rate"), C.exp_target(z).alias("back")))


@register("f18_back_transform", oracle("""
SELECT load_id, round(CASE WHEN p IS NULL OR isnan(p) OR isinf(p) OR p < 1.0 THEN 1.0 ELSE p END, 6) AS adjusted
FROM (SELECT load_id, (distance * 2.0 - 150.0) * 1.0124 AS p FROM loads)"""))
def f18_back_transform(spark, sf):
    df = tables.loads(spark, sf)
    return rounded(df.select("load_id", C.back_transform(F.col("distance") * 2.0 - 150.0, 1.0124, 1.0).alias("adjusted")))


@register("p13_feature_matrix", oracle_clean("SELECT load_id, " + FEATURES_SQL + " FROM clean"))
def p13_feature_matrix(spark, sf):
    return rounded(FE.build_features(clean(spark, sf), keep=("load_id",)))
