"""Registered preprocessing jobs (M1-M6, J5, J6, U3, U5, A42, G3): the encoder is
fitted on cleaned train rows and applied to holdout / scoring rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loadlab.functions.cleaning import clean_loads
from loadlab.functions.features import build_features
from loadlab.operators import encode as EN
from loadlab.operators import vocabulary as VO
from loadlab.operators.lookup import written
from loadlab.plans.common import FEATURES_RAW_SQL, oracle, oracle_clean, rounded
from loadlab.plans.registry import register
from loadlab.session import small_methods
from loadlab.sources import tables

WEIGHT = ["weight"]
OTHER = ["pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon", "distance", "market_index", "quote_signal",
         "doy_sin", "doy_cos", "dow_sin", "dow_cos", "is_weekend", "haversine_miles", "bearing_sin", "bearing_cos",
         "lon_delta", "lat_delta", "log_distance", "weight_per_mile"]
BINARY = ["weight_is_missing", "market_index_is_missing"]
CATS = ["pickup", "delivery", "equipment"]

ENC_CTES = ("btrain AS (SELECT load_id, " + FEATURES_RAW_SQL + " FROM train),\n"
            "bhold AS (SELECT load_id, " + FEATURES_RAW_SQL + " FROM holdout),\n"
            "med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in WEIGHT + OTHER) + " FROM btrain),\n"
            "scl AS (SELECT " + ", ".join(
                [f"quantile_cont(coalesce(b.weight, med.weight), [0.25, 0.5, 0.75]) AS q_weight"]
                + [f"avg(coalesce(b.{c}, med.{c})) AS m_{c}, stddev_pop(coalesce(b.{c}, med.{c})) AS s_{c}" for c in OTHER])
            + " FROM btrain b, med)")


def _fit(spark, sf):
    return EN.FeatureEncoder().fit(tables.train(spark, sf))


def _kept_fit(spark, sf):
    """The encoder of the training window and the windows, from one star join."""
    windows = tables.kept_windows(spark, sf)
    return EN.FeatureEncoder().fit(windows.train), windows


@register("m1_m3_encoder_stats", oracle_clean(
    "SELECT feature, round(median, 6) AS median, round(center, 6) AS center, round(scale, 6) AS scale FROM (\n"
    + "SELECT 'weight' AS feature, med.weight AS median, scl.q_weight[2] AS center, "
      "CASE WHEN scl.q_weight[3] - scl.q_weight[1] = 0 THEN 1.0 ELSE scl.q_weight[3] - scl.q_weight[1] END AS scale FROM med, scl\n"
    + "\n".join(f"UNION ALL SELECT '{c}', med.{c}, scl.m_{c}, CASE WHEN scl.s_{c} = 0 OR scl.s_{c} IS NULL THEN 1.0 ELSE scl.s_{c} END FROM med, scl"
                for c in OTHER) + ")", ENC_CTES))
def m1_m3_encoder_stats(spark, sf):
    s = _fit(spark, sf).fitted
    rows = [(c, float(s["medians"][c]), float(s["scale"][c][0]), float(s["scale"][c][1])) for c in s["weight"] + s["other"]]
    # Fitted statistics are the model; expose them as a small frame.
    return rounded(spark.createDataFrame(rows, "feature string, median double, center double, scale double"))


@register("m4_onehot_vocab", oracle_clean(
    "\nUNION ALL\n".join(f"SELECT DISTINCT '{c}' AS feature, {c} AS value, '{c}_' || {c} AS column_name FROM train WHERE {c} IS NOT NULL"
                          for c in CATS)))
def m4_onehot_vocab(spark, sf):
    found = VO.fit_vocabulary(clean_loads(tables.train(spark, sf)), CATS).table
    return found.select("feature", "value", F.concat_ws("_", "feature", "value").alias("column_name"))


@register("m5_rare_categories", oracle_clean("\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, (SELECT count(*) FROM rare WHERE feature = '{c}') AS rare_values,
  count(*) FILTER (WHERE {c} IN (SELECT value FROM rare WHERE feature = '{c}')) AS rare_rows, count(*) AS rows FROM holdout""" for c in CATS),
    "rare AS (" + "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, {c} AS value FROM train WHERE {c} IS NOT NULL "
                                       f"GROUP BY {c} HAVING count(*) < (SELECT count(*) // 25 FROM train)" for c in CATS) + ")"))
def m5_rare_categories(spark, sf):
    """M5: values in under 1/25 of the training rows share one slot; holdout rows that fall in it."""
    train = clean_loads(tables.train(spark, sf))
    found = VO.fit_vocabulary(train, CATS, train.count() // 25)
    slots = VO.with_slots(clean_loads(tables.holdout(spark, sf)), found, CATS)
    shared = lambda c: F.count_if((F.col(f"{c}_slot") == found.frequent[c]) & F.lit(found.rare[c] > 0))
    one = slots.agg(F.count(F.lit(1)).alias("rows"), *[shared(c).alias(c) for c in CATS])
    return one.select("rows", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(found.rare[c]).cast("long").alias("rare_values"), F.col(c).alias("rare_rows"))
        for c in CATS])))


@register("m4_sparse_slots", oracle_clean("SELECT s.load_id, " + ", ".join(
    f"coalesce({c}_v.slot, (SELECT count(*) FROM {c}_v)) AS {c}_slot" for c in CATS) + " FROM scoring s " + " ".join(
    f"LEFT JOIN {c}_v ON {c}_v.value = s.{c}" for c in CATS), ",\n".join(
    f"{c}_v AS (SELECT {c} AS value, row_number() OVER (ORDER BY {c}) - 1 AS slot FROM train WHERE {c} IS NOT NULL GROUP BY {c})" for c in CATS)))
def m4_sparse_slots(spark, sf):
    """M4: every scoring row's slot in each categorical's block of the sparse vector (the last slot: unknown)."""
    slots, _ = _scoring_slots(spark, sf)
    return slots.select("load_id", *[F.col(f"{c}_slot").cast("long") for c in CATS])


@register("m4_sparse_vectors")
def m4_sparse_vectors(spark, sf):
    """M4/M6: sparse feature vectors of the holdout, as text."""
    windows = tables.kept_windows(spark, sf)
    model = VO.SparseEncoder().fit(windows.train)
    return model.transform(windows.holdout).select("load_id", F.col("features").cast("string").alias("features"))


def _processed_numeric_sql(src: str) -> str:
    cols = ["b.load_id",
            "round((coalesce(b.weight, med.weight) - scl.q_weight[2]) / CASE WHEN scl.q_weight[3] - scl.q_weight[1] = 0 "
            "THEN 1.0 ELSE scl.q_weight[3] - scl.q_weight[1] END, 6) AS weight"]
    cols += [f"round((coalesce(b.{c}, med.{c}) - scl.m_{c}) / CASE WHEN scl.s_{c} = 0 OR scl.s_{c} IS NULL THEN 1.0 "
             f"ELSE scl.s_{c} END, 6) AS {c}" for c in OTHER]
    cols += [f"b.{c}" for c in BINARY]
    return "SELECT " + ", ".join(cols) + f" FROM {src} b, med, scl"


@register("m6_processed_numeric_holdout", oracle_clean(_processed_numeric_sql("bhold"), ENC_CTES))
def m6_processed_numeric_holdout(spark, sf):
    model, windows = _kept_fit(spark, sf)
    out = model.transform(windows.holdout)
    return rounded(out.select("load_id", *WEIGHT, *OTHER, *BINARY))


@register("m4_onehot_row_sums", oracle_clean("""
SELECT h.load_id,
  cast((SELECT count(*) FROM (SELECT DISTINCT pickup FROM train) v WHERE v.pickup = h.pickup) AS DOUBLE) AS pickup_hot,
  cast((SELECT count(*) FROM (SELECT DISTINCT delivery FROM train) v WHERE v.delivery = h.delivery) AS DOUBLE) AS delivery_hot,
  cast((SELECT count(*) FROM (SELECT DISTINCT equipment FROM train) v WHERE v.equipment = h.equipment) AS DOUBLE) AS equipment_hot
FROM scoring h"""))
def m4_onehot_row_sums(spark, sf):
    slots, found = _scoring_slots(spark, sf)
    return slots.select("load_id", *[(1.0 - VO.is_unknown(found, c)).alias(f"{c}_hot") for c in CATS])


def _scoring_slots(spark, sf):
    found = VO.fit_vocabulary(clean_loads(tables.train(spark, sf)), CATS)
    return VO.with_slots(clean_loads(tables.scoring(spark, sf)), found, CATS), found


@register("j5_unknown_flags_scoring", oracle_clean("""
SELECT s.load_id,
  CASE WHEN s.pickup IN (SELECT pickup FROM train WHERE pickup IS NOT NULL) THEN 0.0 ELSE 1.0 END AS pickup_is_unknown,
  CASE WHEN s.delivery IN (SELECT delivery FROM train WHERE delivery IS NOT NULL) THEN 0.0 ELSE 1.0 END AS delivery_is_unknown,
  CASE WHEN s.equipment IN (SELECT equipment FROM train WHERE equipment IS NOT NULL) THEN 0.0 ELSE 1.0 END AS equipment_is_unknown
FROM scoring s"""))
def j5_unknown_flags_scoring(spark, sf):
    slots, found = _scoring_slots(spark, sf)
    return slots.select("load_id", *[VO.is_unknown(found, c).alias(f"{c}_is_unknown") for c in CATS])


@register("j6_unseen_rows", oracle_clean("""
SELECT load_id, delivery FROM scoring WHERE delivery NOT IN (SELECT delivery FROM train WHERE delivery IS NOT NULL)"""))
def j6_unseen_rows(spark, sf):
    return clean_loads(EN.unseen_rows(tables.train(spark, sf), tables.scoring(spark, sf), "delivery")).select("load_id", "delivery")


@register("u3_unseen_values", oracle_clean("""
SELECT 'delivery' AS feature, value, count(*) AS n_rows FROM (
  SELECT delivery AS value FROM scoring WHERE delivery NOT IN (SELECT delivery FROM train WHERE delivery IS NOT NULL))
GROUP BY value"""))
def u3_unseen_values(spark, sf):
    from loadlab.functions.cleaning import strip_text
    train = tables.train(spark, sf).select(strip_text("delivery").alias("value"))
    score = tables.scoring(spark, sf).select(strip_text("delivery").alias("value"))
    # Counted per value first (combined on the map side), so the anti join meets one row per city.
    counts = score.filter("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(train.distinct(), "value", "left_anti").withColumn("feature", F.lit("delivery"))


@register("a42_cleaning_stats", oracle("""
SELECT ds AS dataset, count(*) FILTER (WHERE weight < 0) AS negative_weight,
  count(*) FILTER (WHERE weight IS NULL) AS missing_weight, count(*) FILTER (WHERE market_index IS NULL) AS missing_market_index,
  count(*) FILTER (WHERE delivery NOT IN (SELECT delivery FROM loads WHERE date < DATE '2001-01-01')) AS unseen_delivery_rows
FROM (SELECT *, CASE WHEN date < DATE '2001-01-01' THEN 'development' ELSE 'scoring' END AS ds FROM loads) GROUP BY ds"""))
def a42_cleaning_stats(spark, sf):
    df = tables.with_window(tables.loads(spark, sf)).withColumn(
        "dataset", F.when(F.col("window") == "scoring", "scoring").otherwise("development"))
    # One map-side combined aggregate to (dataset, city) rows; cities are compared there.
    per = df.groupBy("dataset", "delivery").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("weight") < 0).alias("negative_weight"),
        F.count_if(F.col("weight").isNull()).alias("missing_weight"),
        F.count_if(F.col("market_index").isNull()).alias("missing_market_index"))
    seen = F.max(F.col("dataset") == "development").over(Window.partitionBy("delivery")) & F.col("delivery").isNotNull()
    return per.withColumn("seen", seen).groupBy("dataset").agg(
        F.sum("negative_weight").alias("negative_weight"), F.sum("missing_weight").alias("missing_weight"),
        F.sum("missing_market_index").alias("missing_market_index"),
        F.sum(F.when(F.col("seen"), 0).otherwise(F.col("rows"))).alias("unseen_delivery_rows"))


@register("g3_null_counts_processed")
def g3_null_counts_processed(spark, sf):
    model, windows = _kept_fit(spark, sf)
    out = EN.transform_guarded(model, windows.holdout)
    return EN.null_counts(out, model.feature_names())


# --- fixed values: published family labels and the built features each one covers ---
ONE_HOT, UNKNOWN, MISSING, RAW = "Categorical (one-hot)", "Unknown-category indicators", "Missing indicators", "Numerical (raw)"
BUILT_FAMILIES = {
    "Temporal": ("doy_sin", "doy_cos", "dow_sin", "dow_cos", "is_weekend"),
    "Geographic": ("haversine_miles", "bearing_sin", "bearing_cos", "lon_delta", "lat_delta",
                   "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon"),
    "Interaction": ("log_distance", "weight_per_mile"),
}
# --- end fixed values ---


def feature_families(model) -> dict[str, str]:
    """Family of every encoder output, by the part of the encoder that makes it."""
    families = dict.fromkeys(model.feature_names(), RAW)
    families.update({n: f for f, built in BUILT_FAMILIES.items() for n in built if n in families})
    families.update(dict.fromkeys(model.fitted["binary"], MISSING))
    for c, values in model.fitted["vocab"].items():
        families.update({EN.onehot_name(c, v): ONE_HOT for v in values})
        if f"{c}_is_unknown" in families:
            families[f"{c}_is_unknown"] = UNKNOWN
    return families


P15_SQL = oracle_clean("""
SELECT family, count(*) AS n_features, string_agg(feature, '|' ORDER BY feature) AS features FROM (
  SELECT feature, CASE
    WHEN (starts_with(feature, 'pickup_') OR starts_with(feature, 'delivery_') OR starts_with(feature, 'equipment_'))
         AND NOT ends_with(feature, '_lat') AND NOT ends_with(feature, '_lon') AND NOT ends_with(feature, '_is_unknown') THEN 'Categorical (one-hot)'
    WHEN ends_with(feature, '_is_unknown') THEN 'Unknown-category indicators'
    WHEN ends_with(feature, '_is_missing') THEN 'Missing indicators'
    WHEN starts_with(feature, 'doy_') OR starts_with(feature, 'dow_') OR starts_with(feature, 'is_weekend') THEN 'Temporal'
    WHEN starts_with(feature, 'haversine') OR starts_with(feature, 'bearing') OR starts_with(feature, 'lon_delta')
         OR starts_with(feature, 'lat_delta') OR starts_with(feature, 'pickup_lat') OR starts_with(feature, 'pickup_lon')
         OR starts_with(feature, 'delivery_lat') OR starts_with(feature, 'delivery_lon') THEN 'Geographic'
    WHEN starts_with(feature, 'log_distance') OR starts_with(feature, 'weight_per_mile') THEN 'Interaction'
    ELSE 'Numerical (raw)' END AS family
  FROM names) GROUP BY family""", "names AS (SELECT unnest([" + ", ".join(f"'{n}'" for n in WEIGHT + OTHER + BINARY)
    + "]) AS feature UNION ALL " + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}_' || {c} FROM train WHERE {c} IS NOT NULL" for c in CATS)
    + " UNION ALL SELECT unnest(['pickup_is_unknown', 'delivery_is_unknown', 'equipment_is_unknown']))")


@register("p15_feature_families", P15_SQL)
def p15_feature_families(spark, sf):
    rows = list(feature_families(_fit(spark, sf)).items())
    named = spark.createDataFrame(rows, "feature string, family string")
    return named.groupBy("family").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.array_join(F.sort_array(F.collect_list("feature")), "|").alias("features"))


def _matrix_sql(name: str, src: str, key: str) -> str:
    return f"""
SELECT '{name}' AS matrix, count(*) AS n_rows, {1 + len(WEIGHT + OTHER + BINARY) + len(CATS)} + """ + " + ".join(
        f"(SELECT count(DISTINCT {c}) FROM train)" for c in CATS) + f""" AS n_columns, {key} AS key_value,
  round(sum(abs((coalesce(b.weight, med.weight) - scl.q_weight[2]) / CASE WHEN scl.q_weight[3] - scl.q_weight[1] = 0 THEN 1.0
    ELSE scl.q_weight[3] - scl.q_weight[1] END)), 4) AS weights,
  round(sum(abs((coalesce(b.distance, med.distance) - scl.m_distance) / CASE WHEN scl.s_distance = 0 OR scl.s_distance IS NULL
    THEN 1.0 ELSE scl.s_distance END)), 4) AS distances
FROM {src} b, med, scl"""


def _with_key(model, frame, key):
    return model.copy({model.keepColumns: [key]}).transform(frame)


@register("s6_processed_matrices", oracle_clean("\nUNION ALL\n".join([
    _matrix_sql("train", "btrain", "(SELECT round(sum(posted_rate), 4) FROM train)"),
    _matrix_sql("holdout", "bhold", "cast(count(DISTINCT load_id) AS double)"),
    _matrix_sql("scenario", "(SELECT cast(d AS date) AS date, 32000.0 AS weight, 360.0 AS distance "
                "FROM range(DATE '2001-05-01', DATE '2001-06-01', INTERVAL 1 DAY) t(d))", "cast(count(DISTINCT date) AS double)")]), ENC_CTES))
def s6_processed_matrices(spark, sf):
    """The three processed matrices written as parquet, each with its key carried through the encoder
    (J10: target, id, date), and read back."""
    from loadlab.operators import inference as INF
    from loadlab.sources import files
    # One star join for the encoder, the matrices and the lookups; the training rows' features are built once.
    windows = tables.kept_windows(spark, sf, scoring=True)
    built = written(build_features(clean_loads(windows.train), keep=("posted_rate",)), "built")
    model = EN.FeatureEncoder().fit_built(built.drop("posted_rate"))
    scenario = INF.enrich(INF.scenario(spark).drop("predicted_rate"),
                          INF.city_coordinates(windows.development, windows.scoring), INF.daily_market(windows.scoring))
    total = F.round(F.sum("posted_rate"), 4)
    frames = {"train": (model.encode(built, ["posted_rate"]), total),
              "holdout": (_with_key(model, windows.holdout, "load_id"), F.count_distinct("load_id").cast("double")),
              "scenario": (_with_key(model, scenario, "date"), F.count_distinct("date").cast("double"))}
    out = None
    for name, (matrix, value) in frames.items():
        with small_methods(spark):
            back = spark.read.parquet(files.write_parquet(matrix, files.scratch_path(spark, name)))
        one = back.agg(F.count(F.lit(1)).alias("n_rows"), value.alias("key_value"),
                       F.round(F.sum(F.abs("weight")), 4).alias("weights"), F.round(F.sum(F.abs("distance")), 4).alias("distances"))
        one = one.select(F.lit(name).alias("matrix"), "*", F.lit(len(back.columns)).cast("long").alias("n_columns"))
        out = one if out is None else out.unionByName(one)
    return out


@register("s6_processed_matrix_write", oracle("""
SELECT strftime(date, '%Y-%m') AS month, count(*) AS rows FROM loads
WHERE date >= DATE '2000-07-01' AND date < DATE '2001-01-01' GROUP BY 1"""))
def s6_processed_matrix_write(spark, sf):
    """The processed holdout matrix (with id and target) as parquet partitioned by month; read back."""
    from loadlab.functions.features import month_label
    from loadlab.sources import files
    model, windows = _kept_fit(spark, sf)
    keep = ["load_id", "posted_rate", "month"]
    out = model.copy({model.keepColumns: keep}).transform(windows.holdout.withColumn("month", month_label("date")))
    path = files.write_parquet(out, files.scratch_path(spark, "processed"), ["month"])
    return spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("rows"))
