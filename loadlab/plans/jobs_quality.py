"""Registered audit jobs (A1-A10, A14, A49, A50, T2) over ``loads`` and ``loads_dirty``."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlab.operators import contracts as CT
from loadlab.operators import guards as GU
from loadlab.operators import quality as Q
from loadlab.operators.lookup import written
from loadlab.plans.common import oracle, rounded
from loadlab.plans.registry import register
from loadlab.sources import tables

NUMERIC = ["pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon", "distance", "weight",
           "market_index", "quote_signal", "posted_rate"]
DIRTY_COLS = ["load_id", "pickup", "pickup_lat", "distance", "date"]
DIRTY_TEXT = ["load_id", "pickup", "distance", "date"]
DIRTY_CTE = f"loads_dirty AS ({tables.LOADS_DIRTY_SELECT})"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---- A1 ---------------------------------------------------------------------

A1_SQL = oracle(_union([f"""
SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM loads""" for c in NUMERIC]))


@register("a1_numeric_profile", A1_SQL)
def a1_numeric_profile(spark, sf):
    return rounded(Q.numeric_profile(tables.loads(spark, sf), NUMERIC))


# ---- A2 ---------------------------------------------------------------------

def _vc_sql(src: str, cols: list[str]) -> str:
    return _union([f"SELECT '{c}' AS feature, cast({c} AS varchar) AS value, count(*) AS cnt FROM {src} "
                   f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in cols])


A2_SQL = oracle("""
SELECT feature, cast(sum(cnt) AS BIGINT) AS count_non_missing, count(*) AS unique_values,
  first(value ORDER BY cnt DESC, value ASC) AS top_value
FROM vc GROUP BY feature""", DIRTY_CTE + ",\nvc AS (" + _vc_sql("loads_dirty", DIRTY_TEXT) + ")")


@register("a2_categorical_profile", A2_SQL)
def a2_categorical_profile(spark, sf):
    return Q.categorical_profile(tables.loads_dirty(spark, sf), DIRTY_TEXT)


# ---- T2 ---------------------------------------------------------------------

T2_SQL = oracle("""
SELECT feature, value, cnt AS count, rank FROM (
  SELECT feature, value, cnt, cast(row_number() OVER (PARTITION BY feature ORDER BY cnt DESC, value) AS INTEGER) AS rank FROM vc)
WHERE rank <= 10""", "vc AS (" + _vc_sql("loads", ["pickup", "delivery", "equipment"]) + ")")


@register("t2_top_categories", T2_SQL)
def t2_top_categories(spark, sf):
    return Q.top_values(tables.loads(spark, sf), ["pickup", "delivery", "equipment"], 10)


# ---- A3 ---------------------------------------------------------------------

A3_SQL = oracle(_union([
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(*) AS n_rows, "
    f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS missing_pct FROM loads_dirty "
    f"HAVING count(*) FILTER (WHERE {c} IS NULL) > 0" for c in DIRTY_COLS]), DIRTY_CTE)


@register("a3_missing_report", A3_SQL)
def a3_missing_report(spark, sf):
    return rounded(Q.missing_report(tables.loads_dirty(spark, sf)))


# ---- A4-A9 / A14 --------------------------------------------------------------

def _validate_sql(src: str, name: str, cols: dict[str, str], id_col: str = "load_id") -> str:
    """DuckDB twin of ``Q.validate`` for a dataset with the given column types."""
    parts = []
    lat_like = [c for c in cols if c.endswith("_lat")]
    lon_like = [c for c in cols if c.endswith("_lon")]
    coords = set(lat_like + lon_like) if lat_like and lon_like else set()
    for c, t in cols.items():
        miss = f"{c} IS NULL" + (f" OR isnan({c})" if t == "double" else "")
        parts.append(f"SELECT '{name}' AS dataset, 'missing' AS issue_type, '{c}' AS feature, 'warning' AS severity, "
                     f"count(*) FILTER (WHERE {miss}) AS n_bad, count(*) AS n_total FROM {src}")
        text = t == "varchar"
        num_hint = t == "double" or any(h in c.lower() for h in Q.NUMERIC_NAME_HINTS)
        v = (f"(CASE WHEN regexp_matches({c}, '(?i)^\\s*[-+]?[0-9.]+(e[-+]?[0-9]+)?[df]\\s*$') THEN NULL "
             f"ELSE try_cast(trim({c}) AS DOUBLE) END)") if text else c
        inv = f"count(*) FILTER (WHERE {v} IS NULL AND {c} IS NOT NULL)"
        nf = f"count(*) FILTER (WHERE {v} IS NOT NULL AND (isnan({v}) OR isinf({v})))"
        active = f"count(DISTINCT {c}) >= 5" if text else "true"
        if num_hint:
            parts.append(f"SELECT '{name}', 'invalid_numeric', '{c}', 'error', CASE WHEN {active} THEN {inv} ELSE 0 END, count({c}) FROM {src}")
            parts.append(f"SELECT '{name}', 'non_finite', '{c}', 'error', CASE WHEN {active} AND {inv} = 0 THEN {nf} ELSE 0 END, count({c}) FROM {src}")
        if c in coords:
            lo, hi = (-90, 90) if c in lat_like else (-180, 180)
            parts.append(f"SELECT '{name}', 'coordinate_range', '{c}', 'warning', count(*) FILTER (WHERE {v} IS NOT NULL AND ({v} < {lo} OR {v} > {hi})), count(*) FROM {src}")
            parts.append(f"SELECT '{name}', 'coordinate_non_numeric', '{c}', 'warning', {inv}, count(*) FROM {src}")
        if text:
            parts.append(f"SELECT '{name}', 'whitespace', '{c}', 'warning', count(*) FILTER (WHERE regexp_matches({c}, '^\\s|\\s$')), count(*) FROM {src}")
            parts.append(f"SELECT '{name}', 'empty_string', '{c}', 'warning', count(*) FILTER (WHERE {c} = ''), count(*) FROM {src}")
            nu, nl = f"count(DISTINCT {c})", f"count(DISTINCT lower({c}))"
            parts.append(f"SELECT '{name}', 'mixed_case', '{c}', 'info', CASE WHEN {nu} >= 2 AND {nl} < {nu} AND "
                         f"{nl} / {nu} <= 0.7 THEN {nu} - {nl} ELSE 0 END, {nu} FROM {src}")
    allc = ", ".join(cols)
    parts.append(f"SELECT '{name}', 'duplicate_rows', NULL, 'warning', coalesce(sum(CASE WHEN c > 1 THEN c END), 0), sum(c) "
                 f"FROM (SELECT count(*) AS c FROM {src} GROUP BY ALL_COLS)".replace("ALL_COLS", allc))
    if id_col in cols:
        parts.append(f"SELECT '{name}', 'duplicate_ids', '{id_col}', CASE WHEN sum(CASE WHEN c > 1 THEN c ELSE 0 END) > 0 "
                     f"THEN 'error' ELSE 'warning' END, coalesce(sum(CASE WHEN {id_col} IS NULL THEN c END), 0) + "
                     f"coalesce(sum(CASE WHEN c > 1 THEN c END), 0), sum(c) FROM (SELECT {id_col}, count(*) AS c FROM {src} GROUP BY {id_col})")
    body = _union([f"SELECT * FROM ({p})" for p in parts])
    return f"SELECT dataset, issue_type, feature, severity, cast(n_bad AS BIGINT) AS n_bad, cast(n_total AS BIGINT) AS n_total FROM ({body}) WHERE n_bad > 0"


LOADS_TYPES = {"load_id": "varchar", "pickup": "varchar", "delivery": "varchar", "pickup_lat": "double",
               "pickup_lon": "double", "delivery_lat": "double", "delivery_lon": "double", "distance": "double",
               "equipment": "varchar", "weight": "double", "date": "date", "market_index": "double",
               "quote_signal": "double", "posted_rate": "double"}
DIRTY_TYPES = {"load_id": "varchar", "pickup": "varchar", "pickup_lat": "double", "distance": "varchar", "date": "varchar"}

A14_SQL = oracle(_validate_sql("loads_dirty", "dirty", DIRTY_TYPES) + "\nUNION ALL\n"
                 + _validate_sql("loads", "loads", LOADS_TYPES), DIRTY_CTE)


@register("a14_validate_all", A14_SQL)
def a14_validate_all(spark, sf):
    clean = tables.kept_loads(spark, sf)
    return Q.validate_all({"dirty": tables.dirty_rows(clean), "loads": clean})


A50_SQL = oracle("""
SELECT dataset, issue_type, count(*) AS n_issues, cast(sum(n_bad) AS BIGINT) AS n_bad, bool_or(severity = 'error') AS has_error
FROM (""" + _validate_sql("loads_dirty", "dirty", DIRTY_TYPES) + ") GROUP BY dataset, issue_type", DIRTY_CTE)


@register("a50_issue_summary", A50_SQL)
def a50_issue_summary(spark, sf):
    return Q.issue_summary(Q.validate(tables.loads_dirty(spark, sf), "dirty"))


A50_RISKS_SQL = oracle("""
SELECT risk, count(issue_type) AS n_issues, count(issue_type) > 0 AS present
FROM (VALUES ('invalid_numbers'), ('duplicates'), ('missing_values'), ('schema_mismatch')) r(risk)
LEFT JOIN (
  SELECT issue_type, unnest(CASE WHEN issue_type IN ('invalid_numeric', 'non_finite', 'coordinate_non_numeric') THEN ['invalid_numbers']
      WHEN issue_type = 'duplicate_rows' THEN ['duplicates'] WHEN issue_type = 'duplicate_ids' THEN ['duplicates', 'missing_values']
      WHEN issue_type = 'missing' THEN ['missing_values'] ELSE [] END) AS raised FROM issues
  UNION ALL SELECT kind, 'schema_mismatch' FROM differences) i ON i.raised = r.risk GROUP BY risk""",
    DIRTY_CTE + ",\nissues AS (" + _validate_sql("loads_dirty", "dirty", DIRTY_TYPES) + "\nUNION ALL\n"
    + _validate_sql("loads", "loads", LOADS_TYPES) + """),
clean_columns AS (SELECT unnest(""" + repr(list(LOADS_TYPES)) + """) AS name, unnest(""" + repr(list(LOADS_TYPES.values())) + """) AS type),
dirty_columns AS (SELECT unnest(""" + repr(list(DIRTY_TYPES)) + """) AS name, unnest(""" + repr(list(DIRTY_TYPES.values())) + """) AS type),
differences AS (
  SELECT DISTINCT CASE WHEN d.name IS NULL THEN 'left only' WHEN c.name IS NULL THEN 'right only' ELSE c.name END AS kind
  FROM clean_columns c FULL JOIN dirty_columns d ON c.name = d.name
  WHERE c.name IS NULL OR d.name IS NULL OR c.type <> d.type)""")


@register("a50_risk_flags", A50_RISKS_SQL)
def a50_risk_flags(spark, sf):
    """The four data risks over the clean and the dirty table and the differences of their schemas."""
    clean = tables.kept_loads(spark, sf)
    dirty = tables.dirty_rows(clean)
    return Q.risk_flags(Q.validate_all({"dirty": dirty, "loads": clean}), Q.compare_schemas(clean, dirty))


# ---- A10 / A49 ------------------------------------------------------------------

DIRTY_NUMERIC = [c for c, t in DIRTY_TYPES.items() if t == "double"]
A10_SQL = oracle("""
SELECT f.feature, f.missing_count, coalesce(u.n_unique, 0) AS n_unique, f.n_whitespace, f.n_empty, f.min_value, f.max_value,
  coalesce(array_to_string(u.vals, '|'), '') || CASE WHEN u.n_unique > 50
    THEN '|... (truncated, total_unique=' || u.n_unique || ')' ELSE '' END AS unique_values,
  f.min_value IS NOT NULL AS ranged
FROM (""" + _union([
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
    f"count(*) FILTER (WHERE regexp_matches(cast({c} AS varchar), '^\\s|\\s$')) AS n_whitespace, "
    f"count(*) FILTER (WHERE cast({c} AS varchar) = '') AS n_empty, "
    + (f"round(min({c}), 6) AS min_value, round(max({c}), 6) AS max_value" if c in DIRTY_NUMERIC
       else "cast(NULL AS double) AS min_value, cast(NULL AS double) AS max_value") + " FROM loads_dirty" for c in DIRTY_COLS]) + """) f
LEFT JOIN (SELECT feature, count(*) AS n_unique,
                  list_sort(list(value) FILTER (WHERE rk <= 50)) AS vals
           FROM (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS rk FROM vc)
           GROUP BY feature) u ON f.feature = u.feature""",
                   DIRTY_CTE + ",\nvc AS (" + _vc_sql("loads_dirty", DIRTY_COLS) + ")")


@register("a10_feature_audit", A10_SQL)
def a10_feature_audit(spark, sf):
    audit = Q.feature_audit(tables.loads_dirty(spark, sf))
    return rounded(audit.select(
        "feature", "missing_count", "n_unique", "n_whitespace", "n_empty", "min_value", "max_value",
        F.array_join("unique_values", "|").alias("unique_values"),
        F.exists("observations", lambda o: o.startswith("Numeric range: [")).alias("ranged")))


# Expected dtype and role of each ``loads`` column (A11 rules applied to names and types).
A49_ROLES = {"load_id": ("string", "identifier"), "pickup": ("string", "categorical"),
             "delivery": ("string", "categorical"), "pickup_lat": ("double", "numeric"),
             "pickup_lon": ("double", "numeric"), "delivery_lat": ("double", "numeric"),
             "delivery_lon": ("double", "numeric"), "distance": ("double", "numeric"),
             "equipment": ("string", "categorical"), "weight": ("double", "numeric"), "date": ("date", "datetime"),
             "market_index": ("double", "numeric"), "quote_signal": ("double", "numeric"),
             "posted_rate": ("double", "numeric")}
A49_USE = {"identifier": "exclude from features (key)", "datetime": "derive calendar features",
           "numeric": "numeric feature (impute + scale)", "categorical": "categorical feature (one-hot)"}
A49_PARTS = [
    f"SELECT '{c}' AS feature, '{dt}' AS dtype, '{role}' AS role, round(100.0 * count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if dt == "double" else "") + f") / count(*), 6) AS missing_pct, '{A49_USE[role]}' AS recommended_use "
    "FROM loads" for c, (dt, role) in A49_ROLES.items()]


@register("a49_feature_dictionary", oracle(_union(A49_PARTS)))
def a49_feature_dictionary(spark, sf):
    return rounded(Q.feature_dictionary(tables.loads(spark, sf)))


EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "varchar",
               "value": "double", "props": "varchar"}


@register("a14_validate_events", oracle(_validate_sql("events", "events", EVENT_TYPES, "event_id")))
def a14_validate_events(spark, sf):
    """The same audit over another driver table (the event stream), keyed by ``event_id``."""
    return Q.validate(tables.read_table(spark, sf, "events"), "events", id_col="event_id")


@register("a1_numeric_profile_events", oracle(_union([f"""
SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM events""" for c in ["event_id", "user_id", "value"]])))
def a1_numeric_profile_events(spark, sf):
    return rounded(Q.numeric_profile(tables.read_table(spark, sf, "events"), ["event_id", "user_id", "value"]))


# Guards that ride on the job that writes their frame, on planted faults.
GUARD_CTES = DIRTY_CTE + """,
g AS (SELECT *, try_cast(distance AS DOUBLE) AS d FROM loads_dirty)"""


@register("g_observed_faults", oracle("""
SELECT 'date: no date' AS guard, count(*) FILTER (WHERE date IS NULL OR try_cast(date AS DATE) IS NULL) AS faults FROM g
UNION ALL SELECT 'distance: no finite number', count(*) FILTER (WHERE d IS NULL OR isinf(d) OR isnan(d)) FROM g
UNION ALL SELECT 'pickup_lat: null', count(*) FILTER (WHERE pickup_lat IS NULL OR isnan(pickup_lat)) FROM g
UNION ALL SELECT 'load_id: not found', count(*) FILTER (WHERE load_id IS NULL) FROM g
UNION ALL SELECT 'weight: null', count(*) FILTER (WHERE weight IS NULL) FROM loads
UNION ALL SELECT 'market_index: null', count(*) FILTER (WHERE market_index IS NULL) FROM loads
UNION ALL SELECT 'train: empty', CASE WHEN count(*) FILTER (WHERE date < DATE '2000-07-01') = 0 THEN 1 ELSE 0 END FROM loads
UNION ALL SELECT 'holdout: empty', CASE WHEN count(*) FILTER (WHERE date >= DATE '2000-07-01') = 0 THEN 1 ELSE 0 END FROM loads""", GUARD_CTES))
def g_observed_faults(spark, sf):
    """Faults counted by the two jobs that write the tables, not by jobs of their own."""
    guards = GU.Guards()
    dirty = guards.watch(tables.loads_dirty(spark, sf), GU.unreadable_dates("date"), GU.not_numbers("distance"), GU.nulls(["pickup_lat"]),
                         GU.unmatched(["load_id"]))
    clean = guards.watch(tables.loads(spark, sf), GU.nulls(["weight", "market_index"]), GU.split_sides())
    written(dirty, "guarded")
    written(clean, "guarded")
    return spark.createDataFrame(list(guards.counts().items()), "guard string, faults long")


@register("g8_planted_change", oracle("""
SELECT name, (SELECT count(*) FROM h) AS rows_a, rows_b, only_a + only_b = 0 AS same, only_a, only_b FROM (
  SELECT 'equal' AS name, (SELECT count(*) FROM h) AS rows_b, 0 AS only_a, 0 AS only_b
  UNION ALL SELECT 'swapped nulls', (SELECT count(*) FROM s), (SELECT count(*) FROM (SELECT * FROM h EXCEPT ALL SELECT * FROM s)),
    (SELECT count(*) FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM h))
  UNION ALL SELECT 'one row for another', (SELECT count(*) FROM t), (SELECT count(*) FROM (SELECT * FROM h EXCEPT ALL SELECT * FROM t)),
    (SELECT count(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM h)))""", """
h AS (SELECT load_id, weight, market_index FROM loads WHERE date >= DATE '2000-07-01' AND date < DATE '2001-01-01'),
s AS (SELECT load_id, CASE WHEN weight IS NULL AND market_index IS NOT NULL THEN market_index ELSE weight END AS weight,
  CASE WHEN weight IS NULL AND market_index IS NOT NULL THEN NULL ELSE market_index END AS market_index FROM h),
f AS (SELECT min(load_id) AS lo, max(load_id) AS hi FROM h),
t AS (SELECT h.* FROM h, f WHERE load_id <> lo UNION ALL SELECT h.* FROM h, f WHERE load_id = hi)"""))
def g8_planted_change(spark, sf):
    """G8 on equal frames in another order, on nulls moved to the next column, and on a row put in another's place."""
    h = written(tables.holdout(spark, sf).select("load_id", "weight", "market_index"), "compared")
    moved = F.col("weight").isNull() & F.col("market_index").isNotNull()
    swapped = h.select("load_id", F.when(moved, F.col("market_index")).otherwise(F.col("weight")).alias("weight"),
                       F.when(~moved, F.col("market_index")).alias("market_index"))
    lo, hi = h.agg(F.min("load_id"), F.max("load_id")).first()
    replaced = h.filter(F.col("load_id") != lo).unionByName(h.filter(F.col("load_id") == hi))
    out = None
    for name, other in (("equal", h.repartition(5, "weight")), ("swapped nulls", swapped), ("one row for another", replaced)):
        found = CT.compare_rows(h, other).withColumn("name", F.lit(name))
        if found.first()["same"]:
            sides = found.select("name", F.lit(0).cast("long").alias("only_a"), F.lit(0).cast("long").alias("only_b"))
        else:
            sides = CT.row_differences(h, other).agg(F.count_if(F.col("side") == "a").alias("only_a"), F.count_if(F.col("side") == "b").alias("only_b")).withColumn("name", F.lit(name))
        one = found.join(sides, "name")
        out = one if out is None else out.unionByName(one)
    return out
