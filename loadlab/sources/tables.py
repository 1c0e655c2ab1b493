"""Driver tables and the ``loads`` view.

``loads`` rebuilds the freight schema (14 columns) from the TPC-H-like driver
tables with one SQL text that runs unchanged on Spark SQL and DuckDB, so the
same text is the Spark source and the leading CTE of every oracle query.

Scale: the view is a star join. ``lineitem`` x ``orders`` is the one big-big
join (sort-merge on the order key); ``part`` and ``customer`` grow with the
data and are left to AQE (broadcast only when the runtime size is under the
threshold); ``nation`` is 25 rows and always broadcast. Spark joins customers
to the orders, which are fewer than the lines, and names last (``STAR_FROM``),
so that shuffles carry few and narrow rows when no table can be broadcast. Column
pruning and the date filters reach the parquet scans through the view.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlab.config import DEFAULT, JobConfig
from loadlab.operators.lookup import release, written

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# The freight view over driver tables (fixed text, shared with the oracle).
# ``{name}`` placeholders are bound to DataFrames by ``spark.sql(..., name=df)``
# on the Spark side and to the oracle's table names for DuckDB.
LOADS_TEMPLATE = """
SELECT concat_ws('-', cast(l.l_orderkey AS varchar(20)), cast(l.l_linenumber AS varchar(20)),
                 cast(l.l_partkey AS varchar(20)), cast(l.l_suppkey AS varchar(20)),
                 cast(cast(l.l_shipdate AS date) AS varchar(20))) AS load_id,
  CASE WHEN l.l_linenumber = 7 THEN concat(' ', sn.n_name, ' ') ELSE sn.n_name END AS pickup,
  CASE WHEN cast(o.o_orderdate AS date) >= date '2001-01-01' AND cn.n_nationkey % 12 = 5
       THEN concat(cn.n_name, '_NEW') ELSE cn.n_name END AS delivery,
  cast(25 + (sn.n_nationkey * 7) % 25 AS double) AS pickup_lat,
  cast(-120 + (sn.n_nationkey * 11) % 50 AS double) AS pickup_lon,
  cast(25 + (cn.n_nationkey * 7) % 25 AS double) AS delivery_lat,
  cast(-120 + (cn.n_nationkey * 11) % 50 AS double) AS delivery_lon,
  l.l_quantity * cast(70 AS double) AS distance,
  CASE l.l_returnflag WHEN 'A' THEN 'Dry Van' WHEN 'N' THEN 'Flatbed' ELSE 'Reefer' END AS equipment,
  CASE WHEN l.l_partkey % 160 = 0 THEN NULL ELSE c.c_acctbal * cast(5 AS double) END AS weight,
  cast(o.o_orderdate AS date) AS date,
  CASE WHEN l.l_orderkey % 128 = 0 THEN NULL ELSE cast(1 AS double) + l.l_discount END AS market_index,
  cast(2 AS double) + l.l_tax AS quote_signal,
  power(l.l_quantity * cast(70 AS double), cast(0.9 AS double)) * cast(4 AS double)
    * (cast(1 AS double) + l.l_discount) * (p.p_retailprice / cast(950 AS double))
    * CASE l.l_returnflag WHEN 'A' THEN cast(1 AS double) WHEN 'N' THEN cast(1.085 AS double) ELSE cast(1.127 AS double) END
    * CASE WHEN l.l_suppkey % 100 = 13 AND l.l_partkey % 2 = 0 THEN cast(4 AS double) ELSE cast(1 AS double) END AS posted_rate
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
  JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} cn ON c.c_nationkey = cn.n_nationkey
  JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {nation} sn ON s.s_nationkey = sn.n_nationkey
  JOIN {part} p ON l.l_partkey = p.p_partkey
"""

LOADS_COLUMNS = ("load_id", "pickup", "delivery", "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon", "distance",
                 "equipment", "weight", "date", "market_index", "quote_signal", "posted_rate")

# The same joins in the order that Spark runs them: lines are shuffled by order and part (and supplier), never by customer.
STAR_FROM = """
FROM {lineitem} l JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey
  JOIN {part} p ON l.l_partkey = p.p_partkey JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
  JOIN {nation} cn ON c.c_nationkey = cn.n_nationkey JOIN {nation} sn ON s.s_nationkey = sn.n_nationkey
"""

# Dirty variant for the audit jobs: text-typed numbers and dates, duplicates,
# case variants, empty strings, impossible coordinates (fixed text).
LOADS_DIRTY_TEMPLATE = """
SELECT CASE WHEN distance = 700 AND equipment = 'Reefer' THEN NULL ELSE load_id END AS load_id,
  CASE WHEN distance = 140 THEN upper(pickup) WHEN distance = 210 THEN lower(pickup) WHEN distance = 280 THEN '' ELSE pickup END AS pickup,
  CASE WHEN distance = 350 THEN pickup_lat + 100 ELSE pickup_lat END AS pickup_lat,
  CASE WHEN distance = 420 THEN 'n/a' WHEN distance = 490 THEN 'inf' ELSE cast(cast(distance AS integer) AS varchar(20)) END AS distance,
  CASE WHEN quote_signal = 2.05 THEN '2001-02-30' ELSE cast(date AS varchar(20)) END AS date
FROM {loads}
UNION ALL
SELECT load_id, pickup, pickup_lat, cast(cast(distance AS integer) AS varchar(20)), cast(date AS varchar(20)) FROM {loads} WHERE distance = 1400
"""

# The same texts with plain table names (DuckDB oracle).
LOADS_SELECT = LOADS_TEMPLATE.format(**{t: t for t in ("lineitem", "orders", "customer", "nation", "supplier", "part")})
LOADS_DIRTY_SELECT = LOADS_DIRTY_TEMPLATE.format(loads="loads")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (schema from the file footer)."""
    return spark.read.parquet(table_path(sf_dir, name))


def driver_tables(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = DRIVER_TABLES) -> dict[str, DataFrame]:
    return {name: read_table(spark, sf_dir, name) for name in names}


def _star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = driver_tables(spark, sf_dir, ("lineitem", "orders", "customer", "nation", "supplier", "part"))
    rows = spark.sql(LOADS_TEMPLATE[:LOADS_TEMPLATE.index("\nFROM {lineitem}")] + STAR_FROM, **t)
    rows.star_tables = t  # for ``kept_columns``; a copy read back from files has none
    return rows


MATERIALIZE_CONF = "loadlab.loads.materialize"
_MATERIALIZED: dict[tuple[str, str], str] = {}


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14-column freight table, lazily (a plan, not data).

    The inputs are bound to the fixed SQL text as DataFrame parameters (no
    session temp views); Catalyst prunes columns and pushes filters into each scan.

    With ``loadlab.loads.materialize=true`` the star join runs once per session
    and input folder: the result is written, range-partitioned and sorted by
    date, as parquet in the shared checkpoint folder, and every later job scans
    that copy (date filters then skip row groups by their min/max statistics).
    """
    if spark.conf.get(MATERIALIZE_CONF, "false") == "true":
        return spark.read.parquet(materialize_loads(spark, sf_dir))
    return _star_join(spark, sf_dir)


def materialize_loads(spark: SparkSession, sf_dir: str) -> str:
    """Write ``loads`` once to the shared folder and return its path."""
    import hashlib

    from loadlab.session import checkpoint_dir

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key in _MATERIALIZED:
        return _MATERIALIZED[key]
    base = checkpoint_dir(spark)
    path = os.path.join(base, "loads-" + hashlib.sha1("|".join(key).encode()).hexdigest()[:16])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Range on (date, id): a date holding a third of all rows still spreads over many files.
    (_star_join(spark, sf_dir).repartitionByRange(n, "date", "load_id").sortWithinPartitions("date", "load_id")
     .write.mode("overwrite").parquet(path))
    _MATERIALIZED[key] = path
    return path


def loads_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit fixture with text-typed columns and planted defects."""
    return dirty_rows(loads(spark, sf_dir))


def dirty_rows(clean: DataFrame) -> DataFrame:
    """``loads_dirty`` made from a given frame of loads."""
    return clean.sparkSession.sql(LOADS_DIRTY_TEMPLATE, loads=clean)


def with_window(df: DataFrame, cfg: JobConfig = DEFAULT) -> DataFrame:
    """Tag rows train / holdout / scoring by date."""
    d = F.col(cfg.date_column)
    return df.withColumn(
        "window",
        F.when(d < F.lit(cfg.holdout_start), "train")
        .when(d < F.lit(cfg.scoring_start), "holdout")
        .otherwise("scoring"),
    )


def development(spark: SparkSession, sf_dir: str, cfg: JobConfig = DEFAULT) -> DataFrame:
    """Labelled rows: train + holdout (date < scoring start)."""
    return loads(spark, sf_dir).filter(F.col(cfg.date_column) < F.lit(cfg.scoring_start))


def train(spark: SparkSession, sf_dir: str, cfg: JobConfig = DEFAULT) -> DataFrame:
    return loads(spark, sf_dir).filter(F.col(cfg.date_column) < F.lit(cfg.holdout_start))


def holdout(spark: SparkSession, sf_dir: str, cfg: JobConfig = DEFAULT) -> DataFrame:
    d = F.col(cfg.date_column)
    return loads(spark, sf_dir).filter((d >= F.lit(cfg.holdout_start)) & (d < F.lit(cfg.scoring_start)))


def scoring(spark: SparkSession, sf_dir: str, cfg: JobConfig = DEFAULT) -> DataFrame:
    """Unlabelled rows (date >= scoring start), target dropped."""
    return (loads(spark, sf_dir).filter(F.col(cfg.date_column) >= F.lit(cfg.scoring_start))
            .drop(cfg.target))


def kept_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``loads`` for a job that reads it more than once: the star join runs once and its rows are read back from the
    shared folder (a session that has materialised ``loads`` reads that copy)."""
    rows = loads(spark, sf_dir)
    return rows if spark.conf.get(MATERIALIZE_CONF, "false") == "true" else _joined(rows, "loads")


def _joined(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` of the star join, written; the shuffles of the join are several times as large and go at once."""
    out = written(rows, name)
    release(rows.sparkSession)
    return out


@dataclass(frozen=True)
class Windows:
    """The date windows of one frame of loads (``train``, ``holdout``, ``development`` and ``scoring`` above); with
    ``train_columns`` the training rows hold only these."""

    rows: DataFrame
    cfg: JobConfig = DEFAULT
    train_columns: tuple[str, ...] | None = None
    own_holdout: DataFrame | None = None  # the holdout, where ``rows`` lacks some of its columns

    def _before(self, end) -> DataFrame:
        return self.rows.filter(F.col(self.cfg.date_column) < F.lit(end))

    @property
    def train(self) -> DataFrame:
        rows = self._before(self.cfg.holdout_start)
        return rows.select(*self.train_columns) if self.train_columns else rows

    @property
    def holdout(self) -> DataFrame:
        if self.own_holdout is not None:
            return self.own_holdout
        return self._before(self.cfg.scoring_start).filter(F.col(self.cfg.date_column) >= F.lit(self.cfg.holdout_start))

    @property
    def development(self) -> DataFrame:
        if self.train_columns:
            raise ValueError("the training rows of these windows hold only some columns")
        return self._before(self.cfg.scoring_start)

    @property
    def scoring(self) -> DataFrame:
        return self.rows.filter(F.col(self.cfg.date_column) >= F.lit(self.cfg.scoring_start)).drop(self.cfg.target)


def kept_windows(spark: SparkSession, sf_dir: str, cfg: JobConfig = DEFAULT, scoring: bool = False) -> Windows:
    """Windows over one written copy of the star join, for jobs that read them more than once; without ``scoring`` only
    development rows are written."""
    if scoring or spark.conf.get(MATERIALIZE_CONF, "false") == "true":
        return Windows(kept_loads(spark, sf_dir), cfg)
    return Windows(_joined(development(spark, sf_dir, cfg), "windows"), cfg)


# The columns' texts in ``LOADS_TEMPLATE`` over plain column names (``cn_``, ``sn_``: nation of the customer, of the supplier).
_TEXTS = {name: re.sub(r"\b[cs]n\.n_", lambda m: m[0][:2] + "_", text) for text, name in re.findall(
    rf"\s*(.*?) AS ({'|'.join(LOADS_COLUMNS)})(?:,\n|$)", LOADS_TEMPLATE[len("\nSELECT"):LOADS_TEMPLATE.index("\nFROM {lineitem}")], re.DOTALL)}
# What they take from ``l_returnflag``, ``l_linenumber = 7`` and the fourfold rate, lines carry as one number.
_KIND = """CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END + CASE WHEN l_suppkey % 100 = 13 AND l_partkey % 2 = 0 THEN 4 ELSE 0 END
  + CASE WHEN l_linenumber = 7 THEN 8 ELSE 0 END"""
for _old, _new in ((r"\b[locsp]\.", ""), ("l_suppkey % 100 = 13 AND l_partkey % 2 = 0", "l_kind & 4 = 4"), ("l_linenumber = 7", "l_kind & 8 = 8"),
                   ("l_returnflag", "elt(l_kind & 3, 'A', 'N', 'R')")):
    _TEXTS = {name: re.sub(_old, _new, text) for name, text in _TEXTS.items()}


def _inputs(names) -> set[str]:
    return {c for n in names for c in re.findall(r"\b(?:[locsp]|[cs]n)_\w+", _TEXTS[n])}


def _odd_matches(rows: DataFrame, key: str, table: DataFrame, own: str, nation: DataFrame) -> DataFrame | None:
    """Keys of ``rows`` with no match, or several, in an inner join with ``table`` and its nation, and how many (``__m``); None
    if each key has one match, so that a job that reads no column of the table need not shuffle ``rows`` by the key."""
    named = table.join(nation, F.col(f"{own[0]}_nationkey") == F.col("n_nationkey"))
    times = named.groupBy(F.col(own).alias("__k")).agg(F.count(F.lit(1)).alias("__m"))
    found = rows.select(F.col(key).alias("__key")).filter(F.col("__key").isNotNull()).distinct().join(times, F.col("__key") == F.col("__k"), "left")
    odd = written(found.select("__key", F.coalesce("__m", F.lit(0)).alias("__m")).filter("__m <> 1"), "matches")
    return None if odd.isEmpty() else odd


def _with_matches(rows: DataFrame, key: str, odd: DataFrame | None, out: str) -> DataFrame:
    """``rows`` with a key, and where it does not always have one match, their number as ``out``."""
    rows = rows.filter(F.col(key).isNotNull())
    if odd is None:
        return rows
    return rows.join(odd, F.col(key) == F.col("__key"), "left").withColumn(out, F.coalesce("__m", F.lit(1)).cast("int")).drop("__key", "__m")


def _named(table: DataFrame, nation: DataFrame, own: str, prefix: str, *columns: str) -> DataFrame:
    """Customers or suppliers with their nation's key and name."""
    joined = table.join(nation, F.col(f"{own[0]}_nationkey") == F.col("n_nationkey"))
    return joined.select(own, *columns, F.col("n_nationkey").alias(f"{prefix}_nationkey"), F.col("n_name").alias(f"{prefix}_name"))


def _narrow_windows(t: dict[str, DataFrame], train: list[str], names: list[str], cfg: JobConfig) -> Windows:
    """``kept_columns`` from the driver tables.  Lines are shuffled by order and by part only: of customer and supplier, training
    rows need just the number of matches (``_odd_matches``), so only holdout orders meet customers and holdout rows suppliers.
    What only the holdout needs is dropped from training rows between the two shuffles."""
    day, since = F.col("o_orderdate"), F.lit(cfg.holdout_start)
    starting = lambda inputs, *prefixes: sorted(c for c in inputs if c.startswith(prefixes))
    last = [n for n in names if starting(_inputs([n]), "sn_")]
    now = [n for n in names if n not in last]
    raw = sorted({*starting(_inputs(last), "l_", "o_"), "l_suppkey"}) if last else []
    used = _inputs(now) | {*raw}
    customer = starting(used, "c_", "cn_")
    lines = t["lineitem"].withColumn("l_kind", F.expr(_KIND))
    lines = _with_matches(lines, "l_suppkey", _odd_matches(lines, "l_suppkey", t["supplier"], "s_suppkey", t["nation"]), "__s")
    lines = lines.select(*sorted({*starting(used, "l_"), "l_orderkey", "l_partkey"}), *[c for c in lines.columns if c == "__s"])
    orders = t["orders"].withColumn("o_orderdate", F.expr(_TEXTS[cfg.date_column])).filter(day < F.lit(cfg.scoring_start))
    own = ["o_orderkey", "o_orderdate"]
    if customer:
        named = _named(t["customer"], t["nation"], "c_custkey", "cn", "c_acctbal")
        held = orders.filter(day >= since).join(named, F.col("o_custkey") == F.col("c_custkey")).select(*own, *customer)
        orders = orders.filter(day < since)
    orders = _with_matches(orders, "o_custkey", _odd_matches(orders, "o_custkey", t["customer"], "c_custkey", t["nation"]), "__c")
    orders = orders.select(*own, *[c for c in orders.columns if c == "__c"])
    if customer:
        orders = orders.unionByName(held, allowMissingColumns=True)
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    # Copies of a line: the matches of the tables it is not joined with.
    times = F.lit(1)
    if "__s" in rows.columns:
        times = times * (F.when(day >= since, F.lit(1)).otherwise(F.col("__s")) if last else F.col("__s"))
    if "__c" in rows.columns:
        times = times * F.coalesce("__c", F.lit(1))
    if odd := bool({"__s", "__c"} & {*rows.columns}):
        rows = rows.withColumn("__times", times)
    both = sorted((_inputs(train) | {"l_partkey", "o_orderdate"}) & {*rows.columns})
    late = sorted(used & {*rows.columns} - {*both})
    rows = rows.select(*both, *[F.when(day >= since, F.col(c)).alias(c) for c in late], *["__times"] * odd)
    rows = rows.join(t["part"].select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    if odd:
        rows = rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__times"))))
    made = [(F.expr(_TEXTS[n]) if n in train else F.when(day >= since, F.expr(_TEXTS[n]))).alias(n) for n in now]
    kept = _joined(rows.select(*made, *[F.when(day >= since, F.col(c)).alias(c) for c in raw]), "windows")
    holdout = kept.filter(F.col(cfg.date_column) >= since)
    if last:
        holdout = holdout.join(_named(t["supplier"], t["nation"], "s_suppkey", "sn"), F.col("l_suppkey") == F.col("s_suppkey"))
        holdout = written(holdout.select(*[F.expr(_TEXTS[n]).alias(n) if n in last else n for n in names]), "holdout")
    return Windows(kept, cfg, tuple(train), holdout)


def kept_columns(spark: SparkSession, sf_dir: str, train: tuple[str, ...], holdout: tuple[str, ...],
                 cfg: JobConfig = DEFAULT) -> Windows:
    """``kept_windows`` of the named columns only, for jobs that need a few of the training rows: a column that only the
    holdout needs is neither made nor written for training rows."""
    d = F.col(cfg.date_column)
    rows = loads(spark, sf_dir)
    names = [c for c in rows.columns if c in {*train, *holdout, cfg.date_column}]
    if absent := {*train, *holdout} - set(names):
        raise KeyError(f"loads have no columns {sorted(absent)}")
    late = {*names} - {*train, cfg.date_column}
    star = getattr(rows, "star_tables", None)
    if star and not any(c.startswith(("c_", "cn_", "sn_")) for c in _inputs({*names} - late)):
        return _narrow_windows(star, [c for c in names if c not in late], names, cfg)
    rows = rows.filter(d < F.lit(cfg.scoring_start)).select(*[F.when(d >= F.lit(cfg.holdout_start), F.col(c)).alias(c) if c in late else c for c in names])
    kept = rows if spark.conf.get(MATERIALIZE_CONF, "false") == "true" else _joined(rows, "windows")
    return Windows(kept, cfg, tuple(c for c in names if c not in late))
