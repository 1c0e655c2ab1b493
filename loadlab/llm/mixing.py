"""Mixing sources to target weights.

Tokens (words) are summed per source, weights become targets, targets become repetition
rates, and every document is emitted ``floor(rate)`` times plus one more time when a
draw seeded by the hash of its id falls under the rate's fraction.

* Targets: source ``i`` should hold ``weight_i / sum(weights)`` of all words, but at most
  ``max_repeat`` times its own size; what is cut off is shared again by weight until no
  source is above its limit.  That fixed point is found in one pass over the per-source
  rows ordered by ``limit / weight`` (running sums), not by iterating.
* Draws: a Bernoulli draw per document has the right mean but a spread that matters for
  small sources.  ``DRAWS`` independent hash seeds are summed per source in one more
  aggregate and each source uses the seed whose sum lies nearest its target: still one
  hash-seeded draw per document, the same on every run.

Scale: documents are never shuffled.  Two map-side combined aggregates on ``source`` (a
source with a third of all rows costs one partial row per task) and one join of the
documents with the per-source table, which is written first so that the planner
broadcasts it only when its real size allows and AQE splits a skewed source otherwise.

Defined results: null text has size 0; a null source is a source of its own, last in
order; rows without ``doc_id`` draw by the hash of their text; repeated rows draw alike;
a source of size 0 has target 0 and is not emitted; an empty table gives an empty result.
Other columns are kept by ``mix``; working columns take names that the input does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlab.llm.common import cut, hex_to_long, text_or_empty, unused, word_count

DRAWS = 8


def cycle_weights(position: Column) -> Column:
    """Weights 1, 2, 3, 1, ... by 0-based source position."""
    return (position % 3 + 1).cast("long")


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(text_or_empty())))
    return docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"),
                       F.sha2(F.concat(F.lit(f"{seed}:"), key), 256).alias("draw"))


def _draw(j: int) -> Column:
    return hex_to_long(F.col("draw"), 8 * j + 1, 8) / F.lit(4294967296.0)


def source_plan(sized: DataFrame, max_repeat: int, weights=cycle_weights) -> DataFrame:
    """Per source: size, weight, target, rate (one small row per source)."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on; the order of sources needs a single sequence.
    per = per.withColumn("weight", weights(F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1))
    per = per.withColumn("limit_", F.col("source_size") * max_repeat)
    order = Window.orderBy(F.col("limit_") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("total", F.sum("source_size").over(everything))
           .withColumn("before", F.coalesce(F.sum("limit_").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("open_weight", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("full", F.col("limit_") * F.col("open_weight") <= F.col("weight") * (F.col("total") - F.col("before"))))
    per = (per.withColumn("used", F.coalesce(F.sum(F.when(F.col("full"), F.col("limit_"))).over(everything), F.lit(0)))
           .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)))
    share = F.col("weight") * ((F.col("total") - F.col("used")).cast("double") / F.col("open"))
    target = F.when(F.col("full"), F.col("limit_").cast("double")).otherwise(share)
    return (per.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
            .select("source", "source_size", "weight", "target", "rate"))


def ledger(docs: DataFrame, max_repeat: int = 3, seed: int = 7, weights=cycle_weights) -> DataFrame:
    """Per row of ``docs``: ``doc_id, source, size, source_size, target, rate, copies``."""
    sized = cut(_sized(docs, seed), "mix-sized")
    plan = cut(source_plan(sized, max_repeat, weights), "mix-plan")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    s, p = sized.alias("s"), plan.alias("p")
    rated = s.join(p, F.col("s.source").eqNullSafe(F.col("p.source")), "left").select(
        "s.*", "p.source_size", "p.target", "p.rate")
    base, frac = F.floor("rate"), F.col("rate") - F.floor("rate")
    sums = rated.groupBy("source").agg(
        F.first("target").alias("target"),
        *[F.sum(F.col("size") * (base + F.when(_draw(j) < frac, 1).otherwise(0))).alias(f"d{j}") for j in range(DRAWS)])
    gaps = F.array(*[F.abs(F.col(f"d{j}") - F.col("target")) for j in range(DRAWS)])
    pick = cut(sums.select("source", (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int").alias("pick")), "mix-pick")
    plan = plan.join(pick, same(plan, pick), "left").select(plan["source"], "source_size", "target", "rate", "pick")
    plan = cut(plan, "mix-rates")
    p = plan.alias("p")
    out = s.join(p, F.col("s.source").eqNullSafe(F.col("p.source")), "left").select(
        "s.doc_id", "s.source", "s.size", "s.draw", "p.source_size", "p.target", "p.rate", "p.pick")
    u = F.conv(F.substring(F.col("draw"), 8 * F.col("pick") + 1, F.lit(8)), 16, 10).cast("bigint") / F.lit(4294967296.0)
    copies = (F.floor("rate") + F.when(u < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"), "draw", "pick")


def mix(docs: DataFrame, max_repeat: int = 3, seed: int = 7, weights=cycle_weights) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as many times as its copies, columns unchanged."""
    rates = (ledger(docs, max_repeat, seed, weights).groupBy("source")
             .agg(F.first("rate").alias("rate"), F.first("pick").alias("pick")))
    by, info, copy = unused(docs, "__source"), unused(docs, "__rate"), unused(docs, "__copy")
    rates = cut(rates, "mix-bysource").select(F.col("source").alias(by), F.struct("rate", "pick").alias(info))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(text_or_empty())))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    rate = F.col(info)["rate"]
    u = F.conv(F.substring(draw, 8 * F.col(info)["pick"] + 1, F.lit(8)), 16, 10).cast("bigint") / F.lit(4294967296.0)
    copies = (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    out = docs.join(rates, F.col("source").eqNullSafe(F.col(by)), "left")
    return out.select(*docs.columns, F.explode(F.sequence(F.lit(0), copies)).alias(copy)).filter(F.col(copy) > 0).drop(copy)


def taken_words(docs: DataFrame) -> DataFrame:
    return ledger(docs).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.col("copies")).cast("long").alias("taken"))


TAKEN_SQL = """
WITH s AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 't' || md5(coalesce(text, '')))) AS draw FROM documents),
p0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
p1 AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight, 3 * source_size AS cap FROM p0),
p2 AS (SELECT *, sum(source_size) OVER () AS total, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM p1),
p3 AS (SELECT *, cap * open_weight <= weight * (total - before) AS full_ FROM p2),
p4 AS (SELECT *, coalesce(sum(cap) FILTER (WHERE full_) OVER (), 0) AS used, sum(weight) FILTER (WHERE NOT full_) OVER () AS open FROM p3),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM (
  SELECT source, source_size, CASE WHEN full_ THEN CAST(cap AS DOUBLE) ELSE weight * (CAST(total - used AS DOUBLE) / CAST(open AS DOUBLE)) END AS target FROM p4)),
d AS (SELECT s.doc_id, s.source, s.size, p.source_size, p.target, j, floor(p.rate)
    + CASE WHEN CAST('0x' || substr(s.draw, 8 * j + 1, 8) AS BIGINT) / 4294967296.0 < p.rate - floor(p.rate) THEN 1 ELSE 0 END AS copies
  FROM s JOIN p ON s.source IS NOT DISTINCT FROM p.source, range(8) r(j)),
g AS (SELECT source, j, abs(sum(size * copies) - max(target)) AS gap FROM d GROUP BY source, j),
k AS (SELECT source, arg_min(j, gap * 16 + j * 1e-9) AS j FROM g GROUP BY source)
SELECT d.doc_id, d.size, d.source_size, d.target, CAST(d.size * d.copies AS BIGINT) AS taken
FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.j = k.j
"""
