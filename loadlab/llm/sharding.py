"""Shard placement through a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size (a start and a
step from the hash of its name; a prime size makes every step visit all slots).  Shards
take turns, each claiming its most preferred slot that is still free, until the table is
full.  Each shard owns ``size / shards`` slots to within one turn, and removing a shard
moves little besides its own slots.  A row's shard is a hash of its key modulo the table size,
looked up in the broadcast table: constant time, no shuffle.

The table is built from the shard names alone (at most ``MAX_SLOTS`` entries whatever the
data), so broadcasting it is bounded.  Placement is a projection plus a broadcast hash join.

Hot keys: rows of one key share a slot by definition.  ``place`` takes several key
columns; adding a row id (or any column that varies) spreads a key that holds a large
part of the rows over all shards.  ``write_sharded`` splits a shard's rows over
``files_per_shard`` tasks by a second hash, so no task has to take a whole hot shard.

Defined results: null key parts hash as a marker of their own (unlike the empty string);
repeated rows, ties and equal keys go to the same shard; keys of any length are hashed whole; an empty
table gives no rows; input columns named like the results, in any case, are replaced by ``place``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlab.llm.common import hex_to_long

MAX_SLOTS = 1 << 20
SHARDS, SLOTS = 32, 3203  # prime and over 100 slots a shard: shares differ by under one percent


def preference(name: str, slots: int) -> tuple[int, int]:
    """Start and step of a shard's walk over the slots."""
    digest = hashlib.md5(name.encode()).hexdigest()
    return int(digest[:15], 16) % slots, int(digest[15:30], 16) % (slots - 1) + 1


def fill(names: list[str], slots: int = SLOTS) -> list[int]:
    """The lookup table: slot -> index of the shard in ``names``."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be distinct and at least one")
    if not len(names) <= slots <= MAX_SLOTS or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError(f"the table size must be a prime from the number of shards to {MAX_SLOTS}")
    walks = [preference(n, slots) for n in names]
    owner, at, claimed = [-1] * slots, [0] * len(names), 0
    while True:
        for i, (start, step) in enumerate(walks):
            while owner[slot := (start + at[i] * step) % slots] >= 0:
                at[i] += 1
            owner[slot] = i
            claimed += 1
            if claimed == slots:
                return owner


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i}" for i in range(n)]


def lookup(spark: SparkSession, owner: list[int]) -> DataFrame:
    """``slot, shard`` rows from one literal (no Python rows enter the plan)."""
    packed = F.split(F.lit(",".join(map(str, owner))), ",")
    return spark.range(1).select(F.posexplode(packed).alias("slot", "shard")).select(
        F.col("slot").cast("long").alias("slot"), F.col("shard").cast("int").alias("shard"))


def slot_of(keys: list[Column], slots: int) -> Column:
    parts = [F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit("~")) for k in keys]
    return F.pmod(hex_to_long(F.md5(F.concat_ws("\x1f", *parts)), 1, 15), F.lit(slots))


def place(df: DataFrame, keys: list[str], names: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (index into ``names``)."""
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")], slot_of([F.col(k) for k in keys], slots).alias("slot"))
    return kept.join(F.broadcast(lookup(df.sparkSession, fill(names, slots))), "slot")


def write_sharded(df: DataFrame, keys: list[str], names: list[str], path: str, files_per_shard: int = 1,
                  slots: int = SLOTS) -> None:
    """Write ``df`` as one folder per shard under ``path``."""
    placed = place(df, keys, names, slots)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c.lower() not in ("slot", "shard")]), F.lit(files_per_shard))
    placed.repartition(len(names) * files_per_shard, "shard", spread).write.partitionBy("shard").parquet(path)


def placed_documents(docs: DataFrame) -> DataFrame:
    """Every document's slot and shard."""
    return place(docs.select("doc_id"), ["doc_id"], shard_names()).select("doc_id", "slot", "shard")


# The same fill turn by turn: ``free`` holds the slots not yet claimed, ``s`` the shard whose turn it is.
PLACED_SQL = f"""
WITH RECURSIVE walk AS (
  SELECT i, CAST('0x' || substr(md5('shard-' || i), 1, 15) AS BIGINT) % {SLOTS} AS a,
    CAST('0x' || substr(md5('shard-' || i), 16, 15) AS BIGINT) % {SLOTS - 1} + 1 AS b FROM range({SHARDS}) r(i)),
pref AS (SELECT i, list((a + j * b) % {SLOTS} ORDER BY j) AS slots FROM walk, range({SLOTS}) q(j) GROUP BY i),
turn AS (
  SELECT 0 AS t, CAST(-1 AS BIGINT) AS slot, list_transform(range({SLOTS}), lambda x: false) AS taken
  UNION ALL
  SELECT t + 1, got, list_concat(list_concat(taken[1:got], [true]), taken[got + 2:]) FROM (
    SELECT t, taken, list_filter(p.slots, lambda x: NOT taken[x + 1])[1] AS got
    FROM turn JOIN pref p ON p.i = t % {SHARDS} WHERE t < {SLOTS}))
SELECT d.doc_id, d.slot, CAST((t.t - 1) % {SHARDS} AS INTEGER) AS shard
FROM (SELECT doc_id, CAST('0x' || substr(md5(coalesce('=' || doc_id, '~')), 1, 15) AS BIGINT) % {SLOTS} AS slot FROM documents) d
JOIN turn t ON t.slot = d.slot
"""
