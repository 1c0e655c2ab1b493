"""SimHash fingerprints of texts, and a search of all fingerprints within a Hamming radius.

A text's terms are its pairs of neighbouring words, the first word paired with a mark before it and the last with
one after it, so that a text of one word (or none) has terms too.  Each occurrence of a term votes: every bit of the
term's 128-bit hash that is set counts for that bit of the fingerprint, every other against it; the majority
decides (a tie is 0).  A term's weight is therefore its number of occurrences.

``within`` finds all fingerprints at most ``RADIUS`` bits from given ones.  A fingerprint is cut into ``BLOCKS``; two
within the radius agree on at least ``len(BLOCKS) - RADIUS`` of them, here two, so each fingerprint is
posted once for every pair of blocks (a permuted table with these blocks in front) under their bits as key, and an
equi-join per table meets every near pair.  A pair is kept in the first table only in which it meets.

Scale: one shuffle of the texts.  Rows are dealt into buckets of neighbouring doc_ids, whose borders come from
quantiles of the ids; the first row of a bucket also goes to the bucket before it, so that a document meets the one after it
without any window over all rows.  Terms are exploded and voted on within their row's bucket: 64 sums over
two 32-bit counters each, no further shuffle, and a text of any length streams through them.  The driver holds a
few numbers a bucket (``BUCKETS_A_PARTITION`` times the shuffle partitions).  Native DataFrame operations only.

Defined results: null text is the empty text; all empty texts, and texts of white space, have the same
fingerprint; texts of any length count whole.  Documents are ordered by descending doc_id, null last, and rows that share a
doc_id (they stay in one bucket) by the hash of their text; repeated rows each have a row of their own.
The only row of a table is followed by itself.  An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlab.llm.common import WHITE, cut, text_or_empty

BITS, RADIUS = 128, 5
# (word of the fingerprint, first bit, bits) of each block.
BLOCKS = (("hi", 0, 21), ("hi", 21, 21), ("hi", 42, 22), ("lo", 0, 16), ("lo", 16, 16), ("lo", 32, 16), ("lo", 48, 16))
BUCKETS_A_PARTITION = 4
_NO_ID = -(1 << 63)
_LANES, _PAIR = 32, (1 << 32) | 1


def terms(text: Column) -> Column:
    """Hashes of a text's pairs of neighbouring words, repeats included."""
    words = F.filter(F.split(text, f"[{WHITE}]+", -1), lambda w: w != "")
    return F.zip_with(F.concat(F.array(F.lit("\x02")), words), F.concat(words, F.array(F.lit("\x03"))), lambda a, b: F.xxhash64(a, b))


def voted(rows: DataFrame, key: list[str], carried: list[str]) -> DataFrame:
    """``key``, ``carried``, ``hi``, ``lo``: the fingerprint of each row's ``text``; ``key`` names the row."""
    each = rows.select(*key, *carried, F.explode(terms(F.col("text"))).alias("hi"))
    each = each.withColumn("lo", F.xxhash64(F.col("hi"), F.lit(1)))
    # One sum counts two bits: bit b in its lower half, bit b + 32 in its upper half.
    counters = [F.sum(F.shiftrightunsigned(w, b).bitwiseAND(F.lit(_PAIR))).alias(f"{w}{b}") for w in ("hi", "lo") for b in range(_LANES)]
    counted = each.groupBy(*key, *carried).agg(F.count(F.lit(1)).alias("n"), *counters)

    def word(w: str) -> Column:
        low = [F.when(F.col(f"{w}{b}").bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("n"), F.lit(1 << b)).otherwise(F.lit(0)) for b in range(_LANES)]
        high = [F.when(F.shiftrightunsigned(f"{w}{b}", 32) * 2 > F.col("n"), F.lit(_signed(1 << (b + 32)))).otherwise(F.lit(0)) for b in range(_LANES)]
        return reduce(Column.bitwiseOR, [c.cast("long") for c in low + high])
    return counted.select(*key, *carried, word("hi").alias("hi"), word("lo").alias("lo"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def distance(a: str, b: str) -> Column:
    """Hamming distance of the fingerprint structs ``a`` and ``b``."""
    return F.bit_count(F.col(f"{a}.hi").bitwiseXOR(F.col(f"{b}.hi"))) + F.bit_count(F.col(f"{a}.lo").bitwiseXOR(F.col(f"{b}.lo")))


def likeness(a: str, b: str) -> Column:
    """Share of the bits in which two fingerprints agree."""
    return F.lit(1.0) - distance(a, b).cast("double") / BITS


def hexed(fp: str) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(F.col(f"{fp}.{w}"))), 16, "0") for w in ("hi", "lo")])


def bucket_heads(docs: DataFrame) -> list[int]:
    """The largest doc_id of each bucket, descending; a bucket holds the ids down to the next one's head."""
    n = BUCKETS_A_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"))
    cuts = ids.agg(F.percentile_approx("id", [i / n for i in range(1, n + 1)], 20 * n).alias("c")).first()["c"]
    if not cuts:
        return []
    # The quantiles may be rounded; the largest id up to each one is a real head.
    bucket = _place(F.col("id"), sorted(set(cuts), reverse=True))
    heads = ids.groupBy(bucket.alias("b")).agg(F.max("id").alias("id")).collect()
    return sorted((r["id"] for r in heads), reverse=True)


def _place(x: Column, heads: list[int]) -> Column:
    """Number of ``heads`` (descending) after the first that are at least ``x``, found in two steps."""
    width = max(1, int(len(heads) ** 0.5))
    runs = [heads[i:i + width] for i in range(0, len(heads), width)]
    count = lambda a: F.size(F.filter(a, lambda c: c >= x))
    run = F.greatest(count(F.lit([r[0] for r in runs])) - 1, F.lit(0))
    return F.greatest(run * width + count(F.get(F.lit(runs), run)) - 1, F.lit(0))


def with_next(docs: DataFrame, heads: list[int], key: str, value: str, out: str, tie: Column) -> DataFrame:
    """``docs`` with ``bucket``, ``rank`` (in its bucket) and ``out``: ``value`` of the row after it in descending ``key``."""
    last = len(heads) - 1
    own = _place(F.col(key), heads)
    # A bucket's first id goes to the bucket before it as well, and the very first to the last one.
    again = F.when(F.col(key) == heads[0], F.lit(last)).when(F.array_contains(F.lit(heads), F.col(key)), own - 1)
    places = F.array_compact(F.array(F.struct(own.alias("bucket"), F.lit(0).alias("halo")), F.when(again.isNotNull(), F.struct(
        again.alias("bucket"), F.lit(1).alias("halo")))))
    order = Window.partitionBy("bucket").orderBy("halo", F.desc(key), "tie")
    d = docs.withColumn("tie", tie).withColumn("place", F.explode(places)).select(*docs.columns, "tie", "place.*")
    d = d.withColumn(out, F.lead(value).over(order)).withColumn("rank", F.row_number().over(order))
    return d.filter("halo = 0").drop("halo", "tie")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Per row: ``id`` (doc_id, null as the smallest), ``n_chars``, ``edited_sha256``, and the fingerprints (structs
    ``hi``, ``lo``) of the text, ``own``, of its edited text, ``edited``, and of the next document, ``next``."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id")
    heads = bucket_heads(docs)
    if not heads:
        return docs.sparkSession.createDataFrame([], "doc_id long, id long, n_chars long, edited_sha256 string, own struct<hi:bigint,lo:bigint>, "
                                                 "edited struct<hi:bigint,lo:bigint>, next struct<hi:bigint,lo:bigint>")
    d = docs.select("doc_id", key, text_or_empty().alias("text"))
    d = with_next(d, heads, "id", "text", "after", F.xxhash64("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("after", F.lit(1), half))
    d = d.select("bucket", "rank", "doc_id", "id", F.xxhash64("text").alias("tie"), n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    d = d.withColumn("edited_sha256", F.sha2("edited", 256))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text"))))
    carried = ["doc_id", "id", "tie", "n_chars", "edited_sha256"]
    d = d.select("bucket", "rank", *carried, sides.alias("s")).select("bucket", "rank", *carried, "s.*")
    votes = voted(d, ["bucket", "rank", "side"], carried)
    side = lambda s: F.struct(*[F.max(F.when(F.col("side") == s, F.col(w))).alias(w) for w in ("hi", "lo")])
    prints = votes.groupBy("bucket", "rank", *carried).agg(side(0).alias("own"), side(1).alias("edited"))
    prints = cut(prints.drop("bucket", "rank"), "simhash-prints")
    return with_next(prints, heads, "id", "own", "next", F.col("tie")).drop("bucket", "rank", "tie")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Per row: digests of the edited text, fingerprints, and their likeness."""
    return fingerprinted(docs).select("doc_id", "n_chars", "edited_sha256", hexed("own").alias("fingerprint"), hexed("edited").alias("edited_fingerprint"),
                                      likeness("own", "edited").alias("near_edited"), likeness("own", "next").alias("near_next"))


def _tables(fp: str) -> Column:
    """One struct for each pair of blocks: their numbers and their bits, as one key."""
    bits = [F.shiftrightunsigned(f"{fp}.{w}", at).bitwiseAND(F.lit((1 << n) - 1)) for w, at, n in BLOCKS]
    agree = len(BLOCKS) - RADIUS
    assert agree == 2
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.shiftleft(bits[i], 22).bitwiseOR(bits[j]).alias("bits"))
                     for i, j in itertools.combinations(range(len(BLOCKS)), agree)])


def within(queries: DataFrame, prints: DataFrame) -> DataFrame:
    """All ``prints`` (column ``own``, a struct ``hi``, ``lo``) at most ``RADIUS`` bits from those of ``queries`` (``query_id``, ``own``): ``query_id``,
    ``own``, ``n`` (rows with that fingerprint) and ``bits`` apart.  Queries are a stated set, every fingerprint is indexed."""
    index = prints.groupBy("own").agg(F.count(F.lit(1)).alias("n")).select("own", "n", F.explode(_tables("own")).alias("t"))
    asked = queries.select("query_id", F.col("own").alias("asked")).select("query_id", "asked", F.explode(_tables("asked")).alias("t"))
    met = index.select("own", "n", "t.*").join(asked.select("query_id", "asked", "t.*"), ["i", "j", "bits"])
    same = [F.shiftrightunsigned(F.col(f"own.{w}").bitwiseXOR(F.col(f"asked.{w}")), at).bitwiseAND(F.lit((1 << n) - 1)) == 0 for w, at, n in BLOCKS]
    agreed = F.array_compact(F.array(*[F.when(s, F.lit(k)) for k, s in enumerate(same)]))
    first = (F.get(agreed, F.lit(0)) == F.col("i")) & (F.get(agreed, F.lit(1)) == F.col("j"))
    return met.filter((distance("own", "asked") <= RADIUS) & first).select("query_id", "own", "n", distance("own", "asked").alias("bits"))
