"""Exact histogram of encoded lengths and what follows from it for every context limit.

Documents are encoded (byte-level BPE ranks, path a parameter) and only their length is
kept; one map-side combined aggregate turns lengths into a histogram.  Sums over the
histogram from the long end (suffix sums) then answer, exactly and without going back to
the documents: totals, quantiles, and for every context limit how many documents are cut
and how many tokens are left or lost.  Between two lengths that occur the answers are
linear, so the rows of ``length_table`` hold the answer for every limit (``at_limits``).

Scale: encoding is map-only; the histogram has at most one row per distinct length.  The
suffix sums run inside blocks of ``BLOCK`` lengths in parallel, plus one short sequence of
block totals (longest length / ``BLOCK`` rows).

Defined results: null and empty texts have length 0 and count as documents; repeated rows
count each; an empty table gives an empty histogram.  Special-token strings in a text are
ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlab.llm.common import cut

BLOCK = 1024


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens`` of every row."""
    path = path or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for b in batches:
            n = np.fromiter((len(encode(t.as_py())) if t.is_valid else 0 for t in b.column(1)), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n)], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """``n_tokens, n_docs``: how many documents have each length."""
    return counted.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def length_table(hist: DataFrame) -> DataFrame:
    """One row per length ``L`` that occurs, all columns exact:

    ``n_docs`` of that length, ``docs_from`` / ``tokens_from`` documents of at least that
    length and their tokens, ``docs_cut`` longer documents, ``tokens_kept`` / ``tokens_lost``
    when every document is cut to ``L`` tokens, ``total_docs`` / ``total_tokens``.
    """
    h = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
                           F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
                           F.sum("d").over(all_).alias("total_docs"), F.sum("t").over(all_).alias("total_tokens"))
    here = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = (h.join(blocks, "block")
           .withColumn("docs_from", F.col("docs_after") + F.sum("n_docs").over(here))
           .withColumn("tokens_from", F.col("tokens_after") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(here))
           .withColumn("docs_cut", F.col("docs_from") - F.col("n_docs"))
           .withColumn("tokens_lost", F.col("tokens_from") - F.col("docs_from") * F.col("n_tokens"))
           .withColumn("tokens_kept", F.col("total_tokens") - F.col("tokens_lost")))
    return out.select("n_tokens", "n_docs", "docs_from", "tokens_from", "docs_cut", "tokens_kept", "tokens_lost",
                      "total_docs", "total_tokens")


def at_limits(lengths_table: DataFrame, limits: list[int]) -> DataFrame:
    """Per context limit: documents cut, tokens kept and lost (limits need not occur as lengths)."""
    over = lengths_table.select(F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context"), "*")
    longer: Column = F.col("n_tokens") > F.col("context")
    agg = over.groupBy("context").agg(
        F.coalesce(F.sum(F.when(longer, F.col("n_docs"))), F.lit(0)).alias("docs_cut"),
        F.coalesce(F.sum(F.when(longer, F.col("n_docs") * (F.col("n_tokens") - F.col("context")))), F.lit(0)).alias("tokens_lost"),
        F.max("total_tokens").alias("total_tokens"))
    return agg.select("context", "docs_cut", "tokens_lost", (F.col("total_tokens") - F.col("tokens_lost")).alias("tokens_kept"))


def quantiles(lengths_table: DataFrame, probs: list[float]) -> DataFrame:
    """The smallest length that at least a share ``p`` of the documents does not exceed."""
    p = lengths_table.select(F.explode(F.array(*[F.lit(float(x)) for x in probs])).alias("p"), "*")
    return p.filter(F.col("total_docs") - F.col("docs_cut") >= F.ceil(F.col("p") * F.col("total_docs"))).groupBy("p").agg(
        F.min("n_tokens").alias("n_tokens"))


def document_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    # Written once: the table below reads the histogram twice, and encoding is the whole cost.
    return length_table(cut(histogram(lengths(docs, path)), "token-lengths"))
