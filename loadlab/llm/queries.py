"""Registered queries of the training-data operators: name -> (function, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadlab.llm import bpe, chat, line_dedup, merkle, mixing, neardup, quality, sharding, simhash, spelling, token_counts, topk, toxicity
from loadlab.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(table(spark, sf_dir, name))
    return run


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_sharding": (_over("documents", sharding.placed_documents), sharding.PLACED_SQL),
    "op2_toxicity": (_toxicity, None),
    "op3_token_counts": (_over("documents", token_counts.document_lengths), None),
    "op4_near_dedup": (_over("documents", neardup.marked), None),
    "op5_line_dedup": (_over("documents", line_dedup.line_digests), line_dedup.LINES_SQL),
    "op6_quality": (_over("documents", quality.verdicts), quality.QUALITY_SQL),
    "op7_mixing": (_over("documents", mixing.taken_words), mixing.TAKEN_SQL),
    "op8_chat": (_over("conversations", chat.digests), chat.CHAT_SQL),
    "op9_topk": (_over("embeddings", topk.nearest), topk.TOPK_SQL),
    "op10_bpe": (_over("documents", bpe.digests), None),
    "op11_merkle": (_over("documents", merkle.verified), merkle.MANIFEST_SQL),
    "op12_simhash": (_over("documents", simhash.edited_likeness), None),
    "op13_spelling": (_over("documents", spelling.variants), spelling.VARIANTS_SQL),
}
