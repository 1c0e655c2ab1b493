"""The corpus pipeline: toxicity, line dedup, near-duplicate removal, mixing, BPE.

``STAGES`` are (name, function) pairs; a function takes ``(spark, docs, sf_dir)`` and returns
a DataFrame.  All but the last return rows with the columns of ``documents``; what a stage returns
is written as Parquet and read again as the next one's ``docs``.  Each stage works on all rows
that the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlab.llm import bpe, line_dedup, mixing, neardup, toxicity
from loadlab.llm.common import cut, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the toxicity threshold (fitted on the labels of the tables)."""
    return toxicity.rejected_removed(docs, table(spark, sf_dir, "labels"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand in several; ``n_chars`` follows the text."""
    out = line_dedup.deduplicate(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return neardup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return bpe.digests(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# SQL has no form for the fitted classifier, the components and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
