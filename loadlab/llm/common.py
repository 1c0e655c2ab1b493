"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlab.session import checkpoint_dir

# The six characters that separate words, as a Java / RE2 class body (fixed by the contracts).
WHITE = r"\x20\x09-\x0D"
WORD = rf"[^{WHITE}]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"

_CUTS: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    The lineage ends here, so losing an executor costs no recomputation of what lies
    above, a table used twice is computed once, and the planner knows the table's real
    size (it broadcasts it only under ``spark.sql.autoBroadcastJoinThreshold``).
    The folder is removed when the process ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/loadlab-llm-{name}-{uuid.uuid4().hex}"
    if not _CUTS:
        atexit.register(_remove_cuts)
    _CUTS.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove_cuts() -> None:
    for spark, path in _CUTS:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session has ended; its owner clears the shared folder
            return


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, giving its memory back to the system when its task ends.

    Python workers live on and serve later tasks, several at a time in an executor, so what they keep adds up.
    """

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return whole


def slices(batch: pa.RecordBatch, column: int, chars: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch holding at most about ``chars`` bytes of text (one row at least)."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield batch.slice(start)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores until ``df`` has no such column (names are case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def word_count(col: Column) -> Column:
    """Words of a text (runs of non-separators) without building them: a word ends where a
    non-separator is followed by a separator or the end."""
    return F.regexp_count(col, F.lit(WORD)).cast("long")


def hex_to_long(col: Column, start: int, digits: int) -> Column:
    """``digits`` (at most 15) hex digits of ``col`` from 1-based ``start`` as a bigint."""
    return F.conv(F.substring(col, start, digits), 16, 10).cast("bigint")
