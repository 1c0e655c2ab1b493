"""Lookup joins.

A fitted lookup (group -> rate, city -> coordinates, date -> market) is the
output of an aggregate over a large table, so its size is known only at run
time. ``bounded`` writes it to the shared checkpoint folder (the aggregate runs
once, nothing passes through the driver). Reading it back, the planner knows its
real size in bytes: under ``spark.sql.autoBroadcastJoinThreshold`` the join
broadcasts it and the large side is not shuffled; over it the join is a shuffle
join whose sides are both plain exchanges, which AQE can split where a key is hot.
"""

from __future__ import annotations

import gc
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loadlab.session import checkpoint_dir


def written(df: DataFrame, name: str = "lookup", file_rows: int = 0, options: dict | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back; files of at most ``file_rows`` rows, if given."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/loadlab-{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).option("maxRecordsPerFile", file_rows).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files of finished jobs now: it does so when the driver collects their plans, which on a large
    heap may be long after the disk is full (``spark.cleaner.periodicGC.interval``: half an hour)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Remove the files of a ``written`` frame that nothing reads any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.written_path)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@dataclass
class Lookup:
    df: DataFrame

    def join(self, left: DataFrame, on, how: str = "left") -> DataFrame:
        return left.join(self.df, on=on, how=how)


def bounded(df: DataFrame) -> Lookup:
    return Lookup(written(df))
