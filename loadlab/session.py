"""SparkSession helpers.

Jobs never create their own session: they take the caller's. ``get_session`` is
for tests, the bench and local scripts; on a cluster the submitter's session and
its ``spark.checkpoint.dir`` are used as they are.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on for results that equal the SQL oracle.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "loadlab") -> SparkSession:
    """Local session for tests and benchmarks (UI off, AQE on, UTC)."""
    master = master or os.environ.get("LOADLAB_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("LOADLAB_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LOADLAB_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Pin the session settings the jobs' semantics depend on."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """For jobs run inside: a projection of many columns is not one generated method, which the JVM would only interpret
    (it compiles methods of up to 8,000 bytes), but many small ones."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster's shared storage). Only a local
    session without the setting gets a scratch folder of its own; a cluster without it
    is an error, because executors would write where others cannot read.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="loadlab-ckpt-"))
    return context.getCheckpointDir()
