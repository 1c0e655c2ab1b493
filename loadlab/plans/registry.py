"""Registry of named jobs: Spark callable ``(spark, sf_dir) -> DataFrame`` plus
its DuckDB oracle SQL when the job is SQL-expressible."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

_JOBS: dict[str, Job] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Job) -> Job:
        if name in _JOBS:
            raise ValueError(f"duplicate job name {name!r}")
        _JOBS[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return wrap


def _load_all() -> None:
    # Importing the job modules fills the registry.
    from loadlab.plans import jobs_core, jobs_encode, jobs_errors, jobs_inference, jobs_models, jobs_quality, jobs_splits, jobs_stats, jobs_streaming  # noqa: F401


def jobs() -> dict[str, Job]:
    _load_all()
    return dict(_JOBS)


def sqls() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
