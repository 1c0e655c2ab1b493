"""Guards without jobs of their own.

A guard counts faults while the frame passes through whatever job its consumer runs (``DataFrame.observe``), and raises
after that job:

    with Guards() as guards:
        clean = guards.watch(rows, unreadable_dates("date"), not_numbers("distance"))
        clean.write.parquet(path)          # the only job

What the job wrote is in place when the error comes, so the block should end before anything relies on it.
A watched frame has to be read inside the block: without a job there is nothing to check, which is an error too.
The checks that run a job of their own (``cleaning.assert_dates_parsed`` and others) remain for frames that no job reads.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as NotRead

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loadlab.config import DEFAULT, JobConfig
from loadlab.functions.cleaning import coerce_number, is_finite, parse_date

Check = dict[str, Column]
WAIT = 60.0  # seconds for the metrics of a finished job to arrive


def unreadable_dates(column: str) -> Check:
    """dates missing or not readable."""
    return {f"{column}: no date": F.count_if(F.col(column).isNull() | parse_date(column).isNull())}


def not_numbers(column: str) -> Check:
    """Values missing, not numeric or not finite."""
    return {f"{column}: no finite number": F.count_if(~is_finite(coerce_number(column)))}


def nulls(columns: list[str]) -> Check:
    """NULL and NaN in each of the (double) columns."""
    return {f"{c}: null": F.count_if(F.col(c).isNull() | F.isnan(c)) for c in columns}


def split_sides(cfg: JobConfig = DEFAULT) -> Check:
    """A side of the temporal split without rows."""
    before = F.col(cfg.date_column) < F.lit(cfg.holdout_start)
    empty = lambda side: F.when(F.count_if(F.coalesce(side, F.lit(False))) == 0, 1).otherwise(0)
    return {"train: empty": empty(before), "holdout: empty": empty(~before)}


def unmatched(columns: list[str]) -> Check:
    """Looked-up columns without a match."""
    return {f"{c}: not found": F.count_if(F.col(c).isNull()) for c in columns}


class Guards:
    """Checks that ride on the jobs run inside the ``with`` block."""

    def __init__(self):
        self._watched: list[tuple[Observation, list[str]]] = []

    def watch(self, df: DataFrame, *checks: Check) -> DataFrame:
        """``df``, its faults counted by the first job that reads it."""
        every = {label: count for check in checks for label, count in check.items()}
        seen = Observation()
        self._watched.append((seen, list(every)))
        return df.observe(seen, *[count.cast("long").alias(f"c{i}") for i, count in enumerate(every.values())])

    def counts(self) -> dict[str, int]:
        """Faults by check, after the jobs."""
        out: dict[str, int] = {}
        for seen, labels in self._watched:
            # Reading the metrics of a frame that no job has read would wait for ever.
            pool = ThreadPoolExecutor(1)
            try:
                found = pool.submit(lambda seen=seen: seen.get).result(timeout=WAIT)
            except NotRead:
                raise RuntimeError(f"no job has read the frame watched for {labels}") from None
            finally:
                pool.shutdown(wait=False)
            out |= {label: found.get(f"c{i}") or 0 for i, label in enumerate(labels)}
        return out

    def __enter__(self) -> Guards:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            faults = {label: n for label, n in self.counts().items() if n}
            if faults:
                raise ValueError("; ".join(f"{label} ({n})" for label, n in faults.items()))
